"""Registered queries ``op1_*`` to ``op13_*``: each applies one operator, with its
production parameters, to the whole table, and derives the contract's columns.

``SQL`` has the same result in DuckDB SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import bpe, decontaminate, embdedup, fixity, langid, linededup, lm, manifest, minhash, pii, quality, urlfilter, whitening
from shardloom.llm.common import fold, read

#: Documents with a lower score are rejected.
QUALITY_CUT = 0.3
TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of the public tokenizer (a path parameter, read on the driver)."""
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path(TOKENIZER_FILE)), public_tokenizers.PATTERN


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score_documents(docs, fold(F.col("doc_id"), 7) != 2)
    held_out = (~F.col("learned")).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    counts = [F.size(pii.of_kind("spans", k)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    base = F.sha2(pii.joined("spans", pii.BASE_KINDS), 256).alias("base_sha256")
    least = F.array_min(F.transform("spans", lambda s: s["score"])).alias("least_score")
    return found.select("doc_id", *counts, base, pii.joined("spans").alias("spans"), least)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), use=fold(F.col("doc_id"), 5) != 0)
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    predicted = F.when(F.col("score") >= QUALITY_CUT, 1).otherwise(0).alias("predicted")
    return quality.score(docs, model).select("doc_id", held_out, "score", predicted)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang"), use=fold(F.col("doc_id"), 5) != 0)
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = minhash.link_documents(read(spark, sf_dir, "documents"), k=3, threshold=85)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.select("doc_id", "n_shingles", "component_id", kept)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = linededup.dedup_report(read(spark, sf_dir, "documents").select("doc_id", "text"))
    lines, deleted, words = linededup.REPORT
    text = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return report.select(
        "doc_id", F.col(lines).alias("n_lines"), F.col(deleted).alias("n_deleted"), F.col(words).alias("n_words_deleted"), text
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = embdedup.link_vectors(read(spark, sf_dir, "embeddings"))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.select("vec_id", "n_links", "component_id", kept)


def replicas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two copies of the pages' WARC files, each damaged by a fixed rule on the
    page id: the first lacks some records, the second lacks others and has
    others with their last bytes changed (the lengths stay)."""
    records = fixity.warc_records(read(spark, sf_dir, "pages"))
    page = F.col("page_id")
    broken = F.concat(F.expr("substring(payload, 1, length(payload) - 4)"), F.lit("#\n\r\n"))
    stored = F.when(page % 53 == 7, broken).otherwise(F.col("payload"))
    digests = [fixity.digest(F.col("payload")).alias("whole"), fixity.digest(stored).alias("stored")]
    laid = fixity.lay_out(records.select("file", "page_id", "length", *digests))
    kept = F.coalesce(page % 197 != 11, F.lit(True)), F.coalesce(page % 101 != 13, F.lit(True))
    first, second = (
        laid.where(k).select("file", "offset", "length", F.col(d).alias("digest")) for k, d in zip(kept, ("whole", "stored"), strict=True)
    )
    return first, second


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixity.audit(*replicas(spark, sf_dir))
    lengths = [F.coalesce(f"length_{s}", F.lit(-1)).alias(f"length_{s}") for s in "ab"]  # -1: not there
    digests = [F.coalesce(f"digest_{s}", F.lit("")).alias(f"digest_{s}") for s in "ab"]
    return found.select("file", "offset", *lengths, *digests, "status")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, ranks, pattern, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_sha256("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    n_soft = F.size("soft_terms").cast("long").alias("n_soft")
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("strict_hits").alias("n_strict"), n_soft, "weight")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(vectors, whitening.fit(vectors))
    deviation = F.expr("try_cast(deviation AS bigint)").alias("deviation")  # null beyond a long
    each = white.select("vec_id", "n", deviation, F.posexplode("whitened").alias("at", "whitened"), "explained", "identity_error")
    component = (F.col("at") + 1).alias("component")
    return each.select("vec_id", component, "n", "deviation", "whitened", F.expr("explained[at]").alias("explained"), "identity_error")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in docs.columns]
    cut = F.when(fold(F.col("doc_id"), 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    carry = {"doc_id": F.col("doc_id"), "stored": manifest.leaf([*fields[:-1], cut])}
    built = manifest.build(docs, F.col("doc_id"), F.col("source"), fields, carry)
    folded = built.withColumn("folded_root", manifest.fold(F.col("stored"), "path"))
    proof = manifest.proof("path").alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return folded.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", verified)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_lm_scoring, op2_pii, op3_quality, op4_language_id, op5_decontamination, op6_minhash, op7_line_dedup,
        op8_embedding_dedup, op9_warc_fixity, op10_bpe, op11_url_filter,
        op12_whitening, op13_merkle_manifest, pipeline,
    )
    return {f.__name__: f for f in ops}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op5_decontamination": f"""
WITH dw AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS MATERIALIZED (
  SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bwin AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT d.doc_id, d.n, d.i, b.item_id FROM dwin d JOIN bwin b ON d.win = b.win AND d.n = b.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op6_minhash": f"""
WITH RECURSIVE dw AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
link AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM size UNION SELECT r.node, l.v FROM reach r JOIN link l ON r.other = l.u),
comp AS (SELECT node, min(other) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, d.doc_id) AS component_id, d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id LEFT JOIN comp ON comp.node = d.doc_id
""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL),
link AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
degree AS (SELECT u, count(*) AS n FROM link GROUP BY 1),
reach(node, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.w FROM reach r JOIN link l ON r.other = l.u),
comp AS (SELECT node, min(other) AS c FROM reach GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN comp ON comp.node = e.vec_id LEFT JOIN degree ON degree.u = e.vec_id
""",
    "op9_warc_fixity": """
WITH body AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload FROM pages),
laid AS (
  SELECT page_id, payload, 'crawl-' || coalesce(CAST(page_id // 512 AS VARCHAR), 'none') || '.warc' AS file, CAST(strlen(payload) AS BIGINT) AS length FROM body),
rec AS MATERIALIZED (
  SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS "offset" FROM laid),
a AS (SELECT file, "offset", length, sha256(payload) AS digest FROM rec WHERE page_id % 197 <> 11),
b AS (SELECT file, "offset", length,
    sha256(CASE WHEN page_id % 53 = 7 THEN substr(payload, 1, length(payload) - 4) || '#' || chr(10) || chr(13) || chr(10) ELSE payload END) AS digest
  FROM rec WHERE page_id % 101 <> 13)
SELECT coalesce(a.file, b.file) AS file, coalesce(a."offset", b."offset") AS "offset", 
  coalesce(a.length, -1) AS length_a, coalesce(a.digest, '') AS digest_a, coalesce(b.length, -1) AS length_b, coalesce(b.digest, '') AS digest_b,
  CASE WHEN b.file IS NULL THEN 'missing' WHEN a.file IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM a FULL JOIN b ON a.file = b.file AND a."offset" = b."offset" WHERE a.digest IS DISTINCT FROM b.digest
""",
    "op11_url_filter": f"""
WITH words(term, weight) AS (VALUES {", ".join(f"('{t}', {w})" for t, w in urlfilter.VOCABULARY.items())}),
u AS MATERIALIZED (
  SELECT row_number() OVER () AS r, page_id, {_LOWER.replace("text", "url")} AS low,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (
  SELECT *, '.' || host AS h, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'allow example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'block example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'allow org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'block net/' END AS fits FROM u),
hit AS (
  SELECT r, term, weight, count(*) AS n FROM (SELECT r, unnest(regexp_extract_all(low, '[\\pL\\pN]+')) AS term FROM u) JOIN words USING (term) GROUP BY ALL),
total AS (
  SELECT r, sum(CASE WHEN weight >= {urlfilter.LIMIT} THEN n ELSE 0 END) AS n_strict,
    sum(CASE WHEN weight < {urlfilter.LIMIT} THEN 1 ELSE 0 END) AS n_soft, sum(weight) AS weight FROM hit GROUP BY 1)
SELECT page_id, host, path, split_part(fits, ' ', 2) AS rule,
  coalesce(split_part(fits, ' ', 1), CASE WHEN coalesce(weight, 0) >= {urlfilter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(coalesce(n_strict, 0) AS BIGINT) AS n_strict, CAST(coalesce(n_soft, 0) AS BIGINT) AS n_soft, CAST(coalesce(weight, 0) AS BIGINT) AS weight
FROM ruled LEFT JOIN total USING (r)
""",
    "op13_merkle_manifest": """
WITH RECURSIVE f AS MATERIALIZED (
  SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM documents),
crc_step(i, b, c) AS (
  SELECT 0, b, b FROM range(256) t(b) UNION ALL
  SELECT i + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_step WHERE i < 8),
crc_of(t) AS (SELECT list(c ORDER BY b) FROM crc_step WHERE i = 8),
leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS src, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + length(coalesce(CAST(doc_id AS VARCHAR), ''))),
        lambda k: ascii(coalesce(CAST(doc_id AS VARCHAR), '')[k])::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0
      THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS stored
  FROM f, crc_of),
up(l, src, i, n, h) AS (
  SELECT 0, src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf, r) - 1, count(*) OVER (PARTITION BY src), leaf FROM leaves
  UNION ALL SELECT l + 1, src, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY l, src, i // 3, n),
sub AS MATERIALIZED (SELECT l, src, h FROM up WHERE n = 1),
top(l, i, n, h) AS (
  SELECT 0, row_number() OVER (ORDER BY src) - 1, count(*) OVER (), h FROM sub
  UNION ALL SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY l, i // 3, n),
nodes AS MATERIALIZED (
  SELECT src, l, i, n, h FROM up WHERE n > 1 UNION ALL
  SELECT NULL, l, i, n, h FROM top WHERE n > 1),
sib AS MATERIALIZED (
  SELECT a.src, a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lo, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS hi
  FROM nodes a JOIN nodes b ON a.src IS NOT DISTINCT FROM b.src AND a.l = b.l AND a.i // 3 = b.i // 3 GROUP BY ALL),
place AS MATERIALIZED (
  SELECT r, doc_id, leaf, stored, src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, dense_rank() OVER (ORDER BY src) - 1 AS g FROM leaves),
steps AS MATERIALIZED (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY tier, l) AS k, lo, hi FROM (
    SELECT p.r, 0 AS tier, s.l, s.lo, s.hi FROM place p JOIN sib s ON p.src = s.src AND s.i = p.i // CAST(3 ** s.l AS BIGINT)
    UNION ALL SELECT p.r, 1, s.l, s.lo, s.hi FROM place p JOIN sib s ON s.src IS NULL AND s.i = p.g // CAST(3 ** s.l AS BIGINT))),
folding(r, k, h) AS (
  SELECT r, 0, stored FROM place UNION ALL
  SELECT f.r, s.k, sha256(s.lo || f.h || s.hi) FROM folding f JOIN steps s ON s.r = f.r AND s.k = f.k + 1),
folded AS (SELECT r, arg_max(h, k) AS folded_root FROM folding GROUP BY 1),
proofs AS (SELECT r, string_agg(lo || hi, '' ORDER BY k) AS proof FROM steps GROUP BY 1)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root.h AS verified
FROM place JOIN sub USING (src) JOIN (SELECT h FROM top WHERE n = 1) root ON true JOIN folded USING (r) LEFT JOIN proofs USING (r)
""",
}
