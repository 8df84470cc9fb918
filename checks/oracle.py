"""DuckDB SQL used as the independent oracle for the registered queries.

Written directly in SQL over the driver's views (``documents``, ``events``);
it shares only parameter values (prompt wording, sizes) with the library.
Arrays are compared through ``md5`` of their comma-joined values.
"""

from __future__ import annotations

import string

from checks import params as P
from shardloom.functions.text import WHITESPACE

NL = "chr(10)"


def lit(s: str) -> str:
    """A DuckDB string expression for ``s`` (newlines via chr(10))."""
    pieces = ["'" + p.replace("'", "''") + "'" for p in s.split("\n")]
    return f" || {NL} || ".join(pieces)


WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def clean(col: str) -> str:
    return f"regexp_replace(trim({col}, {WS}), '^<SOH[^\\n]+?EOH>', '')"


def template(tpl: str, fields: dict[str, str]) -> str:
    out = []
    for text, field, _spec, _conv in string.Formatter().parse(tpl):
        if text:
            out.append(lit(text))
        if field is not None:
            out.append(f"CAST({fields[field]} AS VARCHAR)")
    return "(" + " || ".join(out) + ")"


SECTIONS = ("title", "abstract", "claims", "background", "summary", "description")


def text_expr(prefix: str = "", null_empty: bool = False) -> str:
    parts = []
    for c in SECTIONS:
        col = f"{prefix}{c}"
        if null_empty:
            col = f"coalesce({col}, '')"
        parts.append(f"'[{c.upper()}]' || {NL} || {clean(col)}")
    return f" || {NL} || ".join(parts)


def corpus_cte() -> str:
    return """corpus AS (
  SELECT doc_id,
         CAST(DATE '2015-03-01' + CAST((doc_id * 7919) % 1200 AS INTEGER) AS DATE) AS filing_date,
         upper(lang) || '0' || CAST(doc_id % 10 AS VARCHAR) AS ipc_label,
         source || ' ' || CAST(doc_id AS VARCHAR) || ' {x} ' AS title,
         CASE WHEN doc_id % 3 = 0 THEN '  <SOH h' || CAST(doc_id AS VARCHAR) || ' EOH>' ELSE '' END
           || substr(text, 1, 200) || ' ' AS abstract,
         substr(text, 201, 400) AS claims,
         substr(text, 601, 400) AS background,
         substr(text, 1001, 400) AS summary,
         substr(text, 1401) AS description
  FROM documents)"""


def wins_cte(start: str = P.START, end: str = P.END, step: int = P.STEP) -> str:
    return f"""wins AS (
  SELECT window_idx, window_start, window_end,
         'shard_' || CAST(window_start AS VARCHAR) || '_' || CAST(window_end AS VARCHAR) AS shard
  FROM (SELECT range AS window_idx,
               CAST(DATE '{start}' + to_months(CAST(range * {step} AS INTEGER)) AS DATE) AS window_start,
               CAST(DATE '{start}' + to_months(CAST((range + 1) * {step} AS INTEGER)) AS DATE) AS window_end
        FROM range(0, 2000))
  WHERE window_start < DATE '{end}')"""


def windowed_cte(until: str | None = None) -> str:
    cut = f" AND c.filing_date < DATE '{until}'" if until else ""
    return f"""windowed AS (
  SELECT c.*, w.window_idx, w.window_start, w.window_end, w.shard
  FROM corpus c JOIN wins w ON c.filing_date >= w.window_start AND c.filing_date < w.window_end{cut})"""


def prompts_cte(null_empty: bool = False) -> str:
    fields = {"ipc_code": "ipc_label", "title": "title", "patent_text": "text"}
    user = template(P.USER_TEMPLATE, fields)
    inputs = (
        lit("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n" + P.SYSTEM_PROMPT + "<|eot_id|>")
        + " || "
        + lit("<|start_header_id|>user<|end_header_id|>\n\n")
        + f" || {user} || '<|eot_id|>'"
    )
    outputs = lit("<|start_header_id|>assistant<|end_header_id|>\n\n") + " || text || '<|eot_id|><|end_of_text|>'"
    return f"""texts AS (
  SELECT doc_id, shard, ipc_label, title, {text_expr(null_empty=null_empty)} AS text FROM windowed),
prompts AS (
  SELECT doc_id, shard, {inputs} AS inputs, {outputs} AS outputs FROM texts)"""


def tokens_cte(max_len: int | None = P.MAX_LEN) -> str:
    cap = f"WHERE len(src) + len(tgt) <= {max_len}" if max_len is not None else ""
    return f"""sides AS (
  SELECT doc_id, shard,
         list_transform(string_split(inputs, ''), lambda c: unicode(c)) AS src,
         list_transform(string_split(outputs, ''), lambda c: unicode(c)) AS tgt
  FROM prompts),
tokens AS (
  SELECT doc_id, shard, list_concat(src, tgt) AS input_ids,
         list_concat(list_transform(src, lambda x: -100), tgt) AS labels,
         len(src) + len(tgt) AS length
  FROM sides {cap})"""


MARKERS = ("<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|end_of_text|>")
PUA = 57344  # private-use code points stand in for the markers


def utf8_ids(col: str) -> str:
    """Byte-level ids: UTF-8 bytes of each code point; markers -> 256 + k."""
    for k, m in enumerate(MARKERS):
        col = f"replace({col}, '{m}', chr({PUA + k}))"
    u = "unicode(c)"
    return f"""flatten(list_transform(string_split({col}, ''), lambda c: CASE
        WHEN {u} BETWEEN {PUA} AND {PUA + len(MARKERS) - 1} THEN [{u} - {PUA} + 256]
        WHEN {u} < 128 THEN [{u}]
        WHEN {u} < 2048 THEN [192 + ({u} >> 6), 128 + ({u} & 63)]
        WHEN {u} < 65536 THEN [224 + ({u} >> 12), 128 + (({u} >> 6) & 63), 128 + ({u} & 63)]
        ELSE [240 + ({u} >> 18), 128 + (({u} >> 12) & 63), 128 + (({u} >> 6) & 63), 128 + ({u} & 63)] END))"""


def bytelevel_tokens_cte(max_len: int | None = P.MAX_LEN) -> str:
    cap = f"WHERE len(src) + len(tgt) <= {max_len}" if max_len is not None else ""
    return f"""bsides AS (
  SELECT doc_id, shard, {utf8_ids('inputs')} AS src, {utf8_ids('outputs')} AS tgt FROM prompts),
btokens AS (
  SELECT doc_id, shard, src, list_concat(src, tgt) AS input_ids,
         list_concat(list_transform(src, lambda x: -100), tgt) AS labels, len(src) + len(tgt) AS length
  FROM bsides {cap})"""


def flat_cte() -> str:
    return """flat0 AS (
  SELECT shard, doc_id, unnest(generate_series(1, len(input_ids))) AS p,
         unnest(input_ids) AS tid, unnest(labels) AS lab
  FROM tokens),
flat AS (
  SELECT shard, doc_id, tid, lab,
         row_number() OVER (PARTITION BY shard ORDER BY doc_id, p) - 1 AS gp
  FROM flat0)"""


def base_ctes(*, tokens: bool = True, flat: bool = False, null_empty: bool = False, max_len=P.MAX_LEN) -> str:
    ctes = [corpus_cte(), wins_cte(), windowed_cte(), prompts_cte(null_empty)]
    if tokens:
        ctes.append(tokens_cte(max_len))
    if flat:
        ctes.append(flat_cte())
    return "WITH " + ",\n".join(ctes)


def blocks_sql(size: int, keep_tail: bool) -> str:
    having = "" if keep_tail else f"HAVING count(*) = {size}"
    return f"""SELECT shard, gp // {size} AS chunk, CAST(count(*) AS BIGINT) AS n_tokens,
       md5(string_agg(CAST(tid AS VARCHAR), ',' ORDER BY gp)) AS ids_md5,
       md5(string_agg(CAST(lab AS VARCHAR), ',' ORDER BY gp)) AS labels_md5
FROM flat GROUP BY shard, gp // {size} {having}"""


def manifest_cte() -> str:
    return f"""manifest AS (
  SELECT shard, CAST(sum(length) AS BIGINT) AS n_tokens, CAST(sum(length) AS BIGINT) AS n_labels,
         CAST(sum(length) AS BIGINT) // {P.CHUNK} AS n_chunks
  FROM tokens GROUP BY shard)"""


def feed_ctes(shuffle_chunks: bool = True) -> str:
    """Manifest, workers, ranks, chunks with sequence numbers and batch ids."""
    key = f"md5('{P.SEED}|{P.EPOCH}|' || shard)"
    ckey = f"md5('{P.SEED}|{P.EPOCH}|' || shard || '|' || CAST(chunk AS VARCHAR))"
    chunk_rank = (
        f"row_number() OVER (PARTITION BY shard ORDER BY {ckey}, chunk) - 1" if shuffle_chunks else "chunk"
    )
    return f""",
{manifest_cte()},
striped AS (
  SELECT *, CAST((row_number() OVER (ORDER BY shard) - 1) % {P.WORKERS} AS INTEGER) AS worker FROM manifest),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY worker ORDER BY {key}, shard) - 1 AS INTEGER) AS shard_rank
  FROM striped),
based AS (
  SELECT *, CAST(coalesce(sum(n_chunks) OVER (PARTITION BY worker ORDER BY shard_rank
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq_base FROM ranked),
chunks AS (
  SELECT shard, gp // {P.CHUNK} AS chunk,
         md5(string_agg(CAST(tid AS VARCHAR), ',' ORDER BY gp)) AS ids_md5,
         md5(string_agg(CAST(lab AS VARCHAR), ',' ORDER BY gp)) AS labs_md5
  FROM flat GROUP BY shard, gp // {P.CHUNK} HAVING count(*) = {P.CHUNK}),
chunks_ranked AS (
  SELECT *, CAST({chunk_rank} AS BIGINT) AS chunk_rank FROM chunks),
samples AS (
  SELECT c.shard, c.chunk, c.ids_md5, c.labs_md5, b.worker, b.shard_rank, c.chunk_rank,
         b.seq_base + c.chunk_rank AS seq, (b.seq_base + c.chunk_rank) // {P.BATCH} AS batch_id
  FROM chunks_ranked c JOIN based b USING (shard))"""


def log_ctes() -> str:
    return f"""WITH tl0 AS (
  SELECT event_id % 2 AS rank, event_id, ts, value / 50.0 AS loss FROM events),
tlk AS (
  SELECT *, row_number() OVER (PARTITION BY rank ORDER BY ts, event_id) - 1 AS k FROM tl0),
elen AS (
  SELECT CAST(ceil(max(c) / {P.LOG_EPOCHS}.0) AS BIGINT) AS L FROM (SELECT rank, count(*) AS c FROM tl0 GROUP BY rank)),
train_log AS (
  SELECT rank, CAST(k // L AS INTEGER) AS epoch, CAST(k % L AS INTEGER) AS step, loss, ts FROM tlk, elen),
ep AS (
  SELECT rank, epoch, max(step) + 1 AS n_steps, min(ts) AS epoch_start FROM train_log GROUP BY rank, epoch),
ep2 AS (
  SELECT *, coalesce(sum((n_steps + {P.ACCUM} - 1) // {P.ACCUM}) OVER (PARTITION BY rank ORDER BY epoch
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM ep),
steps AS (
  SELECT t.rank, t.epoch, t.step, t.loss, t.ts, e.epoch_start,
         CAST(e.prior + t.step // {P.ACCUM} + 1 AS BIGINT) AS opt_step,
         ((t.step + 1) % {P.ACCUM} = 0 OR t.step = e.n_steps - 1) AS is_sync
  FROM train_log t JOIN ep2 e USING (rank, epoch)),
steps_w AS (
  SELECT *, (opt_step - 1) // {P.UPDATE_FREQ} AS log_window FROM steps)"""


def windows_cte() -> str:
    tps = P.TOKENS_PER_MICRO_STEP
    return f""",
pr AS (
  SELECT log_window, rank, sum(CAST(loss AS DECIMAL(38,12))) AS loss_sum, count(*) AS micro_steps,
         max(opt_step) FILTER (WHERE is_sync) AS last_sync, min(epoch) AS first_epoch,
         arg_max(epoch, epoch * 100000000 + step) AS last_epoch,
         arg_max(step, epoch * 100000000 + step) AS last_step,
         arg_max(ts, epoch * 100000000 + step) AS last_ts
  FROM steps_w GROUP BY log_window, rank),
nr AS (SELECT count(DISTINCT rank) AS n FROM train_log),
main AS (
  SELECT log_window, micro_steps AS main_steps, last_epoch AS epoch, last_step AS end_step, last_ts AS log_ts,
         first_epoch <> last_epoch AS spans_epoch
  FROM pr WHERE rank = 0),
tot AS (
  SELECT log_window, sum(loss_sum) AS loss_sum, min(last_sync) AS last_sync FROM pr GROUP BY log_window),
starts AS (SELECT epoch, epoch_start FROM ep WHERE rank = 0),
win AS (
  SELECT t.log_window, m.epoch, m.end_step, m.main_steps, m.spans_epoch, m.log_ts, t.loss_sum,
         s.epoch_start, pv.log_ts AS prev_ts,
         CAST(t.loss_sum AS DOUBLE) / m.main_steps / (SELECT n FROM nr) AS mean_loss
  FROM tot t JOIN main m USING (log_window)
  JOIN starts s ON s.epoch = m.epoch
  LEFT JOIN main pv ON pv.log_window + 1 = t.log_window
  WHERE t.last_sync = (t.log_window + 1) * {P.UPDATE_FREQ}),
win2 AS (
  SELECT *, date_diff('microsecond', greatest(coalesce(prev_ts, epoch_start), epoch_start), log_ts) / 1e6 AS elapsed
  FROM win),
win3 AS (
  SELECT *, CASE WHEN elapsed > 0 THEN CAST({tps} AS DOUBLE) * main_steps / elapsed ELSE 0.0 END AS tokens_per_sec
  FROM win2)"""


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base_text = "WITH " + ",\n".join([corpus_cte(), wins_cte(), windowed_cte()])

    q["date_windows"] = f"""WITH {corpus_cte()}, {wins_cte()}, {windowed_cte()},
counts AS (SELECT shard, count(*) AS n FROM windowed GROUP BY shard)
SELECT CAST(w.window_idx AS BIGINT) AS window_idx, CAST(w.window_start AS VARCHAR) AS window_start,
       CAST(w.window_end AS VARCHAR) AS window_end, w.shard, CAST(coalesce(c.n, 0) AS BIGINT) AS n_docs
FROM wins w LEFT JOIN counts c USING (shard)"""

    q["window_assign"] = f"""{base_text}
SELECT doc_id, CAST(filing_date AS VARCHAR) AS filing_date, shard FROM windowed"""

    q["ipc_filter"] = f"""WITH {corpus_cte()}
SELECT doc_id, ipc_label FROM corpus WHERE starts_with(ipc_label, '{P.LABEL_PREFIX}')"""

    q["scan_window"] = f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders
WHERE o_orderdate >= DATE '{P.SCAN[0]}' AND o_orderdate < DATE '{P.SCAN[1]}'"""

    def split_sql(name: str, start: str, end: str) -> str:
        ctes = [corpus_cte(), wins_cte(start, end), windowed_cte(end), prompts_cte(), tokens_cte()]
        return f"""SELECT * FROM (WITH {", ".join(ctes)}
SELECT '{name}' AS split, shard, (CAST(sum(length) AS BIGINT) + {P.BLOCK - 1}) // {P.BLOCK} AS n_blocks,
       CAST(sum(length) AS BIGINT) AS n_tokens FROM tokens GROUP BY shard)"""

    q["split_shards"] = split_sql("train", *P.TRAIN) + "\nUNION ALL\n" + split_sql("val", *P.VAL)

    q["split_train_val"] = f"""WITH {corpus_cte()}
SELECT doc_id, CASE WHEN filing_date >= DATE '{P.TRAIN[0]}' AND filing_date < DATE '{P.TRAIN[1]}' THEN 'train' ELSE 'val' END AS split
FROM corpus
WHERE (filing_date >= DATE '{P.TRAIN[0]}' AND filing_date < DATE '{P.TRAIN[1]}')
   OR (filing_date >= DATE '{P.VAL[0]}' AND filing_date < DATE '{P.VAL[1]}')"""

    cleaned = ", ".join(f"{clean(c)} AS {c}" for c in SECTIONS)
    q["clean_sections"] = f"""WITH {corpus_cte()}
SELECT doc_id, {cleaned} FROM corpus"""

    q["patent_text"] = f"""WITH {corpus_cte()}
SELECT doc_id, {text_expr()} AS text FROM corpus"""

    user = template(P.USER_TEMPLATE, {"ipc_code": "ipc_label", "title": "title"})
    q["user_prompt"] = f"""WITH {corpus_cte()}
SELECT doc_id, {user} AS user_prompt FROM corpus"""
    q["null_label"] = f"""WITH {corpus_cte()},
holed AS (SELECT * REPLACE (CASE WHEN doc_id % 9 = 0 THEN 'None' ELSE ipc_label END AS ipc_label) FROM corpus)
SELECT doc_id, {user} AS user_prompt FROM holed"""

    q["chat_prompts"] = base_ctes(tokens=False) + "\nSELECT doc_id, shard, inputs, outputs FROM prompts"

    qa_user = template(P.QA_USER_TEMPLATE, {"patent_text": "text"})
    qa_inputs = (
        lit("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n" + P.QA_SYSTEM_TEXT + "<|eot_id|>")
        + " || "
        + lit("<|start_header_id|>user<|end_header_id|>\n\n")
        + f" || {qa_user} || "
        + lit("<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")
    )
    q["qa_prompts"] = f"""WITH {corpus_cte()},
texts AS (SELECT doc_id, {text_expr()} AS text FROM corpus)
SELECT doc_id, {qa_inputs} AS inputs FROM texts"""

    q["null_policy"] = f"""WITH {corpus_cte()},
holed AS (SELECT * REPLACE (CASE WHEN doc_id % 7 = 0 THEN NULL ELSE claims END AS claims) FROM corpus)
SELECT doc_id, {text_expr(null_empty=True)} AS text FROM holed"""

    q["sample_limit"] = f"""{base_text}
SELECT shard, doc_id FROM (
  SELECT shard, doc_id, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS rn FROM windowed)
WHERE rn <= {P.N_SAMPLES}"""

    q["tokenize_cp"] = base_ctes(max_len=None) + """
SELECT doc_id, shard, CAST(len(input_ids) AS BIGINT) AS length,
       CAST(len(list_filter(labels, lambda x: x = -100)) AS BIGINT) AS n_src,
       md5(array_to_string(input_ids, ',')) AS ids_md5
FROM tokens"""

    q["tokenize_bpe"] = base_ctes(tokens=False) + ",\n" + bytelevel_tokens_cte() + """
SELECT doc_id, shard, CAST(length AS BIGINT) AS length, CAST(len(src) AS BIGINT) AS n_src,
       md5(array_to_string(input_ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5
FROM btokens"""

    q["label_mask"] = base_ctes() + """
SELECT doc_id, shard, CAST(len(list_filter(labels, lambda x: x = -100)) AS BIGINT) AS n_masked,
       md5(array_to_string(labels, ',')) AS labels_md5
FROM tokens"""

    q["length_filter"] = base_ctes(max_len=None) + f"""
SELECT shard,
       CAST(count(*) FILTER (WHERE length <= {P.LENGTH_CAP}) AS BIGINT) AS kept_rows,
       CAST(count(*) FILTER (WHERE length > {P.LENGTH_CAP}) AS BIGINT) AS dropped_rows,
       CAST(coalesce(sum(length) FILTER (WHERE length <= {P.LENGTH_CAP}), 0) AS BIGINT) AS kept_tokens,
       CAST(coalesce(sum(length) FILTER (WHERE length > {P.LENGTH_CAP}), 0) AS BIGINT) AS dropped_tokens
FROM tokens GROUP BY shard"""

    q["shard_tokens"] = base_ctes() + f"""
SELECT shard, split_part(shard, '_', 2) AS window_start, split_part(shard, '_', 3) AS window_end,
       CAST(sum(length) AS BIGINT) AS total_tokens, format('{{:,}}', CAST(sum(length) AS BIGINT)) AS total_tokens_fmt,
       'Total tokens ' || format('{{:,}}', CAST(sum(length) AS BIGINT)) || {NL} || 'Start date '
         || split_part(shard, '_', 2) || ', end date ' || split_part(shard, '_', 3) AS description
FROM tokens GROUP BY shard"""

    q["flatten_tokens"] = base_ctes(flat=True) + """
SELECT shard, CAST(gp AS BIGINT) AS pos, doc_id, CAST(tid AS INTEGER) AS input_id, CAST(lab AS INTEGER) AS label FROM flat"""

    q["pack_blocks"] = base_ctes(flat=True) + "\n" + blocks_sql(P.BLOCK, keep_tail=False)
    q["shard_chunks"] = base_ctes(flat=True) + "\n" + blocks_sql(P.CHUNK, keep_tail=False)
    q["rewindow"] = q["shard_chunks"]

    q["npy_read"] = q["shard_chunks"]
    q["parquet_shards"] = base_ctes() + ",\n" + manifest_cte() + "\nSELECT shard, n_tokens, n_labels, n_chunks FROM manifest"
    q["npy_manifest"] = base_ctes() + ",\n" + manifest_cte() + "\nSELECT shard, n_tokens FROM manifest"

    q["manifest"] = base_ctes() + ",\n" + manifest_cte() + "\nSELECT * FROM manifest"

    q["corpus_summary"] = base_ctes() + ",\n" + manifest_cte() + f"""
SELECT CAST(count(*) AS BIGINT) AS n_shards,
       string_agg(CAST(n_tokens AS VARCHAR), ',' ORDER BY shard) AS tokens_per_shard,
       CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
       CAST(sum(n_tokens) AS BIGINT) // {P.CHUNK} AS n_chunks,
       CAST({P.CHUNK} AS BIGINT) AS chunk_size, false AS demo_mode
FROM manifest"""

    q["chunk_estimate"] = base_ctes() + ",\n" + manifest_cte() + f"""
SELECT CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
       CAST(sum(n_tokens) AS BIGINT) // {P.CHUNK} AS estimated_chunks,
       CAST(sum(n_chunks) AS BIGINT) AS exact_chunks
FROM manifest"""

    q["first_shards"] = base_ctes() + ",\n" + manifest_cte() + f"""
SELECT shard, n_tokens FROM manifest ORDER BY shard LIMIT {P.DEMO_SHARDS}"""

    feed = base_ctes(flat=True) + feed_ctes()
    q["worker_stripe"] = feed + "\nSELECT shard, worker FROM striped"
    q["shard_shuffle"] = feed + "\nSELECT shard, worker, shard_rank FROM ranked"
    q["chunk_shuffle"] = feed + "\nSELECT shard, chunk, chunk_rank FROM chunks_ranked"
    q["sample_sequence"] = feed + "\nSELECT worker, seq, shard, chunk FROM samples"
    order_key = f"'{P.SEED}|' || CAST(epoch AS VARCHAR) || '|' || shard"
    q["epoch_order"] = base_ctes() + f""",
{manifest_cte()},
striped AS (
  SELECT *, CAST((row_number() OVER (ORDER BY shard) - 1) % {P.WORKERS} AS INTEGER) AS worker FROM manifest),
ep AS (SELECT s.*, CAST(e.range AS INTEGER) AS epoch FROM striped s, range(0, {P.FEED_EPOCHS}) e),
based AS (
  SELECT *, CAST(coalesce(sum(n_chunks) OVER (PARTITION BY epoch, worker ORDER BY md5({order_key}), shard
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq_base FROM ep),
ch AS (SELECT epoch, worker, shard, seq_base, unnest(range(0, n_chunks)) AS chunk FROM based),
rk AS (
  SELECT *, seq_base + row_number() OVER (PARTITION BY epoch, shard
         ORDER BY md5({order_key} || '|' || CAST(chunk AS VARCHAR)), chunk) - 1 AS seq FROM ch)
SELECT epoch, worker, seq // {P.BATCH} AS batch_id, CAST(seq % {P.BATCH} AS INTEGER) AS pos_in_batch, shard, chunk FROM rk"""
    rounds = "SELECT *, x // b AS u, x % b AS v FROM walk WHERE step = 0 OR x >= n_chunks"
    for r in range(6):
        rounds = f"""SELECT * EXCLUDE (u, v), v AS u,
      (u + CAST('0x' || substr(md5({order_key} || '|{r}|' || CAST(v AS VARCHAR)), 1, 15) AS BIGINT)) % {"ba"[r % 2 == 0]} AS v FROM ({rounds})"""
    keyed = "WITH RECURSIVE" + base_ctes().lstrip()[4:] + f""",
{manifest_cte()},
striped AS (
  SELECT *, CAST((row_number() OVER (ORDER BY shard) - 1) % {P.WORKERS} AS INTEGER) AS worker FROM manifest),
ep AS (SELECT s.*, CAST(e.range AS INTEGER) AS epoch FROM striped s, range(0, {P.FEED_EPOCHS}) e WHERE n_chunks > 0),
based AS (
  SELECT *, CAST(ceil(sqrt(n_chunks)) AS BIGINT) AS a, CAST(coalesce(sum(n_chunks) OVER (PARTITION BY epoch, worker ORDER BY md5({order_key}), shard
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq_base FROM ep),
walk AS (
  SELECT epoch, worker, shard, seq_base, n_chunks, a, (n_chunks + a - 1) // a AS b, chunk, 0 AS step, chunk AS x
  FROM (SELECT *, unnest(range(0, n_chunks)) AS chunk FROM based)
  UNION ALL SELECT epoch, worker, shard, seq_base, n_chunks, a, b, chunk, step + 1, u * b + v FROM ({rounds})),
placed AS (SELECT epoch, worker, shard, chunk, seq_base + x AS seq FROM walk WHERE step > 0 AND x < n_chunks)
SELECT epoch, worker, seq // {P.BATCH} AS batch_id, CAST(seq % {P.BATCH} AS INTEGER) AS pos_in_batch, shard, chunk FROM placed"""
    q["keyed_order"] = keyed
    q["keyed_resume"] = keyed + f" WHERE epoch > 1 OR (epoch = 1 AND seq >= {P.RESUME_BATCH * P.BATCH})"
    q["batches"] = feed + f"""
SELECT worker, batch_id, CAST(count(*) AS INTEGER) AS n_samples,
       md5(string_agg(ids_md5, ',' ORDER BY seq)) AS batch_md5, md5(string_agg(labs_md5, ',' ORDER BY seq)) AS labels_md5,
       CAST(count(*) * {P.CHUNK} AS BIGINT) AS n_attended, CAST(count(*) * {P.CHUNK} AS BIGINT) AS n_mask,
       'array<array<bigint>> array<array<bigint>> array<array<bigint>>' AS types
FROM samples GROUP BY worker, batch_id"""
    q["delivery_order"] = feed + """,
nb AS (SELECT worker, max(batch_id) + 1 AS n FROM samples GROUP BY worker),
bb AS (SELECT DISTINCT worker, batch_id FROM samples)
SELECT bb.worker, bb.batch_id,
       CAST((SELECT sum(least(n, bb.batch_id)) FROM nb)
            + (SELECT count(*) FROM nb WHERE nb.worker < bb.worker AND nb.n > bb.batch_id) AS BIGINT) AS delivery
FROM bb"""
    q["rank_split"] = feed + f""",
nb AS (SELECT worker, max(batch_id) + 1 AS n FROM samples GROUP BY worker),
bb AS (SELECT DISTINCT worker, batch_id FROM samples)
SELECT bb.worker, bb.batch_id,
       CAST(((SELECT sum(least(n, bb.batch_id)) FROM nb)
             + (SELECT count(*) FROM nb WHERE nb.worker < bb.worker AND nb.n > bb.batch_id)) % {P.WORLD} AS INTEGER) AS rank
FROM bb"""

    delivered = feed + f""",
nb AS (SELECT worker, max(batch_id) + 1 AS n FROM samples GROUP BY worker),
bt AS (
  SELECT worker, batch_id, CAST(count(*) AS INTEGER) AS n_samples,
         md5(string_agg(ids_md5, ',' ORDER BY seq)) AS batch_md5, md5(string_agg(labs_md5, ',' ORDER BY seq)) AS labels_md5
  FROM samples GROUP BY worker, batch_id),
dl AS (
  SELECT bt.*, CAST((SELECT sum(least(n, bt.batch_id)) FROM nb)
         + (SELECT count(*) FROM nb WHERE nb.worker < bt.worker AND nb.n > bt.batch_id) AS BIGINT) AS delivery FROM bt),
rk AS (
  SELECT *, CAST(delivery % {P.WORLD} AS INTEGER) AS rank,
         row_number() OVER (PARTITION BY delivery % {P.WORLD} ORDER BY delivery) - 1 AS place FROM dl)"""
    q["delivery_files"] = delivered + """
SELECT rank, place, worker, batch_id, n_samples, batch_md5, labels_md5 FROM rk"""
    q["delivery_resume"] = delivered + f"""
SELECT rank, place AS slot, delivery, worker, batch_id, batch_md5 FROM rk WHERE place >= {P.RESUME_SLOT}"""

    q["pair_check"] = base_ctes() + ",\n" + manifest_cte() + f""",
sized AS (
  SELECT shard, CASE WHEN substr(shard, 12, 2) <> '07' THEN n_tokens END AS n_ids,
         CASE substr(shard, 12, 2) WHEN '11' THEN NULL
              WHEN '03' THEN nullif(n_labels - least(n_labels, {P.BLOCK}), 0) ELSE n_labels END AS n_labels
  FROM manifest)
SELECT shard, n_ids, n_labels, CASE WHEN n_ids IS NULL THEN 'missing_ids' WHEN n_labels IS NULL THEN 'missing_labels'
       WHEN n_ids <> n_labels THEN 'length_mismatch' ELSE 'ok' END AS status
FROM sized WHERE n_ids IS NOT NULL OR n_labels IS NOT NULL"""
    q["length_check"] = base_ctes() + ",\n" + manifest_cte() + """,
sized AS (SELECT shard, n_tokens, CASE substr(shard, 12, 2) WHEN '03' THEN n_labels - 5 ELSE n_labels END AS n_labels FROM manifest)
SELECT shard, n_tokens, n_labels, n_tokens = n_labels AS lengths_match FROM sized"""

    cfg_rows = ", ".join(
        "(" + ", ".join(repr(v) if not isinstance(v, str) else f"'{v}'" for v in row) + ")" for row in P.RUN_CONFIGS
    )
    q["epoch_plan"] = base_ctes() + f""",
tot AS (SELECT CAST(sum(length) AS BIGINT) AS total FROM tokens),
cfg(name, procs, micro_batch, accum, seq_len, epochs, warmup_ratio, log_ratio, demo_ratio) AS (VALUES {cfg_rows}),
p1 AS (SELECT cfg.*, total // seq_len AS est_chunks FROM cfg, tot),
p2 AS (SELECT *, CAST(ceil(est_chunks / micro_batch) AS BIGINT) AS loader_len FROM p1),
p3 AS (SELECT *, CAST(ceil(loader_len / procs) AS BIGINT) AS loader_len_split FROM p2)
SELECT name, CAST(est_chunks AS BIGINT) AS est_chunks, loader_len, loader_len_split,
       CAST(procs * micro_batch * accum AS BIGINT) AS samples_per_step,
       CAST(procs * micro_batch * accum * seq_len AS BIGINT) AS tokens_per_step,
       CAST(seq_len * procs * micro_batch AS BIGINT) AS tokens_per_micro_step,
       CAST(loader_len * procs * micro_batch AS BIGINT) AS samples_per_epoch,
       CAST(loader_len_split * procs * micro_batch AS BIGINT) AS samples_per_epoch_split,
       CAST(loader_len * procs * micro_batch * seq_len AS BIGINT) AS tokens_per_epoch,
       CAST(seq_len * procs * micro_batch * loader_len_split AS BIGINT) AS epoch_tokens,
       CAST(loader_len_split // accum AS BIGINT) AS opt_steps_per_epoch,
       CAST((loader_len_split // accum) * epochs AS BIGINT) AS total_opt_steps,
       CAST(floor((loader_len_split // accum) * epochs * warmup_ratio) AS BIGINT) AS warmup_steps,
       CAST(floor((loader_len_split // accum) * log_ratio) AS BIGINT) AS log_interval,
       CAST(floor((loader_len_split // accum) * demo_ratio) AS BIGINT) AS demo_steps
FROM p3"""

    q["step_windows"] = log_ctes() + """
SELECT rank, epoch, step, opt_step, is_sync, log_window FROM steps_w"""

    lw = log_ctes() + windows_cte()
    q["loss_windows"] = lw + """
SELECT log_window, epoch, end_step, CAST((log_window + 1) * """ + str(P.UPDATE_FREQ) + """ AS BIGINT) AS global_step,
       CAST(CAST(loss_sum AS DECIMAL(38,12)) AS VARCHAR) AS loss_sum, CAST(main_steps AS BIGINT) AS micro_steps,
       CAST((SELECT n FROM nr) AS BIGINT) AS n_ranks, spans_epoch
FROM win3"""
    q["stream_loss_windows"] = q["loss_windows_folded"] = q["loss_windows"]
    q["perplexity"] = lw + f"""
SELECT log_window, round(exp(least(mean_loss, {P.PPL_CLAMP})), 6) AS perplexity FROM win3"""
    q["throughput"] = lw + """
SELECT log_window, round(elapsed, 6) AS elapsed_sec, round(tokens_per_sec, 6) AS tokens_per_sec FROM win3"""

    q["progress"] = log_ctes() + f""",
loader AS (SELECT max(step) + 1 AS L FROM train_log)
SELECT t.rank, t.epoch, t.step,
       CAST((t.step + 1) * {P.TOKENS_PER_MICRO_STEP} AS BIGINT) AS processed_tokens,
       CAST({P.TOKENS_PER_MICRO_STEP} * L AS BIGINT) AS epoch_tokens,
       round((t.step + 1) * {P.TOKENS_PER_MICRO_STEP} * 100.0 / ({P.TOKENS_PER_MICRO_STEP} * L), 4) AS pct,
       printf('%02d:%02d:%05.2f',
              CAST(floor(date_diff('microsecond', e.epoch_start, t.ts) / 1e6 / 3600) AS INTEGER),
              CAST(floor(fmod(date_diff('microsecond', e.epoch_start, t.ts) / 1e6, 3600) / 60) AS INTEGER),
              fmod(date_diff('microsecond', e.epoch_start, t.ts) / 1e6, 60)) AS elapsed,
       CAST(e.prior + t.step // {P.ACCUM} AS BIGINT) AS global_step
FROM train_log t JOIN ep2 e USING (rank, epoch), loader
WHERE t.step % 50 = 0 AND t.step > 0"""

    q["demo_cut"] = log_ctes() + f"""
SELECT rank, epoch, step, opt_step FROM steps WHERE opt_step - 1 <= {P.DEMO_STEPS}"""
    return q
