"""BPE, personal data, quality, language, language model, decontamination:
brute force, exact round trips, held-out accuracy and edge cases."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.llm import bpe, decontaminate, langid, lm, pii, quality
from shardloom.llm.common import fold
from shardloom.llm.queries import queries, tokenizer

SF = "/root/testdata/sf0.001"
EDGES = ["", None, "a", " ", "\n\n", "  two  blanks  ", "x" * 5000, "é ü 漢字  end ", "a\tb\x0bc", "'s don't 12 3456 !!! \r\n z"]


def docs_frame(spark, texts, **extra):
    rows = [(i, t, f"own{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


@pytest.fixture(scope="module")
def encoder():
    ranks, pattern = tokenizer()
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return bpe.Encoder(ranks, pattern), reference


@given(texts=st.lists(st.text(alphabet=" \n\ta bé'1!漢xyz", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_bpe_equals_the_library(encoder, texts):
    ours, reference = encoder
    got = [np.frombuffer(b, np.int32).tolist() for b in ours.batch(texts)]
    assert got == [reference.encode_ordinary(t) for t in texts]


def test_bpe_long_pretokens_and_lower_ranks(encoder):
    ours, reference = encoder
    for text in ("a" * 3001, "ab" * 1500, "xyzzy" * 400):
        assert np.frombuffer(ours(text), np.int32).tolist() == reference.encode_ordinary(text)
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 400, b"ab": 300, b"abc": 260, b"bca": 259}
    plain = tiktoken.Encoding("t", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    table = bpe.RankTable(ranks)
    for text in ("abcabcab", "bcabcabca", "aabbccabc"):  # joins whose rank is lower than their parts'
        assert bpe.merge_pieces([text.encode()], table) == [plain.encode_ordinary(text)]


def test_bpe_query_round_trip_and_edges(spark, encoder):
    ranks, pattern = tokenizer()
    out = bpe.decode_documents(bpe.encode_documents(docs_frame(spark, EDGES), ranks, pattern), ranks).collect()
    for r in out:
        assert bytes(r["decoded"]) == (EDGES[r["doc_id"]] or "").encode() and r["score"] == f"own{r['doc_id']}"
        assert list(r["ids"]) == encoder[1].encode_ordinary(EDGES[r["doc_id"]] or "")
    assert bpe.encode_documents(docs_frame(spark, []), ranks, pattern).count() == 0


def test_pii_base_equals_plain_patterns(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["a@b.c@d.ef x..y@z.a-b.co @q.r", "1.2.3.256 1.2.3.4.5.6.7.8 9.9.9", "4111 1111 1111 1111 +1 (743) 555-3824", "é+49 30 123456 "]
    for t in texts:
        got = [s[:3] for s in pii.find_spans(t) if s[0] in pii.BASE_KINDS]
        want = [("email", *m.span()) for m in re.finditer(pii.EMAIL, t)]
        want += [("ip", *m.span()) for m in re.finditer(pii.IP, t) if all(int(p) <= 255 for p in m.group().split("."))]
        for m in re.finditer(pii.CARD, t):
            d = re.sub(r"\D", "", m.group())
            if 16 <= len(d) <= 19 and pii.luhn(d):
                want.append(("card", *m.span()))
        want += [("phone", *m.span()) for m in re.finditer(pii.PHONE, t) if 8 <= len(re.sub(r"\D", "", m.group())) <= 15]
        assert got == want


def test_pii_validators_context_and_edges(spark):
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 now") == ["iban"]
    assert kinds("pay to DE88 3704 0044 0532 0130 00 now") == []
    assert kinds("id 123-45-6789 here") == [] and kinds("ssn 123-45-6789 here") == ["national_id"]
    assert kinds("card 378282246310005") == ["card_short"] and kinds("code 378282246310005") == []
    texts = [*EDGES, "mail a@b.co or c@d.org, ip 10.0.0.1"]
    found = pii.find_pii(docs_frame(spark, texts))
    assert sum(len(r["spans"]) for r in found.collect()) == 3
    clean = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert clean[len(EDGES)] == "mail [EMAIL] or [EMAIL], ip [IP]" and clean[1] is None


def test_pii_iban_before_other_words():
    found = lambda t: [t[s[1] : s[2]] for s in pii.find_spans(t) if s[0] == "iban"]
    plain, spaced, other = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO9386011117947"
    for own in (plain, spaced, other):
        for after in ("", " BIC COBADEFF", " EUR 50", " 12", " A", " AB12 CD", ", paid"):
            assert found(f"pay {own}{after}") == [own], (own, after)
    assert found(f"{other} {other} {plain}") == [other, other, plain]
    assert found(f"REF AA11 BB {plain} EUR 50") == [plain]  # behind a rejected head
    assert found("DE88370400440532013000 BIC COBADEFF") == found(f"{plain}X EUR 50") == []
    turned = next(f"XX{c:02d}12345678901234" for c in range(2, 99) if pii.mod97(f"XX{c:02d}12345678901234"))
    assert found(f"{turned} EUR 50") == [turned]  # a country without a fixed length


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op3_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.where("held_out").select("quality", "predicted", "score").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) >= 0.9
    score = {q: [r["score"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert np.mean([a > b for a in score[1] for b in score[0]]) > 0.85


def test_quality_edges(spark):
    docs, none = docs_frame(spark, EDGES), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1, None), (2, 1, 0), (None, 0, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, one)).collect()} == {1.0}


def test_quality_dictionary_holds_every_text():
    texts = ["".join(f"<{i:03d}>" for _ in range(200)) for i in range(quality.SAMPLE_DOCS // 2)]
    held = quality.dictionary(texts)
    assert len(held) <= quality.DICT_BYTES and all(f"<{i:03d}>".encode() in held for i in range(len(texts)))
    long = [("a" * 1000 + "b" * 1000 + "c" * 1000 + "d" * 1000) for _ in range(quality.SAMPLE_DOCS // 2)]
    assert all(quality.dictionary(long).count(c) > quality.DICT_BYTES // 8 for c in (b"a", b"b", b"c", b"d"))


def test_quality_learns_traits_after_the_opening(spark):
    rng = np.random.default_rng(5)
    opening = " ".join(f"head{i}" for i in range(300))  # longer than a dictionary's share of a text
    words = {y: ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (150, 7))] for y in (0, 1)}
    rows = [(i, i % 2, f"{opening} {' '.join(rng.choice(words[i % 2], 250))}") for i in range(240)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, quality int, text string"), [r[:2] for r in rows if r[0] < 200]
    model = quality.fit(docs.drop("quality"), spark.createDataFrame(labels, "doc_id long, quality int"))
    score = {y: [model.score(t) for i, q, t in rows if i >= 200 and q == y] for y in (0, 1)}
    assert np.mean([a > b for a in score[1] for b in score[0]]) > 0.95


def test_language_held_out_and_edges(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op4_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.93 and all(0 <= r["score"] <= 1 for r in rows)
    model = langid.KernelModel(["the cat and the dog", "le chat et le chien"] * 4, ["en", "fr"] * 4)
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs_frame(spark, [*EDGES, "the dog", "123"]), model).collect()}
    assert [out[i] for i in (0, 1, 3, 4, len(EDGES) + 1)] == ["und"] * 5 and out[len(EDGES)] == "en"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(docs_frame(spark, ["word"]), langid.fit(empty)).first()["lang_pred"] == "und"


def test_language_of_long_texts_only_is_learned(spark):
    words = {"aa": ["tok", "rel", "min", "sab"], "bb": ["quxo", "zwi", "jyf", "vhk"]}
    text = lambda k, i, n: " ".join(words[k][(i + j * j) % 4] + str(i % 10) for j in range(n))
    rows = [("aa", text("aa", i, 40)) for i in range(12)] + [("bb", text("bb", i, 1200 + i)) for i in range(12)]
    assert all((len(t) > langid.SAMPLE_CHARS) == (k == "bb") for k, t in rows)
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = langid.fit(docs)
    assert model.langs == ["aa", "bb"] and model.predict([text("aa", 3, 30), text("bb", 5, 30)])[0] == ["aa", "bb"]
    some, model_texts = [], langid.KernelModel
    try:  # the shortest of the long texts come first, after all short ones
        langid.KernelModel = lambda texts, langs: some.append(sorted(len(t) for t, k in zip(texts, langs, strict=True) if k == "bb"))
        langid.fit(docs, per_lang=5)
    finally:
        langid.KernelModel = model_texts
    assert some == [sorted(len(t) for k, t in rows if k == "bb")[:5]]


def test_language_kernel_is_the_blended_presence_kernel():
    grams = lambda t: {t.encode()[i : i + n] for n in (1, 2, 3) for i in range(len(t.encode()) - n + 1)}
    x, y = "le chat été", "the chat"
    a, b = langid.gram_codes(x), langid.gram_codes(y)
    assert len(a) == len(grams(x)) and len(np.intersect1d(a, b)) == len(grams(x) & grams(y))


def test_lm_base_columns_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80).collect()
    data = [(r["doc_id"], r["text"]) for r in rows] + [(10**6 + i, t) for i, t in enumerate(EDGES)] + [(None, "null id here")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    toks = {d: [*(t or "").encode().lower().split(), b"\n"] for d, t in data}
    learn = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 != 2
    counts = Counter(w for d, ws in toks.items() if learn(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    old = lm.DICTIONARY
    lm.DICTIONARY = 200  # most words go by the join
    try:
        got = lm.score_documents(docs, fold(F.col("doc_id"), 7) != 2).collect()
    finally:
        lm.DICTIONARY = old
    assert len(got) == len(data)
    for r in got:
        ws = toks[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
        assert r["learned"] == learn(r["doc_id"]) and r["score"] < 0


def test_lm_sums_to_one_and_carries_state():
    words = [b"w%d" % i for i in range(50)]
    n = np.arange(100, 50, -1)
    mass = np.ones(lm.RARE) * 3
    vocab = lm.Vocabulary(words, n, int(n.sum()), 50, mass)
    net = lm.Network(vocab)
    rng = np.random.default_rng(0)
    trainer = lm.Trainer(net)
    x = rng.integers(0, 50, (32, 4)).astype(np.int32)
    before = net.log_probs(net.states(x, x < 0, np.zeros((4, lm.HIDDEN), np.float32))[0].reshape(-1, lm.HIDDEN), x.ravel()).sum()
    for _ in range(30):
        trainer.window(x, x, x < 0, np.zeros((4, lm.HIDDEN), np.float32))
    after = net.log_probs(net.states(x, x < 0, np.zeros((4, lm.HIDDEN), np.float32))[0].reshape(-1, lm.HIDDEN), x.ravel()).sum()
    assert after > before  # it learns to copy its input
    ids = np.arange(net.k + lm.RARE)
    state = rng.standard_normal((1, lm.HIDDEN)).astype(np.float32)
    assert np.exp(net.log_probs(np.repeat(state, len(ids), 0), ids)).sum() == pytest.approx(1, abs=1e-4)
    long = rng.integers(0, 50, 3 * lm.SCORE_STEPS + 5).astype(np.int32)
    y, inputs, fresh = lm._stream([long], net.start)
    states, _ = net.states(inputs[:, None], fresh[:, None], np.zeros((1, lm.HIDDEN), np.float32))
    whole = net.log_probs(states[:, 0], y).sum() / math.log(10)
    assert lm.score_ids(net, [long, long[:7], long[:1]])[0] == pytest.approx(whole, rel=1e-4)


def test_lm_gradients_match_differences():
    vocab = lm.Vocabulary([b"w%d" % i for i in range(60)], np.arange(60, 0, -1), 2000, 60, np.ones(lm.RARE))
    net, rng = lm.Network(vocab), np.random.default_rng(1)
    for name in net.NAMES:
        w = getattr(net, name)
        if name not in ("bw",):
            setattr(net, name, (w + 0.1 * rng.standard_normal(w.shape)).astype(np.float64))
    x, y = rng.integers(0, net.k + lm.RARE, (6, 3)), rng.integers(0, net.k + lm.RARE, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[3, 1] = True
    h = rng.standard_normal((3, lm.HIDDEN))

    def loss():
        states, _ = net.states(x, fresh, h)
        return -net.log_probs(states.reshape(-1, lm.HIDDEN).astype(np.float64), y.ravel()).sum()

    seen = {}
    trainer = lm.Trainer(net)
    trainer._step = lambda name, grad, rows=slice(None): seen.__setitem__(name, (grad * y.size, rows))
    trainer.window(x, y, fresh, h)
    for name, at in (("u", (3, 5)), ("bias", (7,)), ("wc", (2, 1)), ("bc", (0,))):
        w = getattr(net, name)
        w[at] += 1e-2
        up = loss()
        w[at] -= 2e-2
        down = loss()
        w[at] += 1e-2
        assert seen[name][0][at] == pytest.approx((up - down) / 2e-2, rel=2e-2, abs=2e-3), name


def test_lm_trains_on_every_token_at_any_size(spark, monkeypatch):
    texts = [" ".join(f"w{(i * 7 + k) % 90}" for k in range(20 + i)) for i in range(150)] + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    vocab = lm.vocabulary(lm.count_words(docs))
    vocab.total = 50_000_000  # as in a large corpus
    rows = docs.select(F.lit(1).alias("doc_id"), "text", F.lit(True).alias("learned"))
    documents = lm.looked_up(rows, vocab)
    kept, real = [], lm.stage
    monkeypatch.setattr(lm, "stage", lambda df, name: kept.append(real(df, name)) or kept[-1])
    assert lm.train(documents, vocab) is not None
    learned = sum(w.agg(F.sum("n")).first()[0] or 0 for w in kept)
    assert learned == sum(len(lm.tokens(t)) for t in texts)
    lookup = lm.Lookup(vocab)
    stored = sorted(tuple(np.frombuffer(r["ids"], lm.ID)) for r in documents.select("ids").collect())
    assert stored == sorted(tuple(lookup(lm.tokens(t))[1]) for t in texts)


def test_lm_weights_are_averaged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "MEANS", 2)
    texts = [" ".join(f"w{(i * 5 + k) % 40}" for k in range(30)) for i in range(60)]
    rows = spark.createDataFrame([(i, t, i % 6 > 0) for i, t in enumerate(texts)], "doc_id long, text string, learned boolean")
    vocab = lm.vocabulary(lm.count_words(rows.where("learned").select("text")))
    documents = lm.looked_up(rows.repartition(7), vocab)
    assert documents.rdd.getNumPartitions() > 2
    weights = lm.train(documents, vocab)
    net = lm.Network(vocab)
    assert weights.shape == (sum(getattr(net, n).size for n in net.NAMES),) and np.isfinite(weights).all()
    lookup = lm.Lookup(vocab)
    held = [lookup(lm.tokens(t))[1] for t in texts[::6]]
    assert lm.score_ids(lm.Network(vocab).load(weights), held).sum() > lm.score_ids(net, held).sum()


def test_lm_filling_of_a_window_teaches_nothing():
    vocab = lm.Vocabulary([b"w%d" % i for i in range(60)], np.arange(60, 0, -1), 2000, 60, np.ones(lm.RARE))
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 60, (2, 6, 3)).astype(np.int32)
    real, fresh, h = np.ones((6, 3), bool), np.zeros((6, 3), bool), np.zeros((3, lm.HIDDEN), np.float32)
    real[4:, 2] = False
    nets = []
    for filled in (0, 59):
        nets.append(lm.Network(vocab))
        lm.Trainer(nets[-1]).window(np.where(real, x, filled), np.where(real, y, filled), fresh, h, real)
    assert all(np.array_equal(getattr(nets[0], n), getattr(nets[1], n)) for n in nets[0].NAMES)


def test_decontamination_edges_and_removal(spark):
    long = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, long), (2, "Short item"), (3, None), (4, "..."), (None, "nameless thing")], "item_id long, text string")
    texts = [None, "", f"A, b: {long.upper()}! tail", "this Short, ITEM x", "nameless thing", " ".join(long.split()[:9]), long + " " + long]
    docs = docs_frame(spark, [*texts, "clean text"])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontaminate.contamination(docs, bench).collect()}
    assert got[0] == got[1] == (0, 0, [])
    assert got[2] == (15, 12, ["1"]) and got[3] == (4, 2, ["2"]) and got[4] == (2, 2, []) and got[5] == (9, 0, [])
    assert got[6] == (24, 24, ["1"])
    left = decontaminate.remove(docs.unionByName(docs.limit(0)), bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 5, 7] and left.columns == docs.columns
    spans = {r["doc_id"]: r["text"] for r in decontaminate.remove(docs, bench, mode="spans").collect()}
    assert spans[2] == "A, b: tail" and spans[3] == "this x" and spans[6] == "" and spans[7] == "clean text" and spans[0] is None
    assert decontaminate.contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
