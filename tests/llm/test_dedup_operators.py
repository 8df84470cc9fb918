"""Near copies, lines, vectors, fixity and the pipeline against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shardloom.llm import embdedup, fixity, linededup, minhash
from shardloom.llm.components import components

SF = "/root/testdata/sf0.001"
EDGES = ["", None, "a", " \n ", "one two", "One  two", "x " * 3000]


def low_labels(nodes, links):
    """Smallest node reachable."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (300, 299), (299, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in low_labels({x for p in links for x in p}, links).items() if k != 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(n, rng, words=60):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            t[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(t)


@pytest.mark.parametrize(("k", "threshold", "small"), [(3, 85, 64), (5, 80, 3)])
def test_minhash_equals_brute_force(spark, monkeypatch, k, threshold, small):
    monkeypatch.setattr(minhash, "SMALL", small)  # 3: buckets go the way of crowds
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(k)
    texts = [*EDGES, *near_copies(70, rng), *near_copies(30, rng, 25), *near_copies(8, rng)]
    texts += texts[10:20]
    rows = [(i * 3 if i != 12 else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])
    ]
    place = low_labels(range(len(rows)), links)
    ids = defaultdict(list)
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            ids[place[i]].append(d)
    want = sorted((d if d is not None else -1, len(sets[i]), min(ids[place[i]])) for i, (d, _, _) in enumerate(rows))
    got = minhash.link_documents(docs, k=k, threshold=threshold).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"]) for r in got) == want
    kept = minhash.deduplicate(docs, k=k, threshold=threshold)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want})


def test_minhash_pruning_and_empty(spark):
    for n, least in minhash.least_matches(80):
        assert 0 <= least <= n
    assert minhash.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_lines(rows, run, gram):
    """The definition, one document after another: every selected gram against its first
    occurrence, and every window (shortest run of ``run`` words from a line on) against all earlier ones."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    lines = {i: [x.encode().strip() for x in (rows[i][1] or "").split("\n") if x.encode().strip()] for i in order}
    first, marks = {}, defaultdict(list)
    for i in order:
        h, w = linededup.content_lines(rows[i][1])
        for s in range(len(h)):
            ends = [e for e in range(s + 1, len(h) + 1) if sum(w[s:e]) >= run]
            if not ends:
                continue
            grams = []
            for a in range(s, ends[0]):
                stop = next((e for e in range(a + 1, ends[0] + 1) if sum(w[a:e]) >= gram), None)
                if stop:
                    grams.append((linededup.xxhash.xxh3_64_intdigest(h[a:stop].tobytes()), -a))
            m, a = min(grams)
            if (m, -a) not in marks[i]:
                marks[i].append((m, -a))
        for m, a in sorted(marks[i], key=lambda x: x[1]):
            first.setdefault(m, (i, a))
    gone = defaultdict(set)
    for i in order:
        for m, a in marks[i]:
            j, b = first[m]
            if (i, a) == (j, b):
                continue
            x, y, s, e = lines[i], lines[j], 0, 0
            while a - s > 0 and b - s > 0 and x[a - s - 1] == y[b - s - 1]:
                s += 1
            while a + e < len(x) and b + e < len(y) and x[a + e] == y[b + e]:
                e += 1
            if sum(len(t.split()) for t in x[a - s : a + e]) >= gram:
                gone[i] |= set(range(a - s, a + e))
    seen = set()
    for i in order:
        x = lines[i]
        for s in range(len(x)):
            e = next((e for e in range(s + 1, len(x) + 1) if sum(len(t.split()) for t in x[s:e]) >= run), None)
            if e is not None:
                if tuple(x[s:e]) in seen:
                    gone[i] |= set(range(s, e))
                seen.add(tuple(x[s:e]))
    return {i: len(gone[i]) for i in order}


def test_a_run_goes_though_an_older_document_shares_its_middle(spark):
    """In some of the word sets the only fingerprint falls on the middle line, whose first occurrence stands alone."""
    for seed in range(6):
        rng = random.Random(seed)
        line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(45))
        x, y, z, other = (line() for _ in range(4))
        rows = [(1, f"{y}\n{other}"), (2, "\n".join((x, y, z))), (3, "\n".join((x, y, z)))]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r for r in linededup.dedup_report(docs).collect()}
        lines, deleted, _ = linededup.REPORT
        assert got[3][lines] == got[3][deleted] == 3 and got[1][deleted] == 0
        assert {i: got[i][deleted] for i in (1, 2, 3)} == {i + 1: n for i, n in brute_lines(rows, 48, 40).items()}


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(f"p{rng.randrange(30)}" for _ in range(rng.randrange(1, 9))) for _ in range(12)]
    passage = [" ".join(f"q{i}x{j}" for j in range(11)) for i in range(5)]
    texts = list(EDGES)
    for i in range(60):
        t = [rng.choice(pool) for _ in range(rng.randrange(0, 25))]
        if i % 3 == 0:
            t[len(t) // 2 : len(t) // 2] = passage
        texts.append("\n".join(t) + ("\n\n" if i % 2 else ""))
    texts += ["\n".join(passage), "same line of some words here\n" * 30]
    rows = [(i * 7 % 101 if i != 20 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs long").repartition(1)
    out = linededup.dedup_report(docs)
    got = {r["runs"]: r for r in out.collect()}
    place = [r["runs"] for r in docs.collect()]
    want = brute_lines([rows[i] for i in place], linededup.RUN, linededup.GRAM)
    assert {i: got[i]["__ll_deleted"] for i in got} == {place[k]: v for k, v in want.items()}
    whole = "\n".join(passage)
    assert sum(whole in (r["text"] or "") for r in got.values()) == 1  # the first copy stays
    assert got[1]["text"] is None and got[0]["text"] == ""
    assert got[len(texts) - 1]["text"].count("same line") in (1, 0)
    left = linededup.deduplicate(docs)
    assert left.columns == docs.columns and left.where(F.col("text") == "").count() <= 2
    assert linededup.deduplicate(docs.limit(0)).count() == 0


def test_line_dedup_misses_no_run_that_shares_a_part(spark):
    """The first place of a part of a passage is in a document without the rest."""
    line = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    a, b, c = line("a", 22), line("b", 22), line("c", 22)
    texts = [f"own one\n{a}\nother\n{b}", f"{b}\nother\n{c}", *(f"{line(f'd{i}x', 9)}\n{a}\n{b}\n{c}\nend {i}" for i in range(4))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in linededup.dedup_report(docs).collect()}
    assert left[0] == texts[0] and left[1] == texts[1] and left[2] == texts[2]
    assert [left[i] for i in (3, 4, 5)] == [f"{line(f'd{i - 2}x', 9)}\nend {i - 2}" for i in (3, 4, 5)]


def brute_vectors(rows, threshold=0.98):
    ok = [r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) for r in rows]
    links = []
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if ok[i] and ok[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links.append((i, j))
    place = low_labels(range(len(rows)), links)
    degree = [sum(i in p for p in links) for i in range(len(rows))]
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[place[i]].append(r[0])
    return sorted((r[0], degree[i], min(ids[place[i]])) for i, r in enumerate(rows))


@pytest.mark.parametrize("leaf", [8, 512])
def test_vectors_equal_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(embdedup, "BLOCK", 12)
    rng = np.random.default_rng(5)
    vecs = [list(map(float, rng.standard_normal(16))) for _ in range(60)]
    for i in range(80):  # a tight group and pairs near the threshold
        vecs.append(list(map(float, np.array(vecs[i % 3]) + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2]))))
    vecs += [vecs[0]] * 5 + [[2 * x for x in vecs[1]], [0.0] * 16, None, [1.0, None], [float("nan")] * 16, [], [1.0] * 3, [1.0, 1.0, 1.01]]
    rows = [(i, v, None if i == 7 else i % 2 if i < 60 else (i % 3) % 2) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embdedup.link_vectors(df, leaf=leaf).collect())
    assert got == brute_vectors(rows)
    assert embdedup.link_vectors(df.limit(0)).count() == 0


def test_fixity_edges(spark):
    rows = [("f", 0, 10, "a"), ("f", 10, 5, "b"), ("f", fixity.RANGE * 40, 7, "c"), ("g", 0, 1, "d"), ("g", 0, 1, "d"), ("h", 0, 2, "e")]
    kind = "file string, offset long, length long, digest string"
    a = spark.createDataFrame(rows, kind)
    assert fixity.audit(a, a).count() == 0
    b = spark.createDataFrame([rows[0], ("f", 10, 5, "X"), rows[2], rows[3], ("k", 3, 1, "z")], kind)
    got = sorted((r["file"], r["offset"], r["status"]) for r in fixity.audit(a, b).collect())
    assert got == [("f", 10, "changed"), ("g", 0, "changed"), ("h", 0, "missing"), ("k", 3, "extra")]
    assert {r["status"] for r in fixity.audit(a, a.limit(0)).collect()} == {"missing"} and fixity.audit(a.limit(0), a.limit(0)).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "u", "é"), (1, "u", "é"), (600, None, "h")], "page_id long, url string, html string")
    laid = fixity.lay_out(fixity.warc_records(pages).withColumn("digest", fixity.digest(F.col("payload"))).drop("payload")).collect()
    assert sorted({r["file"] for r in laid}) == ["crawl-0.warc", "crawl-1.warc", "crawl-none.warc"]
    same = sorted((r["offset"], r["length"]) for r in laid if r["file"] == "crawl-0.warc")
    assert same[0][0] == 0 and same[1][0] == same[0][1]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, table = docs.columns, docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, table, SF).cache()
        assert out.columns == columns and 0 < out.count() <= table.count(), name
        table = out
    last = corpus_pipeline.STAGES[-1][1](spark, table, SF)
    assert last.where("not round_trip").count() == 0 and last.count() == table.count()
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", "s", 0)], docs.schema)
    for _, function in corpus_pipeline.STAGES:
        function(spark, odd, SF).collect()
        function(spark, docs.limit(0), SF).collect()
