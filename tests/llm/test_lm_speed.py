"""The language model's passes work on many texts or lanes at once and give what
the plain definitions give."""

from __future__ import annotations

import math
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shardloom.llm import lm

ODD = [None, "", " ", "\n", "A b", " lead", "trail ", "a\x0bb\x0cc\rd\te\nf", "x\x1cy\x1fz\x85w v u", "ÀÉ Ab\x00c", "word " * 50, "日本 語", "b A a b"]


class Held:
    def __init__(self, value):
        self.value = value


def vocabulary(texts, size=None):
    counts = Counter(w for t in texts for w in lm.tokens(t))
    mass = np.ones(lm.RARE)
    best = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    for w, n in counts.items():
        mass[lm.rare_class(w)] += n + 1
    for w in best[: lm.NEURAL]:
        mass[lm.rare_class(w)] -= counts[w] + 1
    return lm.Vocabulary(best, np.array([counts[w] for w in best], np.int64), sum(counts.values()), len(counts), mass)


def one_row_batches(texts):
    for i, t in enumerate(texts):
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t], pa.string())], names=["rid", "text"])


def test_split_is_tokens_without_ends():
    words, sizes = lm.split(pa.array(ODD, pa.string()))
    assert words.to_pylist() == [w for t in ODD for w in lm.tokens(t)[:-1]]
    assert sizes.tolist() == [len(lm.tokens(t)) - 1 for t in ODD]
    middle = pa.array(ODD, pa.string()).slice(3, 6)
    assert lm.split(middle)[0].to_pylist() == [w for t in ODD[3:9] for w in lm.tokens(t)[:-1]]


@pytest.mark.parametrize("size", [None, 3, 0])
def test_lookup_is_that_of_single_words(size, monkeypatch):
    monkeypatch.setattr(lm, "NEURAL", 2)
    texts = [*ODD, "seen only here", "B b ÀÉ ÀÉ"]
    v = vocabulary(ODD, size)
    place = {w: i for i, w in enumerate(v.words)}
    got = [r for b in lm._look_up(Held(v))(one_row_batches(texts)) for r in b.to_pylist()]
    assert [r["rid"] for r in got] == [*range(len(texts))]
    for r, t in zip(got, texts, strict=True):
        words = lm.tokens(t)
        own = [place[w] if place.get(w, v.neural) < v.neural else v.neural + lm.rare_class(w) for w in words]
        assert np.frombuffer(r["ids"], lm.ID).tolist() == own and r["n_tokens"] == len(words)
        assert r["known"] == sum(w in place for w in words)
        log = {w: math.log10(v.counts[i] + 1) for w, i in place.items()}
        assert r["base"] == pytest.approx(sum(log.get(w, 0) for w in words))
        rare = [(w, c - v.neural) for w, c in zip(words, own, strict=True) if c >= v.neural]
        assert r["extra"] == pytest.approx(sum(log.get(w, 0) - math.log10(v.rare_mass[c]) for w, c in rare), abs=1e-9)
        assert {e["word"]: e["n"] for e in r["tail"]} == Counter(w for w in words if w not in place)


def test_small_batches_are_counted_and_looked_up_together():
    texts = [f"w{i % 7} x" for i in range(200)]
    assert len([*lm._look_up(Held(vocabulary(texts)))(one_row_batches(texts))]) == 1
    given = (b.select(["text"]) for b in one_row_batches(texts))
    (got,) = lm._count(given)
    assert dict(zip(*(c.to_pylist() for c in got.columns), strict=True)) == Counter(w for t in texts for w in lm.tokens(t))


def test_texts_over_the_limit_lose_nothing(monkeypatch):
    monkeypatch.setattr(lm, "TOGETHER", 50)
    texts = ["a b c d " * k for k in range(40)]
    total: Counter = Counter()
    for b in lm._count(b.select(["text"]) for b in one_row_batches(texts)):
        for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            total[w] += n
    assert total == Counter(w for t in texts for w in lm.tokens(t))


def test_counting_is_faster_than_word_by_word():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"Word{i}" for i in np.minimum(rng.zipf(1.3, 400), 50_000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    def seconds(run):
        took = []
        for _ in range(4):
            start = time.process_time()
            run()
            took.append(time.process_time() - start)
        return min(took)

    def plain():
        seen: Counter = Counter()
        for t in batch.column(0).to_pylist():
            seen.update(lm.tokens(t))

    assert seconds(lambda: [*lm._count(iter([batch]))]) < 0.75 * seconds(plain)


def test_large_logits_are_made_again():
    v = vocabulary([" ".join(f"w{i}" for i in range(60))])
    net, rng = lm.Network(v), np.random.default_rng(3)
    net.bc = (400 * rng.standard_normal(net.bc.shape)).astype(np.float32)
    net.ww = (300 * rng.standard_normal(net.ww.shape)).astype(np.float32)
    s, y = rng.uniform(-1, 1, (50, lm.HIDDEN)).astype(np.float32), rng.integers(0, net.k + lm.RARE, 50)
    log = lambda a: a - a.max() - math.log(np.exp(a - a.max()).sum())
    want = []
    for row, i in zip(s.astype(np.float64), y.tolist(), strict=True):
        c = i // lm.WIDTH if i < net.k else net.c + i - net.k
        p = log(row @ net.wc + net.bc)[c]
        want.append(p + log(row @ net.ww[c] + net.bw[c])[i % lm.WIDTH] if i < net.k else p)
    assert net.log_probs(s, y) == pytest.approx(np.array(want), rel=1e-4, abs=1e-2)
    grads: dict = {}
    assert net.log_probs(s, y, grads) == pytest.approx(np.array(want), rel=1e-4, abs=1e-2)
    assert all(np.isfinite(g).all() for g in grads.values())


def test_sums_by_id_are_plain_sums():
    rng = np.random.default_rng(4)
    for high in (1, 5, 4000):
        ids = rng.integers(0, high, 300)
        rows = rng.standard_normal((300, 6))
        order = np.argsort(ids, kind="stable")
        first = np.unique(ids[order], return_index=True)[1]
        want = np.array([rows[ids == i].sum(0) for i in np.unique(ids)])
        assert lm._sums(rows, order, first) == pytest.approx(want)
