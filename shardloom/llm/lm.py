"""Document scoring with a gated recurrent language model.

Counts: every training token is counted (partial counts in each task, summed
by word).  The ``NEURAL`` commonest words have outputs of their own, grouped
by rank into classes of ``WIDTH``; all other words belong to one of ``RARE``
classes named by their last bytes.  The model factors
P(word | past) = P(class | state) P(word | class, state), where a rare class
gives its words shares by their counts, (c + 1) / (sum of c + 1, plus 1), with one
share for all unseen words.  Each class therefore sums to one.

State: a gated recurrent unit, written in numpy.  Training runs truncated
backpropagation over windows of ``STEPS`` tokens, carrying the state from
window to window; a document starts with a zero state.  Tasks train from the
same weights on their own documents and the weights are averaged (weighted by
tokens), ``ROUNDS`` times.  Every token of every training document is learned from
once, at any size: a hash of the text deals the documents over the rounds.

Texts are split twice, to count and to look up, in Arrow and ``TOGETHER`` bytes at a
time: the token ids of every document, two bytes each, are written to the shared folder
with its counts, then trained on and scored.

Scoring carries the state across windows, so a document's log-likelihood is
that of the whole text whatever its length; many documents are scored side by
side.  Words in a dictionary of at most ``DICTIONARY`` common words are looked
up in the task; the others are joined with the table of counts.

Edge cases: a null or empty text has only the end token; with no training
documents every token is unseen and the model has one outcome, the unseen word
(score 0, base 0 as log10(1)); a null id counts as training (crc32 of an empty
text); repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapreplace
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import python_ready, small_batches, stage

HIDDEN = 16
NEURAL = 2048
WIDTH = 48
RARE = 32
SUFFIX = 3
STEPS = 16  # truncation of the backpropagation
LANES = 128  # documents trained on side by side
SCORE_STEPS = 32
SCORE_LANES = 128
ROUNDS = 2
RATE = 0.25
MEANS = 64  # weights that one task averages
DICTIONARY = 300_000
WORD_BYTES = 64  # longer words are joined, not looked up
TOGETHER = 4 << 20  # bytes of text that are split and looked up in one go
ID = np.dtype("<u2")  # stored token ids: own words, RARE classes and the start
END = b"\n"  # no word holds white space
SEED = 7


def tokens(text: str | None) -> list[bytes]:
    """Words (A-Z lower-cased) of the whole text, then the end token."""
    return [*(text or "").encode().lower().split(), END]


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % RARE


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``tokens`` of many texts one after another, without the ends,
    and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, cuts = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy().astype(np.int64)
    held = pc.binary_length(words).to_numpy() > 0  # blanks at an end leave an empty word
    if held.all():
        return words, np.diff(cuts)
    before = np.concatenate([[0], np.cumsum(held)])
    return words.filter(pa.array(held)), np.diff(before[cuts])


def _parts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches cut and joined to about ``TOGETHER`` bytes of the text in column ``at``."""
    held, size = [], 0
    for batch in batches:
        for part in small_batches(batch, at, TOGETHER):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(at))).as_py() or 0
            if size >= TOGETHER // 2 or len(held) >= 256:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


# ------------------------------------------------------------- counts
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches, 0):
        counts = split(part.column(0))[0].value_counts()
        words = pa.concat_arrays([counts.field(0), pa.array([END], pa.binary())])
        n = pa.concat_arrays([counts.field(1), pa.array([part.num_rows], pa.int64())])
        yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of a one-column table of texts, staged."""
    counted = texts.select(F.coalesce(texts[0], F.lit("")).alias("t")).mapInArrow(_count, "word binary, n long")
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "counts")


@dataclass
class Vocabulary:
    """Bounded summary of the counts that every task holds."""

    words: list[bytes]  # dictionary, by falling count
    counts: np.ndarray
    total: int  # N
    distinct: int  # V
    rare_mass: np.ndarray  # sum of c + 1 over the rare words of each class, plus 1

    def shape(self) -> Vocabulary:
        """What the network needs of it: all but the dictionary's rare part."""
        return Vocabulary(self.words[: self.neural], self.counts[: self.neural], self.total, self.distinct, self.rare_mass)

    @property
    def neural(self) -> int:
        return min(NEURAL, len(self.words))

    @property
    def classes(self) -> int:
        return -(-self.neural // WIDTH)


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    step = F.floor(F.log2("n") * 16)
    steps = short.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()  # at most 1024
    room, least = DICTIONARY, None
    for s, n in steps:
        if n > room:
            break
        room, least = room - n, s
    picked = [] if least is None else short.where(step >= least).select("word", "n").collect()
    picked = sorted(((int(r["n"]), bytes(r["word"])) for r in picked), key=lambda x: (-x[0], x[1]))
    words, n = [w for _, w in picked], np.array([c for c, _ in picked], np.int64)
    by = F.pmod(F.crc32(F.substring("word", -SUFFIX, SUFFIX)), F.lit(RARE)).alias("c")
    mass = np.ones(RARE)
    for c, m in counts.groupBy(by).agg(F.sum(F.col("n") + 1)).collect():  # at most RARE rows
        mass[c] += m
    for w, c in zip(words[:NEURAL], n[:NEURAL], strict=True):
        mass[rare_class(w)] -= int(c) + 1
    return Vocabulary(words, n, int(total or 0), int(distinct), mass)


class Lookup:
    """Word -> place in the dictionary and token id of the model."""

    def __init__(self, v: Vocabulary):
        self.neural, self.words = v.neural, pa.array(v.words, pa.binary())
        self.ids = np.arange(len(v.words), dtype=np.int32)
        if len(v.words) > v.neural:
            rare = np.fromiter(map(rare_class, v.words[v.neural :]), np.int32, len(v.words) - v.neural)
            self.ids[v.neural :] = v.neural + rare
        self.log_count = np.log10(v.counts + 1.0) if len(v.words) else np.zeros(0)

    def __call__(self, words: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place or -1, token id) of each word."""
        words = pa.array(words, pa.binary()) if isinstance(words, list) else words
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        ids = self.ids[at] if len(self.ids) else np.zeros(len(at), np.int32)
        gone = np.flatnonzero(at < 0)
        ids[gone] = [self.neural + rare_class(w) for w in words.take(pa.array(gone)).to_pylist()]
        return at, ids


# ------------------------------------------------------------- model
class Network:
    """Gated recurrent unit with a class-factored softmax.

    Token ids: 0..neural-1 own words, then RARE classes; inputs have one more
    id, the start.  Outputs: classes of own words, then the rare classes."""

    NAMES = ("gate", "u", "bias", "wc", "bc", "ww", "bw")

    def __init__(self, v: Vocabulary):
        rng, h = np.random.default_rng(SEED), HIDDEN
        k, c = v.neural, v.classes
        self.k, self.c, self.start = k, c, k + RARE
        ids = np.arange(k + RARE)
        self.class_of = np.where(ids < k, ids // WIDTH, c + ids - k).astype(np.int16)  # 16 bits: a radix sort
        self.place_of = np.where(ids < k, ids % WIDTH, 0)
        self.gate = (0.1 * rng.standard_normal((k + RARE + 1, 3 * h))).astype(np.float32)
        self.u = (rng.standard_normal((h, 3 * h)) / math.sqrt(h)).astype(np.float32)
        self.bias = np.zeros(3 * h, np.float32)
        self.bias[:h] = -1.0  # keep the state at first
        self.wc = np.zeros((h, c + RARE), np.float32)
        self.ww = np.zeros((c, h, WIDTH), np.float32)
        own = np.zeros(c * WIDTH)
        own[:k] = v.counts[:k] + 1.0
        own = own.reshape(c, WIDTH)
        with np.errstate(divide="ignore"):
            self.bw = np.maximum(np.log(own / np.maximum(own.sum(1, keepdims=True), 1e-30)), -1e9).astype(np.float32)
        mass = np.concatenate([own.sum(1), v.rare_mass])
        self.bc = np.log(mass / mass.sum()).astype(np.float32)

    def to_bytes(self) -> bytes:
        return b"".join(getattr(self, n).tobytes() for n in self.NAMES)

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def states(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Run a window.  x: inputs (steps x lanes); fresh: where a document
        starts; h: state before.  Returns all states and the last one; ``keep``
        gets what the way back needs.  Steps write into arrays made once."""
        n, (steps, lanes) = HIDDEN, x.shape
        kind = np.result_type(self.u, h)
        a = self.gate.reshape(-1, n).take((3 * x)[:, None] + np.arange(3)[:, None], 0)  # steps x (z, r, c) x lanes x n: each in one piece
        a += np.repeat(self.bias.reshape(3, 1, n), lanes, 1)
        u_zr = np.ascontiguousarray(self.u[:, : 2 * n].reshape(n, 2, n).transpose(1, 0, 2))
        u_c = np.ascontiguousarray(self.u[:, 2 * n :])
        held = steps if keep is not None else 1
        zr, rh, c = np.empty((held, 2, lanes, n), kind), np.empty((held, lanes, n), kind), np.empty((held, lanes, n), kind)
        out, step = np.empty((steps, lanes, n), kind), np.empty((lanes, n), kind)
        any_fresh, first = fresh.any(1).tolist(), h
        matmul, dot, add, multiply, subtract, negative = np.matmul, np.dot, np.add, np.multiply, np.subtract, np.negative
        exp, tanh, reciprocal = np.exp, np.tanh, np.reciprocal
        g, k, m = zr[0], rh[0], c[0]
        for t in range(steps):
            if any_fresh[t]:
                h = np.where(fresh[t][:, None], kind.type(0), h)
            if held > 1:
                g, k, m = zr[t], rh[t], c[t]
            now = a[t]
            matmul(h, u_zr, out=g)
            add(g, now[:2], out=g)
            exp(negative(g, out=g), out=g)  # a gate is 1 / (1 + exp(-a))
            add(g, 1, out=g)
            reciprocal(g, out=g)
            dot(multiply(g[1], h, out=k), u_c, out=m)
            add(m, now[2], out=m)
            tanh(m, out=m)
            subtract(m, h, out=step)
            multiply(step, g[0], out=step)
            h = add(h, step, out=out[t])
        if keep is not None:
            before = np.concatenate([first[None], out[:-1]])
            before[fresh] = 0
            keep.update(before=before, z=zr[:, 0], r=zr[:, 1], rh=rh, c=c)
        return out, h

    def log_probs(self, s: np.ndarray, y: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """Natural log P(token id) for states s (m x h); a rare id's is that of
        its class.  With ``grads``, also gradients of the summed loss, and ``ds``."""
        order = np.argsort(cls := self.class_of.take(y), kind="stable")
        s, y, cls = s.take(order, 0), y.take(order), cls.take(order)
        cuts = np.searchsorted(cls, np.arange(self.c + 1))
        out, p = _softmax(lambda: np.add(logit := s @ self.wc, self.bc, out=logit), cls, grads is not None)
        if grads is not None:
            grads["wc"], grads["bc"] = s.T @ p, np.einsum("ij->j", p)
            ds = p @ self.wc.T
            grads["ww"], grads["bw"] = np.zeros_like(self.ww), np.zeros_like(self.bw)
        held, own = np.flatnonzero(np.diff(cuts)), int(cuts[-1])  # classes that occur; rows of own words, by class
        if own:
            parts = [(c, s[a:b], slice(a, b)) for c, a, b in zip(held.tolist(), cuts[held].tolist(), cuts[held + 1].tolist(), strict=True)]
            dot, ww = np.dot, [*self.ww]

            def logits() -> np.ndarray:
                logit = np.empty((own, WIDTH), np.result_type(s, self.ww))
                for c, rows, at in parts:
                    dot(rows, ww[c], out=logit[at])
                logit += self.bw.take(cls[:own], 0)
                return logit

            more, p = _softmax(logits, self.place_of.take(y[:own]), grads is not None)
            out[:own] += more
        if own and grads is not None:
            grads["bw"][held] = np.add.reduceat(p, cuts[held])
            back, ww_t, to_ww = np.empty((own, HIDDEN), p.dtype), [*self.ww.transpose(0, 2, 1)], [*grads["ww"]]
            for c, rows, at in parts:
                dot(rows.T, q := p[at], out=to_ww[c])
                dot(q, ww_t[c], out=back[at])
            ds[:own] += back
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        if grads is not None:
            grads["ds"] = ds.take(back, 0)
        return out.take(back)


def _softmax(logits: Callable[[], np.ndarray], at: np.ndarray, slope: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """log softmax at one place of each row, and (if asked) softmax minus one-hot.
    ``logits`` makes an array that is written over."""
    p = logits()
    flat = np.arange(0, p.size, p.shape[1])
    flat += at
    own = p.take(flat)
    with np.errstate(over="ignore"):
        np.exp(p, out=p)
    ones = np.ones(p.shape[1], p.dtype)
    total = p @ ones
    if not (np.isfinite(total).all() and total.all()):  # rare: large logits
        p = logits()
        top = p.max(1)
        own = own - top
        p -= top[:, None]
        np.exp(p, out=p)
        total = p @ ones
    out = own - np.log(total)
    if not slope:
        return out, None
    p /= total[:, None]
    p.reshape(-1)[flat] -= 1
    return out, p


class Trainer:
    """Truncated backpropagation with Adagrad steps."""

    def __init__(self, net: Network):
        self.net = net
        self.sq = {n: np.full_like(getattr(net, n), 1e-3) for n in net.NAMES}

    def _step(self, name: str, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        """A step of all weights of a name or of some rows; ``grad`` is written over."""
        w, sq = getattr(self.net, name), self.sq[name]
        root = grad * grad
        if rows is None:
            sq += root
            np.sqrt(sq, out=root)
        else:
            root += sq.take(rows, 0)
            sq[rows] = root
            np.sqrt(root, out=root)
        grad *= RATE
        grad /= root
        if rows is None:
            w -= grad
        else:
            w[rows] = w.take(rows, 0) - grad

    def window(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, real: np.ndarray | None = None) -> np.ndarray:
        """One step on a window.  ``real``: where it holds tokens, if not everywhere;
        the rest of such a lane is filling, which has no loss."""
        net, n = self.net, HIDDEN
        keep: dict = {}
        states, last = net.states(x, fresh, h, keep)
        grads: dict = {}
        if real is None:
            net.log_probs(states.reshape(-1, n), y.ravel(), grads)
            ds, size = grads.pop("ds").reshape(states.shape), y.size
        else:
            net.log_probs(states[real], y[real], grads)
            ds, size = np.zeros_like(states), int(real.sum())
            ds[real] = grads.pop("ds")
        scale = np.float32(1.0 / size)
        u_zr, u_c = np.ascontiguousarray(net.u[:, : 2 * n].T), np.ascontiguousarray(net.u[:, 2 * n :].T)
        before, z, r, rh, c = (keep[k] for k in ("before", "z", "r", "rh", "c"))
        stay, to_z, to_c, to_r = 1 - z, c - before, c * c, before * r
        to_z *= z
        to_z *= stay
        np.subtract(1, to_c, out=to_c)
        to_c *= z
        to_r *= 1 - r
        any_fresh, (steps, lanes) = fresh.any(1).tolist(), x.shape
        a = np.empty((steps, lanes, 3 * n), states.dtype)
        dh, drh, more = np.zeros_like(last), np.empty_like(last), np.empty_like(last)
        dot, add, multiply = np.dot, np.add, np.multiply
        for t in range(steps - 1, -1, -1):
            d, g = ds[t], a[t]
            add(d, dh, out=d)
            dot(multiply(d, to_c[t], out=g[:, 2 * n :]), u_c, out=drh)
            multiply(d, to_z[t], out=g[:, :n])
            multiply(drh, to_r[t], out=g[:, n : 2 * n])
            multiply(d, stay[t], out=dh)
            multiply(drh, r[t], out=drh)
            add(dh, drh, out=dh)
            add(dh, dot(g[:, : 2 * n], u_zr, out=more), out=dh)
            if any_fresh[t]:
                dh[fresh[t]] = 0
        flat = a.reshape(-1, 3 * n)
        du = np.concatenate([before.reshape(-1, n).T @ flat[:, : 2 * n], rh.reshape(-1, n).T @ flat[:, 2 * n :]], 1)
        ids = x.ravel().astype(np.uint16)  # 16 bits: a radix sort
        order = np.argsort(ids, kind="stable")
        ids = ids.take(order)
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        self._step("gate", _sums(flat, order, first) * scale, ids.take(first))
        self._step("u", du * scale)
        self._step("bias", np.einsum("ij->j", flat) * scale)
        for name, grad in grads.items():
            grad *= scale
            self._step(name, grad)
        return last


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each id, given their order by id and where ids start in it.
    Most ids of a window occur once: their rows are copied."""
    sizes = np.diff(first, append=len(order))
    often = sizes > 1
    out = rows.take(order.take(first), 0)
    if often.any():
        sizes = sizes[often]
        held = rows.take(order[np.repeat(often, np.diff(first, append=len(order)))], 0)
        out[often] = np.add.reduceat(held, np.cumsum(sizes) - sizes)
    return out


def _stream(docs: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets, inputs and document starts of documents one after another."""
    y = np.concatenate(docs)
    heads = np.cumsum([0, *(len(d) for d in docs[:-1])])
    fresh = np.zeros(len(y), bool)
    fresh[heads] = True
    x = np.concatenate([[start], y[:-1]]).astype(np.int32)
    x[heads] = start
    return y, x, fresh


def _train(shape, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shape.value)
        if weights is not None:
            net.load(weights.value)
        trainer, used, pending, size = Trainer(net), 0, [], 0

        def learn() -> int:
            y, x, fresh = _stream(pending, net.start)
            lanes = min(LANES, max(1, len(y) // STEPS))
            size, length = len(y), -(-len(y) // lanes)
            real = np.arange(lanes * length) < size
            y, x, fresh = (np.pad(a, (0, lanes * length - size)) for a in (y, x, fresh))
            y, x, fresh, real = (a.reshape(lanes, length).T for a in (y, x, fresh, real))
            h = np.zeros((lanes, HIDDEN), np.float32)
            for t in range(0, length, STEPS):
                at = slice(t, t + STEPS)
                h = trainer.window(x[at], y[at], fresh[at], h, None if real[at].all() else real[at])
            return size

        for batch in batches:
            for part in small_batches(batch, 0):
                for ids in part.column(0).to_pylist():
                    pending.append(np.frombuffer(ids, ID).astype(np.int32))
                    size += len(pending[-1])
                    if size >= 250_000:
                        used += learn()
                        pending, size = [], 0
        if pending:
            used += learn()
        if used:
            yield pa.RecordBatch.from_arrays([pa.array([net.to_bytes()], pa.binary()), pa.array([used], pa.int64())], names=["w", "n"])

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        for w, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(w, np.float32).astype(np.float64) * k
            total, n = part if total is None else total + part, n + k
    if n:
        mean = (total / n).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([mean], pa.binary()), pa.array([n], pa.int64())], names=["w", "n"])


def train(documents: DataFrame, vocab: Vocabulary) -> np.ndarray | None:
    """Averaged weights (flat float32) from the learned rows of ``looked_up``
    documents, or None if there is nothing to learn from."""
    spark = documents.sparkSession
    if not vocab.total:
        return None
    held = spark.sparkContext.broadcast(vocab.shape())
    flat, kind = None, "w binary, n long"
    for r in range(ROUNDS):
        now = None if flat is None else spark.sparkContext.broadcast(flat)
        rows = documents.where(F.col("rid.learned") & (F.col("rid.round") == r)).select("ids")
        means = stage(rows.mapInArrow(_train(held, now), kind), "weights")
        left = means.count()  # one row a task that trained
        while left > 8:
            left = max(8, -(-left // MEANS))
            means = means.repartition(left).mapInArrow(_mean, kind)
        means = means.collect()  # at most 8 rows
        if means:
            n = sum(m["n"] for m in means)
            flat = sum(np.frombuffer(m["w"], np.float32).astype(np.float64) * (m["n"] / n) for m in means).astype(np.float32)
    return flat


# ------------------------------------------------------------- scores
def score_ids(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each document's ids (at least one each), state
    carried from its first to its last token."""
    lanes = min(SCORE_LANES, len(docs))
    load, held = [(0, i) for i in range(lanes)], [[] for _ in range(lanes)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):  # longest first, to the shortest lane
        size, lane = load[0]
        held[lane].append(d)
        heapreplace(load, (size + len(docs[d]), lane))
    held.sort(key=lambda ds: -sum(len(docs[d]) for d in ds))
    sizes = np.array([sum(len(docs[d]) for d in ds) for ds in held])
    length = int(sizes[0])
    y, x = np.zeros((lanes, length), np.int32), np.zeros((lanes, length), np.int32)  # a lane in one piece
    fresh, owner = np.zeros((lanes, length), bool), np.zeros((lanes, length), np.int32)
    for i, ds in enumerate(held):
        y[i, : sizes[i]], x[i, : sizes[i]], fresh[i, : sizes[i]] = _stream([docs[d] for d in ds], net.start)
        owner[i, : sizes[i]] = np.repeat(ds, [len(docs[d]) for d in ds])
    total, h = np.zeros(len(docs)), np.zeros((lanes, HIDDEN), np.float32)
    for t in range(0, length, SCORE_STEPS):
        n = int(np.searchsorted(-sizes, -t, "left"))  # lanes longer than t
        stop = min(length, t + SCORE_STEPS)
        states, h = net.states(x[:n, t:stop].T, fresh[:n, t:stop].T, h[:n])
        targets, owners = y[:n, t:stop].T, owner[:n, t:stop].T
        if sizes[n - 1] >= stop:
            states, targets, owners = states.reshape(-1, HIDDEN), targets.ravel(), owners.ravel()
        else:
            real = np.arange(t, stop)[:, None] < sizes[None, :n]
            states, targets, owners = states[real], targets[real], owners[real]
        total += np.bincount(owners, net.log_probs(states, targets), len(docs))
    return total / math.log(10)


def _look_up(vocab):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        lookup, log_mass = Lookup(v), np.log10(v.rare_mass)
        end = lookup([END])
        for part in _parts(batches, 1):
            words, sizes = split(part.column(1))
            sizes += 1
            heads = np.concatenate([[0], np.cumsum(sizes)])
            inner = np.ones(heads[-1], bool)
            inner[heads[1:] - 1] = False  # the rest are ends
            at, own = np.empty(len(inner), np.int32), np.empty(len(inner), np.int32)
            at[~inner], own[~inner] = end
            at[inner], own[inner] = lookup(words)
            held = at >= 0
            log = np.where(held, lookup.log_count[at], 0.0) if len(v.words) else np.zeros(len(at))
            rare = own >= v.neural
            more = np.where(rare, log, 0.0)
            more[rare] -= log_mass[own[rare] - v.neural]
            known, base, extra = (np.add.reduceat(c, heads[:-1]) for c in (held.astype(np.int64), log, more))
            stored = own.astype(ID).tobytes()
            ids = [stored[a:b] for a, b in pairwise((heads * ID.itemsize).tolist())]
            ends, rest, times, gone = [0], [], [], np.flatnonzero(~held)
            tail = words.take(pa.array(np.flatnonzero(~held[inner]))).to_pylist()
            if end[0][0] < 0:  # the end token is in no dictionary
                tail = [*map(dict(zip(np.flatnonzero(~held & inner).tolist(), tail, strict=True)).get, gone.tolist(), repeat(END))]
            for a, b in pairwise(np.searchsorted(gone, heads).tolist()):
                if a < b:
                    n = Counter(tail[a:b])
                    rest += n.keys()
                    times += n.values()
                ends.append(len(rest))
            tail = pa.StructArray.from_arrays([pa.array(rest, pa.binary()), pa.array(times, pa.int32())], names=["word", "n"])
            tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tail)
            cols = [part.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(known, pa.int64())]
            cols += [pa.array(base, pa.float64()), pa.array(extra, pa.float64()), tails]
            yield pa.RecordBatch.from_arrays(cols, names=["rid", "ids", "n_tokens", "known", "base", "extra", "tail"])

    return run


def looked_up(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Rows (doc_id, text, learned) with token ids and what the counts say of them,
    staged; ``round`` is the round of training, by a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    deal = F.pmod(F.xxhash64(text), F.lit(ROUNDS)).cast("int").alias("round")
    rid = F.struct(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("string").alias("doc_id"), "learned", deal)
    kind = (
        "rid struct<rid:long,doc_id:string,learned:boolean,round:int>, ids binary, n_tokens long, known long, base double, "
        "extra double, tail array<struct<word:binary,n:int>>"
    )
    held = rows.sparkSession.sparkContext.broadcast(vocab)
    return stage(rows.select(rid.alias("rid"), "text").mapInArrow(_look_up(held), kind), "ids")


def _score(shape, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shape.value)
        if weights is not None:
            net.load(weights.value)
        for batch in batches:
            for part in small_batches(batch, 1):
                ids = [np.frombuffer(b, ID).astype(np.int32) for b in part.column(1).to_pylist()]
                model = score_ids(net, ids) + part.column(5).to_numpy()
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:5], pa.array(model, pa.float64())], names=SCORED)

    return run


SCORED = ["rid", "n_tokens", "known", "base", "model"]


def score_documents(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the rows of ``docs`` for which ``learn`` holds, score all rows:
    doc_id, learned (the condition), n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), learn.alias("learned"))
    training = rows.where("learned").select("text")
    counts = count_words(training)
    vocab = vocabulary(counts)
    documents = looked_up(rows, vocab)
    weights = train(documents, vocab)
    held = spark.sparkContext.broadcast(vocab.shape())
    flat = None if weights is None else spark.sparkContext.broadcast(weights)

    kind = f"rid {documents.schema['rid'].dataType.simpleString()}, n_tokens long, known long, base double, model double"
    given = documents.select("rid", "ids", "n_tokens", "known", "base", "extra")
    scored = given.mapInArrow(_score(held, flat), kind)
    tail = documents.select(F.col("rid.rid").alias("rid"), F.explode("tail").alias("t")).select("rid", "t.word", F.col("t.n").alias("times"))
    joined = tail.join(counts, "word", "left")
    tail = joined.groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("tail_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
    )
    flat_rows = stage(scored, "scored").select(
        F.col("rid.rid").alias("rid"), F.col("rid.doc_id").cast(rows.schema["doc_id"].dataType).alias("doc_id"),
        F.col("rid.learned").alias("learned"), "n_tokens", "known", "base", "model",
    )
    more = F.coalesce("tail_log", F.lit(0.0))
    unit = math.log10(vocab.total + vocab.distinct + 1)
    return flat_rows.join(tail, "rid", "left").select(
        "doc_id",
        "learned",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
