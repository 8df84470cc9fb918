"""Compression classifier of text quality.

Two zstandard dictionaries hold good and bad labelled text.  A text that is
like one of them compresses better with it, so the difference of the two
compressed sizes, normalised by their sum, tells the classes apart; a logistic
curve fitted on labelled texts outside the dictionaries turns it into a
probability.  Repetition shows in the compressed size against the length,
which enters the same curve.

Fitting uses a bounded sample of the labelled rows (``SAMPLE_DOCS`` a class,
texts of ``SAMPLE_CHARS`` at most, chosen by a hash of the id); scoring covers
every whole text in one pass without a shuffle.  Half of the sample fills the
dictionaries, the other half fits the curve.  A dictionary holds ``DICT_BYTES`` at
most, dealt evenly: each of its n texts gives ``DICT_BYTES // n - 1`` bytes (130 at
the full sample of 750), in pieces of about ``SPAN`` spread over the whole text.

Edge cases: null and empty texts score as the curve gives for "no evidence";
without labelled rows of both classes every text gets the share of good labels
(0.5 without any label); labels that are neither 0 nor 1, or null, are left
out; a document labelled twice alike counts once (of two texts under one id, the
one whose hash sorts first), labelled both ways once in each class; extra columns
are kept, one with the name of the output (in any case) is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import add_columns, columns_but, python_ready, small_batches

SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
DICT_BYTES = 96 << 10
SPAN = 64
LEVEL = 3
#: Bytes that are compressed at a time with a dictionary: a long text would
#: otherwise be compressed by its own beginning and the dictionary not matter.
PIECE = 1024


@dataclass
class QualityModel:
    """Dictionaries and the curve; sent to the executors (about 200 kB)."""

    good: bytes
    bad: bytes
    weights: list[float]
    prior: float
    _sizes: tuple | None = field(default=None, repr=False)

    def features(self, text: str | None) -> list[float]:
        data = (text or "").encode()
        if not data or not self.good:
            return [0.0, 0.0, 0.0]
        if self._sizes is None:
            kinds = zstandard.DICT_TYPE_RAWCONTENT
            dicts = [zstandard.ZstdCompressionDict(d, dict_type=kinds) for d in (self.good, self.bad)]
            for d in dicts:
                d.precompute_compress(level=LEVEL)
            flags = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
            self._sizes = (*(zstandard.ZstdCompressor(dict_data=d, **flags) for d in dicts), zstandard.ZstdCompressor(level=LEVEL, **flags))
        by_good, by_bad, alone = (c.compress for c in self._sizes)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        good, bad = sum(len(by_good(p)) for p in pieces), sum(len(by_bad(p)) for p in pieces)
        return [(bad - good) / (bad + good), math.log(good / len(data)), math.log(len(alone(data)) / len(data))]

    def score(self, text: str | None) -> float:
        if not self.good:
            return self.prior
        x = self.features(text)
        z = sum(w * v for w, v in zip(self.weights, _expand(x), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))

    def __getstate__(self):
        return {**self.__dict__, "_sizes": None}


def _expand(x: list[float]) -> list[float]:
    """Terms of the curve: both signals and the square of the repetition signal."""
    diff, dense, plain = x
    return [1.0, 10.0 * diff, dense, plain, plain * plain]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Damped Newton steps on the ridge-penalised loss (convex, and every step
    lowers it); classes weighted equally so that the curve does not lean on
    their shares."""
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    sign = 2 * y - 1

    def loss(w: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, -sign * (x @ w)) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-9 and loss(w - size * step) > now - 1e-4 * size * float(grad @ step):
            size /= 2
        if size <= 1e-9:
            break
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(1.0, now):
            break
    return w


def dictionary(texts: list[str]) -> bytes:
    """Pieces of every text, one from each of its equal parts; where in the
    part turns with the text's place, so that no place in the texts is left out."""
    share = max(1, DICT_BYTES // len(texts) - 1)
    k = max(1, share // SPAN)
    size, parts = share // k, []
    for i, t in enumerate(texts):
        data = t.encode()
        if len(data) > share:
            turn, room = i * 0.618034 % 1, len(data) - size
            data = b"".join(data[(at := int((j + turn) * room / k)) : at + size] for j in range(k))
        parts.append(data)
    return b"\n".join(parts)


def fit(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    use: Column | None = None, sample_docs: int = SAMPLE_DOCS,
) -> QualityModel:
    """Fit on a bounded sample: ids are chosen from the narrow labels first and
    joined (a broadcast of at most ``2 * sample_docs`` ids) with the texts.
    ``use``: a condition on ``labels`` that says which rows may be learned from."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if use is not None:
        rows = rows.where(use)
    chosen = None
    for value in (0, 1):
        some = rows.where(F.col(label) == value).select(F.col(doc_id).alias("__ll_id"), F.col(label).alias("__ll_y"))
        some = some.withColumn("__ll_h", F.xxhash64(F.col("__ll_id").cast("string"))).orderBy("__ll_h", "__ll_id").limit(sample_docs)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.where((F.length(text) > 0) & (F.length(text) <= SAMPLE_CHARS))
    texts = texts.select(F.col(doc_id).alias("__ll_id"), F.col(text).alias("__ll_text"))
    first = F.min(F.struct(F.xxhash64("__ll_text"), "__ll_text"))["__ll_text"].alias("__ll_text")
    got = texts.join(F.broadcast(chosen.distinct()), "__ll_id").groupBy("__ll_id", "__ll_y", "__ll_h").agg(first).collect()
    by = {v: [r["__ll_text"] for r in sorted(got, key=lambda r: (r["__ll_h"], r["__ll_text"])) if r["__ll_y"] == v] for v in (0, 1)}
    total = len(by[0]) + len(by[1])
    if len(by[0]) < 2 or len(by[1]) < 2:
        return QualityModel(b"", b"", [], (len(by[1]) / total) if total else 0.5)

    model = QualityModel(dictionary(by[1][::2]), dictionary(by[0][::2]), [], len(by[1]) / total)
    x = np.array([_expand(model.features(t)) for v in (0, 1) for t in by[v][1::2]])
    y = np.array([float(v) for v in (0, 1) for _ in by[v][1::2]])
    model.weights = _logistic(x, y).tolist()
    return model


def score(docs: DataFrame, model: QualityModel, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out``: probability (0 to 1) that the whole text is good."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*columns_but(docs, [out]))
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        held = shared.value
        for batch in batches:
            for part in small_batches(batch, at):
                yield part.columns, [pa.array([held.score(t) for t in part.column(at).to_pylist()], pa.float64())]

    return add_columns(kept, [T.StructField(out, T.DoubleType(), False)], run)
