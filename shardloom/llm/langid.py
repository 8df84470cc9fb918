"""Language identification by string kernels.

Kernel: the share of common byte n-grams (n = 1..3, each present or not) of
two texts, k(x, y) = |g(x) & g(y)| / sqrt(|g(x)| |g(y)|).  A bounded sample of
texts per language is split into landmarks and training texts; the Nystrom map
phi(x) = k(x, landmarks) K^(-1/2) turns the kernel into features of fixed
width, and one-versus-rest kernel ridge regression (targets +1/-1) is solved
in that space.  Scoring folds both into one matrix: a batch of texts becomes a
0/1 matrix over the landmarks' n-grams, and two matrix products give the
outputs of all languages.  Whole texts are used; n-grams that no landmark has
count in the norm.

Fitting collects at most ``SAMPLE_PER_LANG`` whole texts for each of at most
``MAX_LANGS`` languages (the commonest), chosen by a hash of the text from those of
``SAMPLE_CHARS`` at most; a language with fewer of these is filled up with its
shortest longer ones.  Scoring is one pass without a shuffle.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
with no labelled text at all every text is ``und``; ties go to the language
that sorts first; extra columns are kept, those with the name of an output (in any
case) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import add_columns, columns_but, python_ready, small_batches

SAMPLE_PER_LANG = 192
LANDMARKS_PER_LANG = 32
SAMPLE_CHARS = 4000
MAX_LANGS = 256
RIDGE = 1e-2
#: Steepness of the curve that turns ridge outputs into a share (0 to 1).
SHARPNESS = 4.0
UNKNOWN = "und"
BATCH = 256

#: First code of the n-grams of each length: 256 + 2^16 + 2^24 codes in all.
_BASE = (0, 1 << 8, (1 << 8) + (1 << 16))
_CODES = (1 << 8) + (1 << 16) + (1 << 24)


def _raw_codes(text: str) -> np.ndarray:
    b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.int32)
    grams = [b + _BASE[0]]
    if len(b) > 1:
        grams.append((b[:-1] << 8 | b[1:]) + _BASE[1])
    if len(b) > 2:
        grams.append((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + _BASE[2])
    return np.concatenate(grams)


def gram_codes(text: str) -> np.ndarray:
    """Sorted distinct n-gram codes of the text."""
    return np.unique(_raw_codes(text))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class KernelModel:
    """Landmark n-grams and the folded weights (vocabulary x languages)."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        sets = [gram_codes(t) for t in texts]
        marks, used = [], dict.fromkeys(self.langs, 0)
        for i, lang in enumerate(langs):
            if used[lang] < LANDMARKS_PER_LANG:
                used[lang] += 1
                marks.append(i)
        self.vocab = np.unique(np.concatenate([sets[i] for i in marks])) if marks else np.zeros(0, np.int64)
        self._table = self._seen = None
        if not marks:
            return
        rows = np.zeros((len(sets), len(self.vocab)), np.float32)
        norms = np.sqrt([len(s) for s in sets]).astype(np.float64)
        for i, s in enumerate(sets):
            rows[i, np.flatnonzero(np.isin(self.vocab, s, assume_unique=True))] = 1
        land = rows[marks] / norms[marks, None].astype(np.float32)
        kernel = (land @ land.T).astype(np.float64)
        value, vector = np.linalg.eigh(kernel)
        ok = value > 1e-6 * value.max()
        root = vector[:, ok] / np.sqrt(value[ok])
        phi = ((rows @ land.T) / norms[:, None]) @ root
        phi = np.hstack([phi, np.ones((len(phi), 1))])
        target = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        share = np.array([langs.count(x) for x in langs], float)  # languages weigh the same
        weighted = phi / share[:, None]
        w = np.linalg.solve(phi.T @ weighted + RIDGE * np.eye(phi.shape[1]) / len(phi), weighted.T @ target)
        self.fold = (root @ w[:-1]).astype(np.float32)  # landmarks x languages
        self.land = land.T.copy()  # vocabulary x landmarks
        self.bias = w[-1].astype(np.float32)

    def __getstate__(self):
        return {**self.__dict__, "_table": None, "_seen": None}

    def outputs(self, texts: list[str]) -> np.ndarray:
        """Ridge outputs, texts x languages."""
        if self._table is None:
            self._table = np.full(_CODES, -1, np.int32)
            self._table[self.vocab] = np.arange(len(self.vocab), dtype=np.int32)
            self._seen = np.zeros(_CODES, np.int32)
        rows = np.zeros((len(texts), len(self.vocab)), np.float32)
        norm = np.ones(len(texts), np.float32)
        for i, text in enumerate(texts):
            codes = _raw_codes(text)
            order = np.arange(len(codes), dtype=np.int32)
            self._seen[codes] = order  # the last occurrence of each code stays
            codes = codes[self._seen[codes] == order]
            norm[i] = np.sqrt(max(1, len(codes)))
            at = self._table[codes]
            rows[i, at[at >= 0]] = 1
        return (rows @ self.land) / norm[:, None] @ self.fold + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        for start in range(0, len(known), BATCH):
            part = known[start : start + BATCH]
            out = self.outputs([texts[i] for i in part]).astype(np.float64)
            best = out.argmax(1)
            weight = np.exp(SHARPNESS * (out - out.max(1, keepdims=True)))
            share = 1.0 / weight.sum(1)
            for k, i in enumerate(part):
                lang[i], score[i] = self.langs[best[k]], float(share[k])
        return lang, score


def fit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", use: Column | None = None, per_lang: int = SAMPLE_PER_LANG
) -> KernelModel:
    """Fit on a bounded sample.  ``use``: condition on ``docs`` that says which rows may be learned from.

    Texts are ranked (short ones by hash, then longer ones by length) within
    (language, slice) first, so no task sorts a whole language, and the slices'
    best are ranked again."""
    rows = docs if use is None else docs.where(use)
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    over = F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)).alias("over")
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"), over)
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("slice", F.pmod("h", F.lit(512)))
    langs = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()]
    if not langs:
        return KernelModel([], [])
    narrow = rows.select("lang", "h", "slice", "over").distinct()
    first = Window.partitionBy("lang", "slice").orderBy("over", "h")
    again = Window.partitionBy("lang").orderBy("over", "h")
    best = narrow.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= per_lang)
    best = best.withColumn("rn", F.row_number().over(again)).where(F.col("rn") <= per_lang).select("lang", "h")
    best = best.where(F.col("lang").isin(langs))  # at most MAX_LANGS * per_lang rows
    got = rows.join(F.broadcast(best), ["lang", "h"]).select("lang", "h", "text").dropDuplicates(["lang", "h"]).collect()
    got = sorted(got, key=lambda r: (r["h"], r["lang"]))
    return KernelModel([r["text"] for r in got], [r["lang"] for r in got])


def identify(docs: DataFrame, model: KernelModel, *, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` plus the predicted language and its share of the outputs."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*columns_but(docs, [lang, score]))
    added = [T.StructField(lang, T.StringType(), False), T.StructField(score, T.DoubleType(), False)]
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        held = shared.value
        for batch in batches:
            for part in small_batches(batch, at):
                a, b = held.predict(part.column(at).to_pylist())
                yield part.columns, [pa.array(a, pa.string()), pa.array(b, pa.float64())]

    return add_columns(kept, added, run)
