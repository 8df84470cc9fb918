"""Tokenising a prompt table (A1 + A2 + A4 + P11).

The two prompt sides are tokenised separately, without automatic special
tokens, then concatenated.  A tokenizer is any object with ``encode_sides(df,
keys, src, tgt)`` that returns the key columns and two id arrays, ``_src`` and
``_tgt``, per row; users bring their own.  One that also has ``sides_encoder(spark,
keys, src, tgt)``, a function over Arrow batches, is run in one Python pass with what
follows it (``streams.tokens_in_place``).  Two are given:

* ``CodePointTokenizer`` - ids are Unicode code points, decoded in Arrow batches
  (used for oracle-checked tests);
* ``JsonTokenizer`` - any tokenizer serialised as ``tokenizer.json`` (the
  ``tokenizers`` library).  The JSON is broadcast once and loaded once per
  Python worker; rows cross to Python in Arrow batches via ``mapInArrow``
  (only the key columns and the two prompt sides), and id lists go back as
  Arrow list arrays without a pandas step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.functions.tokens import mask_labels
from shardloom.session import ship_package


class CodePointTokenizer:
    """Ids are code points; a slice of texts is decoded at once, in Arrow batches
    (``tokens.code_points`` is the same as a JVM expression, some ten times slower)."""

    name = "codepoint"

    def encode_sides(self, df: DataFrame, keys: Sequence[str], src: str, tgt: str) -> DataFrame:
        return _encode_sides(df, self, keys, src, tgt)

    def sides_encoder(self, spark: SparkSession, keys: Sequence[str], src: str, tgt: str):
        def encode(batches):
            import numpy as np
            import pyarrow as pa

            ids_type = pa.list_(pa.field("element", pa.int32(), nullable=False))
            for batch in (part for whole in batches for part in text_slices(whole, (src, tgt))):
                cols = [batch.column(k) for k in keys]
                for side in (src, tgt):
                    texts = batch.column(side).to_pylist()
                    held = [t or "" for t in texts]
                    offsets = np.zeros(len(held) + 1, np.int32)
                    np.cumsum([len(t) for t in held], out=offsets[1:])
                    ids = np.frombuffer("".join(held).encode("utf-32-le"), "<i4")
                    null = pa.array([t is None for t in texts])
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), type=ids_type, mask=null))
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "_src", "_tgt"])

        return encode


class JsonTokenizer:
    """A ``tokenizers`` tokenizer given as its JSON text.

    ``threads`` is the tokenizer's own thread count inside one Spark task;
    Spark already runs one task per core, so the default is 1 (more would
    oversubscribe the executor)."""

    name = "json"

    def __init__(self, json_text: str, add_special_tokens: bool = False, threads: int = 1):
        self.json_text = json_text
        self.add_special_tokens = add_special_tokens
        self.threads = int(threads)

    @classmethod
    def from_file(cls, path: str, **kw) -> JsonTokenizer:
        with open(path, encoding="utf-8") as fh:
            return cls(fh.read(), **kw)

    def encode_sides(self, df: DataFrame, keys: Sequence[str], src: str, tgt: str) -> DataFrame:
        return _encode_sides(df, self, keys, src, tgt)

    def sides_encoder(self, spark: SparkSession, keys: Sequence[str], src: str, tgt: str):
        bc = spark.sparkContext.broadcast(self.json_text)
        key = hashlib.sha1(self.json_text.encode("utf-8")).hexdigest()
        special, threads = self.add_special_tokens, self.threads

        def encode(batches):
            import pyarrow as pa

            tok = _load(key, bc, threads)
            ids_type = pa.list_(pa.field("element", pa.int32(), nullable=False))
            for batch in (part for whole in batches for part in text_slices(whole, (src, tgt))):
                cols = [batch.column(k) for k in keys]
                for side in (src, tgt):
                    enc = tok.encode_batch(batch.column(side).to_pylist(), add_special_tokens=special)
                    cols.append(pa.array([e.ids for e in enc], type=ids_type))
                    del enc
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "_src", "_tgt"])

        return encode


_WORKER_CACHE: dict[str, object] = {}


def _load(key: str, bc, threads: int):
    """One parsed tokenizer per Python worker process and tokenizer."""
    tok = _WORKER_CACHE.get(key)
    if tok is None:
        import os

        # Read when the tokenizer's thread pool first starts in this process.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(bc.value)
        _WORKER_CACHE[key] = tok
    return tok


#: Bytes of text encoded at a time: the library holds some 200 bytes a token of a call.
SLICE_BYTES = 1 << 20


def text_slices(batch, columns: Sequence[str], limit: int = SLICE_BYTES):
    """Consecutive slices of an Arrow batch that hold at most ``limit`` bytes of
    text in ``columns`` each (a longer row alone)."""
    import numpy as np
    import pyarrow.compute as pc

    size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends = np.cumsum(size)
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def sides_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    sides = [T.StructField(side, T.ArrayType(T.IntegerType(), False)) for side in ("_src", "_tgt")]
    return T.StructType([df.schema[k] for k in keys] + sides)


def _encode_sides(df: DataFrame, tokenizer, keys: Sequence[str], src: str, tgt: str) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    return df.select(*keys, src, tgt).mapInArrow(tokenizer.sides_encoder(spark, keys, src, tgt), sides_schema(df, keys))


def joined_sides(batch, keys: Sequence[str]):
    """An Arrow batch (keys..., _src, _tgt) as (keys..., input_ids, length, n_masked)."""
    import numpy as np
    import pyarrow as pa

    src, tgt = batch.column("_src"), batch.column("_tgt")
    n_src, n_tgt = (x.value_lengths() for x in (src, tgt))
    null = np.asarray(src.is_null()) | np.asarray(tgt.is_null())
    (so, sv), (to, tv) = ((x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for x in (src, tgt))
    pieces, offsets = [np.zeros(0, np.int32)], np.zeros(batch.num_rows + 1, np.int32)
    for i in range(batch.num_rows):
        if not null[i]:
            pieces += (sv[so[i] : so[i + 1]], tv[to[i] : to[i + 1]])
        offsets[i + 1] = offsets[i] + (0 if null[i] else so[i + 1] - so[i] + to[i + 1] - to[i])
    lengths = pa.array(np.diff(offsets), pa.int32(), mask=null)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(pieces)), type=src.type, mask=pa.array(null))
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), ids, lengths, n_src], names=[*keys, "input_ids", "length", "n_masked"])


def tokenize(
    df: DataFrame,
    tokenizer=None,
    *,
    src: str = "inputs",
    tgt: str = "outputs",
    keys: Sequence[str] = ("doc_id", "shard"),
    max_len: int | None = None,
) -> DataFrame:
    """(keys..., input_ids, labels, length, n_masked); rows longer than
    ``max_len`` dropped (``length == max_len`` is kept).  ``labels`` masks
    the source side with -100; ``n_masked`` is that side's length, so labels
    can be rebuilt from ids (``labels_from_mask``) instead of stored."""
    tokenizer = tokenizer or CodePointTokenizer()
    keys = [k for k in keys if k in df.columns]
    if not hasattr(tokenizer, "encode_sides"):
        raise TypeError(f"{tokenizer!r} has no encode_sides(df, keys, src, tgt)")
    sides = tokenizer.encode_sides(df, keys, src, tgt)
    out = sides.select(
        *keys,
        F.concat("_src", "_tgt").alias("input_ids"),
        mask_labels("_src", "_tgt").alias("labels"),
        (F.size("_src") + F.size("_tgt")).alias("length"),
        F.size("_src").alias("n_masked"),
    )
    return length_filter(out, max_len)


def length_filter(tok: DataFrame, max_len: int | None, length: str = "length") -> DataFrame:
    """Keep rows with ``length <= max_len``; ``None`` keeps all."""
    if max_len is None:
        return tok
    return tok.where(F.col(length) <= F.lit(int(max_len)))


def length_report(tok: DataFrame, max_len: int, group_cols: Sequence[str] = ("shard",), length: str = "length") -> DataFrame:
    """Kept / dropped row and token counts per group (map-side partial aggregation)."""
    over = F.col(length) > F.lit(int(max_len))
    return tok.groupBy(*group_cols).agg(
        F.count(F.when(~over, 1)).alias("kept_rows"),
        F.count(F.when(over, 1)).alias("dropped_rows"),
        F.coalesce(F.sum(F.when(~over, F.col(length))), F.lit(0)).cast("long").alias("kept_tokens"),
        F.coalesce(F.sum(F.when(over, F.col(length))), F.lit(0)).cast("long").alias("dropped_tokens"),
    )
