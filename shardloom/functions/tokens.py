"""Token-array expressions (A1 code points, A2-A4, P12)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shardloom.session import ship_package

# --- fixed values ------------------------------------------------------------
#: Label value ignored by the loss.
IGNORE_INDEX = -100
#: Ids from -LOW to TOP - 1 (all code points) have their text in a table of at most 16 MB a worker.
LOW, TOP = 128, (1 << 21) - 128
# ---------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def code_points(col: str | Column) -> Column:
    """Code-point ids of a string, in JVM (exact for non-BMP characters).

    ``split(s, '')`` gives one element per code point; ``''`` yields
    ``['']`` so it is guarded to an empty array.
    """
    c = _c(col)
    ids = F.transform(F.split(c, ""), lambda ch: F.ascii(ch))
    return F.when(c == "", F.array().cast("array<int>")).otherwise(ids)


def mask_labels(src_ids: str | Column, tgt_ids: str | Column) -> Column:
    """A2: ``[-100] * len(src) + tgt``."""
    return F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size(_c(src_ids))), _c(tgt_ids))


def labels_from_mask(ids: str | Column, n_masked: str | Column) -> Column:
    """A2 from the compact form: ids with the first ``n_masked`` set to -100."""
    ids, n = _c(ids), F.least(F.greatest(_c(n_masked), F.lit(0)), F.size(_c(ids))).cast("int")
    return F.concat(F.array_repeat(F.lit(IGNORE_INDEX), n), F.slice(ids, n + 1, F.size(ids) - n))


def labels_from_runs(ids: str | Column, masked: str | Column) -> Column:
    """Labels of a block: ids with the runs ``[at, n, at, n, ...]`` set to -100
    (rising, not overlapping).  Runs are copied whole, not token by token."""
    ids, runs = _c(ids), _c(masked)
    at = lambda k: F.element_at(runs, (2 * k + 1).cast("int"))
    end = lambda k: at(k) + F.element_at(runs, (2 * k + 2).cast("int"))
    n = (F.size(runs) / 2).cast("int")
    next_at = lambda k: F.when(k + 1 < n, at(F.least(k + 1, n - 1))).otherwise(F.size(ids))
    spans = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda k: F.concat(
            F.array_repeat(F.lit(IGNORE_INDEX), end(k) - at(k)), F.slice(ids, end(k) + 1, next_at(k) - end(k))
        ),
    )
    cut = F.concat(F.slice(ids, 1, F.element_at(runs, 1)), F.flatten(spans))
    return F.when(n == 0, ids).otherwise(cut)


def attention_mask(ids: str | Column) -> Column:
    """A3: all ones (int64), as long as the ids."""
    return F.array_repeat(F.lit(1).cast("bigint"), F.size(_c(ids)))


def seq_length(ids: str | Column) -> Column:
    """A4."""
    return F.size(_c(ids))


def narrow_ids(ids: str | Column) -> Column:
    """int32 ids (storage)."""
    return _c(ids).cast("array<int>")


def wide_ids(ids: str | Column) -> Column:
    """int64 ids (training samples)."""
    return _c(ids).cast("array<bigint>")


def ids_digest(ids: str | Column) -> Column:
    """md5 of the comma-joined ids: a compact, format-free array fingerprint."""
    return F.md5(F.array_join(_c(ids), ","))


#: Ids of a stored row, four bytes each (little-endian): copied whole where an array goes element by element.
PACKED = "packed_ids"
#: Codec of tables with ``PACKED``: the three upper bytes of an id are mostly zero.
PACKED_CODEC = "zstd"


def packed_ids(flat, ends, null=None) -> pa.Array:
    """Binary values of 4-byte ids: value ``i`` is ``flat[ends[i]:ends[i + 1]]``; ``ends`` starts at 0."""
    import numpy as np

    offsets = pa.array(np.asarray(ends, np.int64) * 4).cast(pa.int32())  # fails where a batch is over 2 GB
    valid = None if null is None else pa.array(~np.asarray(null, bool)).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [valid, offsets.buffers()[1], pa.py_buffer(flat.astype("<i4").tobytes())])


def _unpacked(packed: pa.Array) -> pa.Array:
    import numpy as np

    held = packed.to_pylist()
    ends = np.cumsum([0, *(len(x or b"") // 4 for x in held)])
    ids = np.frombuffer(b"".join(x or b"" for x in held), "<i4")
    null = pa.array([x is None for x in held], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends).cast(pa.int32()), pa.array(ids, pa.int32()), mask=null)


def arrays_from_packed(spark: SparkSession, packed: str = PACKED) -> Column:
    """The id array of a ``packed_ids`` column, computed only by readers that select it."""
    ship_package(spark)
    return F.arrow_udf(_unpacked, "array<int>")(packed)


_TEXTS: list = [None]  # of a worker: "<id>," of the ids from -LOW on, eight bytes each, padded with zero bytes


def _id_texts(top: int):
    """The table of id texts, at least up to ``top``."""
    import numpy as np

    if _TEXTS[0] is None or len(_TEXTS[0]) <= top + LOW:
        size = 1 << max(16, (top + LOW).bit_length())
        _TEXTS[0] = np.array([b"%d," % i for i in range(-LOW, size - LOW)], "S8").view("<u8")
    return _TEXTS[0]


def _md5s(lists) -> list[str | None]:
    """``ids_digest`` of every list of an Arrow array of integer lists."""
    if not len(lists):
        return []
    offsets, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    texts, ids = None, None
    held = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    if not held.null_count and len(held):
        least, most = pc.min_max(held).as_py().values()
        if least >= -LOW and most < TOP:
            ids, texts = held.to_numpy(), _id_texts(most)
    out: list[str | None] = []
    for i in range(len(lists)):
        if not valid[i]:
            out.append(None)
            continue
        if ids is not None:
            own = ids[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]]
            text = texts[own + LOW].tobytes().translate(None, b"\0")[:-1]
        else:  # null ids, which array_join leaves out, and ids beyond the table
            text = ",".join(str(v) for v in lists[i].as_py() if v is not None).encode()
        out.append(hashlib.md5(text).hexdigest())
    return out


def _digest_lists(lists: pa.Array) -> pa.Array:
    return pa.array(_md5s(lists), pa.string())


def _digest_nested(batches: pa.Array) -> pa.Array:
    out = []
    for i in range(len(batches)):
        found = _md5s(batches[i].values) if batches[i].is_valid else None
        out.append(None if found is None else hashlib.md5(",".join(x for x in found if x is not None).encode()).hexdigest())
    return pa.array(out, pa.string())


def arrow_digests(spark: SparkSession):
    """(digest of an id array, digest of an array of id arrays) as functions of a
    column: ``ids_digest``, and the same of the comma-joined digests, in Arrow batches
    (the texts of ids come from a table instead of being formatted one by one)."""
    ship_package(spark)
    return F.arrow_udf(_digest_lists, "string"), F.arrow_udf(_digest_nested, "string")
