"""Embedding whitening from the exact characteristic polynomial of the scatter.

Entries become integers on a grid (``floor(scale * c) + shift``), so the scatter of
the fit list, every distinct vector once, is an exact integer matrix: tasks return
exact products of their blocks, Spark adds them as decimals, cell by cell.  Its
characteristic polynomial comes from modular Hessenberg reductions, a task's work
for each prime, joined by Chinese remainders; the largest real roots are isolated in
integers and the components found by inverse iteration on the null space
(``charpoly``).  No step rounds before the last projection, so the result does
not depend on the order or the partitioning of the rows (``whitened``: but for the
last bit, as the product of a block may add in another order).

What the driver holds grows with the square of the dimension, not with the rows.
The fit list is deduplicated by a shuffle of packed integers (one or two bytes an
entry) with map-side combining, so a very common vector is one row a task.

Edge cases: a null vector and one with null or non-finite entries is dropped; an
empty vector has no components and is dropped too; vectors of each length are a
space of their own, with its own fit; scaled entries beyond +-2^62 count as 2^62;
components with eigenvalue 0 cannot be whitened and are left out (so equal vectors
alone give empty lists); ``deviation`` is null beyond 38 digits; repeated rows are
one member of the fit list and whitened each; extra columns are kept, those with
the name of an output (in any case) are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm import charpoly
from shardloom.llm.common import add_columns, columns_but, python_ready, quoted, stage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows of a block in a task.
ROWS = 4096
_LIMIT = float(1 << 62)
_LIMB = 20
OUTPUTS = ("n", "deviation", "whitened", "explained", "identity_error")


def grid(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integers without the shift) of the vectors of each length in a batch; the others are left out."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    flat = column.flatten()  # leaves out what null lists may cover
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]):
        every = np.flatnonzero(lengths == d)
        for at in range(0, len(every), ROWS):
            rows = every[at : at + ROWS]
            places = starts[rows][:, None] + np.arange(d)
            x = values[places]
            good = np.isfinite(x).all(1) & ~missing[places].any(1)
            with np.errstate(over="ignore"):
                y = np.clip(np.floor(x[good] * scale), -_LIMIT, _LIMIT).astype(np.int64)
            yield rows[good], y


def pack(y: np.ndarray) -> bytes:
    """A vector's integers in the least width that holds them all."""
    for kind in ("<i1", "<i2", "<i4"):
        small = y.astype(kind)
        if (small == y).all():
            return small.tobytes()
    return y.astype("<i8").tobytes()


def unpack(dim: int, keys: list[bytes]) -> Iterator[np.ndarray]:
    """Blocks of packed vectors."""
    for at in range(0, len(keys), ROWS):
        yield np.array([np.frombuffer(k, f"<i{len(k) // dim}") for k in keys[at : at + ROWS]], np.int64)


def products(y: np.ndarray) -> np.ndarray:
    """y transposed times y, exactly.  Products of doubles are exact while their
    sums stay below 2^53; wider entries go in limbs."""
    widest = int(max(y.max(), -int(y.min())))
    if len(y) * widest * widest < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    limbs, rest = [], y
    while (np.abs(rest) >> _LIMB).any():
        limbs.append((rest & ((1 << _LIMB) - 1)).astype(np.float64))
        rest = rest >> _LIMB
    limbs.append(rest.astype(np.float64))
    total = np.zeros((y.shape[1],) * 2, object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + ((a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j)))
    return total


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, i, j, high, low): a task's count (-1, -1), sums (-1, j) and products (i <= j)."""
    held: dict[int, list] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for d in np.unique(dims):
            keys = batch.column(1).filter(pa.array(dims == d)).to_pylist()
            for y in unpack(int(d), keys):
                own = held.setdefault(int(d), [0, np.zeros(d, object), np.zeros((d, d), object)])
                own[0] += len(y)
                own[1] = own[1] + y.astype(object).sum(0)
                own[2] = own[2] + products(y)
    names = ["dim", "i", "j", "high", "low"]
    wide = pa.decimal128(38, 0)
    for d, (n, sums, prods) in held.items():
        cells = [(-1, -1, n), *((-1, j, s) for j, s in enumerate(sums)), *((i, j, prods[i, j]) for i in range(d) for j in range(i, d))]
        i, j, v = zip(*cells, strict=True)
        parts = [[Decimal(int(x) >> 64) for x in v], [Decimal(int(x) & (1 << 64) - 1) for x in v]]
        yield pa.RecordBatch.from_arrays([pa.array([d] * len(v), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(p, wide) for p in parts)], names=names)


@dataclass
class Space:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    project: np.ndarray  # dim x components: components over the roots of n^2 times their eigenvalues
    explained: list[float]
    identity_error: float = 0.0

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - sums, exactly."""
        widest = int(max(y.max(initial=0), -int(y.min(initial=0)))) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if widest < 1 << 62 else object
        return y.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ self.project

    def deviations(self, centred: np.ndarray) -> list[int]:
        if centred.dtype != object and centred.shape[1] * int(np.abs(centred).max(initial=0)) ** 2 >= 1 << 63:
            centred = centred.astype(object)
        return [int(x) for x in (centred * centred).sum(1)]


def fit_list(vectors: DataFrame, vec: str, scale: int) -> DataFrame:
    """(dim, key): every distinct integer vector once, packed."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, y in grid(batch.column(0), scale):
                if len(y):
                    yield pa.RecordBatch.from_arrays([pa.array([y.shape[1]] * len(y), pa.int32()), pa.array([pack(v) for v in y], pa.binary())], names=["dim", "key"])

    keys = vectors.select(F.col(quoted(vec)).alias("vec")).mapInArrow(packed, "dim int, key binary")
    return stage(keys.distinct(), "whitening-fit")


def fit(vectors: DataFrame, *, vec: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> dict[int, Space]:
    """The space of each vector length."""
    spark = vectors.sparkSession
    python_ready(spark)
    distinct = fit_list(vectors, vec, scale)
    cells = distinct.mapInArrow(_partials, "dim int, i int, j int, high decimal(38,0), low decimal(38,0)")
    total: dict[int, dict] = {}
    for r in cells.groupBy("dim", "i", "j").agg(F.sum("high"), F.sum("low")).collect():  # dim^2 / 2 rows a length
        total.setdefault(r[0], {})[r[1], r[2]] = (int(r[3]) << 64) + int(r[4])
    spaces = {}
    for d, cell in sorted(total.items()):
        n, sums = cell[-1, -1], [cell[-1, j] for j in range(d)]
        scatter = [[n * cell[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
        spaces[d] = _space(spark, n, sums, scatter, components)
    _check(distinct, spaces)
    return spaces


def _space(spark, n: int, sums: list[int], scatter: list[list[int]], components: int) -> Space:
    """``scatter`` is n^2 times the covariance."""
    trace = sum(row[i] for i, row in enumerate(scatter))
    if not trace:
        return Space(n, sums, np.zeros((len(sums), 0)), [])
    roots = charpoly.largest_roots(charpoly.characteristic_polynomial(spark, scatter), components)
    columns, explained = [], []
    with localcontext() as ctx:
        ctx.prec = charpoly.DIGITS
        for root, multiplicity in roots:
            for v in charpoly.null_vectors(scatter, root, multiplicity):
                columns.append(v / float(root.sqrt()))
                explained.append(float(root / trace))
    return Space(n, sums, np.array(columns[:components]).T, explained[:components])


def _check(distinct: DataFrame, spaces: dict[int, Space]) -> None:
    """Set each space's largest entry of whitened's covariance minus the identity,
    over the fit list: means first, then centred products, summed by Spark."""

    def moments(centre):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                dims = batch.column(0).to_numpy()
                for d in np.unique(dims):
                    space = spaces[int(d)]
                    for y in unpack(int(d), batch.column(1).filter(pa.array(dims == d)).to_pylist()):
                        w = space.whitened(space.centred(y))
                        part = w.sum(0)[None] if centre is None else (w - centre[int(d)]).T @ (w - centre[int(d)])
                        held[int(d)] = held.get(int(d), 0) + part
            for d, m in held.items():
                i, j = np.indices(m.shape).reshape(2, -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, d, np.int32)), pa.array(i), pa.array(j), pa.array(m.ravel())], names=["dim", "i", "j", "v"])

        summed = distinct.mapInArrow(run, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v")).collect()
        out = {d: np.zeros((1 if centre is None else s.project.shape[1], s.project.shape[1])) for d, s in spaces.items()}
        for d, i, j, v in summed:
            out[d][i, j] = v / spaces[d].n
        return out

    means = {d: m[0] for d, m in moments(None).items()}
    for d, m in moments(means).items():
        spaces[d].identity_error = float(np.abs(m - np.eye(len(m))).max(initial=0.0))


def whiten(vectors: DataFrame, spaces: dict[int, Space], *, vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows of ``vectors`` that can be whitened, plus ``n`` (length of the fit
    list), ``deviation`` (exact sum of squares of n * x - sums), ``whitened`` (one
    double a component), ``explained`` (share of the variance of each) and ``identity_error``."""
    python_ready(vectors.sparkSession)
    kept = vectors.select(*columns_but(vectors, OUTPUTS))
    at = kept.columns.index(vec)
    many = T.ArrayType(T.DoubleType(), False)
    added = [T.LongType(), T.DecimalType(38, 0), many, many, T.DoubleType()]
    fields = [T.StructField(n, t) for n, t in zip(OUTPUTS, added, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        most = 10**38
        for batch in batches:
            for rows, y in grid(batch.column(at), scale):
                if not len(rows):
                    continue
                space = spaces[y.shape[1]]
                centred = space.centred(y)
                white = space.whitened(centred)
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1])
                same = np.tile(np.array(space.explained, np.float64), len(rows))
                more = [
                    pa.array([space.n] * len(rows), pa.int64()),
                    pa.array([Decimal(x) if x < most else None for x in space.deviations(centred)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    pa.ListArray.from_arrays(ends, pa.array(same)),
                    pa.array([space.identity_error] * len(rows)),
                ]
                yield [c.take(pa.array(rows)) for c in batch.columns], more

    return add_columns(kept, fields, run)
