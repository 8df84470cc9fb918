"""Near-duplicate documents: banded MinHash, sequential Bayesian verification.

1. A document is the set of its distinct ``k``-word shingles (64-bit hashes).
   Equal sets are one class; only one row of a class goes on, so a group of
   exact copies costs one row whatever its size.
2. ``BANDS`` bands of ``ROWS`` MinHash values name candidate buckets.  Every
   member of a bucket is a candidate partner of the bucket's first member.
3. Candidates' signatures are compared a batch of values at a time.  After n
   values with m matches the posterior of the similarity is Beta(m+1, n-m+1);
   a pair is pruned once P(similarity >= threshold) falls under ``MISS``.
4. Survivors are verified exactly on their full sets, and linked.
5. A bucket whose members are then still in different components is compared
   across components, pruned and verified as above.  Buckets of over ``SMALL``
   members that share members are one crowd: its members outside its commonest
   component are probes, compared with all its members in tasks of about
   ``BLOCK`` probes by ``BLOCK`` members, however large the crowd.  A task
   returns links that join components, never all its pairs.
6. Connected components over the links.

No pair of a bucket is skipped, so a link is lost only if its sets share no
band (below 1e-5 at similarity 0.8) or to the chosen miss probability.

Edge cases: null texts and texts without words have an empty set, link with
nothing and are kept; fewer than ``k`` words make one shingle; rows with a
null id can be linked but never name a component unless it has no other id;
repeated rows are copies; extra columns are kept by ``deduplicate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import broadcast_within, python_ready, small_batches, stage
from shardloom.llm.components import components

SHINGLE = 5
THRESHOLD = 80  # per cent
ROWS, BANDS = 5, 30
HASHES = ROWS * BANDS
STEP = 25  # signature values compared before each look at the posterior
MISS = 1e-7
SMALL = 64  # members of a bucket that is compared as it is
BLOCK = 512
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles (A-Z lower-cased)."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=k)], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = h * _M1 + (w[i : n - k + 1 + i] ^ (h >> np.uint64(31)))
    h ^= h >> np.uint64(32)
    h *= _M2
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _multipliers() -> np.ndarray:
    x = (np.arange(1, HASHES + 1, dtype=np.uint64) * _M3) ^ _M2
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    return x | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint32 matrix, one MinHash signature a non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    with np.errstate(over="ignore"):
        for j, a in enumerate(_multipliers()):
            out[:, j] = np.minimum.reduceat(flat * a, starts) >> np.uint64(32)
    return out


def least_matches(threshold: int) -> list[tuple[int, int]]:
    """(n, fewest matches among n values with which a pair goes on).

    With a uniform prior, P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    t, out = threshold / 100, []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < MISS:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _alike(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """100 |x & y| >= threshold |x or y|, on sorted distinct hashes."""
    small, large = sorted((len(x), len(y)))
    if 100 * small < threshold * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= threshold * (small + large - both)


def _survivors(left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    """Indices of the rows whose pair of signatures is not pruned."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in least_matches(threshold):
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(1)
        ok = matches >= least
        alive, matches, done = alive[ok], matches[ok], n
    return alive


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, 1, 4 << 20):
                sets = [shingle_hashes(t, k) for t in part.column(1).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                sig, keys = [None] * len(sets), [(None, None)] * len(sets)
                if full:
                    for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                        sig[i] = row.tobytes()
                        d = xxhash.xxh3_128_intdigest(sets[i].tobytes())
                        keys[i] = tuple(int(np.int64(np.uint64(v))) for v in (d >> 64, d & 0xFFFFFFFFFFFFFFFF))
                cols = [part.column(0), pa.array([len(s) for s in sets], pa.int64())]
                cols += [pa.array([x[j] for x in keys], pa.int64()) for j in (0, 1)] + [pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["rid", "n", "k1", "k2", "sig"])
        pa.default_memory_pool().release_unused()

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            n = part.num_rows
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(n, BANDS, ROWS).astype(np.uint64)
            key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], n, 0) * _M3
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    key = (key ^ sig[:, :, r]) * _M1
                    key ^= key >> np.uint64(29)
            node = np.repeat(part.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(node)], names=["bucket", "node"])


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, 1, 4 << 20):
                sets = [shingle_hashes(t, k).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])

    return run


def _matrix(column, dtype=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1)


def _prune(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = _survivors(_matrix(batch.column(2).to_pylist()), _matrix(batch.column(3).to_pylist()), threshold)
                yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    return run


def _verify(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, 3, 8 << 20):
                sides = [[np.frombuffer(x, np.uint64) for x in part.column(i).to_pylist()] for i in (2, 3)]
                ok = [_alike(x, y, threshold) for x, y in zip(*sides, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return run


def _cross(threshold: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Pairs of a small bucket that are in different components and are not
        pruned; those of its first member have been seen before."""
        rows = rows.sort_values("node")
        sig, node, comp = _matrix(rows["sig"]), rows["node"].to_numpy(), rows["component"].to_numpy()
        out = []
        for x in range(1, len(rows) - 1):
            at = x + 1 + np.flatnonzero(comp[x + 1 :] != comp[x])
            if len(at):
                keep = at[_survivors(np.repeat(sig[x : x + 1], len(at), 0), sig[at], threshold)]
                out += [(node[x], node[y]) for y in keep]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _probe(threshold: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Every probe against every member of the block: pruned, verified, and
        linked where no link found here connects the two yet."""
        members, probes = rows[~rows["probe"]], rows[rows["probe"]]
        sig, node = _matrix(members["sig"]), members["node"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in members["hashes"]]
        comp, own, links = members["component"].to_numpy().copy(), probes["component"].to_numpy().copy(), []
        for p, (name, values, hashes) in enumerate(zip(probes["node"], probes["sig"], probes["hashes"], strict=True)):
            at = np.flatnonzero(comp != own[p])
            if not len(at):
                continue
            mine, hashes = _matrix([values]), np.frombuffer(hashes, np.uint64)
            for y in at[_survivors(np.repeat(mine, len(at), 0), sig[at], threshold)]:
                if comp[y] != own[p] and _alike(hashes, sets[y], threshold):
                    links.append((name, node[y]))
                    old, new = comp[y], own[p]
                    comp[comp == old] = new
                    own[own == old] = new
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def link_documents(
    docs: DataFrame, *, k: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: rid (its place in the input), doc_id, n_shingles,
    component (the place that names it), component_id (smallest id reachable)."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _link(stage(rows, "texts"), k, threshold)


def _link(rows: DataFrame, k: int, threshold: int) -> DataFrame:
    texts = rows.select("rid", "text")
    sketch = stage(texts.mapInArrow(_sketch(k), "rid long, n long, k1 long, k2 long, sig binary"), "sketch")
    ids = rows.select("rid", "doc_id")
    keyed = stage(sketch.drop("sig").join(ids, "rid"), "keyed")
    classes = keyed.where("n > 0").groupBy("k1", "k2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("low"))
    classes = stage(classes, "classes")
    reps = sketch.select(F.col("rid").alias("node"), "sig").join(_ids(classes.select("node")), "node", "left_semi")
    buckets = stage(reps.mapInArrow(_bands, "bucket long, node long"), "bands")
    heads = buckets.groupBy("bucket").agg(
        F.min("node").alias("head"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("mark")
    )
    # bands that hold the same members name one bucket
    heads = heads.where("size > 1").groupBy("head", "size", "mark").agg(F.min("bucket").alias("bucket"))
    members = stage(buckets.join(stage(heads.drop("mark"), "heads"), "bucket"), "members")
    involved = _ids(stage(members.select("node").distinct(), "involved"))  # within the bound, texts are not shuffled
    some = texts.withColumnRenamed("rid", "node").join(involved, "node", "left_semi")
    sets = some.mapInArrow(_set_rows(k), "node long, hashes binary")
    sigs = sketch.select(F.col("rid").alias("node"), "sig").join(involved, "node", "left_semi")
    sets, sigs = stage(sets, "sets"), stage(sigs, "signatures")

    pairs = members.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("x"))
    right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("y"))
    matched = stage(pairs, "pairs").join(right, "b").join(left, "a").select("a", "b", "x", "y")
    alive = stage(matched.mapInArrow(_prune(threshold), "a long, b long"), "survivors")
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    whole = alive.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    links = stage(whole.mapInArrow(_verify(threshold), "a long, b long"), "verified")
    found = components(links)

    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed, "placed")
    mixed = placed.where("size > 2").groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = stage(mixed.where("lo != hi").select("bucket"), "mixed")
    rest = stage(placed.join(mixed, "bucket"), "mixed-members")
    small = rest.where(F.col("size") <= SMALL).select("bucket", "node", "component").join(sigs, "node")
    more = stage(small.groupBy("bucket").applyInPandas(_cross(threshold), "a long, b long").distinct(), "cross")
    more = more.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(_verify(threshold), "a long, b long")
    more = more.unionByName(_crowded(rest.where(F.col("size") > SMALL), sigs, sets, threshold))
    more = stage(more, "more-links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    found = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = stage(found.select("k1", "k2", "low", "component"), "found")
    lowest = stage(found.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    final = stage(found.join(lowest, "component").select("k1", "k2", "component", "component_id"), "final")
    out = keyed.join(final, ["k1", "k2"], "left")
    return out.select(
        "rid",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "rid").alias("component"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _ids(ids: DataFrame) -> DataFrame:
    """A one-column table of row places, broadcast if its size is within the bound."""
    return broadcast_within(ids, F.lit(24))


def _crowded(rows: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links across components inside large buckets.

    Large buckets that share members are one crowd.  All its members outside
    its commonest component are probes; each is compared with every member of
    the crowd, in tasks of about ``BLOCK`` probes by ``BLOCK`` members."""
    crowd = components(rows.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    crowd = crowd.select("node", F.col("component").alias("crowd"))
    people = stage(rows.select("node", "component").distinct().join(crowd, "node"), "crowds")
    shares = people.groupBy("crowd", "component").agg(F.count("*").alias("n"))
    shares = shares.groupBy("crowd").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))
    parts = lambda n: F.ceil(n / BLOCK).cast("long")
    shares = shares.select(
        "crowd", F.col("top.component").alias("main"), parts(F.col("n")).alias("blocks"), parts(F.col("n") - F.col("top.n")).alias("chunks")
    )
    people = stage(people.join(stage(shares, "shares"), "crowd"), "crowd-members")
    block, chunk = F.pmod(F.xxhash64("node"), F.col("blocks")), F.pmod(F.xxhash64("node"), F.col("chunks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = people.where("chunks > 0").select("crowd", "node", "component", F.lit(False).alias("probe"), block.alias("block"), every("chunks").alias("chunk"))
    probes = people.where("component != main").select("crowd", "node", "component", F.lit(True).alias("probe"), every("blocks").alias("block"), chunk.alias("chunk"))
    tasks = stage(members.unionByName(probes), "tasks").join(sigs, "node").join(sets, "node")
    return tasks.groupBy("crowd", "block", "chunk").applyInPandas(_probe(threshold), "a long, b long")


def deduplicate(
    docs: DataFrame, *, k: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the one with its smallest id
    (the first such row where an id repeats, or where the component has no id
    at all).  Rows without words all stay."""
    python_ready(docs.sparkSession)
    cols = docs.columns
    held = stage(docs.withColumn("__ll_rid", F.monotonically_increasing_id()), "documents")
    rows = held.select(F.col("__ll_rid").alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    linked = _link(rows, k, threshold)
    first = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("component").agg(F.min("rid").alias("__ll_rid")).select("__ll_rid")
    return held.join(_ids(stage(first, "first")), "__ll_rid", "left_semi").select(*cols)
