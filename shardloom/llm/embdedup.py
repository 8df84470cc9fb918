"""Near-duplicate embeddings by a forest of random-projection trees.

Vectors are compared within a partition (equal label and length).  Equal
vectors are one class with a weight, so a very common vector is one row.

Each tree splits a node at the median of a random projection while it holds
more than ``LEAF`` classes.  Classes within a spill band of the median go to
both sides.  The band is set by the threshold: unit vectors with cosine c lie
sqrt(2 - 2c) apart, and a random projection sees that distance with standard
deviation sqrt((2 - 2c) / d); the band is ``SPILL`` of those deviations wide, so
a linked pair is parted at a level with probability under 0.3 % and by all
``TREES`` trees practically never.  Splitting runs level by level over all
nodes of all trees: medians are approximate percentiles, aggregated on the map
side; nothing is fitted on the driver.

Leaves are compared completely by matrix products in double precision.  A
leaf that cannot be split (a cluster tighter than the band) is cut into blocks
of ``BLOCK`` classes, a group for each pair of blocks, so no task holds more
than two blocks.  A group returns for each class the weight of its direct links
and one link into its local component, never all pairs.  A pair met in several
leaves is counted in the first of them only, which each group can tell from
its members' leaf lists.

Edge cases: null labels, null or empty vectors, null or non-finite components
and zero vectors link with nothing; null ids never name a component unless it
has no other; repeated rows are copies; extra columns are ignored.
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

from shardloom.llm.common import python_ready, stage
from shardloom.llm.components import components

THRESHOLD = 0.98
TREES = 4
DEPTH = 24
LEAF = 768
BLOCK = 1024
SPILL = 3.0
SEED = 20_259
#: A child with more than this share of its parent's classes is not split again.
SHRINK = 0.9


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, vec as float64 bytes, two hash words); null where a vector cannot link."""
    for batch in batches:
        vec, k1, k2 = [], [], []
        for values in batch.column(1).to_pylist():
            x = None if not values or None in values else np.array(values, np.float64) + 0.0
            scale = 0.0 if x is None else np.abs(x).max()
            if x is None or not np.isfinite(x).all() or scale == 0 or not 0 < (norm := np.linalg.norm(x / scale)) < np.inf:
                data, key = None, (None, None)
            else:
                data = x.tobytes()
                d = xxhash.xxh3_128_intdigest(data)
                key = [int(np.uint64(v).view(np.int64)) for v in (d >> 64, d & 0xFFFFFFFFFFFFFFFF)]
                data = (x / scale / norm).tobytes()
            vec.append(data)
            k1.append(key[0])
            k2.append(key[1])
        cols = [batch.column(0), pa.array(vec, pa.binary()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["rid", "vec", "k1", "k2"])


def directions(dim: int, tree: int) -> np.ndarray:
    """dim x DEPTH unit columns."""
    r = np.random.default_rng([SEED, dim, tree]).standard_normal((dim, DEPTH))
    return r / np.linalg.norm(r, axis=0)


def _projections(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            vecs = [np.frombuffer(v) for v in batch.column(2).to_pylist()]
            for t in range(trees):
                rows = []
                for x in vecs:
                    if (len(x), t) not in known:
                        known[len(x), t] = directions(len(x), t)
                    rows.append((x @ known[len(x), t]).astype(np.float32))
                cols = [batch.column(0), batch.column(1), pa.array([t] * len(rows), pa.int32()), pa.array(rows, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "part", "tree", "proj"])

    return run


def _leaves(nodes: DataFrame, spill: float, trees: int, leaf: int) -> DataFrame:
    """(node, part, leaf, size): the leaves of every class; leaf ids rise with the tree."""
    dims = "node long, part string, tree int, proj array<float>"
    projected = nodes.select("node", "part", "vec").mapInArrow(_projections(trees), dims)
    root = F.shiftleft(F.col("tree").cast("long"), 40) + 1  # a path of sides follows its tree
    live = projected.withColumn("leaf", root).withColumn("parent_size", F.lit(1 << 62).cast("long"))
    live = stage(live.drop("tree").join(nodes.select("node", (F.octet_length("vec") / 8).alias("dim")), "node"), "tree")
    done = None
    for level in range(DEPTH + 1):
        value = F.get("proj", F.lit(min(level, DEPTH - 1)))
        sizes = live.groupBy("part", "leaf").agg(
            F.count("*").alias("size"), F.max("parent_size").alias("parent"), F.percentile_approx(value, 0.5, 1000).alias("mid")
        )
        shrinks = (F.col("size") > leaf) & (F.col("size") <= SHRINK * F.col("parent")) & F.lit(level < DEPTH)
        sizes = stage(sizes.select("part", "leaf", "size", "mid", shrinks.alias("open")), "sizes")
        joined = live.join(sizes, ["part", "leaf"])
        closed = joined.where("not open").select("node", "part", "leaf", "size")
        done = closed if done is None else done.unionByName(closed)
        if sizes.where("open").isEmpty():
            return done
        band = F.lit(spill / 2) / F.sqrt("dim")
        left, right = value <= F.col("mid") + band, value > F.col("mid") - band
        sides = F.filter(F.array(F.when(left, F.lit(0)), F.when(right, F.lit(1))), lambda s: s.isNotNull())
        split = joined.where("open").withColumn("side", F.explode(sides))
        tree, path = F.shiftright("leaf", 40), F.col("leaf").bitwiseAND(F.lit((1 << 40) - 1))
        child = F.shiftleft(tree, 40) + path * 2 + F.col("side")
        live = split.select("node", "part", "proj", "dim", child.alias("leaf"), F.col("size").alias("parent_size"))
        live = stage(live, "tree")
    return done


def _compare(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["i"].iloc[0] == rows["j"].iloc[0]
        leaf = rows["leaf"].iloc[0]
        x = np.frombuffer(b"".join(rows["vec"])).reshape(len(rows), -1)
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        side = rows["block"].to_numpy()
        if not own:
            linked &= side[:, None] != side[None, :]
        head = np.arange(len(rows))
        if linked.any():
            while True:  # local components: the smallest place reachable
                low = np.where(linked, head[None, :], len(head)).min(1)
                new = np.minimum(head, low)
                new = new[new]
                if (new == head).all():
                    break
                head = new
            place = {}
            before = [[place.setdefault(v, len(place)) for v in seen if v < leaf] for seen in rows["leaves"]]
            if place:
                met = np.zeros((len(rows), len(place)), np.float32)
                for r, cols in enumerate(before):
                    met[r, cols] = 1
                linked &= (met @ met.T) == 0  # counted in an earlier leaf
        weight = linked @ rows["weight"].to_numpy().astype(np.float64)
        node = rows["node"].to_numpy()
        out = pd.DataFrame({"a": node, "b": node[head], "links": weight.astype(np.int64)})
        return out[(out["links"] > 0) | (out["a"] != out["b"])]

    return run


def link_vectors(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id."""
    python_ready(vectors.sparkSession)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col(vec_id).alias("vec_id"),
        F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("embedding"),
    )
    rows = stage(rows, "vectors")
    usable = F.when(F.col("label").isNotNull(), F.col("embedding"))
    clean = rows.select("rid", usable.alias("embedding")).mapInArrow(_clean, "rid long, vec binary, k1 long, k2 long")
    part = F.concat_ws(":", (F.octet_length("vec") / 8).cast("int").cast("string"), "label")
    keyed = clean.join(rows.drop("embedding"), "rid").withColumn("part", F.when(F.col("vec").isNotNull(), part))
    keyed = stage(keyed.drop("label"), "keyed")
    key = ["part", "k1", "k2"]
    classes = keyed.where("vec is not null").groupBy(*key).agg(
        F.min("rid").alias("node"), F.min("vec_id").alias("low"), F.count("*").alias("weight")
    )
    classes = stage(classes, "classes")
    reps = keyed.select(F.col("rid").alias("node"), "vec").join(classes, "node")
    nodes = stage(reps.select("node", "part", "vec", "weight"), "nodes")

    spill = SPILL * math.sqrt(2 - 2 * threshold)
    found = stage(_leaves(nodes, spill, trees, leaf), "leaves")
    lists = stage(found.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves")), "leaf-lists")
    wide = F.when(F.col("size") > 2 * BLOCK, F.ceil(F.col("size") / BLOCK)).otherwise(F.lit(1)).cast("int")
    placed = found.where("size > 1").withColumn("blocks", wide)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    tasks = placed.join(lists, "node").join(nodes.drop("part"), "node")
    tasks = tasks.select("part", "leaf", "i", "j", "node", "block", "leaves", "vec", "weight")
    links = tasks.groupBy("part", "leaf", "i", "j").applyInPandas(_compare(threshold), "a long, b long, links long")
    links = stage(links, "links")

    reach = components(links.where("a != b").select("a", "b"))
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    done = classes.join(reach, "node", "left").join(degree, "node", "left")
    done = done.select(*key, "low", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    done = stage(done, "done")
    lowest = stage(done.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    final = stage(done.join(lowest, "component").select(*key, "n_links", "component_id"), "final")
    out = keyed.join(final, key, "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
