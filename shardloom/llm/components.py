"""Connected components of a link table, as rounds of distributed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node in ``links``.

    Each round gives every node the smallest label among its neighbours and
    then the label of its label (pointer jumping), until nothing gets smaller.
    Labels and links stay in shared files; only one number a round reaches the
    driver.  Both sides of each join are read from files, so a node with very
    many links is split by the skew-join handling of adaptive execution, and
    minima are pre-aggregated before they are shuffled.
    """
    plain = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v")
    both = stage(plain.unionByName(plain.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("label")), "labels")
    weight = _weight(labels)
    while weight is not None:
        seen = both.join(labels, both["u"] == labels["node"]).select(F.col("v").alias("node"), "label")
        low = stage(seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
        jump = low.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(low.join(jump, "label").select("node", F.col("next").alias("label")), "labels")
        now = _weight(labels)
        if now == weight:
            break
        weight = now
    return labels.select("node", F.col("label").alias("component"))


def _weight(labels: DataFrame):
    """Labels only ever decrease, so an unchanged sum means no change."""
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
