"""Merkle fixity audit of WARC replicas, with DataFrame expressions only.

A replica is a table of records (file, offset, length, payload digest).  A leaf
of a file's tree covers the records that start in one range of ``RANGE`` bytes,
in offset order; each further level hashes ``FANOUT`` neighbouring nodes.  The
roots of two replicas are compared, and only children of mismatching nodes are
looked at, level by level, down to the records of the mismatching ranges.

No group outgrows a range or a fan-out, so a file with a third of all records
is spread over its ranges; payloads are read once and only digests are shuffled.

Edge cases: null and empty payloads have digests of their own; a file that one
replica lacks mismatches at its root and all its records are reported; repeated
equal records count with their number; empty replicas give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import stage
from shardloom.operators.ordering import running_total

RANGE = 1 << 18
FANOUT = 16
FILE_PAGES = 512


def warc_records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(file, page_id, length, payload): pages as WARC response records.

    A file takes a span of ``FILE_PAGES`` page ids (null ids: a file of their own)."""
    body, uri = F.coalesce(F.col(html), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    payload = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
    span = F.floor(F.col(page_id) / FILE_PAGES).cast("string")
    file = F.concat(F.lit("crawl-"), F.coalesce(span, F.lit("none")), F.lit(".warc"))
    rows = pages.select(file.alias("file"), F.col(page_id).alias("page_id"), payload.alias("payload"))
    return rows.withColumn("length", F.octet_length("payload").cast("long"))


def digest(payload: Column) -> Column:
    return F.coalesce(F.sha2(payload.cast("binary"), 256), F.lit("null"))


def lay_out(records: DataFrame) -> DataFrame:
    """Narrow ``records`` (file, page_id, length and digests, no payload) plus
    ``offset``: the running total of lengths by page id, computed in two
    levels, so no file is sorted in one task."""
    cols = records.columns
    rows = stage(records.withColumn("__ll_rid", F.monotonically_increasing_id()), "records")
    narrow = rows.select("file", F.coalesce("page_id", F.lit(-1)).alias("place"), "__ll_rid", "length")
    offsets = running_total(narrow, ["file"], ["place", "__ll_rid"], "length", "offset").select("__ll_rid", "offset")
    return stage(rows.join(offsets, "__ll_rid").select(*cols, "offset"), "laid-out")


def distinct_records(replica: DataFrame) -> DataFrame:
    """(file, offset, length, digest, copies): one row per distinct record, staged."""
    rows = replica.groupBy("file", "offset", "length", "digest").agg(F.count("*").alias("copies"))
    return stage(rows, "replica")


def tree(digests: DataFrame, depth: int) -> DataFrame:
    """(file, level, idx, hash) of levels 0 (ranges) to ``depth`` (roots), staged."""
    entry = F.struct("offset", "length", "digest", "copies")
    ranges = digests.groupBy("file", F.floor(F.col("offset") / RANGE).alias("idx"))
    ranges = ranges.agg(F.sort_array(F.collect_list(entry)).alias("parts"))
    text = F.transform("parts", lambda p: F.concat_ws(":", p["offset"].cast("string"), p["length"].cast("string"), p["digest"], p["copies"].cast("string")))
    nodes = ranges.select("file", F.lit(0).alias("level"), "idx", F.sha2(F.concat_ws(",", text), 256).alias("hash"))
    nodes = stage(nodes, "ranges")
    levels = nodes
    for level in range(1, depth + 1):
        up = nodes.groupBy("file", F.floor(F.col("idx") / FANOUT).alias("up"))
        up = up.agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("parts"))
        text = F.transform("parts", lambda p: F.concat_ws(":", p["idx"].cast("string"), p["hash"]))
        nodes = up.select("file", F.lit(level).alias("level"), F.col("up").alias("idx"), F.sha2(F.concat_ws(",", text), 256).alias("hash"))
        nodes = stage(nodes, "level")
        levels = levels.unionByName(nodes)
    return levels


def _mismatches(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hash differs, or that one side lacks."""
    x, y = a.select(*keys, F.col("hash").alias("hash_a")), b.select(*keys, F.col("hash").alias("hash_b"))
    return x.join(y, keys, "full_outer").where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that differ between two replicas, each a table (file, offset,
    length, digest): file, offset, and for each side its length and digest;
    status is changed, missing (in the second) or extra."""
    a, b = distinct_records(first), distinct_records(second)
    furthest = max(x.agg(F.max(F.floor(F.col("offset") / RANGE))).first()[0] or 0 for x in (a, b))
    depth = 0
    while furthest >= FANOUT**depth:
        depth += 1
    left, right = tree(a, depth), tree(b, depth)
    bad = _mismatches(left.where(F.col("level") == depth), right.where(F.col("level") == depth), ["file", "idx"])
    bad = stage(bad.select("file", "idx"), "bad-roots")
    for level in range(depth - 1, -1, -1):
        parents = bad.select("file", F.col("idx").alias("up"))
        up = F.floor(F.col("idx") / FANOUT)
        sides = [t.where(F.col("level") == level).withColumn("up", up).join(parents, ["file", "up"], "left_semi") for t in (left, right)]
        bad = stage(_mismatches(*sides, ["file", "idx"]).select("file", "idx"), "bad-nodes")
    at = F.floor(F.col("offset") / RANGE)
    sides = [t.withColumn("idx", at).join(bad, ["file", "idx"], "left_semi") for t in (a, b)]
    x, y = (
        t.groupBy("file", "offset").agg(
            F.sort_array(F.collect_list(F.struct("length", "digest", "copies"))).alias(f"records_{s}")
        )
        for t, s in zip(sides, "ab", strict=True)
    )
    both = x.join(y, ["file", "offset"], "full_outer").where(~F.col("records_a").eqNullSafe(F.col("records_b")))
    status = F.when(F.col("records_b").isNull(), "missing").when(F.col("records_a").isNull(), "extra").otherwise("changed")
    one = lambda s, f: F.get(F.col(f"records_{s}"), F.lit(0))[f]
    return both.select(
        "file", "offset", *(one(s, f).alias(f"{f}_{s}") for s in "ab" for f in ("length", "digest")), status.alias("status")
    )


def locate(first: DataFrame, second: DataFrame) -> DataFrame:
    """Ordered damaged byte ranges: each record ``audit`` reports, as [start, stop)."""
    return audit(first, second).select("file", F.col("offset").alias("start"), (F.col("offset") + F.coalesce("length_a", "length_b")).alias("stop"), "status")
