"""Benchmark decontamination with DataFrame expressions only.

Benchmark items become windows of ``n`` normalised words (an item of fewer
words is one window).  The distinct windows are a broadcast hash set when
their measured size allows, else the same join is shuffled.  Each document's
windows are probed against it; the join compares the whole window text, so a
hit is verified by equality, never by a hash alone.

Documents are scanned in place; only hits (rare) and one narrow row a document
are shuffled, keyed by document, so a passage shared by very many documents
does not gather anywhere.  Rows are keyed by (id, text): repeated rows each
get the same result.

Edge cases: null text has no words; a null item id marks words but is not
counted among the items; empty tables give no hits; extra columns are kept by
``remove`` and ignored by ``contamination``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import ascii_lower, broadcast_within, row_key, stage

#: Fixed value: what separates words (the complement of the word pattern).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def item_windows(bench: DataFrame, n: int = WINDOW, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, n_window_words, items): each distinct window and the sorted ids of its items."""
    w = bench.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w"))
    size = F.size("w")
    runs = F.when(size >= n, _windows(F.col("w"), n)).when(size > 0, F.array(F.array_join("w", " ")))
    rows = w.select("item", F.least(size, F.lit(n)).alias("n_window_words"), F.explode(runs).alias("window"))
    return rows.groupBy("window", "n_window_words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _windows(w: Column, n: int) -> Column:
    """Texts of all runs of ``n`` words; none if there are fewer words."""
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))


def hits(docs: DataFrame, bench: DataFrame, n: int = WINDOW, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per contaminated document: row_key, word positions hit (from 0,
    distinct), distinct item ids (sorted)."""
    windows = item_windows(bench, n)
    lengths = sorted(r[0] for r in windows.select("n_window_words").distinct().collect())  # at most n values
    held = broadcast_within(windows, F.length("window") * 2 + F.size("items") * 16 + 64)
    w = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), words(F.col(text)).alias("w"))
    found = None
    for size in lengths:
        each = w.select("row_key", F.posexplode(_windows(F.col("w"), size)).alias("pos", "window"))
        each = each.join(held, "window").where(F.col("n_window_words") == size)
        each = each.select("row_key", "pos", "n_window_words", "items")
        found = each if found is None else found.unionByName(each)
    if found is None:
        return docs.sparkSession.createDataFrame([], "row_key string, positions array<int>, items array<string>")
    runs = F.transform("runs", lambda r: F.sequence(r["pos"], r["pos"] + r["n_window_words"] - 1))
    grouped = found.groupBy("row_key").agg(
        F.collect_set(F.struct("pos", "n_window_words")).alias("runs"), F.collect_set("items").alias("items")
    )
    return grouped.select(
        "row_key",
        F.array_distinct(F.flatten(runs)).alias("positions"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def contamination(
    docs: DataFrame, bench: DataFrame, n: int = WINDOW, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (array<string>), positions."""
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        row_key(F.col(doc_id), F.col(text)).alias("row_key"),
        F.size(words(F.col(text))).cast("long").alias("n_words"),
    )
    none, nowhere = F.expr("cast(array() as array<string>)"), F.expr("cast(array() as array<int>)")
    return base.join(hits(docs, bench, n, doc_id=doc_id, text=text), "row_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("positions", nowhere).alias("positions"),
    )


def remove(
    docs: DataFrame, bench: DataFrame, n: int = WINDOW, *, mode: str = "documents", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="spans"``) with the
    hit words and what separates them from the next word taken out."""
    found = stage(hits(docs, bench, n, doc_id=doc_id, text=text), "hits")
    cols = docs.columns
    keyed = docs.withColumn("__ll_key", row_key(F.col(doc_id), F.col(text)))
    if mode == "documents":
        found = broadcast_within(found.select(F.col("row_key").alias("__ll_key")), F.lit(64))
        return keyed.join(found, "__ll_key", "left_anti").select(*cols)
    if mode != "spans":
        raise ValueError("mode is 'documents' or 'spans'")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all(text, F.lit(f"({word}{sep}*)"), 1)
    head = F.regexp_extract(text, f"^({sep}*)", 1)
    left = F.array_except(F.sequence(F.lit(0), F.size("__ll_w") - 1), "__ll_pos")
    cut = F.concat(head, F.array_join(F.transform(left, lambda i: F.get("__ll_w", i)), ""))
    found = found.select(F.col("row_key").alias("__ll_key"), F.col("positions").alias("__ll_pos"))
    found = broadcast_within(found, F.size("__ll_pos") * 4 + 64)
    joined = keyed.join(found, "__ll_key", "left").withColumn("__ll_w", F.when(F.col("__ll_pos").isNotNull(), pieces))
    new = F.when(F.col("__ll_pos").isNull(), F.col(text)).otherwise(cut).alias(text)
    return joined.select(*[new if c == text else F.col(c) for c in cols])
