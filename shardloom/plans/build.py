"""Build token shards from a corpus (the shard-building entry point).

corpus -> date windows (one ``shard`` column, all windows in one job) ->
labelled text -> chat prompts -> tokens (+ masked labels, length filter) ->
materialised token table -> packed blocks -> Parquet partitioned by shard.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.templates import chat_prompts
from shardloom.functions.text import SECTION_COLUMNS, with_patent_text
from shardloom.functions.tokenizer import CodePointTokenizer, length_filter, tokenize
from shardloom.functions.tokens import PACKED, PACKED_CODEC, arrays_from_packed, labels_from_mask, labels_from_runs, narrow_ids, seq_length
from shardloom.operators.limits import sample_limit
from shardloom.operators.packing import pack_blocks, pack_stream, whole_blocks
from shardloom.operators.streams import PLACE, in_stream_order, tokens_in_place, with_place
from shardloom.operators.windows import assign_windows, filter_label_prefix, scan_window
from shardloom.session import freed_shuffles, materialize


@dataclass(frozen=True)
class BuildSpec:
    """Parameters of a shard build.  Prompt wording is always a parameter."""

    system_prompt: str
    user_template: str
    assistant_template: str = "{patent_text}"
    start: str = "2015-03-01"
    end: str = "2018-06-30"
    step_months: int = 2
    label_prefix: str | None = None
    n_samples: int | None = None
    on_null: str = "error"
    max_len: int | None = 64_000
    block_size: int = 2_048
    date_col: str = "filing_date"
    order_cols: tuple[str, ...] = ("doc_id",)
    #: Spread the corpus over this many partitions before tokenising (0 keeps
    #: the scan's partitioning).  Only for inputs whose files cannot be split
    #: (one row group per file); a large corpus is split by the file source,
    #: and spreading it would shuffle all of its text.
    spread_partitions: int = 0


def windowed_corpus(corpus: DataFrame, spec: BuildSpec) -> DataFrame:
    rows = assign_windows(corpus, spec.date_col, spec.start, spec.end, spec.step_months)
    rows = filter_label_prefix(rows, spec.label_prefix)
    return sample_limit(rows, spec.n_samples, list(spec.order_cols), ["shard"])


def text_table(corpus: DataFrame, spec: BuildSpec, *, in_order: bool = False) -> DataFrame:
    rows = windowed_corpus(corpus, spec)
    if in_order:  # before rendering, which sampling the ranges would run once more
        rows = in_stream_order(rows, ["shard"], list(spec.order_cols))
    return with_patent_text(rows, SECTION_COLUMNS, spec.on_null, keep=("doc_id", "shard", "ipc_label", "title"))


def prompt_table(corpus: DataFrame, spec: BuildSpec, *, in_order: bool = False) -> DataFrame:
    """``in_order`` deals and sorts the rows by (shard, order) (``operators.streams``)."""
    return chat_prompts(text_table(corpus, spec, in_order=in_order), spec.system_prompt, spec.user_template, spec.assistant_template)


def token_table(corpus: DataFrame, spec: BuildSpec, tokenizer=None, *, max_len="spec") -> DataFrame:
    cap = spec.max_len if max_len == "spec" else max_len
    prompts = prompt_table(corpus, spec)
    return tokenize(prompts, tokenizer or CodePointTokenizer(), keys=("doc_id", "shard"), max_len=cap)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Hash-spread rows by ``doc_id`` over ``partitions`` (0 = unchanged)."""
    return df.repartition(int(partitions), "doc_id") if partitions and partitions > 0 else df


def materialized_tokens(corpus: DataFrame, spec: BuildSpec, tokenizer=None) -> DataFrame:
    """Token table written once to the shared folder, so the reads of packing
    (narrow offsets, wide payload) do not re-tokenise.

    Stored compactly: ids, four bytes each in one binary value a row, and the
    masked-prefix length; ``input_ids`` and ``labels`` are derived columns, computed
    only by readers that select them.

    The texts are dealt by ranges of (shard, order) and stored in stream order with
    each row's place (``operators.streams``): packing joins neighbours where it reads
    them and never shuffles ids to give them their offsets.

    The length cap is applied on the stored table (a Parquet pushed filter), which
    holds the longer rows too."""
    group, order = ["shard"], list(spec.order_cols)
    prompts, keys = prompt_table(corpus, spec, in_order=True), ("doc_id", "shard")
    tokenizer = tokenizer or CodePointTokenizer()
    if hasattr(tokenizer, "sides_encoder"):
        tok = tokens_in_place(prompts, tokenizer, keys, group, order, spec.max_len, packed=True)
    else:
        tok = with_place(tokenize(prompts, tokenizer, keys=keys, max_len=None).drop("labels"), group, order, spec.max_len)
    with freed_shuffles(corpus.sparkSession):  # the texts' exchange is as large as the table
        stored = materialize(tok, "tokens", PACKED_CODEC)
    stored = length_filter(stored, spec.max_len)
    if PACKED in stored.columns:
        stored = stored.withColumn("input_ids", arrays_from_packed(stored.sparkSession))
    return stored.withColumn("labels", labels_from_mask("input_ids", "n_masked"))


def packed_shards(tokens: DataFrame, spec: BuildSpec, *, keep_tail: bool = True) -> DataFrame:
    """Blocks per shard in document order; the tail is kept as a last short
    chunk so any read-time window size can be cut later.

    Tokens stored in stream order are packed without a shuffle of ids; the blocks are
    written here, their labels as masked runs, and ``labels`` is derived by readers."""
    if set(PLACE) <= set(tokens.columns):
        pieces = materialize(pack_stream(tokens, ["shard"], spec.block_size), "shards", PACKED_CODEC)
        return whole_blocks(pieces, ["shard"], spec.block_size, keep_tail=keep_tail)
    mask = "n_masked" if "n_masked" in tokens.columns else None
    blocks = pack_blocks(tokens, ["shard"], list(spec.order_cols), spec.block_size, keep_tail=keep_tail, mask=mask)
    # stored as int32, with the block length, so manifests never read the arrays
    stored = blocks.withColumns({c: narrow_ids(c) for c in ("input_ids", "labels")})
    return stored.withColumn("n_tokens", seq_length("input_ids"))


def write_shards(blocks: DataFrame, path: str, mode: str = "overwrite", *, in_order: bool = False) -> None:
    """Parquet partitioned by shard; dynamic overwrite makes a window
    re-runnable without touching the others.  ``in_order``: each task reads a few
    contiguous ranges already (``packed_shards`` of tokens in stream order), so the
    blocks are written where they are read."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "n_tokens" not in blocks.columns:
        blocks = blocks.withColumn("n_tokens", F.size("input_ids"))
    # masked runs cross the exchange in place of labels
    payload = [c for c in blocks.columns if c not in ("labels" if "masked" in blocks.columns else "masked", PACKED)]
    columns = [c for c in blocks.columns if c not in ("masked", PACKED)]
    rows = blocks.select(*payload)
    if not in_order:
        # Contiguous (shard, chunk) ranges: about one file per task, and a
        # hot shard is still split over many tasks.
        rows = rows.repartitionByRange(n, "shard", "chunk")
    (
        rows.sortWithinPartitions("shard", "chunk")
        .select(*(labels_from_runs("input_ids", "masked").alias(c) if c == "labels" and c not in payload else c for c in columns))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )


def build_shards(corpus: DataFrame, spec: BuildSpec, path: str, tokenizer=None) -> DataFrame:
    blocks = packed_shards(materialized_tokens(corpus, spec, tokenizer), spec)
    write_shards(blocks, path, in_order="masked" in blocks.columns)
    # the schema is given, so a build without rows reads as an empty table
    return corpus.sparkSession.read.schema(blocks.drop("masked", PACKED).schema).parquet(path)


def build_splits(
    corpus: DataFrame, spec: BuildSpec, splits: Mapping[str, tuple], path: str, tokenizer=None
) -> dict[str, DataFrame]:
    """S3 taken to shards: each named half-open date range becomes its own set of
    shards under ``path/<name>``, e.g. ``{"train": (a, b), "val": (b, c)}``.

    Rows outside a range stay out of its shards even where its last window
    reaches past the range."""
    return {
        name: build_shards(
            scan_window(corpus, spec.date_col, start, end),
            replace(spec, start=start, end=end),
            f"{path}/{name}",
            tokenizer,
        )
        for name, (start, end) in splits.items()
    }


def write_report(stored: DataFrame) -> DataFrame:
    """Blocks and tokens written per shard, from the stored block lengths."""
    return stored.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("n_tokens").cast("long").alias("n_tokens")
    )
