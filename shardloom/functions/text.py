"""Section cleaning and labelled patent text."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
#: Characters removed by Python's ``str.strip()``: every code point for which
#: ``str.isspace()`` is true (29 of them), built from that rule.
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
#: Leading header block removed after stripping: anchored, lazy, at least one
#: character inside; ``(?d)`` makes ``.`` stop only at ``\n`` as in Python.
HEADER_PATTERN = r"(?d)^<SOH.+?EOH>"
#: Text sections in output order.
SECTION_COLUMNS = ("title", "abstract", "claims", "background", "summary", "description")
# ---------------------------------------------------------------------------

NULL_POLICIES = ("error", "empty")


def py_strip(col: str | Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace, not only U+0020)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(WHITESPACE))


def drop_header(col: str | Column) -> Column:
    """Remove one leading ``<SOH ... EOH>`` block; not re-stripped."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, HEADER_PATTERN, "")


def clean_section(col: str | Column) -> Column:
    return drop_header(py_strip(col))


def null_guard(col: str, on_null: str = "error") -> Column:
    """A null section raises (``error``) or becomes ``''`` (``empty``)."""
    if on_null not in NULL_POLICIES:
        raise ValueError(f"on_null must be one of {NULL_POLICIES}")
    c = F.col(col)
    if on_null == "empty":
        return F.coalesce(c, F.lit(""))
    return F.coalesce(c, F.raise_error(F.lit(f"null value in text column {col}")).cast("string"))


def section_text(columns: Sequence[str] = SECTION_COLUMNS, on_null: str = "error") -> Column:
    """``[NAME]\\n<cleaned>`` per section, joined by ``\\n``."""
    parts = [F.concat(F.lit(f"[{c.upper()}]\n"), clean_section(null_guard(c, on_null))) for c in columns]
    return F.concat_ws("\n", *parts)


def clean_sections(
    df: DataFrame, columns: Sequence[str] = SECTION_COLUMNS, on_null: str = "error"
) -> DataFrame:
    """Replace each text column by its cleaned value."""
    return df.select(
        *[c for c in df.columns if c not in columns],
        *[clean_section(null_guard(c, on_null)).alias(c) for c in columns],
    )


def with_patent_text(
    df: DataFrame,
    columns: Sequence[str] = SECTION_COLUMNS,
    on_null: str = "error",
    out: str = "text",
    keep: Sequence[str] = ("doc_id", "ipc_label", "title"),
) -> DataFrame:
    """Labelled text of all sections; other text columns are dropped."""
    extra = [c for c in df.columns if c in keep]
    return df.select(*extra, section_text(columns, on_null).alias(out))
