"""Prompt rendering.

A template is a Python format string with named fields.  It is split once on
the driver (``string.Formatter().parse``) into literal and field parts and
becomes one ``concat`` expression; braces inside column *values* stay literal.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: chat-format markers of the target model family ----------
BEGIN_OF_TEXT = "<|begin_of_text|>"
START_HEADER = "<|start_header_id|>"
END_HEADER = "<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
END_OF_TEXT = "<|end_of_text|>"
# ---------------------------------------------------------------------------


def render(template: str, fields: Mapping[str, str | Column], *, literal: bool = False) -> Column:
    """Fill ``{name}`` fields from columns.

    A null field reads ``None``, so a document with a null label is kept.
    ``literal=True`` emits the template as is (for texts with literal braces,
    e.g. JSON examples, that are never formatted).
    """
    if literal:
        return F.lit(template)
    parts: list[Column] = []
    for text, field, spec, conv in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is None:
            continue
        if spec or conv:
            raise ValueError(f"format specs are not supported: {{{field}!{conv}:{spec}}}")
        if field not in fields:
            raise KeyError(f"template field {field!r} has no column")
        src = fields[field]
        value = (F.col(src) if isinstance(src, str) else src).cast("string")
        parts.append(F.coalesce(value, F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")


def chat_turn(role: str, content: Column) -> Column:
    return F.concat(F.lit(f"{START_HEADER}{role}{END_HEADER}\n\n"), content, F.lit(END_OF_TURN))


def input_side(system_prompt: str, user: Column) -> Column:
    """Begin marker, system turn (literal text), user turn."""
    return F.concat(F.lit(BEGIN_OF_TEXT), chat_turn("system", F.lit(system_prompt)), chat_turn("user", user))


def target_side(assistant: Column) -> Column:
    """Assistant header + text + end markers (the header is trained on)."""
    return F.concat(
        F.lit(f"{START_HEADER}assistant{END_HEADER}\n\n"), assistant, F.lit(END_OF_TURN + END_OF_TEXT)
    )


def chat_prompts(
    df: DataFrame,
    system_prompt: str,
    user_template: str,
    assistant_template: str = "{patent_text}",
    fields: Mapping[str, str | Column] | None = None,
    keep: tuple[str, ...] = ("doc_id", "shard"),
) -> DataFrame:
    """(keep..., inputs, outputs): the prompt pair of each row.

    Default fields: ``ipc_code`` <- ipc_label, ``title`` <- raw title,
    ``patent_text`` <- text.
    """
    fields = dict(fields or {"ipc_code": "ipc_label", "title": "title", "patent_text": "text"})
    user = render(user_template, fields)
    assistant = render(assistant_template, fields)
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, input_side(system_prompt, user).alias("inputs"), target_side(assistant).alias("outputs"))


def qa_prompts(
    df: DataFrame,
    system_text: str,
    user_template: str,
    fields: Mapping[str, str | Column] | None = None,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Question-answer prompt: literal system text + rendered user turn,
    ending with an open assistant header for generation."""
    fields = dict(fields or {"patent_text": "text"})
    gen = F.lit(f"{START_HEADER}assistant{END_HEADER}\n\n")
    inputs = F.concat(input_side(system_text, render(user_template, fields)), gen)
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, inputs.alias("inputs"))
