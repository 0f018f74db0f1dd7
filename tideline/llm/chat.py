"""Chat formatting with typed content parts, in DataFrame functions only.

A message's content is an array of parts `struct<type, text, ref, tokens>`.  A part of type `text`
gives its text; any other type (`image`, `audio`, `document`, ...) gives a placeholder
`<|type:n|>`, where n counts the attachments of the conversation from 0, and its reference and expanded token
count are recorded in the same order.

Inside roles and texts `&`, `<` and `[` are written as character references, so that no text can
hold a control string (neither this template's nor the bracketed ones of others), and `unescape`
gives the very text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,tokens:bigint>"
# Escaped in this order, unescaped in the opposite one.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
TURN, HEAD, END = "<|", "|>\n", "<|end|>\n"


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_part(text: Column) -> Column:
    """Content of one text part; a NULL text is an empty one."""
    return F.array(
        F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("bigint").alias("tokens"))
    ).cast(f"array<{PART}>")


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _flatten(content: Column, before: Column) -> Column:
    """The text of a message: its parts in order, attachments as numbered placeholders."""

    def part_text(part: Column, i: Column) -> Column:
        number = before + F.size(F.filter(F.slice(content, F.lit(1), i), lambda p: ~_is_text(p)))
        mark = F.concat(F.lit("<|"), escape(part["type"]), F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)

    return F.array_join(F.transform(content, part_text), "")


def format_conversations(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, content).

    Turns go by `turn`, ties by role and content; a NULL turn comes first, a NULL role is the empty
    role, NULL content has no parts.  Gives `formatted`; `loss_spans`, the start and length in code
    points of what `loss_role` said; `attachments` (ref, type, tokens in placeholder order); and
    `attachment_tokens`.  No row gives no conversation.
    """
    row = messages.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>")).alias("content"),
        ).alias("m"),
    )
    turns = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("turns"))
    files = F.filter(F.flatten(F.transform("turns", lambda m: m["content"])), lambda p: ~_is_text(p))

    def body(m: Column, i: Column) -> Column:
        earlier = F.flatten(F.transform(F.slice("turns", F.lit(1), i), lambda t: t["content"]))
        before = F.when(F.size("attachments") == 0, F.lit(0)).otherwise(F.size(F.filter(earlier, lambda p: ~_is_text(p))))
        head = F.concat(F.lit(TURN), escape(m["role"]), F.lit(HEAD))
        return F.struct((m["role"] == loss_role).alias("loss"), head.alias("head"), _flatten(m["content"], before).alias("body"))

    pieces = turns.withColumn(
        "attachments", F.transform(files, lambda p: F.struct(p["ref"].alias("ref"), p["type"].alias("type"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens")))
    ).withColumn("pieces", F.transform("turns", body))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        at = state["at"] + F.length(p["head"])
        span = F.struct(at.alias("start"), F.length(p["body"]).alias("length"))
        spans = F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((at + F.length(p["body"]) + len(END)).alias("at"), spans.alias("spans"))

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("pieces", start, step)["spans"].alias("loss_spans"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from formatted text; placeholders stay as written."""
    # Only the template writes '<', so the end mark cannot come from a text.
    ended = F.split(formatted, r"<\|end\|>\n")
    pieces = F.slice(ended, F.lit(1), F.size(ended) - 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, F.lit(len(TURN) + 1), F.length(p)), HEAD, 1)).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, HEAD, 1)) + len(HEAD) + 1, F.length(p))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
