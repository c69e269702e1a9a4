"""Chat formatting with Spark expressions only (relational formatting)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The marks of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

# Control strings all begin with "<|". "&" is the escape character, so both are rewritten.
_ESCAPES = [("&", "&amp;"), ("<|", "&lt;|")]


def escape(text: Column) -> Column:
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(_ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def format_conversations(
    df: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: the formatted text and where the loss counts.

    Turn structs are collected and sorted by turn, then role, then text. Adjacent turns of one
    role share a block, `<|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n`; one array aggregation
    merges them and keeps the spans of the texts of `loss_role`. Control strings in texts and
    roles are escaped reversibly (`&` to `&amp;`, `<|` to `&lt;|`, line ends in roles to `&nl;`).

    Columns: the conversation, `n_turns`, `formatted`, `loss_spans` (start from 0 and length in
    code points of `formatted`; an empty text has a span of length 0).

    Null text and null role: empty. Null turn: before all others. Null conversation: one
    conversation of its own. Ties and repeated rows: each is a turn, in the order given above.
    An empty table gives an empty table. Other columns are ignored. A conversation becomes one
    string, so the longest conversation bounds the memory of a task.
    """
    turns = df.groupBy(F.col(f"`{conversation}`").alias(conversation)).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ))).alias("_turns")
    )

    # Each turn with what comes before its text: a new block, or a mark within the block.
    def piece(one: Column, i: Column) -> Column:
        before = F.get(F.col("_turns"), i - 1)["role"]
        merged = (i > 0) & (before == one["role"])
        opening = F.concat(
            F.when(i > 0, F.lit(f"{END}\n")).otherwise(F.lit("")), F.lit(START), _escape_role(one["role"]), F.lit("\n")
        )
        return F.struct(
            F.when(merged, F.lit(SEPARATOR)).otherwise(opening).alias("before"),
            escape(one["text"]).alias("body"),
            (one["role"] == loss_role).alias("loss"),
        )

    def place(state: Column, one: Column) -> Column:
        start = state["at"] + F.length(one["before"])
        length = F.length(one["body"]).cast("long")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length).alias("at"),
            F.when(one["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    empty = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )
    return (
        turns.withColumn("_pieces", F.transform("_turns", piece))
        .select(
            F.col(f"`{conversation}`"),
            F.size("_turns").cast("long").alias("n_turns"),
            F.concat(
                F.array_join(F.transform("_pieces", lambda p: F.concat(p["before"], p["body"])), ""),
                F.lit(f"{END}\n"),
            ).alias("formatted"),
            F.aggregate("_pieces", empty, place, lambda s: s["spans"]).alias("loss_spans"),
        )
    )


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted text, array<struct<role, text>>, as they were before formatting."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(role) + 2, F.length(block) - F.length(role) - 2 - len(END))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
