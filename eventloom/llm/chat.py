"""Chat formatting: typed content parts to one masked training string per conversation (built-in functions only).

A part is a struct (type, text, uri, width, height, seconds, pages). The visitor turns a turn's parts
into text with numbered placeholders, in order; text is escaped so that no text can hold a control
string, and `unescape` gives it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.llm.frames import bind

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 1024


def escape(text: Column) -> Column:
    r"""No `<|` and no line break of a role survives: `\` -> `\-`, `<|` -> `<\|`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\-")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\-"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\."))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\."), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("uri"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    )


def expanded_tokens(part: Column) -> Column:
    """Tokens a non-text part stands for: image patches, audio seconds, document pages; unknown size: one unit."""
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(1)) / PATCH)
    return (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * TOKENS_PER_SECOND))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(1)) * TOKENS_PER_PAGE)
        .otherwise(0)
        .cast("bigint")
    )


def visit(parts: Column) -> tuple[Column, Column]:
    """(escaped text with placeholders `<|image|>`..., attachments in order) of a turn's parts.

    A null list or part is skipped, a null text is empty, an unknown type counts as text.
    """
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    media = lambda p: F.coalesce(p["type"], F.lit("text")).isin("image", "audio", "document")
    text = F.array_join(
        F.transform(
            parts,
            lambda p: F.when(media(p), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(
                escape(F.coalesce(p["text"], F.lit("")))
            ),
        ),
        "",
    )
    attachments = F.transform(
        F.filter(parts, media),
        lambda p: F.struct(p["type"].alias("type"), p["uri"].alias("uri"), expanded_tokens(p).alias("tokens")),
    )
    return text, attachments


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    Returns conv_id, formatted, loss_spans (start and end of assistant text, in code points, control
    strings outside), attachments (turn position, type, uri, tokens; in the order of the placeholders),
    expanded_tokens. Turns are ordered by (turn, role, text), so ties have a defined order; repeated rows
    are repeated turns; a null role is empty; rows with a null conv_id are one conversation. A
    conversation is one row of the result, so its turns meet in one task.
    """
    text, attachments = visit(F.col("parts"))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), attachments.alias("att")
    ).withColumns(
        {
            "head": F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")),
            "size": F.char_length("text"),
        }
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.char_length("head") + F.col("size") + len(END) + 1).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumns({"n": F.row_number().over(order), "before": F.coalesce(before, F.lit(0))})
    start = (F.col("before") + F.char_length("head")).cast("bigint")
    packed = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "n",
                    F.concat("head", "text", F.lit(END + "\n")).alias("piece"),
                    F.struct(start.alias("start"), (start + F.col("size")).alias("end")).alias("span"),
                    (F.col("role") == "assistant").alias("loss"),
                    "att",
                )
            )
        ).alias("t")
    )
    refs = F.flatten(
        F.transform(
            "t",
            lambda t: F.transform(
                t["att"],
                lambda a: F.struct(t["n"].alias("turn_position"), a["type"].alias("type"), a["uri"].alias("uri"), a["tokens"].alias("tokens")),
            ),
        )
    )
    return packed.select(
        "conv_id",
        F.array_join(F.col("t.piece"), "").alias("formatted"),
        F.transform(F.filter("t", lambda t: t["loss"]), lambda t: t["span"]).alias("loss_spans"),
        refs.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """Back from a formatted string: array of (role, text), unescaped; placeholders stay in the text."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(1), F.char_length(p) - F.lit(len(END) + 1))
    return F.transform(
        pieces,
        lambda p: bind(
            F.instr(p, "\n"),
            lambda at: F.struct(
                _unescape_role(F.substring(p, F.lit(1), at - 1)).alias("role"),
                unescape(F.substring(body(p), at + 1, F.char_length(p))).alias("text"),
            ),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )
