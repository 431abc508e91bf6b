"""Chat formatting with a grammar that reads back exactly what was written.

A conversation is a row of turns `<s>[INST] role NEWLINE text [/INST]</s>`. The parser cuts at `</s>`, and
refuses a turn that holds a control string besides its own. A conversation that does not come back as its
source is written again with escapes: a backslash after the first character of every control string, and
one more where there are some already; the parser takes one off. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP, END = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
RAW = r"<s>|</s>|\[INST\]|\[/INST\]"
TURN = "struct<role:string,text:string>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def role_line(role: Column) -> Column:
    """A role without line ends."""
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def role_of(line: Column) -> Column:
    return F.replace(F.replace(line, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: Column, change=lambda c: c) -> Column:
    part = lambda t: F.concat(
        F.lit(START), change(role_line(t["role"])), F.lit("\n"), change(t["text"]), F.lit(STOP + END)
    )
    return F.array_join(F.transform(turns, part), "")


def segments(formatted: Column) -> Column:
    """Rendered turns without their end mark."""
    parts = F.split(formatted, END)
    return F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))


def body(segment: Column) -> Column:
    """`role NEWLINE text` of a turn as it is written; null where the segment is no turn."""
    inner = F.substring(segment, F.lit(len(START) + 1), F.length(segment) - (len(START) + len(STOP)))
    good = segment.startswith(START) & segment.endswith(STOP) & (F.length(segment) >= len(START) + len(STOP) + 1)
    return F.when(good & ~inner.rlike(RAW) & inner.contains("\n"), inner)


def written_text(inner: Column) -> Column:
    return F.substring(inner, F.locate("\n", inner) + 1, F.length(inner))


def written_role(inner: Column) -> Column:
    return F.substring_index(inner, "\n", 1)


def parse(formatted: Column) -> Column:
    """(role, text) of every turn; nulls for what the grammar refuses."""

    def turn(segment: Column) -> Column:
        inner = body(segment)
        return F.struct(role_of(unescape(written_role(inner))).alias("role"), unescape(written_text(inner)).alias("text"))

    return F.transform(segments(formatted), turn)


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turns): turns by number, then role and text; a null text or role is empty, a null number first.

    One row holds one whole conversation, as its digest and its output line have to.
    """
    part = F.struct(
        F.col(turn).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.groupBy(F.col(conv).alias("conv_id")).agg(
        F.transform(F.sort_array(F.collect_list(part)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def formatted(rows: DataFrame, learn: str = "assistant", conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, formatted, turns, loss_spans): the text, what the parser reads from it, and the learned spans.

    A span is (turn from 0, start, length): code points within the rendered turn, the text alone. A
    conversation that would not come back even with escapes stops the job; the grammar excludes it.
    """
    known = conversations(rows, conv, turn)
    tries = known.withColumn("raw", render(F.col("turns")))
    tries = tries.withColumn("same", parse(F.col("raw")).eqNullSafe(F.col("turns")))
    chosen = tries.select(
        "conv_id", F.col("turns").alias("source"), F.when(F.col("same"), F.col("raw")).otherwise(render(F.col("turns"), escape)).alias("formatted")
    )
    read = chosen.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation does not come back as it was"))
    )

    def span(segment: Column, i: Column) -> Column:
        inner = body(segment)
        wanted = role_of(unescape(written_role(inner))) == learn
        start = F.lit(len(START)) + F.locate("\n", inner)
        return F.when(wanted, F.struct(i.alias("turn"), start.alias("start"), F.length(written_text(inner)).alias("length")))

    spans = F.array_compact(F.transform(segments(F.col("formatted")), span))
    return read.select("conv_id", checked.alias("formatted"), "turns", spans.alias("loss_spans"))


def loss_text(formatted_text: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the output and unescaped."""
    parts = F.col("_parts") if formatted_text is None else segments(formatted_text)
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(F.get(parts, s["turn"]), s["start"] + 1, s["length"]))), ""
    )


def digests(found: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted conversations."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    cut = found.withColumn("_parts", segments(F.col("formatted")))
    return cut.withColumn("_loss", loss_text(None, F.col("loss_spans"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
