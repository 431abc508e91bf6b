"""Quality rules: a table of thresholds compiled into one projection over counts of each text.

All counts are built-in functions on the row itself: no shuffle, no user function.
The table is for English, German, French and Spanish: clean texts of any other language have too few of its stop
words and are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import BLANKS

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "au", "aux", "avec", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "es", "las", "los", "no", "para", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts that must lie within [low, high]; None is open."""

    name: str
    count: str
    over: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        ratio = F.try_divide(F.col(self.count).cast("double"), F.col(self.over))
        bounds = [ratio >= self.low] if self.low is not None else []
        bounds += [ratio <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, bounds, ratio.isNotNull())


RULES = (
    Rule("word length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols per word", "n_symbols", "n_words", None, 0.3),
    Rule("exclamation marks per word", "n_exclaims", "n_words", None, 0.5),
    Rule("stop words per word", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 0.5),
)


def counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` of every row with the counts of its whole text; a null text counts like an empty one."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select(
        *keep,
        "_text",
        F.array_remove(F.split("_text", BLANKS), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    n = F.size("_words")
    # Words hold no blank, so that joined windows are equal where their words are.
    window = F.transform(
        F.slice("_words", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, *[F.get("_words", i + j) for j in range(1, WINDOW)]),
    )
    rows = rows.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_exclaims"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        window.alias("_windows"),
    )
    placed = F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(placed))).drop("_windows")
    again = F.filter(
        "_sorted",
        lambda x, i: x["w"].eqNullSafe(F.get("_sorted", i - 1)["w"]) | x["w"].eqNullSafe(F.get("_sorted", i + 1)["w"]),
    )
    covered = F.flatten(F.transform(again, lambda x: F.sequence(x["i"], x["i"] + (WINDOW - 1))))
    n_repeat = F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))
    return rows.withColumn("n_repeat_words", F.when(F.col("_sorted").isNull(), 0).otherwise(n_repeat).cast("long")).drop("_sorted")


def judged(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The counts with `base_failed` (too short or mostly repeated), `failed` (names of rules) and `kept`.

    Write the result before filtering by it: a filter that moves below the projections repeats their work.
    """
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(r.passes(), F.lit(False)), F.lit(r.name)) for r in rules]))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~base & reduce(lambda a, b: a & b, [F.coalesce(r.passes(), F.lit(False)) for r in rules], F.lit(True))
    return counts(docs, text, keep).select("*", base.alias("base_failed"), failed.alias("failed"), kept.alias("kept"))
