"""Writers for feature, label and submission tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_events(events: DataFrame, path: str, columns: list[str]) -> None:
    """Event file as `load_events` reads it."""
    events.select(*columns).write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


def write_table(table: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Feature or label table, without an index column. CSV gets a header line."""
    writer = table.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def submission(scores: DataFrame, user: str, score: str) -> DataFrame:
    """userid and the score with four decimals (ties to even)."""
    text = F.expr(f"format_number(`{score}`, '0.0000')")
    return scores.select(F.col(user).alias("userid"), text.alias("score"))


def write_submission(scores: DataFrame, path: str, user: str, score: str) -> None:
    """Submission file without a header line."""
    submission(scores, user, score).write.mode("overwrite").option("header", False).csv(path)
