"""Missing-sign handling and typing of the raw event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schema import FLAGS, MISSING


def missing_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(MISSING))


def missing_to_zero(col: Column, dtype: str) -> Column:
    return F.coalesce(missing_to_null(col.cast("string")).cast(dtype), F.lit(0).cast(dtype))


def category(col: Column) -> Column:
    """Value used for label codes: missing is a category of its own, named `nan`."""
    return F.coalesce(missing_to_null(col.cast("string")), F.lit("nan"))


def clean_events(events: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Flags and play length with the missing sign as 0, all numbers typed; absent drops are fine."""
    typed = {f: missing_to_zero(F.col(f), "int") for f in FLAGS if f in events.columns}
    typed["play_time_length"] = missing_to_zero(F.col("play_time_length"), "double")
    typed["video_length"] = F.col("video_length").cast("int")
    return events.drop(*drop).withColumns(typed)
