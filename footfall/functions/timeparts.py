"""Calendar columns. All follow the session time zone, which the job sets to the data's zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def time_of_day(ts: Column) -> Column:
    """Hour of day as a decimal, to the minute."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def decode_timestamp(events: DataFrame) -> DataFrame:
    """Add event time and calendar parts from `play_stamp` (ms) and `launch_time` (s)."""
    ts = F.timestamp_millis(F.col("play_stamp"))
    launch = F.timestamp_seconds(F.col("launch_time"))
    return events.withColumns(
        {
            "ts": ts,
            "play_mday": F.dayofmonth(ts),
            "play_yday": F.dayofyear(ts),
            "play_time": time_of_day(ts),
            "launch_day": F.dayofyear(launch),
            "launch_date": F.to_date(launch),
        }
    )


def day_period(hour: Column, compat: str = "literal") -> Column:
    """1 morning, 2 noon, 3 afternoon, 4 evening (21:00 included), 5 night.

    Midnight sharp has no period; `intended` counts it as night.
    """
    night_start = hour >= 0 if compat == "intended" else hour > 0
    return (
        F.when(night_start & (hour < 6), 5)
        .when((hour >= 6) & (hour < 11), 1)
        .when((hour >= 11) & (hour < 13.5), 2)
        .when((hour >= 13.5) & (hour < 18), 3)
        .when((hour >= 18) & (hour <= 21), 4)
        .when((hour > 21) & (hour < 24), 5)
    )


def weekday(mday: Column) -> Column:
    """Weekday 1-7 of a month whose 15th is a Monday; defined for days 15 to 31."""
    return F.when(mday.between(15, 31), (mday - 15) % 7 + 1)


def weekday_of(date: Column) -> Column:
    """Weekday 1 (Monday) to 7 of any date."""
    return F.weekday(date) + 1


def is_weekend(day: Column) -> Column:
    """0 on weekdays 1-5, else 1; an unknown weekday counts as weekend."""
    return F.when(day.between(1, 5), 0).otherwise(1)


def watch_gap(compat: str = "literal") -> Column:
    """Days from launch to play; literal: difference of days of year, wrong across a new year."""
    if compat == "intended":
        return F.datediff(F.to_date("ts"), F.col("launch_date"))
    return F.col("play_yday") - F.col("launch_day")


def watch_ratio() -> Column:
    return F.col("play_time_length") / (F.col("video_length") + F.lit(0.01))


def over_midnight() -> Column:
    """1 when the play runs past the end of its day."""
    ts = F.col("ts")
    start = F.hour(ts) + F.minute(ts) / F.lit(60.0) + F.second(ts) / F.lit(3600.0)
    length = F.coalesce(F.nullif(F.col("play_time_length").cast("string"), F.lit("-")).cast("double"), F.lit(0.0))
    return F.when(start + length / F.lit(3600.0) > 24, 1).otherwise(0)
