"""One row per user: first event, labels, joins onto the user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.timeparts import is_weekend, weekday, weekday_of
from footfall.schema import DEFAULT, EventSpec

BASE = ("gender", "age", "edu", "play_mday", "play_yday")


def first_per_user(events: DataFrame, cols, spec: EventSpec = DEFAULT) -> DataFrame:
    """`cols` of each user's first event. An aggregate, not a window: one partial row per task."""
    first = F.min_by(F.struct(*cols), spec.order_key()).alias("_first")
    return events.groupBy(spec.user).agg(first).select(spec.user, "_first.*")


def user_base(events: DataFrame, spec: EventSpec = DEFAULT, label: str | None = None, compat: str = "literal") -> DataFrame:
    """Demographics and day of the first event, with the label where there is one; `intended` with its date."""
    date = [F.to_date(spec.ts).alias("play_date")] if compat == "intended" else []
    return first_per_user(events, [*BASE, *([label] if label else []), *date], spec)


def user_labels(events: DataFrame, spec: EventSpec = DEFAULT, label: str = "label") -> DataFrame:
    """Label table: the label on each user's first event."""
    return first_per_user(events, [label], spec)


def weekday_features(users: DataFrame, compat: str = "literal") -> DataFrame:
    """Add play_weekday and play_isweekend; literal reads `play_mday`, intended `play_date`."""
    day = weekday(F.col("play_mday")) if compat == "literal" else weekday_of(F.col("play_date"))
    return users.withColumn("play_weekday", day).withColumn("play_isweekend", is_weekend(F.col("play_weekday")))


def join_user(users: DataFrame, features: DataFrame, spec: EventSpec = DEFAULT, how: str = "left") -> DataFrame:
    """Join a per-user table. `inner` drops users absent from `features`, `left` leaves NULLs.

    Both sides have one row per user, so no key can be heavy.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r}: only inner and left")
    return users.join(features, spec.user, how)
