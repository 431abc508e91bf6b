"""Counts, rates and plain statistics that one aggregate by user can carry together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import stats
from footfall.functions.cleaning import missing_to_null
from footfall.functions.timeparts import day_period, over_midnight, watch_ratio
from footfall.schema import DEFAULT, DEMOGRAPHICS, FLAGS, REC_TYPES, EventSpec

PERIODS = (1, 2, 3, 4, 5)


def action_count_columns(spec: EventSpec = DEFAULT) -> list[Column]:
    """show_count_all, <flag>_count for the five flags, and the five rates."""
    total = F.count("show")
    n = {f: F.sum(f) for f in FLAGS}
    rates = {
        "show": F.try_divide(n["show"], total),
        "click": n["click"] / (n["show"] + 1),
        "comment": n["comment"] / (n["click"] + 1),
        "like": n["like"] / (n["click"] + 1),
        "share": n["share"] / (n["click"] + 1),
    }
    return [
        total.alias("show_count_all"),
        *[c.alias(f"{f}_count") for f, c in n.items()],
        *[c.alias(f"{f}_ratio") for f, c in rates.items()],
    ]


def length_and_launch_columns(spec: EventSpec = DEFAULT) -> list[Column]:
    """video_length_{mean,max,min} and launch_time_{mean,max,min,std,skew,kurt} (day of year)."""
    length, day = F.col("video_length"), F.col("launch_day")
    return [
        stats.mean_of(length).alias("video_length_mean"),
        stats.max_of(length).alias("video_length_max"),
        stats.min_of(length).alias("video_length_min"),
        stats.mean_of(day).alias("launch_time_mean"),
        stats.max_of(day).alias("launch_time_max"),
        stats.min_of(day).alias("launch_time_min"),
        stats.std_of(day).alias("launch_time_std"),
        stats.skew_of(day).alias("launch_time_skew"),
        stats.kurt_of(day).alias("launch_time_kurt"),
    ]


def duration_columns(spec: EventSpec = DEFAULT, slices=("play", "show", "click", "like", "share")) -> list[Column]:
    """<slice>_duration: latest minus earliest time of day."""
    x = F.col(spec.time_of_day)
    return [stats.range_of(x, spec.in_slice(s)).alias(f"{s}_duration") for s in slices]


def watch_ratio_columns(spec: EventSpec = DEFAULT) -> list[Column]:
    """watch_ratio_{mean,max,min,skew,kurt} over clicked events."""
    ratio, clicked = watch_ratio(), spec.in_slice("click")
    return [
        build(ratio, clicked).alias(f"watch_ratio_{name}")
        for name, build in {
            "mean": stats.mean_of,
            "max": stats.max_of,
            "min": stats.min_of,
            "skew": stats.skew_of,
            "kurt": stats.kurt_of,
        }.items()
    ]


def _fixed_pivot(cond: Column, key: Column, values, name) -> list[Column]:
    """One count per value among rows meeting `cond`; NULL when no such row has a key."""
    here = F.count_if(cond & key.isNotNull()) > 0
    return [F.when(here, F.count_if(cond & (key == v))).alias(name(v)) for v in values]


def rec_type_columns(spec: EventSpec = DEFAULT, values=REC_TYPES) -> list[Column]:
    """<rec_type>_{show0,show1,click,like,share}; show0 counts every event."""
    slices = {"show0": "play", "show1": "show", "click": "click", "like": "like", "share": "share"}
    return [
        col
        for suffix, s in slices.items()
        for col in _fixed_pivot(spec.in_slice(s), F.col("rec_type"), values, lambda v, x=suffix: f"{v}_{x}")
    ]


def day_period_columns(
    spec: EventSpec = DEFAULT, slices=("show", "click", "like"), compat: str = "literal"
) -> list[Column]:
    """period_<slice>_{1..5}."""
    period = day_period(F.col(spec.time_of_day), compat)
    return [
        col
        for s in slices
        for col in _fixed_pivot(spec.in_slice(s), period, PERIODS, lambda v, x=s: f"period_{x}_{v}")
    ]


def missing_rate_columns(cols=DEMOGRAPHICS) -> list[Column]:
    """<col>_nan_count and <col>_nan_ratio."""
    out = []
    for c in cols:
        gone = F.count_if(missing_to_null(F.col(c)).isNull())
        out += [gone.alias(f"{c}_nan_count"), (gone / F.count(F.lit(1))).alias(f"{c}_nan_ratio")]
    return out


def _by_user(events: DataFrame, spec: EventSpec, columns: list[Column]) -> DataFrame:
    return events.groupBy(spec.user).agg(*columns)


def action_counts(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return _by_user(events, spec, action_count_columns(spec))


def video_length_launch_stats(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return _by_user(events, spec, length_and_launch_columns(spec))


def slice_durations(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return _by_user(events, spec, duration_columns(spec))


def watch_ratio_stats(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return _by_user(events, spec, watch_ratio_columns(spec))


def rec_type_pivot(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return _by_user(events, spec, rec_type_columns(spec))


def day_period_pivot(events: DataFrame, spec: EventSpec = DEFAULT, compat: str = "literal") -> DataFrame:
    return _by_user(events, spec, day_period_columns(spec, compat=compat))


def missing_rates(events: DataFrame, spec: EventSpec = DEFAULT, cols=DEMOGRAPHICS) -> DataFrame:
    """Share of a user's events without gender, edu or age; takes raw events."""
    return _by_user(events, spec, missing_rate_columns(cols))


def over_midnight_flag(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """is_overday: 1 when any play ran past midnight (hour with seconds); raw or cleaned events."""
    return _by_user(events, spec, [F.max(over_midnight()).alias("is_overday")])


def slice_counts_by_user(events: DataFrame, spec: EventSpec = DEFAULT, slices=("show", "click", "like", "share")):
    return _by_user(events, spec, [F.count_if(spec.in_slice(s)).alias(f"n_{s}") for s in slices])


def install_channel_count(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Number of different install channels per user; pairs first, so no list of values is built."""
    pairs = events.select(spec.user, "install_channel").distinct()
    return pairs.groupBy(spec.user).agg(F.count("install_channel").alias("install_channel_count"))
