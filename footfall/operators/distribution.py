"""Distribution statistics from value counts: distinct count, median, deviations, moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import stats
from footfall.functions.timeparts import watch_gap
from footfall.operators.profiles import value_counts
from footfall.schema import DEFAULT, SLICES, EventSpec

STATS = ("count", "var", "mean", "median", "mad", "skew", "kurt", "max")


def distribution_stats(
    counts: DataFrame,
    keys: list[str],
    weights: dict[str, str],
    value: str = "x",
    wanted=STATS,
    carry=(),
    repeated: bool = False,
) -> DataFrame:
    """Statistics of `value` per `keys`, each row of `counts` standing for `weight` equal values.

    `weights` maps a weight column to a name pattern, e.g. {"n_play": "time_play_{}"}.
    `count` is the number of distinct values, NULL where the weight column has no events at all;
    a NULL value marks events without a value. Columns in `carry` are passed on as their maximum.
    With `repeated` (one weight column, no zero weights) several rows may have the same value.
    Two passes around the mean, one sort by value: both windows and the aggregate share one
    partitioning by `keys`.
    """
    group = Window.partitionBy(*keys)
    running = group.orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = counts.select(*keys, *carry, F.col(value).cast("double").alias("_x"), *weights)
    if "median" in wanted:
        base = base.withColumns({f"_upto_{w}": F.sum(_n(w)).over(running) for w in weights})
    if repeated:
        before = F.lag("_x").over(group.orderBy("_x"))
        base = base.withColumn("_again", before.isNotNull() & (before == F.col("_x")))
    base = base.withColumns(
        {f"_total_{w}": F.sum(_n(w)).over(group) for w in weights}
        | {f"_sum_{w}": F.sum(_n(w) * F.col("_x")).over(group) for w in weights}
    )
    aggs = [a for w in weights for a in _sums(w, wanted, repeated)] + [F.max(c).alias(c) for c in carry]
    out = [c for w, name in weights.items() for c in _finish(w, name, wanted)]
    return base.groupBy(*keys).agg(*aggs).select(*keys, *out, *carry)


def _n(w: str) -> Column:
    """Number of values a row stands for."""
    return F.when(F.col("_x").isNotNull(), F.col(w)).otherwise(0)


def _sums(w: str, wanted, repeated: bool) -> list[Column]:
    x, n, total = F.col("_x"), _n(w), F.col(f"_total_{w}")
    mean = F.try_divide(F.col(f"_sum_{w}"), total)
    dev = x - mean
    here = n > 0
    aggs = {
        "present": F.sum(w) > 0,
        "n": F.sum(n),
        "mean": F.max(mean),
        "max": F.max(F.when(here, x)),
    }
    if "count" in wanted:
        aggs["distinct"] = F.count_if(here & ~F.col("_again") if repeated else here)
    if "median" in wanted:
        upto = F.col(f"_upto_{w}")
        aggs["lower"] = F.min(F.when(here & (upto >= F.floor((total + 1) / 2)), x))
        aggs["upper"] = F.min(F.when(here & (upto >= F.floor(total / 2) + 1), x))
    if "mad" in wanted:
        aggs["s1"] = F.sum(n * F.abs(dev))
    if {"var", "skew", "kurt", "std"} & set(wanted):
        aggs["s2"] = F.sum(n * dev * dev)
    if {"skew", "kurt"} & set(wanted):
        aggs["min"] = F.min(F.when(here, x))
    if "skew" in wanted:
        aggs["s3"] = F.sum(n * dev * dev * dev)
    if "kurt" in wanted:
        aggs["s4"] = F.sum(n * dev * dev * dev * dev)
    return [col.alias(f"{name}_{w}") for name, col in aggs.items()]


def _finish(w: str, pattern: str, wanted) -> list[Column]:
    def c(name: str) -> Column:
        return F.col(f"{name}_{w}")

    constant = c("min") == c("max")
    formulas = {
        "count": lambda: F.when(c("present"), c("distinct")),
        "var": lambda: F.when(c("n") > 1, c("s2") / (c("n") - 1)),
        "std": lambda: F.when(c("n") > 1, F.sqrt(c("s2") / (c("n") - 1))),
        "mean": lambda: c("mean"),
        "median": lambda: (c("lower") + c("upper")) / 2,
        "mad": lambda: F.try_divide(c("s1"), c("n")),
        "skew": lambda: stats.skew_from_sums(c("n"), c("s2"), c("s3"), constant),
        "kurt": lambda: stats.kurt_from_sums(c("n"), c("s2"), c("s4"), constant),
        "max": lambda: c("max"),
    }
    return [formulas[s]().alias(pattern.format(s)) for s in wanted]


def value_stats(
    events: DataFrame, value: Column, pattern: str, spec: EventSpec = DEFAULT, slices=SLICES, wanted=STATS
) -> DataFrame:
    """Statistics of a column with a bounded set of values, per user and slice.

    `pattern` names the output, e.g. "time_{slice}_{stat}".
    """
    counts = value_counts(events, value, spec, slices)
    return distribution_stats(counts, [spec.user], _weights(pattern, slices), wanted=wanted)


def _weights(pattern: str, slices) -> dict[str, str]:
    return {f"n_{s}": pattern.format(slice=s, stat="{}") for s in slices}


def time_of_day_stats(events: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES) -> DataFrame:
    """time_<slice>_{count,var,mean,median,mad,skew,kurt,max}; at most 1,440 values per user."""
    return value_stats(events, F.col(spec.time_of_day), "time_{slice}_{stat}", spec, slices)


def time_of_day_stats_from_runs(runs: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES) -> DataFrame:
    """The same from per-minute counts that another family needs anyway."""
    counts = runs.groupBy(spec.user, "x").agg(*[F.sum(f"n_{s}").alias(f"n_{s}") for s in slices])
    return distribution_stats(counts, [spec.user], _weights("time_{slice}_{stat}", slices))


def watch_gap_stats(
    events: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES, compat: str = "literal"
) -> DataFrame:
    """watch_gap_<slice>_{...}: days between launch and play; at most one value per day."""
    return value_stats(events, watch_gap(compat), "watch_gap_{slice}_{stat}", spec, slices)


def watch_gap_stats_from(values: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES) -> DataFrame:
    """The same from counts per gap that were made with others."""
    return distribution_stats(values, [spec.user], _weights("watch_gap_{slice}_{stat}", slices))
