"""One user with most of the events, one minute and one stamp with many of them: brute force."""

import pandas as pd
import pytest

from fixtures import brute_stats, log, ordered, same, skewed_rows
from footfall.functions.joins import attach, hot_keys, is_hot, lookup
from footfall.operators import distribution, intervals, items, sequence
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def events(spark):
    return log(spark, skewed_rows()).cache()


@pytest.fixture(scope="module")
def table(events):
    return ordered(events)


def part(table, s):
    return table if s == "play" else table[table[s] == 1]


def by_user(df):
    return {r["user_id"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("s", ["play", "show", "click", "like"])
def test_sequence_stats(events, table, s):
    got = by_user(sequence.time_diff_stats(events))
    for user, rows in part(table, s).groupby("user_id"):
        for name, want in brute_stats(rows["play_time"].diff()).items():
            assert same(got[user][f"diff_time_{s}_{name}"], want), (user, name)
        assert same(got[user][f"diff2_time_{s}_max"], rows["play_time"].diff(2).max()), user
    assert sequence.second_lag_max(events).exceptAll(
        sequence.time_diff_stats(events).select("user_id", *[f"diff2_time_{x}_max" for x in ("play", "show", "click", "like")])
    ).isEmpty()


@pytest.mark.parametrize("s", ["play", "click", "like"])
def test_value_stats(events, table, s):
    times, gaps = by_user(distribution.time_of_day_stats(events)), by_user(distribution.watch_gap_stats(events))
    for user, rows in part(table, s).groupby("user_id"):
        for name, want in brute_stats(rows["play_time"]).items():
            assert same(times[user][f"time_{s}_{name}"], want), (user, name)
        for name, want in brute_stats(rows["play_yday"] - rows["launch_day"]).items():
            assert same(gaps[user][f"watch_gap_{s}_{name}"], want), (user, name)


def test_times_from_runs_equal_times_from_values(events):
    from footfall.operators.profiles import minute_runs

    both = by_user(sequence.sequence_stats(minute_runs(events), with_time=True))
    alone = by_user(distribution.time_of_day_stats(events))
    for user, row in alone.items():
        assert all(same(both[user][c], v, 1e-9) for c, v in row.items())


def test_differences_of_events(events, table):
    got = {r["event_id"]: r for r in sequence.slice_differences(events).collect()}
    assert len(got) == len(table)
    for s in ("play", "show", "like"):
        want = part(table, s).copy()
        want["d"] = want.groupby("user_id")["play_time"].diff()
        for event, d in zip(want["event_id"], want["d"]):
            assert same(got[event][f"diff_{s}"], d, 1e-9)
        outside = set(table["event_id"]) - set(want["event_id"])
        assert all(got[e][f"diff_{s}"] is None for e in outside)


def test_intervals(events, table):
    steps = table.copy()
    steps["d"] = steps.groupby("user_id")["play_stamp"].diff()
    got = {r["event_id"]: r for r in intervals.event_intervals(events).collect()}
    for event, d in zip(steps["event_id"], steps["d"]):
        assert same(got[event]["interval"], d)
        assert same(got[event]["interval_flag"], 1 if d and d > 0 else None)
    totals = by_user(intervals.interval_stats(events))
    for user, rows in steps.groupby("user_id"):
        d = rows["d"][rows["d"] > 0]
        want = {"sum": d.sum(), "cnt": len(d), "median": d.median(), "std": d.std(), "skew": d.skew(), "max": d.max(),
                "diff": d.max() - d.min(), "mean": d.mean(), "min": d.min()}
        for name, value in want.items():
            assert same(totals[user][f"interval_{name}"], value), (user, name)


def test_popularity(events, table):
    rows, users = table, None
    for col in items.POPULARITY_ITEMS:
        rows = rows[rows[col].notna()]
        n = rows.groupby(col)["event_id"].transform("size").groupby(rows["user_id"]).sum().rename(f"{col}_sum")
        users = n.to_frame() if users is None else users.join(n, how="inner")
    got = by_user(items.item_popularity(events))
    assert set(got) == set(users.index)
    for user, want in users.iterrows():
        assert all(got[user][c] == want[c] for c in users.columns)


def test_lookup_hot_and_cold(spark):
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40)
    rows = spark.range(1000).select(key.alias("k"), "id")
    table = spark.range(39).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = rows.join(table, "k", "left").select("k", "id", "v")
    assert [r["k"] for r in hot_keys(rows, "k", share=4).collect()] == [0]
    joined = attach(rows, table, "k", ["id"])
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    hot = table.filter("k = 0")
    joined = lookup(rows, table, ["k"], hot, ["id"]).select("k", "id", "v")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_hot_rows_are_spread(spark):
    """Without broadcasting, the rows of the hot key end up in many partitions of the shuffled join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(2000).select(F.lit(7).cast("long").alias("k"), "id")
        table = spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v"))
        joined = lookup(rows, table, ["k"], table.filter("k = 7"), ["id"])
        assert joined.filter("v = 7").count() == 2000
        assert joined.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_limit(spark):
    rows = spark.range(100).select((F.col("id") % 5).alias("k"))
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert per_key.filter(is_hot("n", rows, share=5)).count() == 0
    assert per_key.filter(is_hot("n", rows, share=6)).count() == 5


def test_partitioning_and_row_order_do_not_matter(spark, events):
    base = by_user(sequence.time_diff_stats(events))
    shuffled = events.orderBy(F.rand(3)).repartition(13)
    again = by_user(sequence.time_diff_stats(shuffled))
    assert all(same(again[u][c], v, 1e-9) for u, row in base.items() for c, v in row.items())
