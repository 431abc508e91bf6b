"""Hand-worked answers: ties, midnight, 21:00, empty slices, missing items, single events."""

import pytest

import fixtures
from fixtures import EDGE, log, same
from footfall import catalog
from footfall.functions import stats
from footfall.functions.timeparts import day_period, watch_gap
from footfall.operators import actions, distribution, intervals, items, ratios, sequence, tags, users
from footfall.operators.profiles import minute_runs
from footfall.plans import features
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def events(spark):
    return log(spark, EDGE).cache()


def rows(df):
    return {r["user_id"]: r.asDict() for r in df.collect()}


def check(df, user, **want):
    got = rows(df)[user]
    bad = {k: (got[k], v) for k, v in want.items() if not (got[k] == v if isinstance(v, str) else same(got[k], v))}
    assert not bad


def test_action_counts(events):
    df = actions.action_counts(events)
    check(df, 1, show_count_all=5, show_count=4, click_count=3, like_count=1, show_ratio=0.8, click_ratio=3 / 5, like_ratio=1 / 4)
    check(df, 2, show_count_all=1, show_count=1, click_count=0, click_ratio=0)


def test_time_of_day(events):
    df = distribution.time_of_day_stats(events)
    check(df, 1, time_play_count=4, time_play_var=21.575, time_play_mean=13.2, time_play_median=10.5, time_play_mad=3.44,
          time_play_skew=1.675298, time_play_kurt=2.508120, time_play_max=21)
    check(df, 1, time_click_count=3, time_click_var=28.583333, time_click_mean=15.166667, time_click_median=14,
          time_click_mad=3.888889, time_click_skew=0.935220, time_click_kurt=None, time_click_max=21)
    check(df, 2, time_play_count=1, time_play_var=None, time_play_mean=0, time_play_median=0, time_play_mad=0,
          time_play_skew=None, time_play_kurt=None, time_play_max=0)
    check(df, 2, **{f"time_click_{s}": None for s in distribution.STATS})


def test_time_differences(events):
    df = sequence.time_diff_stats(events)
    check(df, 1, diff_time_play_count=4, diff_time_play_var=10.416667, diff_time_play_mean=2.75, diff_time_play_median=2,
          diff_time_play_mad=2.5, diff_time_play_skew=0.892335, diff_time_play_kurt=-0.92352, diff_time_play_max=7,
          diff2_time_play_max=10.5)
    check(df, 1, diff_time_click_count=2, diff_time_click_mean=5.25, diff2_time_click_max=10.5)
    check(df, 2, diff_time_play_count=0, diff_time_play_mean=None, diff2_time_play_max=None, diff_time_click_count=None)


def test_durations_and_intervals(events):
    both = actions.slice_durations(events).join(sequence.time_diff_stats(events), "user_id")
    df = ratios.slice_intervals(both)
    check(df, 1, play_duration=11, show_duration=11, click_duration=10.5, like_duration=0, share_duration=None, play_interval=2.75)
    check(df, 2, play_duration=0, show_duration=0, click_duration=None, play_interval=None)


def test_day_periods(events):
    df = actions.day_period_pivot(events)
    check(df, 1, **{f"period_show_{i}": n for i, n in zip(range(1, 6), (2, 0, 1, 1, 0))})
    check(df, 1, **{f"period_click_{i}": n for i, n in zip(range(1, 6), (1, 0, 1, 1, 0))})
    check(df, 2, **{f"period_{s}_{i}": None for s in ("show", "click") for i in range(1, 6)})
    check(actions.day_period_pivot(events, compat="intended"), 2, period_show_5=1, period_show_1=0)


def test_period_borders(spark):
    hours = [0.0, 0.5, 6.0, 11.0, 13.5, 18.0, 21.0, 21.5, 23.99]
    df = spark.createDataFrame([(h,) for h in hours], "h double")
    got = [r[0] for r in df.select(day_period(F.col("h"))).collect()]
    assert got == [None, 5, 1, 2, 3, 4, 4, 5, 5]


def test_repeat_interest(events):
    df = items.repeat_interest(events)
    check(df, 1, replay_type_max=3, replay_type_mean=5 / 3, replay_type_count=1)
    check(df, 1, reclick_type_max=1, reclick_type_mean=1, reclick_type_count=None)
    check(df, 2, replay_type_max=1, replay_type_mean=1, replay_type_count=None, reclick_type_max=None)


def test_favourites(events):
    check(items.favourite_type(events), 1, fav_play_type="Z", fav_play_type_count=3, fav_play_type_ratio=0.6)
    check(items.favourite_type(events, compat="intended"), 1, fav_play_type="A", fav_play_type_count=3)
    check(items.favourite_type(events), 2, fav_play_type="A", fav_play_type_count=1, fav_play_type_ratio=1.0)


def test_popularity(events):
    df = items.item_popularity(events)
    assert set(rows(df)) == {1}
    check(df, 1, video_tag_sum=3, video_tag_ratio=0.6, video_id_sum=8, video_id_ratio=1.6)
    intended = items.item_popularity(events, compat="intended")
    check(intended, 2, video_id_sum=3, video_id_ratio=3, video_tag_sum=None)


def test_tags(events):
    def counts(compat):
        return [r["tag_count"] for r in tags.event_tag_counts(events, compat=compat).orderBy("event_id").collect()]

    assert counts("literal") == [2, 1, 1, 1, 1, 1]
    assert counts("intended") == [2, 1, 0, 1, 1, 0]
    assert [(r["tag"], r["n"]) for r in tags.top_tags(events, 2).collect()] == [("t1", 3), ("nan", 2), ("t2", 2)]
    check(tags.tag_topn_counts(events, tags.fit_tags(events, 2)), 2, nan_count=1, t2_count=0)


def test_interval_stats(events):
    df = intervals.interval_stats(events)
    minute = 60_000
    check(df, 1, interval_cnt=3, interval_sum=660 * minute, interval_min=30 * minute, interval_max=420 * minute,
          interval_diff=390 * minute, interval_median=210 * minute)
    check(df, 2, interval_cnt=0, interval_sum=0, interval_mean=None, interval_max=None, interval_diff=None)


def test_moments_of_small_groups(spark):
    groups = {
        1: ([3.0], None, None, None, 3.0),
        2: ([1.0, 4.0], None, None, 4.5, 2.5),
        3: ([1.0, 2.0, 9.0], 1.630059, None, 19.0, 2.0),
        4: ([2.5] * 5, 0.0, 0.0, 0.0, 2.5),
        5: ([1.0, 2.0, 2.0, 8.0, 30.0], 1.976905, 3.920215, 150.8, 2.0),
        6: ([1.0, None, 4.0, 4.0, 10.0, 2.0], 1.483124, 2.581295, 12.2, 4.0),
        7: ([None, None], None, None, None, None),
    }
    data = [(k, v) for k, (vs, *_) in groups.items() for v in vs]
    df = spark.createDataFrame(data, "user_id long, v double")
    direct = rows(df.groupBy("user_id").agg(stats.skew_of(F.col("v")).alias("skew"), stats.kurt_of(F.col("v")).alias("kurt"),
                                            stats.var_of(F.col("v")).alias("var")))
    counted = df.groupBy("user_id", F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    by_count = rows(distribution.distribution_stats(counted, ["user_id"], {"n": "{}"}))
    for k, (_, skew, kurt, var, median) in groups.items():
        for got in (direct[k], by_count[k]):
            assert same(got["skew"], skew) and same(got["kurt"], kurt) and same(got["var"], var), k
        assert same(by_count[k]["median"], median), k


def test_gap_across_new_year(spark):
    from fixtures import stamp

    launch = stamp(0, day=1) // 1000 - 2 * 86_400
    df = log(spark, [dict(user_id=1, play_stamp=stamp(5, day=2), launch_time=launch)])
    got = df.select(watch_gap().alias("a"), watch_gap("intended").alias("b")).first()
    assert (got["a"], got["b"]) == (2 - 364, 3)


def test_join_kinds(events):
    few = events.filter("user_id = 1").select("user_id").distinct().withColumn("v", F.lit(1))
    everyone = events.select("user_id").distinct()
    assert users.join_user(everyone, few, how="inner").count() == 1
    assert users.join_user(everyone, few, how="left").count() == 2
    with pytest.raises(ValueError):
        users.join_user(everyone, few, how="outer")


def test_tags_in_one_scan(events):
    for k in (1, 2, 5):
        names = tags.fit_tags(events, k)
        found, counts = tags.fit_and_count(events, k)
        assert found == names
        wanted = tags.tag_topn_counts(events, names)
        assert counts.columns == wanted.columns and counts.exceptAll(wanted).isEmpty() and wanted.exceptAll(counts).isEmpty()


def test_a_tag_twice_in_one_event_counts_once_for_the_user(spark):
    few = fixtures.log(spark, [dict(user_id=1, play_stamp=fixtures.stamp(9), video_tag="a$a$b"), dict(user_id=2, play_stamp=fixtures.stamp(9), video_tag="c")])
    assert {tuple(r) for r in tags.user_tag_counts(few).collect()} == {(1, "a", 2, 1), (1, "b", 1, 1), (2, "c", 1, 1)}
    assert tags.fit_and_count(few, 2)[0] == ["b", "c"]


@pytest.mark.parametrize("compat", ["literal", "intended"])
def test_shared_counts_give_the_families(spark, compat):
    skewed = fixtures.log(spark, fixtures.skewed_rows(n=400))
    counts = features.feature_counts(skewed, compat=compat)
    equal = lambda a, b: a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert equal(items.repeat_interest_from(counts.of(*items.INTEREST_ITEMS)), items.repeat_interest(skewed))
    assert equal(items.popularity_sums_from(counts.of(*items.POPULARITY_ITEMS), compat=compat), items.popularity_sums(skewed, compat=compat))
    assert equal(items.favourite_type_from(counts.of("type"), compat=compat), items.favourite_type(skewed, compat=compat))
    assert equal(counts.minutes(), minute_runs(skewed))
    rounded = lambda t: catalog.rounded(t, 9)
    assert equal(rounded(distribution.watch_gap_stats_from(counts.values("gap", "int"))), rounded(distribution.watch_gap_stats(skewed, compat=compat)))
