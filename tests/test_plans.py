"""What the plans must and must not contain."""

import pytest

from footfall.catalog import QUERIES
from footfall.operators import actions, distribution, intervals, items, sequence, users
from footfall.plans import features
from footfall.sources import sample

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return sample.event_log(spark, SF)


def shuffles(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def test_one_shuffle_for_plain_aggregates(events):
    from footfall.plans.features import plain_aggregates

    for family in (actions.action_counts, actions.rec_type_pivot, actions.watch_ratio_stats, plain_aggregates):
        assert shuffles(family(events)) == 1, family
        assert "Window" not in plan(family(events))


def test_value_counts_come_before_users_meet(events):
    for family in (distribution.time_of_day_stats, distribution.watch_gap_stats):
        text = plan(family(events))
        assert shuffles(family(events)) == 2
        first = text.rindex("Exchange hashpartitioning")
        assert "partial_count" in text[first:]


def test_differences_need_two_shuffles(events):
    assert shuffles(sequence.time_diff_stats(events)) == 2
    assert shuffles(items.repeat_interest(events)) == 2
    assert shuffles(items.favourite_type(events)) == 2


def test_no_window_over_raw_events(events):
    """Every window reads counts: an aggregate lies between it and the scan."""
    for df in (sequence.time_diff_stats(events), sequence.slice_differences(events), intervals.interval_stats(events)):
        text = plan(df)
        assert "Aggregate" in text[text.rindex("Window") :]


ALL = sorted(set(QUERIES) - {"feature_vector", "gbt_auc", "feature_importance", "importance_refit", "pattern_refit", "retention_scores"})


@pytest.mark.parametrize("name", ALL)
def test_no_python_no_products_no_expand(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "MapInPandas", "Scan ExistingRDD"):
        if (bad, name) == ("Expand", "tag_topn_counts"):
            continue  # the long form of the finished table
        allowed = bad == "Scan ExistingRDD" and name in {"user_base", "user_base_nolabel", "label_encode", "user_features", "ratio_grid"}
        assert allowed or bad not in text, (name, bad)


def test_scan_reads_only_what_is_needed(events):
    text = plan(actions.rec_type_pivot(events))
    # `props` and `value` give the cleaned columns their types; the time is not read.
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double,props:string>" in text
    text = plan(items.favourite_type(events))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double,props:string>" in text


def test_the_log_is_scanned_three_times(spark):
    """User base, plain aggregates, shared counts: what is read later is written by the third."""
    base = users.first_per_user(sample.event_log(spark, SF), ["play_mday", "play_yday"]).join(sample.people(spark, SF), "user_id", "left")
    assert plan(base).count("events.parquet") == 1
    assert plan(features.user_features(sample.event_log(spark, SF), users=base, clicks=True)).count("events.parquet") == 1


def test_no_event_is_shuffled_for_popularity(spark):
    """With broadcasts off, only counts per user and item meet the totals."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "events.parquet" not in plan(items.popularity_sums(sample.event_log(spark, SF)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_time_filter_reaches_the_scan(spark):
    text = plan(actions.action_counts(sample.before_label(spark, SF)))
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    assert f"LessThan(ts,{sample.LABEL_FROM}" in pushed
