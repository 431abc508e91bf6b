"""Every operator as a named query over the sample tables: (spark, sf_dir) -> DataFrame.

All run over the whole tables. Floating-point columns are rounded for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import stats, timeparts
from footfall.functions.joins import attach
from footfall.functions.cleaning import clean_events as clean
from footfall.functions.timeparts import day_period, is_weekend, watch_gap, weekday, weekday_of
from footfall.ml import folds, forest, scores, trees
from footfall.ml.encode import LabelCodes, LabelMeans, label_encode
from footfall.ml.forest import NODE, Forest
from footfall.operators import actions, distribution, intervals, items, pivots, ratios, sequence, tags, users
from footfall.operators.profiles import Counts
from footfall.plans import features, retention
from footfall.schema import DEFAULT, DEMOGRAPHICS, SLICES, TRAIN_COLUMNS, EventSpec
from footfall.session import materialise, scratch_path
from footfall.sources import events as source
from footfall.sources import sample, sinks

Query = Callable[[SparkSession, str], DataFrame]
TOP_TAGS = 8
FOLDS = 5
TREES = trees.TreeSettings()


def rounded(table: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded; the nudge sends values half-way between two roundings up, whatever their
    last bit, which depends on the order of summing."""
    kinds, nudge = dict(table.dtypes), F.lit(10.0 ** -(digits + 3))
    return table.select(
        *[
            F.round(F.col(f"`{c}`") + nudge, digits).alias(c) if kinds[c] == "double" else F.col(f"`{c}`")
            for c in table.columns
        ]
    )


def _log(family: Callable[..., DataFrame], digits: int = 6, **params) -> Query:
    """Query for a family over the event log without demographics."""
    return lambda spark, sf: rounded(family(sample.event_log(spark, sf), **params), digits)


def _by_user(columns: Callable[[], list]) -> Query:
    return lambda spark, sf: rounded(sample.event_log(spark, sf).groupBy("user_id").agg(*columns()))


# Sources and sinks.


def _event_file(spark: SparkSession, sf: str, *order: str) -> str:
    """The event log written as an event file."""
    raw = sample.raw_events(spark, sf, demographics=True).withColumn("label", F.lit(0))
    raw = raw.orderBy(*order) if order else raw
    path = scratch_path(spark, "events")
    sinks.write_events(raw.withColumnRenamed("user_id", "UserId"), path, TRAIN_COLUMNS)
    return path


def load_events(spark: SparkSession, sf: str) -> DataFrame:
    return source.load_events(spark, _event_file(spark, sf))


FILE_SPEC = EventSpec(user="UserId")


def _from_file(spark: SparkSession, sf: str) -> DataFrame:
    """The event file read back and cleaned; it has no event id, so that one is given."""
    raw = source.load_events(spark, _event_file(spark, sf))
    return source.with_event_id(clean(timeparts.decode_timestamp(raw), drop=("location",)))


def file_event_intervals(spark: SparkSession, sf: str) -> DataFrame:
    log = _from_file(spark, sf)
    found = intervals.event_intervals(log, FILE_SPEC).join(log.select("event_id", "play_stamp"), "event_id")
    return found.select("UserId", "play_stamp", "interval", "interval_flag")


def file_event_tags(spark: SparkSession, sf: str) -> DataFrame:
    log = _from_file(spark, sf)
    found = tags.event_tag_counts(log, FILE_SPEC).join(log.select("event_id", "play_stamp"), "event_id")
    return found.select("UserId", "play_stamp", "tag_count")


def load_events_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of an event file that was written in order."""
    path = _event_file(spark, sf, "user_id", "play_stamp", "event_id")
    return source.load_events(spark, path, nrows=1000).select("UserId", "play_stamp", "video_id", "rec_type")


def load_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    counts = actions.slice_counts_by_user(sample.event_log(spark, sf))
    path = scratch_path(spark, "counts")
    sinks.write_table(counts.select(F.col("user_id").alias("Unnamed: 0"), "*"), path, "csv")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ["Unnamed: 0", *counts.columns]])
    return source.load_table(spark, path, schema)


def write_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    counts = actions.action_counts(sample.event_log(spark, sf))
    path = scratch_path(spark, "features")
    sinks.write_table(counts, path)
    return rounded(spark.read.parquet(path))


def user_labels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = attach(sample.event_log(spark, sf), sample.labels(spark, sf), "user_id", ["event_id"])
    return users.user_labels(labelled)


def submission_format(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.submission(fold_average(spark, sf), "user_id", "score")


# Cleaning and calendar.


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return sample.event_log(spark, sf).select(
        "user_id", "event_id", "show", "click", "comment", "like", "share", "video_length", "play_time_length"
    )


def decode_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    return log.select("user_id", "event_id", "play_mday", "play_yday", "play_time", "launch_day", "launch_date")


def _day_period(compat: str) -> Query:
    return lambda spark, sf: sample.event_log(spark, sf).select(
        "user_id", "event_id", day_period(F.col("play_time"), compat).alias("play_period")
    )


def _weekday(compat: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        log = sample.event_log(spark, sf).withColumn("play_date", F.to_date("ts"))
        first = users.first_per_user(log, ["play_mday", "play_date"])
        return users.weekday_features(first, compat)

    return query


def event_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Weekday, weekend and watch gap of every event, as published and as meant."""
    day, true_day = weekday(F.col("play_mday")), weekday_of(F.to_date("ts"))
    return sample.event_log(spark, sf).select(
        "user_id", "event_id",
        day.alias("weekday"), is_weekend(day).alias("weekend"),
        true_day.alias("true_weekday"), is_weekend(true_day).alias("true_weekend"),
        watch_gap().alias("watch_gap"), watch_gap("intended").alias("true_watch_gap"),
    )


def over_midnight(spark: SparkSession, sf: str) -> DataFrame:
    return actions.over_midnight_flag(sample.event_log(spark, sf))


# Joins.


def _clickers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All users, and the average share length of those who share."""
    log = sample.event_log(spark, sf)
    shared = log.filter(F.col("share") == 1).groupBy("user_id").agg(F.sum("video_length").alias("shared_length"))
    return log.select("user_id").distinct(), shared


def _join(how: str) -> Query:
    return lambda spark, sf: users.join_user(*_clickers(spark, sf), how=how)


def _tag_table(log: DataFrame) -> DataFrame:
    """A per-user tag table that leaves out users who never share."""
    shared = log.filter(F.col("share") == 1)
    return shared.groupBy("user_id").agg(F.sum(tags.tag_count(F.col("video_tag"))).alias("shared_tags"))


def join_labels(spark: SparkSession, sf: str) -> DataFrame:
    counts = actions.slice_counts_by_user(sample.event_log(spark, sf))
    return users.join_user(counts, sample.labels(spark, sf))


def join_tags(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    return users.join_user(actions.slice_counts_by_user(log), _tag_table(log))


def _splits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    counts = actions.slice_counts_by_user(sample.event_log(spark, sf))
    train = counts.filter(F.col("user_id") % 5 != 0).join(sample.labels(spark, sf), "user_id", "left")
    return train, counts.filter(F.col("user_id") % 5 == 0)


def union_enrich_split(spark: SparkSession, sf: str) -> DataFrame:
    both = folds.union_and_tag(*_splits(spark, sf), _tag_table(sample.event_log(spark, sf)))
    train, test = folds.split_by_flag(both)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# Single aggregates.


def _value_stat(*wanted: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        log = sample.event_log(spark, sf)
        return rounded(
            distribution.value_stats(log, F.col("play_time"), "{slice}_{stat}", slices=("play", "click"), wanted=wanted)
        )

    return query


def _length(spec_slice: str | None = None):
    return F.col("video_length"), (F.col("click") == 1 if spec_slice else None)


def _length_aggs(builders: dict[str, Callable]) -> Query:
    def columns() -> list:
        return [
            build(*_length(s)).alias(f"{name}_{s or 'all'}") for name, build in builders.items() for s in (None, "click")
        ]

    return _by_user(columns)


# Tags, pivots, ratios.


def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return tags.top_tags(sample.event_log(spark, sf), TOP_TAGS)


def tag_topn_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Long form, since the names of the tags come from the data."""
    wide = tags.fit_and_count(sample.event_log(spark, sf), TOP_TAGS)[1]
    return wide.unpivot("user_id", [c for c in wide.columns if c != "user_id"], "tag", "n")


def sparse_click_pivot(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    return pivots.sparse_click_pivot(log, pivots.category_values(log))


def sparse_click_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors over all values of the clicked events, whatever their number, one line per cell."""
    log = sample.event_log(spark, sf)
    clicked = log.filter(DEFAULT.in_slice("click"))
    codes = LabelCodes.fit(clicked, pivots.SPARSE_ITEMS).codes
    vectors = pivots.sparse_click_vectors(log, codes)
    return vectors.select("user_id", F.inline(F.arrays_zip("indices", "counts"))).withColumnRenamed("indices", "i").withColumnRenamed("counts", "n")


def slice_interval(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    both = actions.slice_durations(log).join(sequence.time_diff_stats(log), "user_id")
    return rounded(ratios.slice_intervals(both).select("user_id", *features.INTERVALS))


def _model_table(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    counts = features.feature_counts(log)
    return features.model_features(_features(spark, sf, counts), log, counts=counts)


def ratio_grid(spark: SparkSession, sf: str) -> DataFrame:
    table = _model_table(spark, sf)
    return rounded(table.select("user_id", *[c for c in table.columns if c.endswith("_ratio") and "_interval_" in c]))


def drop_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    log = sample.event_log(spark, sf)
    table = actions.slice_durations(log).join(items.favourite_type(log), "user_id")
    return rounded(ratios.drop_by_pattern(table))


def constant_column(spark: SparkSession, sf: str) -> DataFrame:
    return ratios.constant_column(items.favourite_type(sample.event_log(spark, sf)).select("user_id", "fav_play_type"))


# Users and the whole table.


def _base(spark: SparkSession, sf: str, label: bool) -> DataFrame:
    log = sample.event_log(spark, sf, demographics=True)
    base = users.user_base(log)
    return base.join(sample.labels(spark, sf), "user_id") if label else base


def _encoded_base(label: bool) -> Query:
    return lambda spark, sf: label_encode(_base(spark, sf, label), DEMOGRAPHICS)


def first_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return users.first_per_user(sample.event_log(spark, sf), ["event_id", "play_stamp", "video_id", "rec_type"])


def missing_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(actions.missing_rates(sample.raw_events(spark, sf, demographics=True)))


def label_encode_favourites(spark: SparkSession, sf: str) -> DataFrame:
    favourites = items.favourite_type(sample.event_log(spark, sf))
    cols = [f"fav_{s}_type" for s in SLICES]
    return label_encode(favourites.select("user_id", *cols), cols)


def _features(spark: SparkSession, sf: str, counts: Counts | None = None, compat: str = "literal") -> DataFrame:
    log = sample.event_log(spark, sf)
    return features.user_features(log, users=_people_base(spark, sf, log, compat), counts=counts, clicks=True, compat=compat)


def _people_base(spark: SparkSession, sf: str, log: DataFrame, compat: str = "literal") -> DataFrame:
    """The user base from a log without demographics: these join the users, not their events."""
    date = [F.to_date("ts").alias("play_date")] if compat == "intended" else []
    first = users.first_per_user(log, ["play_mday", "play_yday", *date])
    return users.join_user(first, sample.people(spark, sf).drop("location"))


def user_features(spark: SparkSession, sf: str) -> DataFrame:
    """Click vectors as text: places and counts, joined by commas."""
    vectors = [F.array_join(F.col(c).cast("array<string>"), ",") for c in trees.CLICKS]
    return rounded(_features(spark, sf).withColumns(dict(zip(trees.CLICKS, vectors))), 4)


def user_features_intended(spark: SparkSession, sf: str) -> DataFrame:
    """The table with every family as it is meant to be: the columns that differ from the literal ones."""
    table = _features(spark, sf, compat="intended")
    names = ["play_weekday", "play_isweekend", *[c for c in table.columns if c.startswith(("period_", "watch_gap_", "diff_time_", "diff2_")) or c.endswith("_sum")]]
    return rounded(table.select("user_id", *names), 4)


# Folds and scores.


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return folds.stratified_folds(sample.labels(spark, sf), k=FOLDS)


def _fold_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and fold: the click rate over the events outside the fold."""
    log = sample.event_log(spark, sf)
    outside = [
        F.struct(F.lit(f).alias("fold"), F.avg(F.when(F.col("event_id") % FOLDS != f, F.col("click"))).alias("score"))
        for f in range(FOLDS)
    ]
    return log.groupBy("user_id").agg(F.array(*outside).alias("folds")).select("user_id", F.inline("folds"))


def fold_average(spark: SparkSession, sf: str) -> DataFrame:
    return scores.fold_average(_fold_scores(spark, sf))


def _labelled_scores(spark: SparkSession, sf: str) -> DataFrame:
    return fold_average(spark, sf).join(sample.labels(spark, sf), "user_id")


def auc_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scores.auc_rank(_labelled_scores(spark, sf)), 9)


def tail_rate_sweep(spark: SparkSession, sf: str) -> DataFrame:
    latest = _by_user(lambda: [F.max(F.when(F.col("click") == 1, F.col("play_time"))).alias("time_click_max")])
    labelled = latest(spark, sf).join(sample.labels(spark, sf), "user_id", "left")
    return scores.tail_rate_sweep(labelled)


# Trees.


def _user_table(spark: SparkSession, sf: str, fitted_on: Column | None = None) -> DataFrame:
    """All features before the label date, with click vectors by the codes of the users in `fitted_on`."""
    log = sample.before_label(spark, sf)
    base = _people_base(spark, sf, log)
    counts = features.feature_counts(log)
    cells = features.click_counts(counts)
    codes = LabelCodes.of_values((cells if fitted_on is None else cells.filter(fitted_on)).select("kind", F.col("item").alias("value")))
    table = features.user_features(log, users=base, counts=counts, clicks=codes)
    table = table.join(items.favourite_type_from(counts.of("type")), "user_id").join(intervals.interval_stats(log), "user_id")
    return materialise(table, "features")


def _tree_table(spark: SparkSession, sf: str) -> DataFrame:
    """What the trees of the whole job learn from."""
    table = _user_table(spark, sf).join(_tag_table(sample.before_label(spark, sf)), "user_id", "left")
    table = label_encode(table, retention.FAVOURITES)
    table = ratios.ratio_grid(table).join(sample.labels(spark, sf), "user_id")
    return materialise(folds.stratified_folds(table, k=FOLDS), "users")


NOMINAL = (*retention.FAVOURITES, *retention.NOMINAL)


def _names(table: DataFrame) -> list[str]:
    return trees.feature_names(table, ("user_id", "label", "fold"))


def _trees(spark: SparkSession, sf: str, chosen=(0,)) -> tuple[DataFrame, trees.CrossValidation]:
    table = _tree_table(spark, sf)
    return table, trees.cross_validate(table, _names(table), TREES, NOMINAL, folds=chosen, clicks=True)


def feature_vector(spark: SparkSession, sf: str) -> DataFrame:
    table = _tree_table(spark, sf)
    columns = trees.Columns.fit(table, _names(table), NOMINAL, clicks=True)
    vectors = columns.vector(columns.prepared(table), fold="fold")
    return vectors.select("user_id", "label", trees.vector_to_array("features").alias("features"))


def gbt_auc(spark: SparkSession, sf: str) -> DataFrame:
    """The best prefix of each fold's trees, and its area under the curve."""
    result = _trees(spark, sf, chosen=range(FOLDS))[-1]
    return spark.createDataFrame(list(zip(result.folds, result.prefixes, result.aucs)), "fold int, trees int, auc double")


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return _trees(spark, sf)[-1].importance(spark)


def importance_refit(spark: SparkSession, sf: str) -> DataFrame:
    """Importance of the features kept by a first model, from a second one trained on them alone; if none is kept, of none."""
    table, first = _trees(spark, sf)
    kept = [f for f in trees.select_features(first.importance(spark), above=1) if not f.startswith("click_rest_")]
    if not kept:
        return spark.createDataFrame([], "feature string, importance double")
    table, names = trees.click_columns(table, kept)
    return trees.cross_validate(table, names, TREES, NOMINAL, folds=(0,)).importance(spark)


def pattern_refit(spark: SparkSession, sf: str) -> DataFrame:
    """Importance after leaving out the features whose name contains a word, but for some."""
    kept = ratios.drop_by_pattern(_tree_table(spark, sf), "count", keep=("show_count_all", "click_count", *trees.CLICKS))
    return trees.cross_validate(kept, _names(kept), TREES, NOMINAL, folds=(0,), clicks=True).importance(spark)


#: A saved ensemble over action counts. Inner nodes are (feature, threshold, left, right), leaves are numbers.
FOREST_FEATURES = ("show_count_all", "show_count", "click_count", "comment_count", "like_count", "share_count")
FOREST = (
    (2, 11.5, (0, 40.5, -0.25, 0.125), (4, 2.5, 0.0625, 0.375)),
    (0, 62.5, (2, 17.5, -0.125, 0.25), (1, 44.5, 0.03125, 0.1875)),
    (4, 3.5, (5, 0.5, -0.0625, 0.09375), 0.28125),
    (1, 38.5, -0.15625, (2, 21.5, 0.0, (3, 0.5, 0.0625, 0.21875))),
    (3, 0.5, (0, 55.5, -0.03125, 0.15625), 0.125),
    (2, 24.5, (1, 50.5, 0.0625, -0.09375), (5, 1.5, 0.1875, -0.125)),
    (0, 71.5, (4, 4.5, -0.03125, 0.0625), 0.03125),
    (5, 2.5, (2, 14.5, 0.015625, -0.0625), 0.09375),
)


def _saved_forest(spark: SparkSession) -> Forest:
    """The fixed ensemble, saved and loaded as the models of a job are."""
    rows: list[tuple] = []

    def add(tree: int, node) -> int:
        at = len([r for r in rows if r[0] == tree])
        rows.append((tree, at))
        if isinstance(node, float):
            rows[rows.index((tree, at))] = (tree, at, None, None, -1, -1, node)
            return at
        left = add(tree, node[2])
        right = add(tree, node[3])
        rows[rows.index((tree, at))] = (tree, at, node[0], node[1], left, right, None)
        return at

    for tree, node in enumerate(FOREST):
        add(tree, node)
    path = scratch_path(spark, "forest")
    Forest(spark.createDataFrame(rows, NODE)).save(path)
    return Forest.load(spark, path)


def _forest_values(spark: SparkSession, sf: str) -> DataFrame:
    counts = actions.action_counts(sample.event_log(spark, sf)).join(sample.labels(spark, sf), "user_id")
    return counts.select("user_id", "label", _saved_forest(spark).tree_values(FOREST_FEATURES).alias("values"))


def forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's score by the whole saved ensemble, and by its first half."""
    whole, half = forest.score("values", len(FOREST)), forest.score("values", len(FOREST) // 2)
    return rounded(_forest_values(spark, sf).select("user_id", whole.alias("score"), half.alias("half_score")))


def staged_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forest.staged_auc(_forest_values(spark, sf)), 9)


def best_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forest.best_prefix(forest.staged_auc(_forest_values(spark, sf)), patience=3), 9)


def split_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Splits of the saved ensemble by feature, with how many users' values lie on either side of them on average."""
    saved = _saved_forest(spark)
    counts = actions.action_counts(sample.event_log(spark, sf))
    cells = counts.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in FOREST_FEATURES])).alias("feature", "value"))
    cells = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("users"))
    splits = saved.nodes.filter("left >= 0").select("tree", "node", "feature", "threshold")
    below = cells.join(F.broadcast(splits), "feature").groupBy("feature").agg(
        F.sum(F.when(F.col("value") <= F.col("threshold"), F.col("users")).otherwise(0)).alias("below"), F.sum("users").alias("users")
    )
    found = saved.split_counts().join(below, "feature")
    name = F.get(F.array(*[F.lit(c) for c in FOREST_FEATURES]), F.col("feature"))
    return found.select(name.alias("feature"), F.col("splits").alias("importance"), "below", "users")


def label_means(spark: SparkSession, sf: str) -> DataFrame:
    """Favourite types as out-of-fold means of the label, for the model of fold 0 and for none."""
    favourites = items.favourite_type(sample.event_log(spark, sf)).join(sample.labels(spark, sf), "user_id")
    table = materialise(folds.stratified_folds(favourites, k=FOLDS), "favourites")
    cols = [f"fav_{s}_type" for s in SLICES]
    means = LabelMeans.fit(table, cols, k=FOLDS)
    rows = means.attach(table, cols)
    values = [means.value(c, f, "fold").alias(f"{c}_{n}") for c in cols for f, n in ((None, "all"), (0, "0"))]
    return rounded(rows.select("user_id", "fold", *values))


def retention_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way: features before the label date, tags, encoding, grid, trees, test scores."""
    in_train = F.col("user_id") % 5 != 0
    table = _user_table(spark, sf, in_train)
    _, scored = retention.train_and_score(
        table.filter(in_train), table.filter(~in_train), sample.labels(spark, sf), _tag_table(sample.before_label(spark, sf)), settings=TREES
    )
    return scored


QUERIES: dict[str, Query] = {
    # Sources and sinks
    "load_events": load_events,
    "load_events_limited": load_events_limited,
    "file_event_intervals": file_event_intervals,
    "file_event_tags": file_event_tags,
    "load_feature_table": load_feature_table,
    "profile_events": lambda spark, sf: source.profile_events(sample.event_log(spark, sf)),
    "user_labels": user_labels,
    "write_feature_table": write_feature_table,
    "submission_format": submission_format,
    "sort_events": lambda spark, sf: source.sort_events(sample.event_log(spark, sf)).select(
        "user_id", "play_stamp", "event_id", "show", "click"
    ),
    # Cleaning and calendar
    "clean_events": clean_events,
    "decode_timestamp": decode_timestamp,
    "day_period": _day_period("literal"),
    "day_period_intended": _day_period("intended"),
    "weekday_feats": _weekday("literal"),
    "weekday_feats_intended": _weekday("intended"),
    "event_calendar": event_calendar,
    "over_midnight": over_midnight,
    "drop_by_pattern": drop_by_pattern,
    "constant_column": constant_column,
    # Joins and sets
    "join_inner_user": _join("inner"),
    "join_left_user": _join("left"),
    "join_labels": join_labels,
    "join_tags": join_tags,
    "union_enrich_split": union_enrich_split,
    # Aggregates
    "slice_counts": _log(actions.slice_counts_by_user),
    "agg_count": _length_aggs({"count": stats.count_of}),
    "agg_sum": _length_aggs({"sum": stats.sum_of}),
    "agg_mean_max_min": _length_aggs({"mean": stats.mean_of, "max": stats.max_of, "min": stats.min_of}),
    "agg_var_std": _length_aggs({"var": stats.var_of, "std": stats.std_of}),
    "agg_skew": _length_aggs({"skew": stats.skew_of}),
    "agg_kurt": _length_aggs({"kurt": stats.kurt_of}),
    "agg_median": _value_stat("median"),
    "agg_mad": _value_stat("mad"),
    "agg_nunique": _value_stat("count"),
    # Sequence
    "first_per_user": first_per_user,
    "diff1_play": lambda spark, sf: rounded(
        sequence.slice_differences(sample.event_log(spark, sf), slices=("play",))
    ),
    "diff1_slices": lambda spark, sf: rounded(
        sequence.slice_differences(sample.event_log(spark, sf), slices=("show", "click", "like"))
    ),
    "diff2_max": _log(sequence.second_lag_max),
    "event_interval": _log(intervals.event_intervals),
    # Families
    "user_base": _encoded_base(label=True),
    "user_base_nolabel": _encoded_base(label=False),
    "action_counts": _log(actions.action_counts),
    "item_popularity": _log(items.item_popularity),
    "item_popularity_intended": _log(items.item_popularity, compat="intended"),
    "video_length_launch_stats": _log(actions.video_length_launch_stats),
    "time_of_day_stats": _log(distribution.time_of_day_stats),
    "tag_count": _log(tags.event_tag_counts),
    "tag_count_intended": _log(tags.event_tag_counts, compat="intended"),
    "top_tags": top_tags,
    "tag_topn_counts": tag_topn_counts,
    "rec_type_pivot": _log(actions.rec_type_pivot),
    "day_period_pivot": _log(actions.day_period_pivot),
    "day_period_pivot_intended": _log(actions.day_period_pivot, compat="intended"),
    "sparse_click_pivot": sparse_click_pivot,
    "sparse_click_vectors": sparse_click_vectors,
    "sparse_click_counts": lambda spark, sf: pivots.sparse_counts(sample.event_log(spark, sf)),
    "slice_duration": _log(actions.slice_durations),
    "watch_ratio_stats": _log(actions.watch_ratio_stats),
    "time_diff_stats": _log(sequence.time_diff_stats),
    "time_diff_stats_intended": _log(sequence.time_diff_stats, compat="intended"),
    "slice_interval": slice_interval,
    "watch_gap_stats": _log(distribution.watch_gap_stats, digits=4),
    "watch_gap_stats_intended": _log(distribution.watch_gap_stats, digits=4, compat="intended"),
    "repeat_interest_max": _log(items.repeat_interest, which=("max",)),
    "repeat_interest_mean": _log(items.repeat_interest, which=("mean",)),
    "repeat_interest_count": _log(items.repeat_interest, which=("count",)),
    "install_channel_count": _log(actions.install_channel_count),
    "interval_stats": _log(intervals.interval_stats, digits=3),
    "missing_rates": missing_rates,
    "favourite_type": _log(items.favourite_type),
    "favourite_type_argmax": _log(items.favourite_type, compat="intended"),
    "ratio_grid": ratio_grid,
    "user_features": user_features,
    "user_features_intended": user_features_intended,
    # Modelling
    "label_encode": label_encode_favourites,
    "stratified_folds": stratified_folds,
    "fold_average": lambda spark, sf: rounded(fold_average(spark, sf)),
    "prediction_mean": lambda spark, sf: rounded(scores.prediction_mean(fold_average(spark, sf))),
    "auc_rank": auc_rank,
    "tail_rate_sweep": lambda spark, sf: rounded(tail_rate_sweep(spark, sf)),
    "tail_rate_max": lambda spark, sf: rounded(scores.tail_rate_max(tail_rate_sweep(spark, sf))),
    "feature_vector": feature_vector,
    "forest_scores": forest_scores,
    "staged_auc": staged_auc,
    "best_prefix": best_prefix,
    "split_importance": split_importance,
    "label_means": label_means,
    "gbt_auc": gbt_auc,
    "feature_importance": feature_importance,
    "importance_refit": importance_refit,
    "pattern_refit": pattern_refit,
    "retention_scores": retention_scores,
}
