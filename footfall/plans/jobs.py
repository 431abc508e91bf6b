"""Jobs from files to files: event file to feature and label tables, tables to submission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.cleaning import clean_events
from footfall.functions.timeparts import decode_timestamp
from footfall.ml.encode import LabelCodes
from footfall.ml.trees import CLICKS, CrossValidation, TreeSettings
from footfall.operators.items import favourite_type
from footfall.operators.intervals import interval_stats
from footfall.operators.pivots import SPARSE_ITEMS, sparse_click_vectors
from footfall.operators.users import user_base, user_labels
from footfall.plans.features import user_features
from footfall.plans.retention import train_and_score
from footfall.schema import DEMOGRAPHICS, TEST_COLUMNS, TRAIN_COLUMNS, EventSpec
from footfall.session import configure, materialise, scratch_scope
from footfall.sources.events import load_events, with_event_id
from footfall.sources.sinks import write_submission, write_table

FILE_SPEC = EventSpec(user="UserId")


def read_event_log(spark: SparkSession, path: str, train: bool = True) -> DataFrame:
    """Event file, decoded and cleaned."""
    raw = load_events(spark, path, TRAIN_COLUMNS if train else TEST_COLUMNS)
    return clean_events(decode_timestamp(raw), drop=("location",))


def feature_job(
    spark: SparkSession,
    event_path: str,
    out: str,
    train: bool = True,
    values: dict[str, list[str]] | None = None,
    codes: LabelCodes | None = None,
    fmt: str = "parquet",
    item_codes: str | None = None,
    time_zone: str = "UTC",
) -> tuple[dict[str, list[str]] | None, LabelCodes]:
    """Write `<out>/features` and, for train data, `<out>/labels`; calendar features follow `time_zone`.

    The event file is text, so it is converted to Parquet once and read by column afterwards. Gives
    `values` and the codes fitted on this file, to be passed to the job for the test file. Click counts per
    category value are one sparse vector per user, in `<out>/sparse` and in the feature table, by the codes fitted
    on the train file (part of the codes; `item_codes` is the path of a table to use in their place). Where
    `values` names the values, they are columns.
    """
    configure(spark, time_zone)
    with scratch_scope(spark):
        events = with_event_id(read_event_log(spark, event_path, train))
        base = materialise(user_base(events, FILE_SPEC), "users")
        if codes is None:
            LabelCodes.fit(base, DEMOGRAPHICS).save(f"{out}/codes")
            codes = LabelCodes.load(spark, f"{out}/codes")
        vectors = None
        if values is None:
            if item_codes is not None:
                codes = codes.only(DEMOGRAPHICS).also(LabelCodes.load(spark, item_codes))
            elif not set(SPARSE_ITEMS) & set(codes.sizes):
                if not train:
                    raise ValueError("a test file takes the codes of the train file's category values")
                LabelCodes.fit(events.filter(FILE_SPEC.in_slice("click")), SPARSE_ITEMS).save(f"{out}/item_codes")
                codes = codes.also(LabelCodes.load(spark, f"{out}/item_codes"))
            vectors = sparse_click_vectors(events, codes.only(SPARSE_ITEMS).codes, FILE_SPEC).toDF("UserId", "indices", "counts")
            if fmt == "csv":  # has no arrays
                vectors = vectors.select("UserId", *[F.to_json(c).alias(c) for c in ("indices", "counts")])
            write_table(vectors, f"{out}/sparse", fmt)
        features = user_features(events, FILE_SPEC, values=values or {}, codes=codes.only(DEMOGRAPHICS), users=base)
        favourites = favourite_type(events, FILE_SPEC)
        wide = features.join(favourites, "UserId").join(interval_stats(events, FILE_SPEC), "UserId")
        if vectors is not None:
            wide = wide.join(vectors.toDF("UserId", *CLICKS), "UserId", "left")
        write_table(wide, f"{out}/features", fmt)
        if train:
            write_table(user_labels(events, FILE_SPEC), f"{out}/labels", fmt)
    return values, codes


def submission_job(
    spark: SparkSession,
    train_out: str,
    test_out: str,
    submission: str,
    tags: DataFrame | None = None,
    settings: TreeSettings = TreeSettings(),
) -> CrossValidation:
    """Train on `feature_job` output and write the test users' scores."""
    configure(spark)
    with scratch_scope(spark):
        train, test = spark.read.parquet(f"{train_out}/features"), spark.read.parquet(f"{test_out}/features")
        labels = spark.read.parquet(f"{train_out}/labels")
        tags = tags if tags is not None else train.select("UserId").limit(0)
        result, scores = train_and_score(train, test, labels, tags, "UserId", settings)
        write_submission(scores, submission, "UserId", "score")
    return result
