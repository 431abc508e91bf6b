"""Readers for the event file and the user-level tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schema import DEFAULT, TRAIN_COLUMNS, EventSpec, event_file_schema
from footfall.session import materialise


def load_events(
    spark: SparkSession, path: str, columns: list[str] = TRAIN_COLUMNS, nrows: int | None = None, spec: EventSpec | None = None
) -> DataFrame:
    """Tab-separated event file with a header line; columns take their names by position.

    A field that is not of its column's type, or a line with too few fields, stops the job, as a flag does
    that `clean_events` cannot read. `nrows` takes the first rows of the file (of the files in the order of
    their names), and `spec` puts what was taken in (user, time) order.
    """
    events = (
        spark.read.schema(event_file_schema(columns))
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if nrows is not None:
        events = _first_rows(events, nrows)
    return events.orderBy(spec.user, spec.play_stamp) if spec else events


def _first_rows(events: DataFrame, nrows: int) -> DataFrame:
    """The first rows of files, in the order of their names, without sorting them.

    Rows are counted per split of a file, and their sums tell where the limit falls. Splits before it are taken whole; of
    the one it falls in, rows keep the order they are read in, and a top-k takes the rest. No other file is read again.
    """
    name, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    splits = events.groupBy(name.alias("file"), start.alias("start")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("file", "start")  # one row per split
    sums = splits.select("file", "start", "n", F.sum("n").over(order).alias("end"))
    last = sums.filter(F.col("end") >= nrows).orderBy("end", "file", "start").first() if nrows > 0 else None
    if last is None:
        return events if nrows > 0 else events.filter(F.lit(False))
    before = (name < last["file"]) | ((name == last["file"]) & (start < last["start"]))
    here = events.filter((name == last["file"]) & (start == last["start"]))
    some = here.orderBy(F.monotonically_increasing_id()).limit(nrows - (last["end"] - last["n"]))
    return events.filter(before).unionByName(some)


def with_event_id(events: DataFrame, name: str = "event_id") -> DataFrame:
    """The events with a number of their own, in the order of the file; written once, so that every use
    of the table sees the same numbers."""
    return materialise(events.withColumn(name, F.monotonically_increasing_id()), "events")


def first_events(events: DataFrame, nrows: int, spec: EventSpec = DEFAULT) -> DataFrame:
    """The first `nrows` events by (user, time): a top-k per task, no full sort."""
    return events.orderBy(*_order(spec)).limit(nrows)


def sort_events(events: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Events in (user, time) order, for output; no operator needs its input sorted."""
    return events.orderBy(*_order(spec))


def _order(spec: EventSpec) -> list[str]:
    return [spec.user, spec.ts, *([spec.tie] if spec.tie else [])]


def load_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Feature, label or tag table; an unnamed index column left by an earlier writer is dropped."""
    reader = spark.read.schema(schema)
    table = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return table.drop("Unnamed: 0")


def profile_events(events: DataFrame, spec: EventSpec = DEFAULT, approximate: bool = False) -> DataFrame:
    """Number of events and of users. Events are counted per user first, so one heavy user is
    one row per task."""
    if approximate:
        return events.agg(
            F.count(F.lit(1)).alias("events"), F.approx_count_distinct(spec.user).alias("users")
        )
    per_user = events.groupBy(spec.user).agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(F.sum("n").alias("events"), F.count(spec.user).alias("users"))
