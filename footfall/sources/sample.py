"""The sample tables seen as an event log: `events`, with demographics from `customer`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.cleaning import clean_events
from footfall.functions.joins import attach
from footfall.functions.timeparts import decode_timestamp
from footfall.session import configure

LABEL_FROM = "2024-01-29"

RAW = {
    "user_id": "user_id",
    "event_id": "event_id",
    "play_stamp": "unix_micros(cast(ts as timestamp)) div 1000",
    "install_channel": "concat('ch_', cast(event_id % 6 as string))",
    "video_id": "k",
    "video_type": "concat('video_type_', cast(k % 8 as string))",
    "video_tag": "case when k % 11 = 0 then null when k % 3 = 0 then concat('t', cast(k % 5 as string)) "
    "else concat('t', cast(k % 5 as string), '$t', cast(5 + k % 7 as string)) end",
    "video_creator": "nullif(k % 20, 19)",
    "launch_time": "cast(unix_date(cast(ts as date) - (k % 30)) as bigint) * 86400",
    "video_length": "10 + k * 3",
    "show": "case event_type when 'error' then '-' when 'view' then '1' when 'click' then '1' "
    "when 'purchase' then '1' else '0' end",
    "click": "case event_type when 'error' then '-' when 'click' then '1' when 'purchase' then '1' else '0' end",
    "rec_type": "concat('rec_type_', cast(1 + event_id % 3 as string))",
    "play_time_length": "case event_type when 'error' then '-' else cast(value as string) end",
    "comment": "case when event_type = 'error' then '-' when event_type = 'purchase' and k % 25 = 0 then '1' else '0' end",
    "like": "case when event_type = 'error' then '-' when event_type = 'purchase' and value >= 50 then '1' else '0' end",
    "share": "case when event_type = 'error' then '-' when event_type = 'click' and k % 10 = 0 then '1' else '0' end",
}

DEMOGRAPHICS = {
    "gender": "case c_nationkey % 3 when 0 then '-' when 1 then 'male' else 'female' end",
    "age": "case when c_acctbal < 0 then '-' when c_acctbal < 3000 then 'age_1' when c_acctbal < 6000 then 'age_2' "
    "else 'age_3' end",
    "edu": "case c_mktsegment when 'BUILDING' then '-' else c_mktsegment end",
    "location": "concat('loc_', cast(c_nationkey as string))",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, demographics: bool = False, before: str | None = None) -> DataFrame:
    """All rows of `events` with the raw columns of an event log.

    Demographics cost a join, so only operators that read them ask for it; very active users
    are spread (see `attach`). `before` keeps earlier events; the scan is pruned by it.
    """
    events = table(spark, sf_dir, "events")
    if before:
        kind = events.schema["ts"].dataType.simpleString()
        events = events.filter(F.col("ts") < F.lit(before).cast(kind))
    events = events.withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    )
    raw = events.selectExpr(*[c if e == c else f"{e} as `{c}`" for c, e in RAW.items()])
    if not demographics:
        return raw
    return attach(raw, people(spark, sf_dir), "user_id", ["event_id"])


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics by user."""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as user_id", *[f"{e} as {c}" for c, e in DEMOGRAPHICS.items()])


def event_log(spark: SparkSession, sf_dir: str, demographics: bool = False, before: str | None = None) -> DataFrame:
    """The same, decoded and cleaned: what the operators take."""
    return clean_events(decode_timestamp(raw_events(spark, sf_dir, demographics, before)), drop=("location",))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: 1 when they buy on or after LABEL_FROM."""
    events = table(spark, sf_dir, "events")
    buys = (F.col("event_type") == "purchase") & (F.col("ts") >= F.lit(LABEL_FROM).cast("timestamp"))
    return events.groupBy("user_id").agg(F.max(F.when(buys, 1).otherwise(0)).alias("label"))


def before_label(spark: SparkSession, sf_dir: str, demographics: bool = False) -> DataFrame:
    """The part of the event log features may use to predict the label."""
    return event_log(spark, sf_dir, demographics, before=LABEL_FROM)
