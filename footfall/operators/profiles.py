"""First-level counts that shrink the event log before anything meets by user.

Each table here is an ordinary hash aggregate: combined on the map side, then shuffled on
(user, something), so the events of one very active user spread over many tasks. What later
meets by user alone has a size that does not grow with the number of events: at most one row
per minute, per day gap or per item a user has seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.timeparts import time_of_day
from footfall.schema import DEFAULT, SLICES, EventSpec
from footfall.session import scratch_path


def slice_counts(spec: EventSpec, slices=SLICES) -> list[Column]:
    return [F.count_if(spec.in_slice(s)).alias(f"n_{s}") for s in slices]


def value_counts(events: DataFrame, value: Column, spec: EventSpec = DEFAULT, slices=SLICES) -> DataFrame:
    """(user, x, n_<slice>...): events per value of `value` and slice."""
    return events.groupBy(spec.user, value.alias("x")).agg(*slice_counts(spec, slices))


def minute_runs(events: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES, firsts: bool = False) -> DataFrame:
    """(user, minute, x, n_<slice>...): events per minute, with the minute's time of day as x.

    With `firsts`, also `first_<slice>`: the id of the slice's first event in the minute.
    """
    aggs = slice_counts(spec, slices)
    if firsts:
        aggs += [
            F.min(F.when(spec.in_slice(s), spec.order_key())).getField(spec.tie).alias(f"first_{s}")
            for s in slices
        ]
    minute = F.date_trunc("minute", F.col(spec.ts)).alias("minute")
    return events.groupBy(spec.user, minute).agg(*aggs).withColumn("x", time_of_day(F.col("minute")))


def item_pairs(items: dict[str, Column]) -> Column:
    """One (kind, item) row per kind; the item may be NULL."""
    return F.inline(
        F.array(*[F.struct(F.lit(kind).alias("kind"), col.cast("string").alias("item")) for kind, col in items.items()])
    )


def item_counts(
    events: DataFrame, items: dict[str, Column], spec: EventSpec = DEFAULT, slices=SLICES
) -> DataFrame:
    """(user, kind, item, n_<slice>...) for all item kinds in one scan and one shuffle.

    Events without an item are counted under NULL, so every user has rows.
    """
    flags = [s for s in slices if s != "play"]
    return (
        events.select(spec.user, *flags, item_pairs(items))
        .groupBy(spec.user, "kind", "item")
        .agg(*slice_counts(spec, slices))
    )


MINUTE = "minute"


def minute_item(spec: EventSpec = DEFAULT) -> Column:
    """The minute of an event as an item."""
    return F.unix_seconds(F.date_trunc("minute", F.col(spec.ts)))


class Counts:
    """(user, kind, item, n_<slice>...) of all kinds that several families need, counted once and written by kind.

    Families say which kinds they read (`interest_kinds` and the like); the log is scanned once for all of them.
    """

    def __init__(self, events: DataFrame, kinds: dict[str, Column], spec: EventSpec = DEFAULT, slices=SLICES):
        self.spec, self.slices, self.kinds = spec, slices, tuple(kinds)
        path = scratch_path(events.sparkSession, "counts")
        item_counts(events, kinds, spec, slices).write.partitionBy("kind").parquet(path)
        cells = [f"n_{s} long" for s in slices]
        kind = events.schema[spec.user].dataType.simpleString()
        reader = events.sparkSession.read.schema(", ".join([f"`{spec.user}` {kind}", "item string", *cells, "kind string"]))
        self.table = reader.parquet(path)

    def of(self, *kinds: str) -> DataFrame:
        """The rows of some kinds; the others are not read."""
        return self.table.filter(F.col("kind").isin(*kinds))

    def values(self, kind: str, type_: str) -> DataFrame:
        """(user, x, n_<slice>...) as `value_counts` gives them."""
        return self.of(kind).select(self.spec.user, F.col("item").cast(type_).alias("x"), *[f"n_{s}" for s in self.slices])

    def minutes(self) -> DataFrame:
        """(user, minute, x, n_<slice>...) as `minute_runs` gives them."""
        minute = F.timestamp_seconds(F.col("item").cast("long")).alias("minute")
        runs = self.of(MINUTE).select(self.spec.user, minute, *[f"n_{s}" for s in self.slices])
        return runs.withColumn("x", time_of_day(F.col("minute")))
