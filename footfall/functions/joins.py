"""A lookup join that stays even when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one in HOT_SHARE of all rows, so there are fewer than
# HOT_SHARE hot keys whatever the size of the data.
HOT_SHARE = 10_000


def is_hot(weight: str, rows: DataFrame, share: int = HOT_SHARE) -> Column:
    """Whether a key's weight, a number of rows of `rows`, is more than 1/share of them all."""
    return F.col(weight) * share > rows.agg(F.count(F.lit(1)).alias("total")).scalar()


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """The hot keys of `rows`; fewer than `share` by construction."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.filter(is_hot("_n", rows, share)).select(key)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame, spread_by: list[str]) -> DataFrame:
    """Left join of `table` (one row per key) onto `rows`.

    `hot` is the part of `table` with the hot keys. Rows with such a key take their values from its
    broadcast; they and rows with a NULL key are spread in the shuffled join that serves all other
    keys. They are spread by the columns `spread_by` and by input partition, so that even copies of
    one row do not meet.
    """
    values = [c for c in table.columns if c not in keys]
    hot = hot.select(*keys, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    matchless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.col("_hot").isNotNull())
    salt = F.when(matchless, F.xxhash64(F.spark_partition_id(), *spread_by)).otherwise(F.lit(0).cast("long"))
    joined = marked.withColumn("_salt", salt).join(
        table.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], "left"
    )
    found = [F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values]
    return joined.select(*[c for c in rows.columns if c not in values], *found)


def attach(rows: DataFrame, table: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """`lookup` for a table whose hot keys are not known: they are counted in `rows`."""
    hot = table.join(F.broadcast(hot_keys(rows, key)), key, "left_semi")
    return lookup(rows, table, [key], hot, spread_by)
