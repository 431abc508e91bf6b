"""Mixing sources to target weights by pivotal rounding.

Every document of a source starts with the same expected number of copies; the whole part is certain.
The fractions are rounded two documents at a time: words of probability move at random from one to the
other until one is settled, so that a source's expected words never change, but for the last document.
Documents are dealt to buckets by a hash; each bucket leaves one open document per source at most, and
these meet in groups of `FAN` buckets, level by level, until one is left per source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.text import n_words, packed, text_key
from footfall.session import materialise

BUCKET_ROWS = 50_000
FAN = 64
MOST = 3
SEED = 20_240
STATE = "bucket long, source_rank long, key long, doc_id {id}, size long, copies long, p double, open boolean"


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_rank, source_size, target) from (source, size) rows, one row per source.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share all words; what would exceed
    `most` times a source's size goes to the others by weight. The windows read one row per source.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("source_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long"))
    rows = rows.withColumn("weight", (F.col("source_rank") - 1) % 3 + 1).withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # The level at which this source and all later ones would stand with all earlier ones at their caps.
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    fits = F.struct((F.col("cap") / F.col("weight")).alias("room"), "source_rank", "level")
    first = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), fits)).over(everything)
    rows = rows.withColumn("level", first["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_rank", "source_size", target.alias("target"))


def _chance(*parts: object) -> float:
    return xxhash.xxh64_intdigest(repr(parts), SEED) / 2.0**64


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round rows sorted by (bucket, source) in one pass; the last open row of each stays open."""
    group, held, turn = None, None, 0

    def release(row: dict, rows: list[dict], is_open: bool) -> None:
        if not is_open:
            row["copies"] += int(row["p"])
            row["p"] = 0.0
        rows.append(row | {"open": is_open})

    schema = None
    for batch in batches:
        schema, rows = batch.schema, []
        for row in batch.to_pylist():
            if group != (row["bucket"], row["source_rank"]):
                if held:
                    release(held, rows, True)
                group, held, turn = (row["bucket"], row["source_rank"]), None, 0
            if not 0.0 < row["p"] < 1.0 or not row["size"]:
                release(row, rows, False)
                continue
            if held is None:
                held = row
                continue
            turn += 1
            a, b = held, row
            up = min((1 - a["p"]) * a["size"], b["p"] * b["size"])
            down = min(a["p"] * a["size"], (1 - b["p"]) * b["size"])
            if _chance(a["key"], b["key"], turn) * (up + down) < down:
                a_done, b_done = up == (1 - a["p"]) * a["size"], up == b["p"] * b["size"]
                a["p"], b["p"] = (1.0 if a_done else a["p"] + up / a["size"]), (0.0 if b_done else b["p"] - up / b["size"])
            else:
                a_done, b_done = down == a["p"] * a["size"], down == (1 - b["p"]) * b["size"]
                a["p"], b["p"] = (0.0 if a_done else a["p"] - down / a["size"]), (1.0 if b_done else b["p"] + down / b["size"])
            held = None
            for x in (a, b):
                if 0.0 < x["p"] < 1.0:
                    held = x
                else:
                    release(x, rows, False)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
    if held:
        yield pa.RecordBatch.from_pylist([held | {"open": True}], schema)


def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, key, source_rank, source, size, source_size, target, copies) for every row.

    `key` hashes id, source and text. Null and blank texts have size 0 and no copies beyond the whole part.
    Rows with equal keys are rounded one by one and are interchangeable.
    """
    key = F.xxhash64("doc_id", "source", text_key())
    rows = materialise(docs.select("doc_id", "source", n_words().alias("size"), key.alias("key")), "sizes")
    n = rows.count()
    buckets = 1 << max(0, math.ceil(math.log2(max(1, n / BUCKET_ROWS))))
    targets = materialise(source_targets(rows, most), "targets")
    expected = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    whole = F.floor(expected)
    joined = rows.join(targets.alias("t"), rows["source"].eqNullSafe(F.col("t.source"))).select(
        F.pmod("key", F.lit(buckets)).alias("bucket"),
        "source_rank",
        "key",
        "doc_id",
        "size",
        whole.cast("long").alias("copies"),
        F.when(F.col("size") > 0, expected - whole).otherwise(0.0).alias("p"),
        F.lit(True).alias("open"),
    )
    schema = STATE.format(id=dict(docs.dtypes)["doc_id"])
    done, state = None, joined
    while True:
        state = _dealt(state, F.col("bucket")).mapInArrow(settle, schema)
        state = materialise(state, "mixing")
        closed = state.filter("not open")
        done = closed if done is None else done.unionByName(closed)
        state = state.filter("open")
        if buckets == 1:
            break
        buckets = -(-buckets // FAN)
        state = state.withColumn("bucket", F.floor(F.col("bucket") / FAN).cast("long"))
    chance = F.shiftrightunsigned(F.xxhash64("key", F.lit(SEED)), 11) / F.lit(2.0**53)
    last = state.withColumn("copies", F.col("copies") + (chance < F.col("p")).cast("long"))
    return (
        done.unionByName(last)
        .join(targets, "source_rank")
        .select("doc_id", "key", "source_rank", "source", "size", "source_size", "target", "copies")
    )


def _dealt(state: DataFrame, bucket: Column) -> DataFrame:
    """Rows of a bucket in one task, in an order that does not depend on how they were read.

    Large documents come first: words move between documents of like size, and what stays open is small.
    """
    return state.repartition(bucket).sortWithinPartitions("bucket", "source_rank", F.desc("size"), "key", "doc_id")


def mixed(docs: DataFrame, most: int = MOST) -> DataFrame:
    """The documents, each as often as the mix takes it; columns stay.

    Among rows that differ neither in id nor source nor text, the first in the order of the other
    columns get the odd copies.
    """
    found = mix(docs, most).groupBy("key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    joined = docs.select(packed(docs).alias("row"), F.xxhash64("doc_id", "source", text_key()).alias("key")).join(found, "key")
    sortable = [c for c, kind in docs.dtypes if c not in ("doc_id", "text", "source") and not kind.startswith(("map", "variant"))]
    order = [F.col(f"row.`{c}`") for c in sortable] or ["key"]
    place = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    joined = joined.withColumn("own", F.floor(F.col("copies") / F.col("rows")) + (place <= F.col("copies") % F.col("rows")).cast("long"))
    taken = joined.filter("own > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("own").cast("int"))).alias("copy"))
    return taken.select("row.*")
