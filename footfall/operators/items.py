"""Features from how often a user meets each item: repeat interest, favourites, popularity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.joins import is_hot, lookup
from footfall.operators.profiles import item_counts
from footfall.schema import DEFAULT, SLICES, EventSpec
from footfall.session import materialise

INTEREST_ITEMS = {"creator": "video_creator", "video": "video_id", "type": "video_type"}
INTEREST_SLICES = ("play", "show", "click")
POPULARITY_ITEMS = ("video_id", "video_tag", "video_creator")


def interest_kinds() -> dict[str, Column]:
    return {kind: F.col(col) for kind, col in INTEREST_ITEMS.items()}


def popularity_kinds(compat: str = "literal") -> dict[str, Column]:
    """Items to count; literal: an event without the earlier items does not count for the later."""
    out, complete = {}, F.lit(True)
    for col in POPULARITY_ITEMS:
        complete = complete & F.col(col).isNotNull()
        out[col] = F.col(col) if compat == "intended" else F.when(complete, F.col(col))
    return out


def _n(kind: str, s: str) -> Column:
    """The user's event count of an item of this kind; NULL unless it occurs in the slice."""
    n = F.col(f"n_{s}")
    return F.when((F.col("kind") == kind) & F.col("item").isNotNull() & (n > 0), n)


def interest_columns(which=("max", "mean", "count"), slices=INTEREST_SLICES) -> list[Column]:
    """re<slice>_<item>_{max,mean,count}: most events on one item, mean events per item met,
    number of items met more than once (NULL when there is none)."""
    builders = {
        "max": F.max,
        "mean": F.avg,
        "count": lambda n: F.nullif(F.count_if(n > 1), F.lit(0)),
    }
    return [
        builders[w](_n(kind, s)).alias(f"re{s}_{kind}_{w}")
        for w in which
        for kind in INTEREST_ITEMS
        for s in slices
    ]


def repeat_interest(
    events: DataFrame, spec: EventSpec = DEFAULT, which=("max", "mean", "count"), slices=INTEREST_SLICES
) -> DataFrame:
    return repeat_interest_from(item_counts(events, interest_kinds(), spec, slices), spec, which, slices)


def repeat_interest_from(
    counts: DataFrame, spec: EventSpec = DEFAULT, which=("max", "mean", "count"), slices=INTEREST_SLICES
) -> DataFrame:
    return counts.groupBy(spec.user).agg(*interest_columns(which, slices))


def favourite_columns(slices=SLICES, compat: str = "literal", kind: str = "type") -> list[Column]:
    """fav_<slice>_type, its _count and _ratio.

    The count is that of the most frequent type. The literal name is the last type in
    alphabetical order whatever its count; `intended` names the most frequent one.
    """
    out = []
    for s in slices:
        n = _n(kind, s)
        item = F.when(n.isNotNull(), F.col("item"))
        best = F.max(item) if compat == "literal" else F.max(F.when(n.isNotNull(), F.struct(n, F.col("item"))))["item"]
        out += [
            best.alias(f"fav_{s}_type"),
            F.max(n).alias(f"fav_{s}_type_count"),
            F.try_divide(F.max(n), F.sum(n)).alias(f"fav_{s}_type_ratio"),
        ]
    return out


def favourite_type(
    events: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES, compat: str = "literal"
) -> DataFrame:
    return favourite_type_from(item_counts(events, {"type": F.col("video_type")}, spec, slices), spec, slices, compat)


def favourite_type_from(counts: DataFrame, spec: EventSpec = DEFAULT, slices=SLICES, compat: str = "literal") -> DataFrame:
    return counts.groupBy(spec.user).agg(*favourite_columns(slices, compat))


def popularity_sums(events: DataFrame, spec: EventSpec = DEFAULT, compat: str = "literal") -> DataFrame:
    """<item>_sum: over the user's events, how often each event's item occurs in the whole log.

    One scan: the events are counted per user and item, and only these counts meet the items' totals.
    """
    counts = item_counts(events, popularity_kinds(compat), spec, ("play",))
    return popularity_sums_from(materialise(counts, "item_counts"), spec, compat)


def popularity_sums_from(counts: DataFrame, spec: EventSpec = DEFAULT, compat: str = "literal") -> DataFrame:
    """The same from a written table of counts; items that very many users met are kept apart in the lookup."""
    totals = counts.filter(F.col("item").isNotNull()).groupBy("kind", "item")
    totals = totals.agg(F.sum("n_play").alias("total"), F.count(F.lit(1)).alias("_users"))
    hot = totals.filter(is_hot("_users", counts)).drop("_users")
    found = lookup(counts.select(spec.user, "kind", "item", "n_play"), totals.drop("_users"), ["kind", "item"], hot, [spec.user])
    n, first = F.col("n_play"), POPULARITY_ITEMS[0]
    sums = [F.sum(F.when(F.col("kind") == c, n * F.col("total"))).alias(f"{c}_sum") for c in POPULARITY_ITEMS]
    users = found.groupBy(spec.user).agg(*sums, F.sum(F.when(F.col("kind") == first, n)).alias("_events"))
    return users.dropna(subset=[f"{c}_sum" for c in POPULARITY_ITEMS]) if compat == "literal" else users


def popularity_ratios(all_events: Column) -> list[Column]:
    return [F.try_divide(F.col(f"{c}_sum"), all_events).alias(f"{c}_ratio") for c in POPULARITY_ITEMS]


def item_popularity(events: DataFrame, spec: EventSpec = DEFAULT, compat: str = "literal") -> DataFrame:
    """`popularity_sums` and <item>_ratio, the same per event. Literal drops users without an event
    that has all items."""
    return popularity_sums(events, spec, compat).select(
        spec.user, *[f"{c}_sum" for c in POPULARITY_ITEMS], *popularity_ratios(F.col("_events"))
    )
