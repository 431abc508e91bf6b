"""SimHash near-duplicates by vantage-point trees.

Fingerprints differ in few bits. Cut in parts, two fingerprints within `distance` bits are within
`distance // parts` bits in one part at least, so one vantage-point tree per part, searched with that
smaller radius, finds every pair; the whole fingerprints are compared afterwards. The top of each tree
is built from a bounded sample and only decides which shard a fingerprint lives in and which shards its
ball overlaps; every fingerprint is routed. A shard's task carries the tree on downwards in memory.
A shard gives one link from each fingerprint to the first of its group, never all pairs of a group;
groups are joined over shards by star contraction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import in_batches, packed, steps, text_key
from footfall.session import materialise

SEED = 42
SHARD = 20_000
MAX_DEPTH = 16
SAMPLE_PER_SHARD = 16
BRUTE = 1 << 19
ROWS = 1 << 14


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the XXH64 of all shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), ROWS):
        bits = np.unpackbits(hashes[i : i + ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, fp) for every row; fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text").cast(pa.binary())
                fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64)
                fps = pa.array(fps.view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), fps], ["doc_id", "text_key", "fp"])

    columns = in_batches(docs).select(F.col(doc).alias("doc_id"), F.col(text).alias("text"), text_key(text).alias("text_key"))
    return columns.mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc]}, text_key long, fp long")


class TopTree:
    """The upper levels of a vantage-point tree over one part of the bits, as arrays in heap order."""

    def __init__(self, sample: np.ndarray, depth: int, mask: int, radius: int):
        self.depth, self.mask, self.radius = depth, np.uint64(mask), radius
        self.vantage = np.zeros((1 << depth) - 1, np.uint64)
        self.limit = np.zeros((1 << depth) - 1, np.int16)
        groups = [np.unique(sample & self.mask)]
        for node in range(len(self.vantage)):
            own = groups[node]
            if len(own):
                self.vantage[node] = own[node % len(own)]
                d = np.bitwise_count(own ^ self.vantage[node])
                self.limit[node] = np.sort(d)[(len(d) - 1) // 2]
            else:
                d = np.zeros(0)
            groups += [own[d <= self.limit[node]], own[d > self.limit[node]]]

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, lives there) of every fingerprint: one shard it lives in, and those its ball reaches."""
        own = fps & self.mask
        row, node, home = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(own[row] ^ self.vantage[node]).astype(np.int16)
            limit = self.limit[node]
            inner, outer = d <= limit + self.radius, d > limit - self.radius
            row, node, home = (
                np.concatenate([row[inner], row[outer]]),
                np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2]),
                np.concatenate([home[inner] & (d <= limit)[inner], home[outer] & (d > limit)[outer]]),
            )
        return row, node - ((1 << self.depth) - 1), home


class Groups:
    """Disjoint sets over 0..n-1, joined by arrays of pairs; a set is named by its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def shard_links(home: np.ndarray, visitors: np.ndarray, mask: int, radius: int, distance: int) -> np.ndarray:
    """(fingerprint, first of its group) rows for all pairs of a home and any fingerprint within `distance`.

    Walks a vantage-point tree over the home fingerprints with all fingerprints as queries. Where the
    part's bits no longer tell them apart, the whole fingerprints take over.
    """
    fps = np.concatenate([home, visitors])
    groups, whole = Groups(len(fps)), np.uint64(0xFFFFFFFFFFFFFFFF)
    stack = [(np.arange(len(home)), np.arange(len(fps)), np.uint64(mask), radius)]
    turn = 0
    while stack:
        data, query, bits, r = stack.pop()
        if not len(data) or not len(query):
            continue
        if len(data) * len(query) > BRUTE:
            turn += 1
            v = fps[data[(turn * 2654435761) % len(data)]] & bits
            d = np.bitwise_count((fps[data] & bits) ^ v).astype(np.int16)
            limit = np.sort(d)[(len(d) - 1) // 2]
            if d.max() == limit and limit > 0:
                limit -= 1
            inner = d <= limit
            if inner.any() and not inner.all():
                q = np.bitwise_count((fps[query] & bits) ^ v).astype(np.int16)
                stack += [(data[inner], query[q <= limit + r], bits, r), (data[~inner], query[q > limit - r], bits, r)]
                continue
            if bits != whole:
                stack.append((data, query, whole, distance))
                continue
        width = max(1, BRUTE // len(data))
        for i in range(0, len(query), width):
            part = query[i : i + width]
            q, d = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[data][None, :]) <= distance)
            groups.join(part[q], data[d])
    linked = np.nonzero(groups.root != np.arange(len(fps)))[0]
    return np.stack([fps[linked], fps[groups.root[linked]]]) if len(linked) else np.zeros((2, 0), np.uint64)


def links(distinct: DataFrame, n: int, distance: int = 3, parts: int = 2) -> DataFrame:
    """(a, b) fingerprints joining every group of the distinct fingerprints in `fp`."""
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, n / SHARD)))))
    sample_size = SAMPLE_PER_SHARD << depth
    share = min(1.0, 2 * sample_size / max(1, n))
    chosen = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = [r.fp for r in distinct.filter(chosen).limit(4 * sample_size).collect()]
    sample = np.array(sorted(sample), dtype=np.int64).view(np.uint64)
    step, radius = 64 // parts, distance // parts
    masks = [((1 << (step if p < parts - 1 else 64 - step * p)) - 1) << (step * p) for p in range(parts)]
    trees = [TopTree(sample, depth, mask, radius) for mask in masks]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column("fp"), dtype=np.int64)
            for p, tree in enumerate(trees):
                for i in range(0, len(fps), ROWS):
                    some = fps[i : i + ROWS]
                    row, shard, home = tree.route(some.view(np.uint64))
                    key = (shard * parts + p).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row]), pa.array(home)], ["shard", "fp", "home"])

    def search(found: pa.Table) -> pa.Table:
        fps = np.asarray(found.column("fp"), dtype=np.int64).view(np.uint64)
        home = np.asarray(found.column("home"))
        part = found.column("shard")[0].as_py() % parts
        a, b = shard_links(fps[home], fps[~home], masks[part], radius, distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = distinct.select("fp").mapInArrow(route, "shard long, fp long, home boolean")
    return routed.groupBy("shard").applyInArrow(search, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): each node's smallest reachable node, by large and small stars; (a, b) edges in longs.

    Rounds are written to the shared scratch folder; nodes without an edge have no row.
    """
    edges = materialise(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = materialise(small.filter("u != v").distinct(), name)
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state or not row[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(row)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int = 2, text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row, repeated rows included.

    `component_id` is the smallest id reachable over fingerprints within `distance` bits. A null or
    empty text has fingerprint 0 and is linked like any other; a row without an id never names a
    component unless no row of it has an id (then null). Other columns are not read.
    """
    rows = materialise(fingerprints(docs, shingle, text, doc), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints")
    n = distinct.count()
    roots = components(links(distinct, n, distance, parts))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "text_key", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each group: the one with the smallest id; rows without an id come last. Columns stay."""
    found = near_duplicates(docs, shingle, distance)
    # Where no row of a group has an id, its fingerprint's least text stands for it.
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    named = F.when(F.col("component_id").isNull(), F.col("fp"))
    first = found.groupBy("component_id", named.alias("f")).agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key")
    )
    keyed = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("id"), text_key().alias("key"))
    same = keyed["id"].eqNullSafe(first["_id"]) & (keyed["key"] == first["_key"])
    return keyed.join(first, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
