"""Benchmark decontamination by greedy string tiling.

Seeds are runs of `k` words. Their rolling Karp-Rabin hashes over all documents pass a bit set of the
benchmark's hashes; what passes is joined with the benchmark's seeds, which are compared word by word
later. A document and an item go on to tiling only where the item's seeds found cover enough of it:
tiles of at least `k` words cannot cover more. Tiling marks the longest unmarked common runs first and
so counts passages in any order. Only the runs of a document that hold a seed travel. An item shorter than
`k` words is its own seed and tile: it counts where it stands in one piece.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import encoded, in_batches, packed, split_words, steps, text_key
from footfall.session import materialise

MIN_RUN = 5
COVERAGE = 0.6
MIN_BITS, MAX_BITS = 20, 24
MULTIPLIER = 0x9E3779B97F4A7C15
_NOT_WORD = re.compile(r"[\W_]+")


def normal(word: str) -> str:
    """Letters and digits of a word in lower case."""
    return _NOT_WORD.sub("", word.lower())


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Codes of all texts' normal words, each word's text, the different words, and their hashes."""
    words, counts = split_words(texts)
    codes, different = encoded(words)
    names = [normal(w) for w in different.to_pylist()]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    filled = np.array([bool(w) for w in names], bool)
    keep = filled[codes] if len(codes) else np.zeros(0, bool)
    return codes[keep], text[keep], names, hashes


def seed_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of each run of k word hashes."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(MULTIPLIER) + words[j : j + n]
    return out ^ (out >> np.uint64(29))


def tile(document: list[list[str]], item: list[str], k: int) -> int:
    """Words of the item covered by greedy string tiling with runs of at least k words.

    The search length halves from half the item down to k; runs of that length are found by Karp-Rabin
    hashes, extended, and marked from the longest on, in the item's order among equals.
    """
    free_doc = [[True] * len(run) for run in document]
    free = [True] * len(item)
    codes: dict[str, int] = {}
    item_codes = [codes.setdefault(w, len(codes) + 1) for w in item]
    doc_codes = [[codes.get(w, 0) for w in run] for run in document]

    def windows(run: list[int], unmarked: list[bool], size: int) -> Iterator[tuple[int, int]]:
        """(hash, start) of each window without a marked word, rolling by one word."""
        base, mod = 1_000_003, (1 << 61) - 1
        top, value, length = pow(base, size, mod), 0, 0
        for i, (w, ok) in enumerate(zip(run, unmarked)):
            if not ok:
                value = length = 0
                continue
            value = (value * base + w) % mod
            length += 1
            if length > size:
                value = (value - run[i - size] * top) % mod
            if length >= size:
                yield value, i - size + 1

    size = max(k, len(item) // 2)
    while True:
        longest = 0
        while True:  # at this length, until nothing that long is left
            places = defaultdict(list)
            for value, i in windows(item_codes, free, size):
                places[value].append(i)
            matches = []
            for r, run in enumerate(doc_codes):
                for value, j in windows(run, free_doc[r], size):
                    for i in places.get(value, ()):
                        if i and j and free[i - 1] and free_doc[r][j - 1] and item[i - 1] == document[r][j - 1]:
                            continue  # begins earlier
                        n = 0
                        while (
                            i + n < len(item) and j + n < len(run) and free[i + n] and free_doc[r][j + n]
                            and item[i + n] == document[r][j + n]
                        ):
                            n += 1
                        if n >= size:
                            matches.append((-n, i, r, j))
            if not matches:
                break
            for n, i, r, j in sorted(matches):
                if all(free[i : i - n]) and all(free_doc[r][j : j - n]):
                    free[i : i - n] = [False] * -n
                    free_doc[r][j : j - n] = [False] * -n
                    longest = max(longest, -n)
        if size == k:
            return free.count(False)
        size = max(k, size // 2)


def _benchmark(benchmark: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, words) of items with a word, and (item, at, seed): runs of k words, or the whole shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, text, names, hashes = tokens(batch.column("text"))
            ids, words, seeds = [], [], []
            for t in range(len(batch)):
                own = codes[text == t]
                if len(own):
                    ids.append(batch.column("item_id")[t])
                    words.append([names[c] for c in own])
                    seeds.append(seed_hashes(hashes[own], min(k, len(own))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column("item_id").type), pa.array(words, pa.list_(pa.string())), pa.array(seeds, pa.list_(pa.int64()))],
                ["item_id", "words", "seeds"],
            )

    kind = dict(benchmark.dtypes)["item_id"]
    rows = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, words array<string>, seeds array<long>")
    rows = rows.dropDuplicates(["item_id", "words"])
    rows = materialise(rows.withColumn("item", F.struct("item_id", F.xxhash64("words").alias("key"))), "benchmark")
    return rows.select("item", "item_id", "words"), rows.select("item", F.posexplode("seeds").alias("at", "seed"))


def _bit_set(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each hash value of the benchmark's seeds; its size is bounded, more seeds only let more pass."""
    n = seeds.count()
    bits = int(np.clip(np.ceil(np.log2(max(1, n) * 1024)), MIN_BITS, MAX_BITS))
    at = seeds.select(F.shiftrightunsigned("seed", 64 - bits).alias("bit"))
    words = at.groupBy(F.shiftright("bit", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("w"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in words.collect():  # at most 2**(MAX_BITS - 6) numbers
        out[r.i] = r.w
    return out.view(np.uint8), 64 - bits


def coverage(
    docs: DataFrame, benchmark: DataFrame, k: int = MIN_RUN, threshold: float = COVERAGE
) -> DataFrame:
    """(doc_id, text_key, item_id, n_words, covered): items whose tiles cover `threshold` of their words in a text.

    An item with fewer than k words counts where a text has all of it in one piece. Null and empty texts and
    items without a word have no tiles. Rows with the same id and text count once; so do items with the same
    id and words.
    """
    spark = docs.sparkSession
    items, seeds = _benchmark(benchmark, k)
    bits, shift = _bit_set(seeds)
    sent = spark.sparkContext.broadcast(bits)  # 2 MB at most
    tile_words = F.least(F.lit(k), F.size("words"))
    lengths = sorted(r.n for r in items.select(tile_words.alias("n")).distinct().collect())  # k numbers at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(sent.value, bitorder="little").view(bool)
        for batch in batches:
            for part in steps(batch):
                codes, text, names, hashes = tokens(part.column("text"))
                inside, seeds_at = np.zeros(len(codes), bool), []  # words of passing runs, and their hashes
                for n in lengths:
                    found = seed_hashes(hashes[codes], n) if len(codes) else np.zeros(0, np.uint64)
                    whole = text[: len(found)] == text[len(text) - len(found) :]
                    hit = np.nonzero(passes[found >> np.uint64(shift)] & whole)[0]
                    inside[(hit[:, None] + np.arange(n)).ravel()] = True
                    seeds_at.append((text[hit], found[hit].view(np.int64)))
                at = np.nonzero(inside)[0]
                rows = np.unique(text[at])
                runs_of = [[] for _ in rows]
                for run in np.split(at, np.nonzero((np.diff(at) > 1) | (np.diff(text[at]) > 0))[0] + 1) if len(at) else []:
                    runs_of[np.searchsorted(rows, text[run[0]])].append([names[c] for c in codes[run]])
                # A passage repeated within a text sends its seeds once.
                pairs = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *map(np.stack, seeds_at)], axis=1), axis=1)
                seeds_of = np.split(pairs[1], np.nonzero(np.diff(pairs[0]))[0] + 1) if len(rows) else []
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(take), part.column("text_key").take(take), pa.array(runs_of, pa.list_(pa.list_(pa.string()))),
                     pa.array(seeds_of, pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "runs", "seeds"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    scanned = in_batches(docs).select("doc_id", "text", text_key().alias("text_key")).mapInArrow(
        scan, f"doc_id {kind}, text_key long, runs array<array<string>>, seeds array<long>"
    )
    distinct = scanned.dropDuplicates(["doc_id", "text_key"])
    rows = materialise(distinct.withColumn("row", F.struct("doc_id", "text_key")), "seed_runs")
    hits = rows.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("row", "item").agg(
        F.collect_set("at").alias("at")  # as many as the item has words, at most
    )
    reach = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (tile_words - 1))))))
    pairs = (
        hits.join(items, "item")
        .filter(reach >= F.lit(threshold) * F.size("words"))
        .join(rows.drop("seeds"), "row")
        .select("doc_id", "text_key", "item_id", "words", "runs")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words").to_pylist()
            covered = [tile(runs, item, min(k, len(item))) for runs, item in zip(batch.column("runs").to_pylist(), words)]
            take = pa.array([i for i, (c, item) in enumerate(zip(covered, words)) if c >= threshold * len(item)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(take) for c in ("doc_id", "text_key", "item_id")],
                 pa.array([len(w) for w in words], pa.int64()).take(take), pa.array(covered, pa.int64()).take(take)],
                ["doc_id", "text_key", "item_id", "n_words", "covered"],
            )

    item_kind = dict(benchmark.dtypes)["item_id"]
    return pairs.mapInArrow(verify, f"doc_id {kind}, text_key long, item_id {item_kind}, n_words long, covered long")


def contamination(docs: DataFrame, benchmark: DataFrame, k: int = MIN_RUN, threshold: float = COVERAGE) -> DataFrame:
    """(doc_id, text_key, contaminated, n_items, best_item, best_coverage) for every row, repeated ones included.

    `best_item` is the item covered most, the smallest id among equals; without any it is null and the coverage 0.
    """
    share = F.col("covered") / F.col("n_words")
    best = F.min(F.struct((-share).alias("s"), F.col("item_id").alias("i")))
    found = coverage(docs, benchmark, k, threshold).groupBy("doc_id", "text_key").agg(
        F.countDistinct("item_id").alias("n"), best.alias("best")
    )
    rows, found = docs.select("doc_id", text_key().alias("text_key")), found.alias("f")
    same = rows["doc_id"].eqNullSafe(F.col("f.doc_id")) & (rows["text_key"] == F.col("f.text_key"))
    return rows.join(found, same, "left").select(
        rows["doc_id"],
        rows["text_key"],
        F.col("f.n").isNotNull().alias("contaminated"),
        F.coalesce("f.n", F.lit(0)).alias("n_items"),
        F.col("f.best.i").alias("best_item"),
        F.coalesce(-F.col("f.best.s"), F.lit(0.0)).alias("best_coverage"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, k: int = MIN_RUN, threshold: float = COVERAGE) -> DataFrame:
    """The documents of which no item is covered; columns and repeated rows stay."""
    found = coverage(docs, benchmark, k, threshold).select("doc_id", "text_key").distinct()
    keyed = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("id"), text_key().alias("key"))
    same = keyed["id"].eqNullSafe(found["doc_id"]) & (keyed["key"] == found["text_key"])
    return keyed.join(found, same, "left_anti").select("row.*")
