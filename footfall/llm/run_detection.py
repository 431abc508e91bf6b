"""Periodic runs of words, found by uniting suffixes in the order of their common prefixes.

A run is a stretch of words with smallest period q, at least `exponent` periods and `min_length` words
long, that cannot be extended. Suffixes are united by decreasing length of the common prefix (LCP), as
Kruskal's algorithm unites vertices; every class keeps its positions in order. Where two positions p < r
become neighbours in a class at an LCP of l and r - p <= l, the words from p to r + l have period r - p; it
is the smallest one, since a smaller one would have put a position of the class between them. They are a run
if the word before p does not continue the period, and every run is found so, from its first position.

A run's first pair has an LCP of its length less its period, so that unions stop at the least LCP that a
run can have (16 words for runs of 24 words and 3 periods). Texts in which no stretch of that length comes
twice need no suffixes at all: hashes of all stretches of a batch tell them apart.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.text import encoded, in_batches, packed, split_words, spread, steps

MIN_LENGTH = 24
EXPONENT = 3
CHUNK = 2_000
ODD = np.uint64(0x9E3779B97F4A7C15)
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def least_lcp(min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> int:
    """The smallest LCP that the first pair of a run can have."""
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, max(2, min_length + 1)))


class Positions:
    """Ordered positions in chunks, so that adding one stays cheap in a class of any size."""

    __slots__ = ("chunks", "firsts", "size")

    def __init__(self, first: int):
        self.chunks, self.firsts, self.size = [[first]], [first], 1

    def around(self, x: int) -> tuple[int, int]:
        """The positions before and after x, -1 where there is none."""
        c = bisect_right(self.firsts, x) - 1
        if c < 0:
            return -1, self.firsts[0]
        chunk = self.chunks[c]
        j = bisect_left(chunk, x)
        after = chunk[j] if j < len(chunk) else self.firsts[c + 1] if c + 1 < len(self.firsts) else -1
        return chunk[j - 1], after

    def add(self, x: int) -> None:
        c = max(0, bisect_right(self.firsts, x) - 1)
        chunk = self.chunks[c]
        insort(chunk, x)
        self.size += 1
        self.firsts[c] = chunk[0]
        if len(chunk) > CHUNK:
            half = len(chunk) // 2
            self.chunks[c : c + 1] = [chunk[:half], chunk[half:]]
            self.firsts[c : c + 1] = [chunk[0], chunk[half]]

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def new_neighbours(large: Positions, small: Positions) -> list[tuple[int, int]]:
    """Pairs that are neighbours in the union and come from both classes; `large` becomes the union."""
    found, own = [], list(small)
    for i, x in enumerate(own):
        before, after = large.around(x)
        if before >= 0 and (i == 0 or own[i - 1] < before):
            found.append((before, x))
        if after >= 0 and (i + 1 == len(own) or own[i + 1] > after):
            found.append((x, after))
    for x in own:
        large.add(x)
    return found


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the LCP of each with the next, from ranks by prefixes of doubled length."""
    n = len(codes)
    ranks, size = [np.unique(codes, return_inverse=True)[1].astype(np.int64)], 1
    while ranks[-1].max(initial=0) + 1 < n:
        rank, top = ranks[-1], int(ranks[-1].max()) + 2
        key = rank * top
        key[: n - size] += rank[size:] + 1
        ranks.append(np.unique(key, return_inverse=True)[1])
        size *= 2
    order = np.argsort(ranks[-1], kind="stable")
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, n - 1), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        for part in (a, b, lcp):
            part[same] += 1 << level
    return order, lcp


def periodic_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word codes, by start, then period; `exponent` is 2 at least."""
    if len(codes) < max(2, min_length):
        return []
    order, lcp = suffixes(codes)
    picked = np.nonzero(lcp >= least_lcp(min_length, exponent))[0]
    picked = picked[np.argsort(-lcp[picked], kind="stable")]
    above: dict[int, int] = {}
    classes: dict[int, Positions] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    found = []
    for a, b, common in zip(order[picked].tolist(), order[picked + 1].tolist(), lcp[picked].tolist()):
        a, b = root(a), root(b)
        large, small = classes.pop(a, None) or Positions(a), classes.pop(b, None) or Positions(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        above[b] = a
        for p, r in new_neighbours(large, small):
            period, length = r - p, r - p + common
            if period <= common and length >= max(min_length, exponent * period) and (not p or codes[p - 1] != codes[r - 1]):
                found.append((p, length, period))
        classes[a] = large
    return sorted(found, key=lambda run: (run[0], run[2]))


def with_repeats(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Texts (by number) in which some stretch of `size` words may come twice; equal hashes only add texts."""
    texts = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(codes))  # words from here to the text's end
    starts = np.nonzero(left >= size)[0]
    if not len(starts):
        return np.zeros(0, np.int64)
    hashes, width = (codes.astype(np.uint64) + np.uint64(1)) * ODD, 1
    hashes ^= hashes >> np.uint64(29)
    while 2 * width <= size:
        hashes = hashes[: len(hashes) - width] * ODD + (hashes[width:] ^ (hashes[width:] >> np.uint64(31)))
        width *= 2
    whole = hashes[starts] * ODD + hashes[starts + size - width]
    whole ^= texts[starts].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    place = np.argsort(whole)
    twice = np.nonzero(whole[place][1:] == whole[place][:-1])[0]
    return np.unique(texts[starts[place[twice]]])


def _found(texts: pa.Array, min_length: int, exponent: int) -> list[pa.Array]:
    words, counts = split_words(texts, lower=False)
    codes = encoded(words)[0]
    ends = np.cumsum(counts)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(counts))]
    kept = np.ones(len(codes), bool)
    for t in with_repeats(codes, counts, least_lcp(min_length, exponent)).tolist():
        first = int(ends[t] - counts[t])
        runs[t] = periodic_runs(codes[first : ends[t]], min_length, exponent)
        starts, lengths, periods = (np.array([r[k] for r in runs[t]], np.int64) for k in range(3))
        kept[spread(first + starts + periods, lengths - periods)] = False
    sums = np.concatenate([[0], np.cumsum(kept)])
    offsets = sums[np.concatenate([[0], ends])]
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists.cast(pa.list_(words.type)), " ")
    flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
    structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], RUN.names)
    bounds = np.concatenate([[0], np.cumsum([len(found) for found in runs])])
    return [pa.array(counts), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs), collapsed]


def runs_of(
    docs: DataFrame, keep: Column | str = "doc_id", min_length: int = MIN_LENGTH, exponent: int = EXPONENT, text: str = "text"
) -> DataFrame:
    """(kept, n_words, runs, collapsed) of every row: an expression over its columns, its words' number, its runs
    as (start, length, period) by start, then period, and its words but for those that a run repeats, joined by blanks.

    A null text has no words, no runs and an empty collapsed text; so has an empty one. Equal rows give equal
    results, an empty table an empty one, and other columns are not read. A text is worked on whole, with its
    ranks: some hundred bytes a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                found = _found(part.column("text"), min_length, exponent)
                yield pa.RecordBatch.from_arrays([part.column("kept"), *found], ["kept", "n_words", "runs", "collapsed"])

    rows = in_batches(docs).select((F.col(keep) if isinstance(keep, str) else keep).alias("kept"), F.col(text).alias("text"))
    schema = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    return rows.mapInArrow(run, T.StructType([rows.schema["kept"], *schema]))


def collapsed(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """The documents with one period left of every run; texts without runs stay as they are, and so do all columns."""
    found = runs_of(docs, packed(docs), min_length, exponent)
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("kept.text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(f"kept.`{c}`") for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """One line per document: its runs' number, the run with most periods (ties: first start, then period), and hashes."""
    more = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), more).alias("best")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.select(
        F.col("kept").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best,
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words",
    )
