"""N-gram Jaccard join of documents by rare-first prefix filtering, down to classes of linked documents.

A document is the set of hashes of its shingles. Equal sets are one set from the start. Shingles are ordered
by rarity, from counts in a fixed number of hash buckets, then by hash; any order gives the same links. Two
sets that are similar enough share a shingle of their prefixes, so that only sets of one posting can be linked.

* Length filter: sizes within the threshold of each other. Positional filter: what may still be shared
  before and after the common shingle. Suffix filter: the shingles are dealt to buckets, a sketch keeps the
  parity of each, and sets differ in no fewer shingles than sketches in bits.
* Many shingles have one and the same posting: it is kept once.
* Verification reads whole sets, once per pair. To spare most pairs of large groups it comes in two rounds.
  First each posting gives the pairs of a spanning tree over what passes the filters, nearest first. Then, with
  the components these links make, it gives every pair that passes the filters, was not verified and has its sides in
  different components. A pair inside a component can't change the classes, all others are verified.
* Postings of over GROUP sets are cut by a hash in parts, and in the second round all pairs of parts meet, each
  in a group of its own. No task holds more than two parts. Sets whose pairs all lie in two parts are in no tree; they
  are read for the second round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.simhash_dedup import Groups, components
from footfall.llm.text import drop_finished_shuffles, encoded, in_batches, split_words, spread, steps, text_key
from footfall.session import materialise

SHINGLE = 4
PERCENT = 85
BUCKET_BITS = 18
FILTER_BITS = 23
BLOCK = 1 << 15  # bytes of a part of the two tables that are reduced over all tasks
CLASSES = 63
GROUP = 1_024
LONG_POSTING = 1 << 16
WORDS = (4, 64)  # least and most 64-bit words of a sketch
STEP = 1 << 20
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def mixed(x: np.ndarray, k: int = 0) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1 + k]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of all texts in a row, ascending in each, and their numbers."""
    words, counts = split_words(texts)
    codes, different = encoded(words)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in different.cast(pa.binary()).to_pylist()), np.uint64, len(different))
    hashes = hashes[codes]
    firsts = np.cumsum(counts) - counts
    sizes = np.where(counts >= size, counts - (size - 1), (counts > 0).astype(np.int64))
    found, text = np.zeros(int(sizes.sum()), np.uint64), np.repeat(np.arange(len(counts)), sizes)
    at = spread(firsts, sizes)
    for k in range(1, size + 1):  # texts of fewer words are one shingle of all of them
        mine = counts[text] == k if k < size else counts[text] >= size
        value = np.full(int(mine.sum()), k, np.uint64)
        for j in range(k):
            value = value * MIX[0] + hashes[at[mine] + j]
        found[mine] = mixed(value)
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.bincount(text[new], minlength=len(counts))


def digests(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """128 bits that tell sets apart, as two signed longs; 0 and 0 for an empty set."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    found = []
    for k in range(2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + MIX[3], k), dtype=np.uint64)])
        found.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
    return found


def sketch(hashes: np.ndarray) -> bytes:
    """Parity of the set's shingles in as many buckets as it has shingles, about."""
    words = WORDS[0]
    while words < WORDS[1] and words * 64 < len(hashes):
        words *= 2
    own = np.bincount((hashes & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(own.astype(np.uint8), bitorder="little").tobytes()


def _tables(docs: DataFrame, made: Callable[[pa.RecordBatch | None, dict], Iterator[pa.RecordBatch]], columns: list, schema: str) -> DataFrame:
    """What `made` gives for every step of the texts, and, for None, at the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for part in steps(batch):
                yield from made(part, state)
        yield from made(None, state)

    return in_batches(docs).select(*columns).mapInArrow(run, schema)


def _reduced(blocks: DataFrame, join: Callable) -> np.ndarray:
    """Blocks (block, bytes) of 64-bit numbers joined over all rows, in the order of the blocks; a few MB in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("bytes")):
                own = np.frombuffer(data.as_buffer(), np.int64)
                held[block] = join(held[block], own) if block in held else own.copy()
        for block, own in sorted(held.items()):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own.tobytes()])], ["block", "bytes"])

    schema = "block int, bytes binary"
    rows = blocks.mapInArrow(run, schema).repartition("block").mapInArrow(run, schema).collect()
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r.bytes, np.int64) for r in sorted(rows, key=lambda r: r.block))])


def _blocks(numbers: np.ndarray) -> tuple[list[int], list[bytes]]:
    data = numbers.tobytes()
    return list(range(len(data) // BLOCK)), [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def profiles(docs: DataFrame, size: int = SHINGLE, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, n, d0, d1, sketch) of every row; in rows with a `block`, how many shingles each hash bucket got."""
    kind = docs.schema[doc].dataType
    names = ["doc_id", "text_key", "n", "d0", "d1", "sketch", "block", "bytes"]

    def made(part: pa.RecordBatch | None, state: dict) -> Iterator[pa.RecordBatch]:
        if part is None:
            block, data = _blocks(state.get("counts", np.zeros(0, np.int64)))
            if block:
                rows = pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(data)], names[6:])
                empty = [pa.nulls(len(block), state["types"][c]) for c in names[:6]]
                yield pa.RecordBatch.from_arrays([*empty, *rows.columns], names)
            return
        hashes, counts = shingle_sets(part.column("text"), size)
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        state["counts"] = state.get("counts", 0) + np.bincount(bucket, minlength=1 << BUCKET_BITS)
        ends = np.cumsum(counts)
        sketches = pa.array([sketch(hashes[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())], pa.binary())
        own = [part.column("doc_id"), part.column("text_key"), pa.array(counts), *map(pa.array, digests(hashes, counts)), sketches]
        state["types"] = {c: a.type for c, a in zip(names, own)}
        yield pa.RecordBatch.from_arrays([*own, pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())], names)

    columns = [F.col(doc).alias("doc_id"), F.col(text).alias("text"), text_key(text).alias("text_key")]
    return _tables(docs, made, columns, f"doc_id {kind.simpleString()}, text_key long, n long, d0 long, d1 long, sketch binary, block int, bytes binary")


def rarity(counts: np.ndarray) -> np.ndarray:
    """A class of frequency for each bucket, the rarest first; finest about the usual count."""
    if not counts.any():
        return np.zeros(1 << BUCKET_BITS, np.uint64)
    usual = max(1.0, float(np.median(counts)))
    return np.clip(8 + 8 * np.log2(np.maximum(counts, 1) / usual), 0, CLASSES).astype(np.uint64)


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles of which a similar set must share one; 0 where only an equal set is similar."""
    return np.where(n * 100 // percent == n, 0, n - (n * percent + 99) // 100 + 1)


def postings(docs: DataFrame, classes: np.ndarray, size: int = SHINGLE, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """(token, d0, d1, n, at): the rarest shingles of each set with their place from 1, once for each set and task."""
    sent = docs.sparkSession.sparkContext.broadcast(classes)

    def made(part: pa.RecordBatch | None, state: dict) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        hashes, counts = shingle_sets(part.column("text"), size)
        d0, d1 = digests(hashes, counts)
        ends = np.cumsum(counts)
        tokens = (sent.value[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] << np.uint64(58)) | (hashes >> np.uint64(6))
        seen, first = state.setdefault("seen", set()), np.zeros(len(counts), bool)
        for i, key in enumerate(zip(d0.tolist(), d1.tolist())):
            if key not in seen:
                seen.add(key)
                first[i] = True
        wanted = np.where(first, prefix_size(counts, percent), 0)
        for a, b in zip((ends - counts)[wanted > 0].tolist(), ends[wanted > 0].tolist()):
            tokens[a:b].sort()
        starts = ends - counts
        own = tokens[spread(starts, wanted)].view(np.int64)
        at = spread(np.ones(len(counts), np.int64), wanted)
        row = [np.repeat(x, wanted) for x in (d0, d1, counts.astype(np.int32))]
        for i in range(0, len(own), STEP):
            cut = slice(i, i + STEP)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[cut]), *[pa.array(x[cut]) for x in row], pa.array(at[cut].astype(np.int32))], ["token", "d0", "d1", "n", "at"]
            )

    return _tables(docs, made, [F.col(text).alias("text")], "token long, d0 long, d1 long, n int, at int")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[dict[str, np.ndarray | pa.Array]]:
    """Rows in pieces of whole groups of the keys, which lie together."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
        both = pa.concat_batches(held)
        if last:
            return both, None
        change = np.zeros(len(both) - 1, bool)
        for k in keys:
            own = np.asarray(both.column(k))
            change |= own[1:] != own[:-1]
        where = np.nonzero(change)[0]
        end = int(where[-1]) + 1 if len(where) else 0
        return both.slice(0, end), both.slice(end)

    size, most = 0, rows
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch)
        if size >= most:
            ready, rest = cut(False)
            held, size = ([rest] if len(rest) else []), len(rest)
            most = max(rows, 2 * size)
            if len(ready):
                yield ready
    if held:
        yield cut(True)[0]


def _bounds(part: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where groups begin, and the end."""
    change = np.ones(len(part), bool)
    if len(part) > 1:
        change[1:] = np.logical_or.reduce([np.asarray(part.column(k))[1:] != np.asarray(part.column(k))[:-1] for k in keys])
    return np.append(np.nonzero(change)[0], len(part))


def shared_postings(found: DataFrame) -> DataFrame:
    """(k0, k1, d0, d1, n, at): each posting of several sets once, named by a hash of what it holds.

    A posting of over LONG_POSTING sets is streamed and named by its shingle.
    """
    names = ["k0", "k1", "token", "d0", "d1", "n", "at"]

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        last = None
        for batch in batches:
            own = [np.asarray(batch.column(c)) for c in names[2:]]
            same = np.zeros(len(batch), bool)
            same[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in own[:3]])
            if len(batch):
                same[0] = last == tuple(x[0] for x in own[:3])
                last = tuple(x[-1] for x in own[:3])
                yield tuple(x[~same] for x in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held, size, long = [], 0, None  # rows whose posting may go on, and the long posting they belong to

        def out(k0: np.ndarray, k1: np.ndarray, rows: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (k0, k1, *rows)], names)

        def ready(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Whole postings."""
            starts = np.nonzero(np.append(True, rows[0][1:] != rows[0][:-1]))[0]
            sizes = np.diff(np.append(starts, len(rows[0])))
            keys = []
            for k in range(2):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(rows[1].view(np.uint64) * MIX[3] + rows[2].view(np.uint64), k), dtype=np.uint64)])
                keys.append((sums[starts + sizes] - sums[starts]).view(np.int64))
            several = sizes > 1
            for i in np.nonzero(several)[0].tolist():
                key = (int(keys[0][i]), int(keys[1][i]))
                several[i] = key not in seen
                seen.add(key)
            keep = np.repeat(several, sizes)
            if keep.any():
                yield out(*[np.repeat(k, sizes)[keep] for k in keys], [x[keep] for x in rows])

        for rows in distinct(batches):
            held.append(rows)
            size += len(rows[0])
            if size < LONG_POSTING:
                continue
            whole = [np.concatenate(x) for x in zip(*held)]
            change = np.nonzero(whole[0][1:] != whole[0][:-1])[0]
            if long is not None:
                end = int(np.searchsorted(whole[0] != long, True)) if (whole[0] != long).any() else len(whole[0])
                if end:
                    named = whole[0][:end]
                    yield out(named, np.zeros_like(named), [x[:end] for x in whole])
                whole = [x[end:] for x in whole]
                long = long if not len(whole[0]) else None
                change = np.nonzero(whole[0][1:] != whole[0][:-1])[0]
            end = int(change[-1]) + 1 if len(change) else 0
            if end:
                yield from ready([x[:end] for x in whole])
                whole = [x[end:] for x in whole]
            if len(whole[0]) >= LONG_POSTING:
                long = int(whole[0][0])
                yield out(whole[0], np.zeros_like(whole[0]), whole)
                whole = [x[:0] for x in whole]
            held, size = [tuple(whole)], len(whole[0])
        whole = [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0, np.int64)]
        if len(whole[0]) and long is not None:
            mine = whole[0] == long
            if mine.any():
                yield out(whole[0][mine], np.zeros_like(whole[0][mine]), [x[mine] for x in whole])
            whole = [x[~mine] for x in whole]
        if len(whole[0]):
            yield from ready(whole)

    dealt = found.repartition("token").sortWithinPartitions("token", "d0", "d1")
    each = dealt.mapInArrow(run, "k0 long, k1 long, token long, d0 long, d1 long, n int, at int")
    one = each.groupBy("k0", "k1", "d0", "d1").agg(F.min(F.struct("token", "at", "n")).alias("p"))
    return one.select("k0", "k1", "d0", "d1", "p.n", "p.at")


def wanted_sets(docs: DataFrame, members: DataFrame, size: int = SHINGLE, text: str = "text") -> DataFrame:
    """(d0, d1, uid, tokens) of the sets in `members` (uid, d0, d1), each once.

    A bit filter of FILTER_BITS bits, whatever their number, spares most other sets the way to the join.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            bit = np.asarray(batch.column("d0")).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            np.bitwise_or.at(bits, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        block, data = _blocks(bits)
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(data)], ["block", "bytes"])

    bits = _reduced(members.select("d0").mapInArrow(marked, "block int, bytes binary"), np.bitwise_or)
    sent = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def made(part: pa.RecordBatch | None, state: dict) -> Iterator[pa.RecordBatch]:
        if part is None or not len(sent.value):
            return
        hashes, counts = shingle_sets(part.column("text"), size)
        d0, d1 = digests(hashes, counts)
        bit = d0.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        hit = (sent.value[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        ends, seen, rows = np.cumsum(counts), state.setdefault("seen", set()), []
        for i in np.nonzero(hit)[0].tolist():
            key = (int(d0[i]), int(d1[i]))
            if counts[i] and key not in seen:
                seen.add(key)
                rows.append(i)
        own = [hashes[ends[i] - counts[i] : ends[i]] for i in rows]
        bounds = np.concatenate([[0], np.cumsum(counts[rows])]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.uint64), *own]).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(d0[rows]), pa.array(d1[rows]), tokens], ["d0", "d1", "tokens"]
        )

    found = _tables(docs, made, [F.col(text).alias("text")], "d0 long, d1 long, tokens array<long>")
    return found.join(members, ["d0", "d1"]).dropDuplicates(["d0", "d1"])


def plausible(n: np.ndarray, at: np.ndarray, sketches: list[bytes], percent: int = PERCENT) -> Iterator[tuple[np.ndarray, ...]]:
    """(i, j, differing bits) of all pairs i < j that pass the three filters, in pieces; n ascends."""
    words = np.array([len(s) // 8 for s in sketches])
    tables = {int(w): np.frombuffer(b"".join(s for s in sketches if len(s) == 8 * w), np.uint64).reshape(-1, w) for w in np.unique(words)}
    first = {w: int(np.searchsorted(words, w)) for w in tables}
    for w, own in tables.items():
        others = [(first[w], own)]
        if 2 * w in tables:  # sizes beyond the next class of sketches are too far apart
            others.append((first[2 * w], tables[2 * w][:, :w] ^ tables[2 * w][:, w:]))
        for start, other in others:
            i = 0
            while i < len(own):
                low = first[w] + i
                high = int(np.searchsorted(n, n[low] * 100 // percent, side="right"))
                width = max(1, min(len(own) - i, STEP // max(1, w * max(1, high - low))))
                end = int(np.searchsorted(n, n[low + width - 1] * 100 // percent, side="right"))
                a = np.arange(low, low + width)
                b = np.arange(max(start, low), min(start + len(other), end))
                i += width
                if not len(b):
                    continue
                bits = np.bitwise_count(own[a - first[w]][:, None, :] ^ other[b - start][None, :, :]).sum(axis=2, dtype=np.int64)
                both = n[a][:, None] + n[b][None, :]
                share = (both * percent + percent + 99) // (percent + 100)
                place = np.minimum(at[a][:, None], at[b][None, :]) + np.minimum((n - at)[a][:, None], (n - at)[b][None, :])
                good = (b[None, :] > a[:, None]) & (bits <= both - 2 * share) & (place >= share) & (n[a][:, None] * 100 >= n[b][None, :] * percent)
                x, y = np.nonzero(good)
                yield a[x], b[y], bits[x, y]


def nearest_tree(size: int, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Numbers of the edges of a least spanning forest; of equally long ones the first by i and j."""
    order = np.lexsort((j, i, far))
    i, j, groups, kept = i[order], j[order], Groups(size), []
    left = np.arange(len(order))
    while True:
        a, b = groups.root[i[left]], groups.root[j[left]]
        open_ = a != b
        left, a, b = left[open_], a[open_], b[open_]
        if not len(left):
            return order[np.unique(np.concatenate([np.zeros(0, np.int64), *kept]))]
        best = np.full(size, len(order))
        np.minimum.at(best, a, left)
        np.minimum.at(best, b, left)
        chosen = np.unique(best[best < len(order)])
        kept.append(chosen)
        groups.join(i[chosen], j[chosen])


def _all_plausible(part: dict, percent: int) -> list[np.ndarray]:
    found = list(plausible(part["n"], part["at"], part["sketch"], percent))
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def _pairs(rows: DataFrame, keys: list[str], chosen: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(a, b) of the pairs that `chosen` finds in each group, each once, a < b."""
    columns = [c for c in rows.columns if c not in ("k0", "k1")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for piece in _whole_groups(batches, keys):
            bounds = _bounds(piece, keys)
            flat = {c: piece.column(c).to_pylist() if c == "sketch" else np.asarray(piece.column(c)).astype(np.int64) for c in columns}
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if e - s < 2:
                    continue
                part = {c: flat[c][s:e] for c in columns}
                i, j = chosen(part)
                a, b = part["uid"][i], part["uid"][j]
                new = [p for p in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()) if p not in seen]
                if len(seen) < STEP:
                    seen.update(new)
                for k in range(0, len(new), STEP):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*new[k : k + STEP])], ["a", "b"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "n", "uid")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sets have the wanted similarity."""
    side = lambda c: sets.select(F.col("uid").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long")
    union = F.size("a_tokens") + F.size("b_tokens") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b")


def _parts(sets: Column) -> Column:
    """In how many parts a posting is cut."""
    return F.ceil(F.coalesce(sets, F.lit(1)) / GROUP).cast("int")


def _tree_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Spanning trees of each part; an eighth of a long posting's sets is in the next part as well, to tie them."""
    own = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    tie = (F.col("parts") > 1) & (F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(8)) == 0)
    places = F.when(tie, F.array(own, F.pmod(own + 1, F.col("parts")))).otherwise(F.array(own))
    rows = posts.select("k0", "k1", F.explode(places).alias("i"), "uid", "n", "at", "sketch")

    def chosen(part: dict) -> tuple[np.ndarray, np.ndarray]:
        i, j, far = _all_plausible(part, percent)
        edges = nearest_tree(len(part["n"]), i, j, far)
        return i[edges], j[edges]

    return _pairs(rows, ["k0", "k1", "i"], chosen)


def _open_pairs(posts: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of a posting that pass the filters and are in different components."""
    rows = posts.join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    several = rows.groupBy("k0", "k1").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("k0", "k1")
    rows = rows.join(several, ["k0", "k1"], "left_semi")
    own = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int").alias("own")
    rows = rows.select("k0", "k1", "uid", "n", "at", "sketch", "root", own, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    rows = rows.withColumn("i", F.least("own", "o")).withColumn("j", F.greatest("own", "o")).drop("o")

    def chosen(part: dict) -> tuple[np.ndarray, np.ndarray]:
        if (part["root"] == part["root"][0]).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        apart = part["i"][0] != part["j"][0]
        found = [(np.zeros(0, np.int64),) * 2]
        for i, j, _ in plausible(part["n"], part["at"], part["sketch"], percent):
            good = part["root"][i] != part["root"][j]
            if apart:
                good &= part["own"][i] != part["own"][j]
            found.append((i[good], j[good]))
        return tuple(np.concatenate(x) for x in zip(*found))

    return _pairs(rows, ["k0", "k1", "i", "j"], chosen)


def linked(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row, repeated rows included.

    Documents are linked when 100 * shared >= percent * all of their shingles; `component_id` is the smallest id that links
    reach. Null and empty texts have no shingles and are linked with nothing; texts of fewer words than a shingle are one
    shingle. Rows of one id with different texts are different documents; a row without an id never names a component
    unless no row of it has one (then null). Sets are compared by 64-bit hashes of their shingles. Other columns
    are not read, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    profile = materialise(profiles(docs, size, text, doc), "profiles")
    rows = profile.filter(F.col("block").isNull()).select("doc_id", "text_key", "n", "d0", "d1", "sketch")
    each = rows.filter("n > 0").groupBy("d0", "d1").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = rarity(_reduced(profile.filter(F.col("block").isNotNull()).select("block", "bytes"), np.add))

    groups = materialise(shared_postings(postings(docs, classes, size, percent, text)), "shared_postings")
    drop_finished_shuffles(spark)
    members = each.join(groups.select("d0", "d1").distinct(), ["d0", "d1"]).select(F.monotonically_increasing_id().alias("uid"), "d0", "d1", "n", "sketch")
    members = materialise(members, "members")
    long = groups.groupBy("k0", "k1").count().filter(F.col("count") > GROUP)
    posts = groups.drop("n").join(members, ["d0", "d1"]).join(long, ["k0", "k1"], "left")
    posts = materialise(posts.select("k0", "k1", "uid", "n", "at", "sketch", _parts(F.col("count")).alias("parts")), "sketched_postings")
    tried = materialise(_tree_pairs(posts, percent), "tree_pairs")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    paired = materialise(ends(tried).join(members.select("uid", "d0", "d1"), "uid"), "paired")
    sets = materialise(wanted_sets(docs, paired, size, text), "sets")
    drop_finished_shuffles(spark)

    first = materialise(verified(tried, sets, percent), "tree_links")
    drop_finished_shuffles(spark)
    roots = components(first, "first_components")
    # A set with any pair that passes the filters is in a tree, but for postings in parts: there the pair may lie in two.
    near = posts.filter("parts = 1").join(paired.select("uid"), "uid").unionByName(posts.filter("parts > 1"))
    rest = materialise(_open_pairs(near, roots, percent).join(tried, ["a", "b"], "left_anti"), "open_pairs")
    late = ends(rest).join(paired, "uid", "left_anti").join(members.select("uid", "d0", "d1"), "uid")
    late = materialise(late, "paired_late")
    if not late.isEmpty():
        sets = sets.unionByName(materialise(wanted_sets(docs, late, size, text), "sets_late"))
    second = materialise(verified(rest, sets, percent), "open_links")
    drop_finished_shuffles(spark)
    roots = components(first.unionByName(second), "components")

    named = each.join(members.select("d0", "d1", "uid"), ["d0", "d1"], "left").join(roots, F.col("uid") == F.col("node"), "left")
    alone = F.lit(-1) - F.col("d0").bitwiseAND(F.lit((1 << 63) - 1))  # below 0, and not one key for all
    named = named.select("d0", "d1", "first_id", F.coalesce("root", "uid", alone).alias("root"))
    least = named.filter("root >= 0").groupBy("root").agg(F.min("first_id").alias("least_id"))
    by_set = named.join(least, "root", "left").select("d0", "d1", F.coalesce("least_id", "first_id").alias("component_id"))
    found = rows.join(by_set, ["d0", "d1"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "text_key", F.col("n").alias("n_shingles"), own.alias("component_id"))
