"""Brown's class-based bigrams: words in classes by exchange clustering, texts scored by class transitions.

Texts are coded once: a chunk is a row with its different words, their counts, and the words of its texts
as codes. Word counts are exact over all training texts. Clustering begins with the head: a word of at least
1 in `CORE_SHARE` training tokens (so at most that many) is an item, and all other words share `TAILS`
items by a hash of their last letters. Item bigrams count every training bigram; the table has at most
(CORE_SHARE + TAILS + 1)**2 rows, packed in blocks, and each exchange round scores all moves of the
round's items in parallel. Then every other word of at least `OWN_COUNT` training tokens, whatever their
share, goes from its shared item to the class that its own counts by the class before and after fit best.
Rarer and unseen words keep the class of the shared item. Class bigrams are counted with the final classes. Scores
use P(class | class before) * P(word | class), both smoothed, where each class keeps one share for unseen words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import drop_finished_shuffles, encoded, gathered, give_back, in_batches, split_words
from footfall.session import materialise, scratch_path, scratch_scope

CLASSES = 64
CORE_SHARE = 4096
TAILS = 512
TAIL_LETTERS = 3
OWN_COUNT = 3
PARTS = 4
BLOCKS = 32
SMOOTH_CLASS = 0.5
SMOOTH_WORD = 0.5
CHUNK_BYTES = 16 << 20
PIECE_WORDS = 1 << 18  # words of a chunk that one step works on
END = 0  # the item and the class of the end of a text
#: How chunk rows are written. A page or a group of rows ends when it is full, not after a hundred rows of some megabytes;
#: this compression needs no memory outside the heap for whole pages, two for each open file.
LARGE_ROWS = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


def code(docs: DataFrame, held_out: Column) -> DataFrame:
    """Chunk rows: words and their training counts; ids, marks, lengths and codes of the chunk's texts, compressed."""

    def chunk(part: pa.RecordBatch, n: int) -> pa.RecordBatch:
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        words, counts = split_words(part.column("text"))
        codes, different = encoded(words)
        del words
        held = np.asarray(part.column("held_out"))
        n_train = np.bincount(codes[np.repeat(~held, counts)], minlength=len(different)).astype(np.int64)
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([(TaskContext.get().partitionId() << 32) + n], pa.int64()),
                "words": one(different.cast(pa.string())),
                "n_train": one(pa.array(n_train)),
                "doc_ids": one(part.column("doc_id")),
                "held": one(part.column("held_out")),
                "lengths": one(pa.array(counts)),
                "codes": pa.array([pa.compress(codes.astype("<i4"), "zstd", asbytes=True)], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, part in enumerate(gathered(batches, limit=CHUNK_BYTES)):
            yield chunk(part, n)

    kind = dict(docs.dtypes)["doc_id"]
    rows = in_batches(docs).select("doc_id", "text", held_out.alias("held_out"))
    return rows.mapInArrow(
        run,
        f"chunk long, words array<string>, n_train array<long>, doc_ids array<{kind}>, held array<boolean>, lengths array<long>, codes binary",
    )


def tail_item() -> Column:
    """The shared item of the words in `word` that are not frequent."""
    return (F.pmod(F.xxhash64(F.expr(f"right(word, {TAIL_LETTERS})")), F.lit(TAILS)) + 1).cast("int")


def tail_of(word: str) -> int:
    return xxhash.xxh64_intdigest(word[-TAIL_LETTERS:].encode(), 42) % TAILS + 1


def with_ends(values: np.ndarray, lengths: np.ndarray, end) -> np.ndarray:
    """Each text's values with an end before the first text and after every text."""
    stops = np.cumsum(lengths)
    return np.concatenate([np.array([end], values.dtype), np.insert(values, stops, end)])


def pieces(lengths: np.ndarray, most: int) -> Iterator[tuple[slice, slice]]:
    """Texts of a chunk and their words, in runs of up to `most` words or one text that has more."""
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, stop), slice(before, int(ends[stop - 1]))
        start = stop


def texts_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and marks of a chunk's texts, true for training, and codes of their words."""
    lengths = np.asarray(batch.column("lengths")[i].values, dtype=np.int64)
    train = ~np.array(batch.column("held")[i].as_py(), bool)
    codes = pa.decompress(batch.column("codes")[i].as_buffer(), int(lengths.sum()) * 4, "zstd")
    return lengths, train, np.frombuffer(codes, "<i4")


def items_of(words: pa.Array, core: dict[str, int]) -> np.ndarray:
    parts = (words.slice(first, SLICE_WORDS).to_pylist() for first in range(0, len(words), SLICE_WORDS))
    return np.concatenate([np.zeros(0, np.int32), *(np.array([core.get(w) or tail_of(w) for w in part], np.int32) for part in parts)])


def item_pairs(coded: DataFrame, core: dict[str, int], n_items: int) -> DataFrame:
    """(a, b, n): how often item b follows item a in training texts, an end before and after each text."""
    sent = coded.sparkSession.sparkContext.broadcast(core)  # at most CORE_SHARE words
    kind = np.int32 if n_items**2 < 1 << 31 else np.int64

    def of_chunk(items: np.ndarray, lengths: np.ndarray, train: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        path = with_ends(items.astype(kind)[codes[np.repeat(train, lengths)]], lengths[train], END)
        return np.unique(path[:-1] * n_items + path[1:], return_counts=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for i in range(len(batch)):
                pairs, n = of_chunk(items_of(batch.column("words")[i].values, known), *texts_of(batch, i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pairs // n_items).astype(np.int32)), pa.array((pairs % n_items).astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["a", "b", "n"],
                )
            give_back()

    found = coded.select("words", "held", "lengths", "codes").mapInArrow(run, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def contexts(pairs: DataFrame) -> DataFrame:
    """One row per block of items: (item, other, n, after): `other` follows or precedes the item n times."""
    sides = pairs.select(F.col("a").alias("item"), F.col("b").alias("other"), "n", F.lit(True).alias("after")).unionByName(
        pairs.select(F.col("b").alias("item"), F.col("a").alias("other"), "n", F.lit(False).alias("after"))
    )

    def pack(rows: pa.Table) -> pa.Table:
        get = lambda c, t: np.ascontiguousarray(np.asarray(rows.column(c)).astype(t)).tobytes()
        return pa.table(
            {
                "block": pa.array([rows.column("block")[0].as_py()], pa.int32()),
                **{c: pa.array([get(c, t)], pa.binary()) for c, t in (("item", "<i4"), ("other", "<i4"), ("n", "<i8"), ("after", "?"))},
            }
        )

    blocked = sides.withColumn("block", (F.col("item") % BLOCKS).cast("int"))
    return blocked.groupBy("block").applyInArrow(pack, "block int, item binary, other binary, n binary, after binary")


def _block(row: dict, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items of a block; their counts by the class after and the class before; how often each follows itself."""
    item, other = np.frombuffer(row["item"], "<i4"), np.frombuffer(row["other"], "<i4")
    n, after = np.frombuffer(row["n"], "<i8").astype(float), np.frombuffer(row["after"], "?")
    items, at = np.unique(item, return_inverse=True)
    cell, size = at * n_classes + classes[other], len(items) * n_classes
    right = np.bincount(cell[after], n[after], size).reshape(-1, n_classes)
    left = np.bincount(cell[~after], n[~after], size).reshape(-1, n_classes)
    own = after & (item == other)
    return items, right, left, np.bincount(at[own], n[own], len(items))


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(g: int, right: np.ndarray, left: np.ndarray, own: float, table: np.ndarray) -> np.ndarray:
    """Change of the class bigrams' log-likelihood if an item of class g moves to each class.

    The likelihood is the sum of n log n over the class pairs, less the sums over rows and columns.
    """
    k = len(table)
    base = table.copy()  # without the item
    base[g, :] -= right
    base[:, g] -= left
    base[g, g] += own
    rows, cols = base.sum(1), base.sum(0)
    # The item's own pairs stand in `right` and `left` at its old class; they go where it goes.
    r, c = right.copy(), left.copy()
    r[g] -= own
    c[g] -= own
    diagonal = np.arange(k)
    met, meets = np.flatnonzero(r), np.flatnonzero(c)  # a rare item meets few classes
    gain_rows = (_h(base[:, met] + r[None, met]) - _h(base[:, met])).sum(1)
    gain_cols = (_h(base[meets] + c[meets, None]) - _h(base[meets])).sum(0)
    # The corner cell takes both parts and the own pairs at once.
    corner = base[diagonal, diagonal]
    gain = gain_rows + gain_cols - (_h(corner + r) - _h(corner)) - (_h(corner + c) - _h(corner)) + _h(corner + r + c + own) - _h(corner)
    # Classes before keep their pairs with the item in their rows, and classes after in their columns,
    # wherever it goes; only the class it goes to gains the item's own tokens.
    rows, cols = rows + c, cols + r
    gain -= _h(rows + r.sum() + own) - _h(rows) + _h(cols + c.sum() + own) - _h(cols)
    return gain - gain[g]


def class_table(packed: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Class bigrams; a block sends one small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items, right, _, _ = _block(row, classes, n_classes)
                out = np.zeros((n_classes, n_classes))
                np.add.at(out, classes[items], right)
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["m"])

    total = np.zeros((n_classes, n_classes))
    for row in packed.mapInArrow(run, "m binary").collect():
        total += np.frombuffer(row.m).reshape(n_classes, n_classes)
    return total


def likelihood(table: np.ndarray) -> float:
    return float(_h(table).sum() - _h(table.sum(1)).sum() - _h(table.sum(0)).sum())


def moved(table: np.ndarray, g: int, h: int, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """Class bigrams after an item goes from class g to h; `right` and `left` are without its own pairs."""
    table = table.copy()
    table[g, :] -= right
    table[:, g] -= left
    table[h, :] += right
    table[:, h] += left
    table[g, g] -= own
    table[h, h] += own
    return table


def least_gain(table: np.ndarray) -> float:
    """Less than this is rounding."""
    return max(1e-9, 1e-12 * float(_h(table).sum()))


def exchange(packed: DataFrame, order: np.ndarray, n_classes: int = CLASSES, rounds: int | None = None) -> np.ndarray:
    """Class of every item. Items start in classes in turn, by frequency; class 0 is the end's alone.

    A round looks at one in `PARTS` items: the blocks send those that would gain by a move, and their pairs
    with items of the same part. Moves are made one by one, each with the counts that the moves before it
    left, so that each raises the likelihood. Ends when no item of any part gains by a move, or after `rounds`.
    """
    classes = np.zeros(len(order), np.int64)
    rest = order[order != END]
    classes[rest] = np.arange(len(rest)) % (n_classes - 1) + 1
    table = class_table(packed, classes, n_classes)
    least, turn, still = least_gain(table), 0, 0
    while still < PARTS and (rounds is None or turn < rounds):
        current, counts = classes.copy(), table
        in_part = (np.arange(len(order)) // BLOCKS + turn) % PARTS == 0
        in_part[END] = False

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    items, right, left, own = _block(row, current, n_classes)  # noqa: B023
                    item, other = np.frombuffer(row["item"], "<i4"), np.frombuffer(row["other"], "<i4")
                    n, after = np.frombuffer(row["n"], "<i8"), np.frombuffer(row["after"], "?")
                    near = in_part[item] & in_part[other] & (item != other)  # noqa: B023
                    for i in np.flatnonzero(in_part[items]):  # noqa: B023
                        gain = gains(int(current[items[i]]), right[i], left[i], own[i], counts)  # noqa: B023
                        gain[END] = -np.inf
                        if gain.max() <= least:
                            continue
                        at = np.flatnonzero(near & (item == items[i]))
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item": pa.array([int(items[i])], pa.int32()),
                                "gain": pa.array([float(gain.max())]),
                                "own": pa.array([float(own[i])]),
                                **{c: pa.array([x.tobytes()], pa.binary()) for c, x in (("right", right[i]), ("left", left[i]))},
                                **{c: pa.array([x[at].tobytes()], pa.binary()) for c, x in (("other", other), ("n", n), ("after", after))},
                            }
                        )

        kinds = "item int, gain double, own double, right binary, left binary, other binary, n binary, after binary"
        found = sorted(packed.mapInArrow(run, kinds).collect(), key=lambda m: (-m.gain, m.item))  # a part's items at most
        at = {m.item: i for i, m in enumerate(found)}
        sides = []
        for m in found:  # what follows and what precedes the item, without itself
            right, left = np.frombuffer(m.right).copy(), np.frombuffer(m.left).copy()
            right[classes[m.item]] -= m.own
            left[classes[m.item]] -= m.own
            sides.append((right, left))
        any_moved, again = False, bool(found)
        while again:
            again = False
            for m, (right, left) in zip(found, sides):
                g, own = int(classes[m.item]), np.zeros(n_classes)
                own[g] = m.own
                gain = gains(g, right + own, left + own, m.own, table)
                gain[END] = -np.inf
                h = int(gain.argmax())
                if gain[h] <= least:
                    continue
                table, classes[m.item], any_moved, again = moved(table, g, h, right, left, m.own), h, True, True
                for other, n, after in zip(np.frombuffer(m.other, "<i4").tolist(), np.frombuffer(m.n, "<i8").tolist(), np.frombuffer(m.after, "?")):
                    if other in at:  # the item precedes what comes after it
                        side = sides[at[other]][1 if after else 0]
                        side[g] -= n
                        side[h] += n
        turn, still = turn + 1, 0 if any_moved else still + 1
    return classes


#: Counts of one cell; larger ones take several.
CELL = np.dtype([("cell", "<u2"), ("n", "u1")])
PLACE = np.dtype([("at", "<i4"), ("c", "<i8"), ("class", "<i2")])
SLICE_WORDS, HELD_PLACES, JOINED_ROWS = 1 << 16, 1 << 19, 1 << 10


def word_contexts(coded: DataFrame, core: dict[str, int], classes: np.ndarray, n_classes: int) -> DataFrame:
    """(word, chunk, at, n, cells) of each chunk's words: place in its dictionary, training count, contexts.

    Cells count the class after (0 ...), the class before (n_classes ...) and the word itself after (2 * n_classes);
    words of the core have none, as their classes are known.
    """
    sent = coded.sparkSession.sparkContext.broadcast(core)  # at most CORE_SHARE words
    width = 2 * n_classes + 1

    def of_chunk(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
        words, chunk, n_train = batch.column("words")[i].values, batch.column("chunk")[i].as_py(), batch.column("n_train")[i].values
        items = np.append(items_of(words, sent.value), np.int32(END))
        lengths, train, codes = texts_of(batch, i)
        path = with_ends(codes[np.repeat(train, lengths)], lengths[train], len(items) - 1)
        shared, word_class = (items != END) & (items <= TAILS), classes[items].astype(np.int32)
        x, y, first = path[:-1], path[1:], 0
        tokens = np.cumsum(np.where(shared[:-1], np.asarray(n_train), 0))  # of the words that have contexts
        while first < len(words):
            most = int(np.searchsorted(tokens, (tokens[first - 1] if first else 0) + PIECE_WORDS, side="right"))
            stop = min(max(first + 1, most), first + SLICE_WORDS, len(words))
            inside = shared.copy()
            inside[:first], inside[stop:] = False, False
            after, before = inside[x], inside[y]
            own, other = x[after] - first, y[before] - first
            twice = own[own + first == y[after]]
            keys = np.concatenate(
                [own * width + word_class[y[after]], other * width + n_classes + word_class[x[before]], twice * width + 2 * n_classes]
            )
            keys, n = np.unique(keys, return_counts=True)
            times = (n + 254) // 255
            cells = np.empty(int(times.sum()), CELL)
            cells["cell"], cells["n"] = np.repeat(keys % width, times), 255
            cells["n"][np.cumsum(times) - 1] = n - 255 * (times - 1)
            ends = np.searchsorted(np.repeat(keys // width, times), np.arange(stop - first + 1))
            offsets = (ends * CELL.itemsize).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    words.slice(first, stop - first),
                    pa.array(np.full(stop - first, chunk, np.int64)),
                    pa.array(np.arange(first, stop, dtype=np.int32)),
                    n_train.slice(first, stop - first),
                    pa.BinaryArray.from_buffers(pa.binary(), stop - first, [None, pa.py_buffer(offsets), pa.py_buffer(cells.tobytes())]),
                ],
                ["word", "chunk", "at", "n", "cells"],
            )
            first = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield from of_chunk(batch, i)
            give_back()

    rows = coded.select("chunk", "words", "n_train", "held", "lengths", "codes")
    return rows.mapInArrow(run, "word string, chunk long, at int, n long, cells binary")


def cells_of(found: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all rows, and the number of each row's."""
    offsets = np.frombuffer(found.buffers()[1], "<i4")[found.offset : found.offset + len(found) + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(found.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(CELL) if size else np.zeros(0, CELL)
    return data, np.diff(offsets) // CELL.itemsize


def placed(found: DataFrame, core: dict[str, int], classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """Counts and classes of all words, sent back to the chunks in one pass over the rows of each word.

    Rows with a `chunk` hold `PLACE` records of that chunk, any number of rows a chunk; rows without one hold the
    training words (word, c, item, class). A word of at least `OWN_COUNT` tokens that is not of the core has the
    class that its contexts fit best; rarer and unseen words have their item's class.
    """
    sent = found.sparkSession.sparkContext.broadcast(core)  # at most CORE_SHARE words
    k, least, least_count = len(table), least_gain(table), OWN_COUNT
    width = 2 * k + 1

    def best(g: int, cells: np.ndarray) -> int:
        gain = gains(g, cells[:k], cells[k : 2 * k], cells[2 * k], table)
        gain[END] = -np.inf
        return int(gain.argmax()) if gain.max() > least else g

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        places, chunks, rows, held = [], [], [], 0

        def settled(words: list[str], c: np.ndarray, cells: np.ndarray) -> np.ndarray:
            items = np.array([known.get(w) or tail_of(w) for w in words], np.int64)
            out = classes[items]
            for i in np.flatnonzero((c >= least_count) & (items <= TAILS)):
                out[i] = best(int(out[i]), cells[i])
            rows.extend(r for r in zip(words, c.tolist(), items.tolist(), out.tolist()) if r[1])
            return out

        def keep(chunk: np.ndarray, at: np.ndarray, c: np.ndarray | int, word_class: np.ndarray | int) -> int:
            own = np.empty(len(chunk), PLACE)
            own["at"], own["c"], own["class"] = at, c, word_class
            places.append(own)
            chunks.append(chunk)
            return len(chunk)

        def sent_back() -> pa.RecordBatch:
            chunk, place = np.concatenate([np.zeros(0, np.int64), *chunks]), np.concatenate([np.zeros(0, PLACE), *places])
            order = np.argsort(chunk, kind="stable")
            chunk, place = chunk[order], place[order]
            own, starts = np.unique(chunk, return_index=True)
            parts = [p.tobytes() for p in np.split(place, starts[1:])] if len(own) else []
            lists = [[list(x) for x in zip(*rows)] if rows else [[], [], [], []]]
            none = [None] * len(own)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([*own.tolist(), None], pa.int64()),
                    pa.array([*parts, None], pa.binary()),
                    *(pa.array([*none, x], pa.list_(t)) for x, t in zip(lists[0], (pa.string(), pa.int64(), pa.int32(), pa.int32()))),
                ],
                ["chunk", "places", "word", "c", "item", "class"],
            )
            places.clear(), chunks.clear(), rows.clear()
            return out

        word, c_last, cells_last, open_rows = None, 0, None, []  # the word whose rows may go on
        for batch in joined(batches):
            words, n = batch.column("word"), len(batch)
            starts = np.append(0, np.flatnonzero(np.asarray(pc.not_equal(words.slice(1), words.slice(0, n - 1)))) + 1)
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            chunk, at = np.asarray(batch.column("chunk")), np.asarray(batch.column("at"))
            c = np.add.reduceat(np.asarray(batch.column("n")), starts)
            data, sizes = cells_of(batch.column("cells"))
            cells = np.bincount(np.repeat(group, sizes) * width + data["cell"], data["n"], len(starts) * width).reshape(-1, width)
            different, end = words.take(pa.array(starts)).to_pylist(), starts[-1]
            if word == different[0]:
                c[0] += c_last
                cells[0] += cells_last
            elif word is not None:
                own = settled([word], np.array([c_last]), cells_last[None])
                held += sum(keep(*r, c_last, own[0]) for r in open_rows)
                open_rows = []
            if end:
                own = settled(different[:-1], c[:-1], cells[:-1])
                held += sum(keep(*r, c[0], own[0]) for r in open_rows)
                held += keep(chunk[:end], at[:end], c[group[:end]], own[group[:end]])
                open_rows = []
            word, c_last, cells_last = different[-1], int(c[-1]), cells[-1].copy()
            open_rows.append((chunk[end:].copy(), at[end:].copy()))
            if held >= HELD_PLACES:
                yield sent_back()
                held = 0
        if word is not None:
            own = settled([word], np.array([c_last]), cells_last[None])
            for r in open_rows:
                keep(*r, c_last, own[0])
        yield sent_back()
        give_back()

    kinds = "chunk long, places binary, word array<string>, c array<long>, item array<int>, class array<int>"
    # A chunk gives a word one row.
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(run, kinds)


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that aren't empty, small ones joined."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] if len(batch) else []
        if sum(map(len, held)) >= JOINED_ROWS:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def looked_up(coded: DataFrame, back: DataFrame) -> DataFrame:
    """Chunk rows with `entries`: the records of their words, in parts."""
    own = back.filter("chunk is not null").groupBy("chunk").agg(F.collect_list("places").alias("entries"))  # one chunk's dictionary
    rows = coded.select("chunk", "doc_ids", "held", "lengths", "codes").join(own, "chunk", "left")
    return rows.select("entries", "doc_ids", "held", "lengths", "codes")


def entries_of(found: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Training counts and classes of a chunk's words."""
    place = np.concatenate([np.zeros(0, PLACE), *(np.frombuffer(p, PLACE) for p in found.as_py() or [])])
    c, word_class = np.zeros(len(place)), np.zeros(len(place), np.int64)
    c[place["at"]], word_class[place["at"]] = place["c"], place["class"]
    return c, word_class


def class_bigrams(chunks: DataFrame, n_classes: int) -> np.ndarray:
    """Class bigrams of training texts, by the final class of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes * n_classes, np.int64)
        for batch in batches:
            for i in range(len(batch)):
                _, word_class = entries_of(batch.column("entries")[i])
                lengths, train, codes = texts_of(batch, i)
                for texts, own in pieces(lengths, PIECE_WORDS):
                    n, marks = lengths[texts], train[texts]
                    path = with_ends(word_class[codes[own][np.repeat(marks, n)]], n[marks], END)
                    total += np.bincount(path[:-1] * n_classes + path[1:], minlength=len(total))
        give_back()
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total[cells])], ["cell", "n"])

    out = np.zeros(n_classes * n_classes)
    for r in chunks.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(n_classes, n_classes)


@dataclass
class Model:
    """Class bigrams of all training texts, classes of the items, a (word, c, item, class) table, and the chunks
    with the counts and classes of their words."""

    transitions: np.ndarray
    classes: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_tokens: int
    n_words: int
    n_ends: int
    words: DataFrame
    chunks: DataFrame


def fit(coded: DataFrame, n_classes: int = CLASSES, rounds: int | None = None) -> Model:
    spark = coded.sparkSession
    size = coded.agg(
        F.coalesce(F.sum(F.expr("aggregate(zip_with(held, lengths, (h, n) -> if(h, 0L, n)), 0L, (a, n) -> a + n)")), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.expr("size(filter(held, h -> not h))")), F.lit(0)).alias("ends"),
    ).first()
    ends, n_tokens = size.ends, size.n + size.ends
    entries = coded.select(F.explode(F.arrays_zip("words", "n_train")).alias("e")).select("e.words", "e.n_train").filter("n_train > 0")
    counts = entries.groupBy(F.col("words").alias("word")).agg(F.sum("n_train").alias("c"))
    frequent = counts.filter(F.col("c") * CORE_SHARE >= n_tokens).collect()  # at most CORE_SHARE by construction
    frequent = sorted(frequent, key=lambda r: (-r.c, r.word))
    core = {r.word: TAILS + 1 + i for i, r in enumerate(frequent)}
    n_items = 1 + TAILS + len(core)
    pairs = materialise(item_pairs(coded, core, n_items), "item_pairs")
    packed = materialise(contexts(pairs), "item_contexts")
    order = np.concatenate([[END], np.arange(TAILS + 1, n_items), np.arange(1, TAILS + 1)])
    classes = exchange(packed, order, n_classes, rounds)
    drop_finished_shuffles(spark)
    contexts_of = word_contexts(coded, core, classes, n_classes)
    back = materialise(placed(contexts_of, core, classes, class_table(packed, classes, n_classes)), "word_places", LARGE_ROWS)
    drop_finished_shuffles(spark)
    training = F.explode(F.arrays_zip("word", "c", "item", "class")).alias("w")
    words = back.filter("chunk is null").select(training).select("w.*")
    by_class = words.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, different = np.zeros(n_classes), np.zeros(n_classes)
    tokens[END], different[END] = ends, float(ends > 0)
    for r in by_class:
        tokens[r["class"]], different[r["class"]] = r.n, r.v
    chunks = materialise(looked_up(coded, back), "word_classes", LARGE_ROWS)
    drop_finished_shuffles(spark)
    transitions, n_words = class_bigrams(chunks, n_classes), int(different.sum())
    return Model(transitions, classes, tokens, different, n_tokens, n_words, ends, words, chunks)


def score(model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text of the model's chunks.

    Scores are log10 probabilities; a null or empty text is its end alone.
    """
    k = len(model.transitions)
    steps_ = np.log10((model.transitions + SMOOTH_CLASS) / (model.transitions.sum(1, keepdims=True) + SMOOTH_CLASS * k))
    room = np.log10(np.maximum(model.class_tokens + SMOOTH_WORD * (model.class_words + 1), 1e-300))
    base_room = np.log10(model.n_tokens + model.n_words + 1)
    ends, n_tokens = model.n_ends, model.n_tokens

    def of_chunk(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
        c, word_class = entries_of(batch.column("entries")[i])
        all_lengths, _, all_codes = texts_of(batch, i)
        doc_ids, held = batch.column("doc_ids")[i].values, batch.column("held")[i].values
        c, emitted = np.append(c, ends), np.append(np.log10(c + SMOOTH_WORD) - room[word_class], np.log10(ends + SMOOTH_WORD) - room[END])
        word_class = np.append(word_class, END)
        for texts, own in pieces(all_lengths, PIECE_WORDS):
            lengths = all_lengths[texts]
            path = with_ends(all_codes[own], lengths, len(c) - 1)
            path_class = word_class[path]
            token = path[1:]
            stops = np.cumsum(lengths + 1)
            starts = stops - lengths - 1
            total = lambda x: np.add.reduceat(x, starts)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids[texts],
                    held[texts],
                    pa.array(lengths + 1),
                    pa.array(total((c[token] > 0).astype(np.int64)).astype(np.int64)),
                    pa.array(np.full(len(lengths), n_tokens, np.int64)),
                    pa.array(total(np.log10(c[token] + 1) - base_room)),
                    pa.array(total(steps_[path_class[:-1], path_class[1:]] + emitted[token])),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield from of_chunk(batch, i)
            give_back()

    kind = dict(model.chunks.dtypes)["doc_ids"].removeprefix("array<")[:-1]
    return model.chunks.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def score_documents(docs: DataFrame, held_out: Column, n_classes: int = CLASSES, rounds: int | None = None) -> DataFrame:
    """Learn from the rows that are not held out, and score all rows; tables made on the way are deleted.

    One result row per row of `docs`, so repeated rows have equal ones and count as often in training. Columns
    other than `doc_id` and `text` are not read; null and empty texts are their end alone; an empty table has an
    empty result. A text of any length is one row of a chunk. Words that tie in a gain take the class of least number.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "class_scores")
    with scratch_scope(spark):
        coded = materialise(code(docs, held_out), "coded_texts", LARGE_ROWS)
        score(fit(coded, n_classes, rounds)).write.parquet(path)
    return spark.read.parquet(path)


def held_out(doc: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """One in `folds` rows by the checksum of the id; rows without an id are learnt from."""
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % folds == fold, F.lit(False))
