"""Token ids in range-coded files, in the order of document ids.

A file set is a Parquet folder whose rows are segments, a frequency table with the frames that share it (see
`rans`): Spark commits whole files, and any store that Spark can write holds them. Documents are spread by
ranges of their id; a task cuts its range in segments, and a segment in blocks of whole documents.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm import rans
from footfall.llm.text import encoded, give_back, in_batches, split_words, spread, steps, text_key

END_ID = 2
BLOCK_IDS = 1 << 18
SEGMENT_IDS = 1 << 22
CACHE_ENTRIES = 250_000
#: The steps of the tokenizer file for which words can be cut here, and the blanks it removes.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
ENDINGS = ".,;:!?"

BLOCK = "struct<first:long,n_ids:long,doc_ids:array<long>,lengths:array<long>,payload:binary>"
SCHEMA = f"shard int, segment int, n_ids long, table binary, blocks array<{BLOCK}>"


@functools.lru_cache(maxsize=4)
def cut_here(path: str) -> tuple[bool, tuple[str, ...]]:
    """Whether words of this tokenizer file can be cut as `WordIds` does, and its strings that become ids unsplit."""
    with open(path, encoding="utf-8") as file:
        steps_of = json.load(file)
    added, model = steps_of["added_tokens"] or [], steps_of["model"]
    if model["type"] == "Unigram":
        ids = [len(model["vocab"]) - 1]
    else:
        ids = model["vocab"].values()
    if max([*ids, *(t["id"] for t in added)], default=0) >= 1 << 16:
        raise ValueError(f"{path} has ids beyond 65535, which the files' 16-bit symbols cannot hold")
    marks = tuple(t["content"] for t in added)
    apart = (
        steps_of["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
        and steps_of["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}
        and model["type"] == "BPE"
        and not model["dropout"]
        and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        and not any(c.isspace() for m in marks for c in m)
    )
    return apart, marks


class WordIds:
    """Ids of texts by the tokenizers library, for any tokenizer file with at most 65,536 ids.

    Where the file's own steps are `NORMALIZERS` and `PRE_TOKENIZERS` (`apart`), words between blanks are encoded
    apart from each other: Latin words are lower-cased and cut here by the same pattern, so that a piece met before
    costs one look-up; any other word goes through the library as it is. With any other file whole texts do.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.apart, self.marks = cut_here(path)
        self.model, self.pieces = self.whole.model, regex.compile(PIECES).findall
        self.plain = re.compile(r"[\x21-\x7EÀ-ÖØ-öø-įĲ-ňŊ-ž]+").fullmatch
        self.known: dict[str, bytes] = {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        # Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on.
        self.alphabet = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}

    def ids(self, word: str) -> bytes:
        if not word.isascii() and not self.plain(word):
            return self.by_library(word)
        if word.isalpha():
            return self.piece(word.lower())
        if word[:-1].isalpha() and word[-1] in ENDINGS:
            return self.piece(word[:-1].lower()) + self.piece(word[-1])
        if not self.plain(word) or any(m in word for m in self.marks):
            return self.by_library(word)
        return b"".join(map(self.piece, self.pieces(word.lower())))

    def by_library(self, word: str) -> bytes:
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u2").tobytes()

    def piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
            found = np.array([t.id for t in self.model.tokenize(text)], "<u2").tobytes()
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            self.known[piece] = found
        return found


def word_ids(path: str) -> WordIds:
    """One per worker process: pieces met in an earlier task are not encoded again."""
    store = sys.modules.setdefault("footfall_worker_state", types.ModuleType("footfall_worker_state"))
    if getattr(store, "path", None) != path:
        store.path, store.words = path, WordIds(path)
    return store.words


def token_ids(texts: pa.Array, words: WordIds, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in a row, each text followed by the end id, and each text's number of ids."""
    if not words.apart:
        coded = [words.by_library(t.as_py() or "") + np.array([end_id], "<u2").tobytes() for t in texts]
        return np.frombuffer(b"".join(coded), "<u2"), np.fromiter(map(len, coded), np.int64, len(coded)) // 2
    flat, counts = split_words(texts, lower=False)
    codes, different = encoded(flat)
    coded = [words.ids(w) for w in different.to_pylist()]
    coded.append(np.array([end_id], "<u2").tobytes())
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 2
    flat_ids = np.frombuffer(b"".join(coded), "<u2")
    starts = np.cumsum(lengths) - lengths
    ends = np.cumsum(counts)
    codes = np.insert(codes, ends, len(coded) - 1)
    sizes = lengths[codes]
    total = np.concatenate([[0], np.cumsum(sizes)])
    stops = total[ends + np.arange(1, len(ends) + 1)]
    return flat_ids[spread(starts[codes], sizes)], np.diff(stops, prepend=0)


def _segment(shard: int, segment: int, first: int, docs: list, lengths: list, ids: np.ndarray) -> dict:
    table = rans.Table.of(ids)
    blocks, start, at = [], 0, 0
    while start < len(docs):
        stop, n = start, 0
        while stop < len(docs) and (stop == start or n + lengths[stop] <= BLOCK_IDS):
            n += lengths[stop]
            stop += 1
        frame = rans.encode(ids[at : at + n], table)
        blocks.append({"first": first + at, "n_ids": n, "doc_ids": docs[start:stop], "lengths": lengths[start:stop], "payload": frame})
        start, at = stop, at + n
    return {"shard": shard, "segment": segment, "n_ids": len(ids), "table": table.to_bytes(), "blocks": blocks}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every text of (doc_id, text, ...) and write the file set to a new folder `path`.

    A task holds one segment's ids: `SEGMENT_IDS` and at most one step's more.

    Null and empty texts have the end id alone. Rows without an id come first; rows of one id follow each
    other in the order of a hash of their text, and a hot id's rows may go to several tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard = word_ids(tokenizer), TaskContext.get().partitionId()
        block = pa.struct([("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                           ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
        schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("table", pa.binary()),
                            ("blocks", pa.list_(block))])
        first = segment = held = 0
        docs, lengths, ids = [], [], []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_segment(shard, segment, first, docs, lengths, np.concatenate(ids))], schema)

        for batch in batches:
            for part in steps(batch):
                found, sizes = token_ids(part.column("text"), words, end_id)
                docs += part.column("doc_id").to_pylist()
                lengths += sizes.tolist()
                ids.append(found)
                held += len(found)
                if held >= SEGMENT_IDS:
                    yield flush()
                    first, segment, held = first + held, segment + 1, 0
                    docs, lengths, ids = [], [], []
        if docs:
            yield flush()

    rows = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"))
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ranged.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document's ids, decoded block by block."""
    return _decoded(spark, path, "ids array<int>", lambda ids: ids.astype(np.int32), pa.list_(pa.int32()))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the decoded ids; `start` counts all ids before the document."""
    return _decoded(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _decoded(spark: SparkSession, path: str, column: str, value, kind: pa.DataType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                table = rans.Table.from_bytes(batch.column("table")[row].as_py())
                shard, slots = batch.column("shard")[row].as_py(), table.slots()
                for block in batch.column("blocks")[row].as_py():
                    ids = rans.decode(block["payload"], table, slots)
                    docs, lengths = block["doc_ids"], np.array(block["lengths"], np.int64)
                    if len(ids) != lengths.sum():
                        raise rans.Damaged("a block's documents and ids differ in number")
                    stops = np.cumsum(lengths)
                    starts = stops - lengths
                    values = pa.array([value(ids[a:b]) for a, b in zip(starts, stops)], kind)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(starts + block["first"]), pa.array(lengths), values],
                        ["shard", "doc_id", "start", "n_tokens", name],
                    )
            give_back()

    name = column.split()[0]
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so at most as many rows as the writing job had tasks.
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = spark.read.parquet(path).select("shard", "table", "blocks").mapInArrow(run, f"shard int, doc_id long, start long, n_tokens long, {column}")
    return rows.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", name)
