"""Words of text columns, and tables the operators read."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space and the controls from tab to carriage return, as a Java and RE2 class.
BLANKS = r"[\x20\x09-\x0D]+"
#: Rows of a record batch that one step works on, and the bytes of text it takes at most (one text at least).
STEP_BYTES = 8 << 20
#: Bounds of the record batches that Spark sends to Python.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(docs: DataFrame) -> DataFrame:
    """The table itself; its session sends texts to Python in batches of bounded size from now on."""
    for key, most in BATCHES.items():
        now = docs.sparkSession.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            docs.sparkSession.conf.set(key, str(most))
    return docs


def packed(docs: DataFrame) -> Column:
    """All columns as one, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def text_key(text: str = "text") -> Column:
    """Tells rows of one id apart by their text; null and empty texts differ."""
    return F.coalesce(F.xxhash64(F.col(text), F.col(text).isNull()), F.lit(0))


def n_words(text: str = "text") -> Column:
    """Number of words, 0 for null."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANKS), "")
    return F.size(words).cast("long")


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with up to `limit` bytes of text, or one row that has more."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, ends = 0, np.cumsum(sizes)
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def gathered(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined up to `limit` bytes of text, or one row that has more."""
    held, size = [], 0
    for batch in batches:
        for part in steps(batch, column, limit):
            own = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and size + own > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.concat_batches(held)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are written: it does once the driver's JVM
    has collected what refers to them, by itself only every half hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return freed memory to the machine: a worker lives on between tasks, beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, and the number of words of each; null has none."""
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    words = pc.list_flatten(lists)
    blank = np.asarray(pc.equal(pc.binary_length(texts), 0))
    if blank.any():  # an empty text gives one empty word
        words = words.filter(pc.not_equal(pc.binary_length(words), 0))
        counts = np.where(blank, 0, counts)
    return words, counts


def encoded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words in a dictionary of the different ones."""
    found = words.dictionary_encode()
    return np.asarray(found.indices, dtype=np.int64), found.dictionary


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
