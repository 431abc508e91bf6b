"""Language identification with string kernels.

The kernel of two texts is the mean over n = 1..`orders` of the cosine of their n-gram presence vectors
(blended spectrum). Landmark texts span a Nystroem feature space in which one ridge regression per
language is solved on a bounded sample; documents are scored by products of whole batches with the
landmarks' presence matrix and the coefficients. N-grams are taken over letters in lower case; any other
character is a boundary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from footfall.llm.text import in_batches, steps

#: Bounds of the fit: labelled texts and landmarks per language. Texts up to FIT_CHARS characters come first; longer ones
#: fill up, the shortest first, while all of a language stay within TRAIN_TEXTS * FIT_CHARS, one text at least.
TRAIN_TEXTS = 300
LANDMARKS = 24
FIT_CHARS = 20_000
ORDERS = 3
RIDGE = 1e-3
BATCH = 256
CODE_POINTS = 0x110000
#: Places of a look-up table; beyond them the same keys are searched in order.
TABLE_PLACES = 1 << 23
_TAGS = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
NONE = "und"
BOUNDARY, UNKNOWN = 0, 1


@dataclass
class Model:
    """`letters`: code of every code point; `index`: per order, what `_look_up` finds columns in; `columns`: columns
    per order; `landmarks`: their normalised presence, columns x landmarks; `weights`: landmarks x languages."""

    languages: list[str]
    letters: np.ndarray
    index: list[tuple[bool, np.ndarray]]
    columns: list[int]
    landmarks: np.ndarray
    weights: np.ndarray


def _codes(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts in a row, and the text of each."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    return letters[points], np.repeat(np.arange(len(low)), [len(t) for t in low])


def _keys(codes: np.ndarray, text: np.ndarray, n: int, base: int, before: np.ndarray | None) -> np.ndarray:
    """Key of each n-gram: the column of its first n - 1 letters and its last letter; -1 where those have no
    column or the n-gram leaves its text."""
    if before is None:
        return codes.astype(np.int64)
    size = max(0, len(codes) - n + 1)
    keys = before[:size].astype(np.int64) * base + codes[n - 1 :]
    keys[(before[:size] < 0) | (text[:size] != text[n - 1 :])] = -1
    return keys


def _index(keys: np.ndarray, places: int) -> tuple[bool, np.ndarray]:
    """The ordered keys as a table of all places, the last one for unknown keys, or as they are."""
    if places > TABLE_PLACES:
        return False, keys
    table = np.full(places + 1, -1, np.int32)
    table[keys] = np.arange(len(keys))
    return True, table


def _look_up(index: tuple[bool, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Column of each key, -1 for unknown ones."""
    tabled, known = index
    if tabled:
        return known[keys]
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def _presence(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Normalised presence, texts x columns, and whether a text has a letter."""
    codes, text = _codes(texts, model.letters)
    out = np.zeros((len(texts), sum(model.columns)), np.float32)
    base, first, columns = int(model.letters.max()) + 1, 0, None
    for n, (index, width) in enumerate(zip(model.index, model.columns), 1):
        columns = _look_up(index, _keys(codes, text, n, base, columns))
        known = columns >= 0
        part = out[:, first : first + width]
        part[text[: len(columns)][known], columns[known]] = 1
        part /= np.sqrt(np.maximum(1, part.sum(axis=1, keepdims=True)) * len(model.columns))
        first += width
    lettered = np.zeros(len(texts), bool)
    lettered[text[codes != BOUNDARY]] = True
    return out, lettered


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, orders: int = ORDERS, ridge: float = RIDGE) -> Model:
    """Solve the regressions on the given texts; the first `landmarks` of each language are landmarks."""
    names = sorted(set(languages))
    alphabet = sorted({c for t in texts for c in set(t.lower()) if c.isalpha()})
    base = len(alphabet) + 2
    letters = np.array([UNKNOWN if chr(i).isalpha() else BOUNDARY for i in range(CODE_POINTS)], np.min_scalar_type(base))
    letters[[ord(c) for c in alphabet]] = np.arange(2, base)
    chosen = [i for name in names for i in [j for j, x in enumerate(languages) if x == name][:landmarks]]
    codes, text = _codes([texts[i] for i in chosen], letters)
    index, columns, before = [], [], None
    for n in range(1, orders + 1):
        keys = _keys(codes, text, n, base, before)
        found = np.unique(keys[keys >= 0])
        index.append(_index(found, base * max([1, *columns[-1:]])))
        columns.append(len(found))
        before = _look_up(index[-1], keys)
    model = Model(names, letters, index, columns, np.zeros(0), np.zeros(0))
    model.landmarks = np.ascontiguousarray(_presence([texts[i] for i in chosen], model)[0].T)
    between = (model.landmarks.T @ model.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(between)
    keep = values > 1e-8 * max(1e-30, values.max(initial=0))
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel = np.concatenate([_presence(texts[i : i + BATCH], model)[0] @ model.landmarks for i in range(0, len(texts), BATCH)] or [np.zeros((0, 0))])
    space = kernel.astype(np.float64) @ root
    wanted = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    shares = np.array([languages.count(x) for x in languages], np.float64)
    weight = (1 / shares)[:, None]  # every language counts the same
    solved = np.linalg.solve(space.T @ (weight * space) + ridge * np.eye(space.shape[1]), space.T @ (weight * wanted))
    model.weights = (root @ solved).astype(np.float32)
    return model


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; `und` and 0 for null, texts without a letter, and an empty model."""
    names, scores = [], np.zeros(len(texts))
    for i in range(0, len(texts), BATCH):
        some = [t or "" for t in texts[i : i + BATCH]]
        if not model.languages:
            names += [NONE] * len(some)
            continue
        presence, lettered = _presence(some, model)
        found = presence @ model.landmarks @ model.weights
        best = found.argmax(axis=1)
        names += [model.languages[b] if ok else NONE for b, ok in zip(best, lettered)]
        top = np.clip((found[np.arange(len(some)), best] + 1) / 2, 0, 1)
        scores[i : i + BATCH] = np.where(lettered, top, 0)
    return names, scores


def fit_table(
    docs: DataFrame, train: Column, label: str = "lang", per_language: int = TRAIN_TEXTS, max_chars: int = FIT_CHARS
) -> Model:
    """Fit on up to `per_language` labelled rows of each language, taken by a hash of the id.

    Texts of at most `max_chars` characters come first. A language that has too few of them takes longer ones, the
    shortest first, while its texts stay within `per_language * max_chars` characters, and one at least. The driver
    holds no more than these. Of long rows with one length and one hash of the id, as repeated rows, the least text
    is taken.
    """
    size = F.length("text")
    rows = docs.filter(train & F.col(label).isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", F.col(label).alias("label"), "text", size.alias("n"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("o"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") <= max_chars).alias("short")).collect()
    if not counts:
        return Model([], np.zeros(0), [], [], np.zeros(0), np.zeros(0))

    def sampled(wanted: dict[str, tuple[int, int]]) -> Column:
        """Three times as many of each language as wanted, of those there are."""
        share = F.lit(0)
        for name, (n, there) in wanted.items():
            share = F.when(F.col("label") == name, min(1 << 30, int(3 * n / there * (1 << 30)) + 1)).otherwise(share)
        return F.col("o") < share

    some = rows.filter(sampled({r.label: (per_language, r.short) for r in counts if r.short}) & (F.col("n") <= max_chars))
    taken = (
        some.groupBy("label")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("o", "doc_id", "text"))), 1, per_language).alias("rows"))
        .collect()
    )
    pairs = sorted((r.label, x["o"], x["text"]) for r in taken for x in r["rows"])
    few = {r.label: (per_language - r.short, r["all"] - r.short) for r in counts if r.short < min(per_language, r["all"])}
    if few:
        used = {name: sum(len(p[2]) for p in pairs if p[0] == name) for name in few}
        longer = rows.filter(sampled(few) & (F.col("n") > max_chars))
        listed = longer.select("label", "n", "o").distinct().orderBy("n", "o").collect()  # no texts
        last = {}
        for r in listed:
            n, there = few[r.label]
            used[r.label] += r.n
            few[r.label] = (n - 1, there)
            alone = r.label not in last and not any(p[0] == r.label for p in pairs)
            if alone or (few[r.label][0] >= 0 and used[r.label] <= per_language * max_chars):
                last[r.label] = (r.n, r.o)
        cut = F.lit(False)
        for name, (n, o) in last.items():
            cut = cut | ((F.col("label") == name) & ((F.col("n") < n) | ((F.col("n") == n) & (F.col("o") <= o))))
        chosen = longer.filter(cut).groupBy("label", "n", "o").agg(F.min("text").alias("text")).collect()
        pairs = sorted([*pairs, *((r.label, r.o, r.text) for r in chosen)])
    return fit([p[2] for p in pairs], [p[0] for p in pairs])


def tag(docs: DataFrame, model: Model, keep: Column | str = "doc_id") -> DataFrame:
    """(kept, lang_pred, score) of every row: an expression over its columns, and what its text alone gives."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**sent.value)
        for batch in batches:
            for part in steps(batch):
                texts = [None if t is None else t.decode("utf-8", "replace") for t in part.column("text").cast(pa.binary()).to_pylist()]
                names, scores = predict(texts, known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("kept"), pa.array(names, pa.string()), pa.array(scores)], ["kept", "lang_pred", "score"]
                )

    rows = in_batches(docs).select((F.col(keep) if isinstance(keep, str) else keep).alias("kept"), "text")
    return rows.mapInArrow(run, StructType([rows.schema["kept"], *_TAGS]))


def held_out(doc: str = "doc_id", folds: int = 5) -> Column:
    """Rows that are never trained on; a row without an id is neither held out nor trained on."""
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % folds == 0, F.lit(False))


def trained_on(doc: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % folds != 0, F.lit(False))
