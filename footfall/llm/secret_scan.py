"""Secret scans over a trigram index.

Each rule's pattern gives a Boolean query over trigrams that every match must hold, from Python's own
parse of the pattern. The index has a posting (trigram, text) for each trigram that any query names, over
all whole texts in lower case. Queries are evaluated by joining postings with their clauses and counting;
only texts left over are searched with the pattern. A pattern without mandatory trigrams searches all texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import in_batches, steps, text_key
from footfall.session import materialise

MAX_STRINGS = 64
MAX_CLAUSES = 256


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern (ASCII classes), and the shortest match, or group, that counts."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    at_least: int = 1

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def finder(self) -> Callable[[str], list[tuple[int, int]]]:
        found = self.compiled().finditer
        return lambda text: [m.span() for m in found(text) if len(m[self.group]) >= self.at_least]


#: The three base kinds come first, in the order in which spans that begin together are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=18),
    Rule("hex", r"[0-9a-f]+", at_least=16),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE + MORE


def trigram_clauses(rule: Rule) -> list[frozenset[str]]:
    """Clauses of which one must hold, each a set of trigrams of the text in lower case; [] where none is mandatory."""
    query = _mandatory(_parser.parse(rule.pattern, re.ASCII))
    return sorted(query, key=sorted) if all(query) else []


def _grams(text: str) -> frozenset[str]:
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return frozenset(g for g in (low[i : i + 3] for i in range(len(low) - 2)) if g.isascii())


def _simple(clauses: set[frozenset[str]]) -> set[frozenset[str]]:
    """Without clauses that another one implies; an empty clause stands for no condition at all."""
    return {c for c in clauses if not any(d < c for d in clauses)} if len(clauses) <= MAX_CLAUSES else {frozenset()}


def _both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    if len(a) * len(b) > MAX_CLAUSES:  # one of two conditions is still a condition
        return a if min(map(len, a)) >= min(map(len, b)) else b
    return _simple({x | y for x in a for y in b})


def _mandatory(nodes) -> set[frozenset[str]]:
    query, strings = {frozenset()}, {""}
    for node in [*nodes, None]:
        exact = None if node is None else _exact(node)
        if exact is not None and len(strings) * len(exact) <= MAX_STRINGS:
            strings = {s + e for s in strings for e in exact}
            continue
        query = _both(query, _simple({_grams(s) for s in strings}))
        strings = {""} if exact is None else exact
        if node is not None and exact is None:
            query = _both(query, _inside(node))
    return query


def _exact(node) -> set[str] | None:
    """All strings a part can match, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value)}
    if kind is op.AT:
        return {""}
    if kind is op.IN:
        if all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
            return {chr(v) for _, v in value}
        return None
    if kind is op.SUBPATTERN:
        return _exact_all(value[-1])
    if kind is op.BRANCH:
        found = [_exact_all(x) for x in value[1]]
        return None if any(x is None for x in found) else set().union(*found)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        some = _exact_all(inner) if high in (0, 1) or low == high and low <= 8 else None
        if some is None:
            return None
        if low == high:
            found = {""}
            for _ in range(low):
                found = {a + b for a in found for b in some}
                if len(found) > MAX_STRINGS:
                    return None
            return found
        return {""} | some
    return None


def _exact_all(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        some = _exact(node)
        if some is None or len(found) * len(some) > MAX_STRINGS:
            return None
        found = {a + b for a in found for b in some}
    return found


def _inside(node) -> set[frozenset[str]]:
    """What a part without a short list of strings still asks for."""
    kind, value = node
    if kind is op.SUBPATTERN:
        return _mandatory(value[-1])
    if kind is op.BRANCH:
        return _simple(set().union(*[_mandatory(x) for x in value[1]]))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _mandatory(value[2])
    return {frozenset()}


def _code(gram: str) -> int:
    return int.from_bytes(gram.encode("ascii"), "big")


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, row): the given trigrams' texts, each once; `row` hashes id and text."""
    wanted = sorted(_code(g) for g in grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(1 << 24, -1, np.int16)
        table[wanted] = np.arange(len(wanted))
        codes = np.array(wanted, np.int32)
        for batch in batches:
            for part in steps(batch):
                ids, rows = [], []
                for text, row in zip(part.column("text").cast(pa.binary()), part.column("row").to_pylist()):
                    b = np.frombuffer((text.as_py() or b"").lower(), np.uint8)
                    if len(b) < 3:
                        continue
                    at = (b[:-2].astype(np.int32) << 16) | (b[1:-1].astype(np.int32) << 8) | b[2:]
                    found = table[at]
                    found = np.unique(found[found >= 0])
                    ids.append(codes[found])
                    rows.append(np.full(len(found), row, np.int64))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(rows))], ["gram", "row"])

    return in_batches(docs).select("text", _row().alias("row")).mapInArrow(run, "gram int, row long")


def _row():
    return F.xxhash64("doc_id", text_key())


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, rules): numbers of the rules whose trigram query a text satisfies."""
    spark = index.sparkSession
    clauses = [(_code(g), r, c, len(clause)) for r, rule in enumerate(rules) for c, clause in enumerate(trigram_clauses(rule)) for g in clause]
    asked = spark.createDataFrame(clauses, "gram int, rule int, clause int, n int")
    met = index.join(F.broadcast(asked), "gram").groupBy("row", "rule", "clause").agg(F.count(F.lit(1)).alias("found"), F.first("n").alias("n"))
    return met.filter("found = n").groupBy("row").agg(F.collect_set("rule").alias("rules"))  # at most all rules


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for every row; spans are (kind, start, end) in code points, by start, then rule order.

    A null or empty text has none. Rows with equal ids are told apart by their texts, and equal rows give
    equal results.
    """
    grams = sorted({g for rule in rules for clause in trigram_clauses(rule) for g in clause})
    full = [r for r, rule in enumerate(rules) if not trigram_clauses(rule)]
    index = materialise(postings(docs, grams).distinct(), "trigram_index")
    found = candidates(index, rules)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [rule.finder() for rule in rules]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in steps(batch):
                out = []
                for text, extra in zip(part.column("text").cast(pa.binary()), part.column("rules").to_pylist()):
                    text = (text.as_py() or b"").decode("utf-8", "replace")
                    spans = [(a, r, b) for r in {*full, *(extra or ())} for a, b in finders[r](text)]
                    out.append([{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in sorted(spans)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    rows = docs.select("doc_id", "text", _row().alias("row"))
    id_kind = dict(docs.dtypes)["doc_id"]
    return rows.join(found, "row", "left").select("doc_id", "text", "rules").mapInArrow(
        verify, f"doc_id {id_kind}, spans array<struct<kind:string,start:long,end:long>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of scanned rows, in the query's form."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(r.kind) for r in BASE],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )
