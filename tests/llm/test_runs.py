"""Periodic runs against brute force."""

import hashlib
import zlib

import numpy as np
import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import catalog, run_detection
from footfall.llm.text import table

SF = "/root/testdata/sf0.001"


def brute(words, min_length=24, exponent=3):
    """Every period: stretches on which words that far apart are equal; the smallest period names a run."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 8), st.integers(2, 4))
def test_runs_of_short_sequences(codes, min_length, exponent):
    assert run_detection.periodic_runs(np.array(codes, np.int64), min_length, exponent) == brute(codes, min_length, exponent)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 30), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 2))
def test_runs_inside_runs(unit, times, rest, again):
    codes = (unit * times + rest) * (again + 1)
    assert run_detection.periodic_runs(np.array(codes, np.int64)) == brute(codes)


def test_a_class_of_many_positions(monkeypatch):
    monkeypatch.setattr(run_detection, "CHUNK", 4)
    codes = [1] * 200 + [2, 1, 1] * 40 + [1] * 90
    assert run_detection.periodic_runs(np.array(codes)) == brute(codes)


def test_texts_without_repeats_are_told_apart():
    codes, counts = np.array([1, 2, 3, 1, 2, 3, 4, 5, 6, 7, 4, 5, 6]), np.array([6, 3, 0, 4])
    assert run_detection.with_repeats(codes, counts, 3).tolist() == [0]
    assert run_detection.with_repeats(codes, counts, 4).tolist() == []


def damaged(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc, text):
    words = damaged(doc, text)
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc, len(runs), *top, sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)), len(words))


def key(row):
    return tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in row)


def test_query_equals_brute_force(spark):
    rows = [r for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = {r.doc_id: tuple(r) for r in catalog.QUERIES["op13_run_detection"](spark, SF).collect()}
    small = [r for r in rows if len((r.text or "").split()) < 1500]
    assert len(found) == len(rows) and len(small) > 100
    assert [found[r.doc_id] for r in small] == [expected(r.doc_id, r.text) for r in small]
    assert sum(found[r.doc_id][1] for r in small) > 10


def test_odd_rows(spark):
    docs = odd.docs(spark)
    rows = run_detection.digest(run_detection.runs_of(catalog.looped(docs))).collect()
    short = sorted((tuple(r) for r in rows if r.n_words < 5000), key=key)
    assert short == sorted((expected(r[0], r[1]) for r in odd.ROWS if r[1] is None or len(r[1]) < 5000), key=key)
    assert len(rows) == len(odd.ROWS)
    assert run_detection.runs_of(docs.filter("false")).collect() == []


def test_collapsed_keeps_columns_and_other_texts(spark):
    loop = "head " + "one two three " * 40 + "tail"
    docs = odd.docs(spark, odd.ROWS + [odd._row(9, loop)])
    found = run_detection.collapsed(docs)
    assert found.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in found.collect()}
    assert (9, "head one two three tail") in texts
    assert {(r[0], r[1]) for r in odd.ROWS if r[0] is not None and r[1] != odd.LONG} <= texts
