"""The n-gram join against brute force."""

import random

import numpy as np
import odd
import pyarrow as pa
import pytest

import compare
from footfall.llm import catalog, ngram_join, oracles
from footfall.llm.text import table

SF = "/root/testdata/sf0.001"


def shingles(text, size=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, percent=85):
    """Per row: set size, and the smallest id that links reach."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, both = sets[j], len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).extend([] if doc is None else [doc])
    return sorted(((d, len(s), min(ids[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(docs, **how):
    return sorted((tuple(r) for r in ngram_join.linked(docs, **how).drop("text_key").collect()), key=str)


def family(rng, size, edits, words=140):
    """Copies of one text with a few words changed, so that only some pairs are similar."""
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    made = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        made.append(" ".join(copy))
    return made


def mixed_rows(seed=5):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 60, 7) + family(rng, 25, 12, 90) + family(rng, 10, 3, 20) + family(rng, 6, 90, 900)
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    texts += [" ".join(f"s{rng.randrange(3)}" for _ in range(rng.randrange(9))) for _ in range(60)]
    texts += ["A b C d e f", "a b c d e f g", "a b c d e f g h i", "x y z", "X  y\tz", "x y"]
    rng.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_join_equals_brute_force(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("percent", [50, 95])
def test_other_thresholds(spark, percent):
    rows = mixed_rows(6)[:90]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent) == brute(rows, percent)


def test_long_postings_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 9)
    monkeypatch.setattr(ngram_join, "LONG_POSTING", 16)
    rows = mixed_rows(7)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_pairs_across_the_parts_of_a_posting(spark, monkeypatch):
    """Pairs that share one posting alone, a long one, and are similar to nothing else in it."""
    monkeypatch.setattr(ngram_join, "GROUP", 9)
    # By hash alone: the passage all texts begin with is the first shingle of each.
    monkeypatch.setattr(ngram_join, "rarity", lambda counts: np.zeros(1 << ngram_join.BUCKET_BITS, np.uint64))
    passages = [f"a b c d{i}" for i in range(4000)]
    hashes, _ = ngram_join.shingle_sets(pa.array(passages))
    passage, texts = passages[int(np.argmin(hashes))], []
    for i in range(60):
        one = f"{passage} " + " ".join(f"u{i}x{j}" for j in range(5))
        texts += [one, f"{one} more{i}"]
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd.ROWS]
    assert found(odd.docs(spark)) == brute(rows)
    assert found(odd.docs(spark).filter("false")) == []


def test_filters_keep_every_similar_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = []
    for _ in range(80):
        size = int(rng.integers(5, 900))
        own = base[:size].copy()
        change = rng.random(size) < rng.random() * 0.15
        own[change] = rng.integers(0, 2**63, int(change.sum()), dtype=np.uint64)
        sets.append(np.unique(own))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    pairs = set()
    for i, j, bits in ngram_join.plausible(n, n // 2, [ngram_join.sketch(s) for s in sets]):
        pairs |= set(zip(i.tolist(), j.tolist()))
        assert all(b <= len(set(sets[x].tolist()) ^ set(sets[y].tolist())) for x, y, b in zip(i, j, bits))
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            place = min(n[i] // 2, n[j] // 2) + min(n[i] - n[i] // 2, n[j] - n[j] // 2)
            need = -(-85 * (n[i] + n[j]) // 185)
            if 100 * both >= 85 * (n[i] + n[j] - both) and place >= need:
                assert (i, j) in pairs


def test_query_equals_sql(spark):
    assert compare.differences(catalog.QUERIES["op11_ngram_join"](spark, SF), compare.oracle(SF), oracles.SQL["op11_ngram_join"]) == []


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted((tuple(r) for r in catalog.QUERIES["op11_ngram_join"](spark, SF).collect()), key=str) == brute(rows)
