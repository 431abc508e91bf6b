"""Token files, class scores, mixing, quality, chat, and the pipeline."""

import collections
import math
import pathlib
import zlib

import duckdb
import numpy as np
import odd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import compare
import corpus_pipeline
from footfall.llm import catalog, chat_format, class_lm, mixing, oracles, quality_rules, rans, token_files
from footfall.llm.text import table
from footfall.session import scratch_path

SF = "/root/testdata/sf0.001"
PATH = catalog.tokenizer_path()


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


# --- range coding and token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 65_535)), max_size=400), st.integers(1, 40), st.integers(1, 5))
def test_frames_come_back(ids, lanes, every):
    ids = np.array(ids, np.uint16)
    made = rans.Table.of(ids)
    read = rans.Table.from_bytes(made.to_bytes())
    frame = rans.encode(ids, made, lanes, every)
    assert np.array_equal(rans.decode(frame, read), ids)
    parts = [rans.decode(frame, read, part=p) for p in range(rans.parts(frame))]
    assert np.array_equal(np.concatenate([np.zeros(0, np.uint16), *parts]), ids)


def test_many_rare_symbols_and_one_hot():
    ids = np.concatenate([np.arange(49_408), np.full(3_000_000, 7)]).astype(np.uint16)
    made = rans.Table.of(ids)
    assert made.freqs.sum() == 1 << rans.PROB_BITS and made.freqs.min() >= 1
    frame = rans.encode(ids, made)
    assert np.array_equal(rans.decode(frame, made), ids) and len(frame) < 600_000


def test_damage_is_found():
    ids = np.arange(5000, dtype=np.uint16)
    made = rans.Table.of(ids)
    frame = bytearray(rans.encode(ids, made))
    frame[-3] ^= 1
    with pytest.raises(rans.Damaged):
        rans.decode(bytes(frame), made)


STRANGE = [
    "", " \n", "İstanbul Σίσυφος ΟΔΟΣ é H̱ 中文 ２３ it's IT'S <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
    "\x00\x1f ª² ½ ﬁ ß ẞ don't x", "'ll ́abc ŉ Ŀ ĳ ſtart ÷× a.b. end. (x) 12a", "  wide　blank\u0085",
]


def test_word_ids_equal_whole_text_ids(whole):
    words = token_files.WordIds(PATH)
    ids, sizes = token_files.token_ids(pa.array([*STRANGE, None]), words)
    wanted = [whole.encode(t, add_special_tokens=False).ids + [2] for t in [*STRANGE, ""]]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAéÉñß 'sS.,!?\t\n<|>ΣςıİĶ́中1٣²‍😀tT", max_size=40))
def test_any_text_is_cut_like_the_whole(whole, text):
    ids, _ = token_files.token_ids(pa.array([text]), token_files.WordIds(PATH))
    assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_any_tokenizer_are_the_librarys(spark, name):
    path = catalog.tokenizer_path(name)
    whole, words = Tokenizer.from_file(path), token_files.WordIds(path)
    assert words.apart == (name == "word_bpe_49k.json")
    texts = [*STRANGE, "Hello  world, this IS a\n\ttest <|endoftext|> it's", None]
    ids, sizes = token_files.token_ids(pa.array(texts), words)
    wanted = [whole.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert sizes.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]
    folder = scratch_path(spark, "any_tokens")
    token_files.write_tokens(odd.docs(spark), folder, path)
    read = collections.Counter((r.doc_id, tuple(r.ids)) for r in token_files.read_tokens(spark, folder).collect())
    assert read == collections.Counter((d[0], tuple(whole.encode(d[1] or "", add_special_tokens=False).ids + [2])) for d in odd.ROWS)


def plain_index(whole, rows):
    at, out = 0, []
    for doc, text in rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_output_equals_the_library(spark, whole):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    found = [tuple(r) for r in catalog.token_output(spark, SF).orderBy("doc_id").collect()]
    assert found == plain_index(whole, rows)


def test_token_files_of_odd_rows(spark, whole, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    path = scratch_path(spark, "odd_tokens")
    token_files.write_tokens(odd.docs(spark), path, PATH)
    read = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in read] == [None, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert [r.start for r in read] == np.cumsum([0, *[r.n_tokens for r in read]])[:-1].tolist()
    wanted = collections.Counter((d[0], tuple(whole.encode(d[1] or "", add_special_tokens=False).ids + [2])) for d in odd.ROWS)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in read) == wanted
    assert catalog.token_rows(odd.docs(spark, [])).count() == 0


# --- class-based scores


def plain_base(rows, held):
    words = [(t or "").encode().lower().split() + [None] for _, t in rows]
    counts = collections.Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws) for ws in words]
    return [(len(ws), sum(counts[w] > 0 for w in ws), n, b) for ws, b in zip(words, base)]


def test_class_scores(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    found = catalog.class_scores(spark, SF).orderBy("doc_id").collect()
    for r, h, (n, known, train, base) in zip(found, held, plain_base(rows, held), strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    test = [r for r in found if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_class_scores_of_odd_rows(spark):
    rows = [(d[0], d[1]) for d in odd.ROWS]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    found = class_lm.score_documents(odd.docs(spark), class_lm.held_out(), n_classes=4, rounds=2).collect()
    wanted = sorted((n, k, t) for n, k, t, _ in plain_base(rows, held))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in found) == wanted
    assert class_lm.score_documents(odd.docs(spark, []), class_lm.held_out(), n_classes=4, rounds=1).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = odd.docs(spark, [odd._row(i, t) for i, t in enumerate(["a b a c", "b a b", "c c a", "a"])])
    coded = class_lm.code(docs, class_lm.held_out(folds=1, fold=5))
    model = class_lm.fit(coded, n_classes=3, rounds=2)
    words = model.words.collect()
    rooms = model.class_tokens + class_lm.SMOOTH_WORD * (model.class_words + 1)
    for c in range(1, 3):
        known = sum(w.c + class_lm.SMOOTH_WORD for w in words if w["class"] == c)
        assert known + class_lm.SMOOTH_WORD == pytest.approx(rooms[c])
    assert model.transitions.sum() == model.n_tokens == 15


def plain_scores(texts, held, words, classes, k):
    """log10 probabilities from the definition, given the classes of words and items."""
    class_of = lambda w: 0 if w is None else words[w]["class"] if w in words else int(classes[class_lm.tail_of(w)])
    paths = [[None, *(t or "").lower().split(), None] for t in texts]
    trained = [p for p, h in zip(paths, held) if not h]
    # The end before the first text is one more than there are texts; steps are between texts too.
    stream = [None, *(w for p in trained for w in p[1:])]
    counts, steps = collections.Counter(stream[1:]), np.zeros((k, k))
    for a, b in zip(stream, stream[1:]):
        steps[class_of(a), class_of(b)] += 1
    tokens = [sum(n for w, n in counts.items() if class_of(w) == c) for c in range(k)]
    kinds = [sum(class_of(w) == c for w in counts) for c in range(k)]

    def of(a, b):
        g, h = class_of(a), class_of(b)
        step = (steps[g, h] + class_lm.SMOOTH_CLASS) / (steps[g].sum() + class_lm.SMOOTH_CLASS * k)
        return math.log10(step * (counts[b] + class_lm.SMOOTH_WORD) / (tokens[h] + class_lm.SMOOTH_WORD * (kinds[h] + 1)))

    return [sum(of(a, b) for a, b in zip(p, p[1:])) for p in paths]


def test_scores_equal_their_definition(spark, monkeypatch):
    """Many chunks, words over several batches, counts of over 255, unseen words, and words of their own classes."""
    monkeypatch.setattr(class_lm, "CORE_SHARE", 40)
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 600)
    monkeypatch.setattr(class_lm, "SLICE_WORDS", 7)
    monkeypatch.setattr(class_lm, "HELD_PLACES", 20)
    rng = np.random.default_rng(3)
    vocabulary = [a + b + c for a in "klm" for b in "aeiou" for c in ("", "st", "ng", "ts", "xt")]
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(0, 60))) for _ in range(120)]
    texts += [" ".join(["again", "and"] * 900), None, "", "unseen words only here", "kast Kast KAST " * 5]
    docs = odd.docs(spark, [odd._row(i, t) for i, t in enumerate(texts)])
    coded = class_lm.code(docs.repartition(4), class_lm.held_out()).cache()
    model = class_lm.fit(coded, n_classes=6)
    words = {w.word: w for w in model.words.collect()}
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = collections.Counter(w for t, h in zip(texts, held) if not h for w in (t or "").lower().split())
    assert {w: r.c for w, r in words.items()} == counts
    found = [r.score for r in class_lm.score(model).orderBy("doc_id").collect()]
    assert found == pytest.approx(plain_scores(texts, held, words, model.classes, 6), rel=1e-9)


def test_chunks_are_worked_on_in_pieces(spark, monkeypatch):
    """Steps of few words give the rows of whole chunks; chunk rows are small and their pages need no buffers outside the heap."""
    rng = np.random.default_rng(8)
    vocabulary = [a + b + c for a in "klm" for b in "aeiou" for c in ("", "st", "ng")]
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(0, 60))) for _ in range(90)] + ["again and " * 300, None, ""]
    docs = odd.docs(spark, [odd._row(i, t) for i, t in enumerate(texts)])
    monkeypatch.setattr(class_lm, "CORE_SHARE", 40)
    coded = class_lm.code(docs.repartition(3), class_lm.held_out()).cache()
    for r in coded.collect():
        assert len(r.codes) < 4 * sum(r.lengths)
    found = []
    for most in (1 << 18, 50):
        monkeypatch.setattr(class_lm, "PIECE_WORDS", most)
        model = class_lm.fit(coded, n_classes=5, rounds=3)
        found.append([tuple(r) for r in class_lm.score(model).orderBy("doc_id").collect()])
    assert found[0] == found[1] and len(found[0]) == len(texts)
    for t in (model.chunks, model.words):
        for path in t.inputFiles():
            meta = pq.ParquetFile(path.removeprefix("file:")).metadata
            groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
            assert {g.column(c).compression for g in groups for c in range(meta.num_columns)} <= {"ZSTD"}


def test_pieces_of_texts():
    found = list(class_lm.pieces(np.array([3, 0, 5, 20, 1, 0]), 8))
    assert found == [(slice(0, 3), slice(0, 8)), (slice(3, 4), slice(8, 28)), (slice(4, 6), slice(28, 29))]
    assert list(class_lm.pieces(np.zeros(0, np.int64), 8)) == []


def test_cells_come_back_whole():
    data = pa.array([b"", bytes([1, 0, 255, 1, 0, 45]), b"", bytes([2, 1, 7])], pa.binary())
    cells, sizes = class_lm.cells_of(data.slice(1))
    assert sizes.tolist() == [2, 0, 1] and cells.tolist() == [(1, 255), (1, 45), (258, 7)]
    cells, sizes = class_lm.cells_of(data.slice(0, 1))
    assert sizes.tolist() == [0] and len(cells) == 0


def test_gains_are_changes_of_the_likelihood():
    rng = np.random.default_rng(1)
    n, classes = rng.integers(0, 30, (12, 12)).astype(float), rng.integers(0, 4, 12)

    def counts(classes):
        out = np.zeros((4, 4))
        np.add.at(out, (np.repeat(classes, 12), np.tile(classes, 12)), n.ravel())
        return out

    for w in range(12):
        right, left = np.bincount(classes, n[w], 4), np.bincount(classes, n[:, w], 4)
        gains = class_lm.gains(classes[w], right, left, n[w, w], counts(classes))
        for h in range(4):
            moved = classes.copy()
            moved[w] = h
            assert gains[h] == pytest.approx(class_lm.likelihood(counts(moved)) - class_lm.likelihood(counts(classes)), abs=1e-6)


def test_exchange_ends_where_no_single_move_gains(spark):
    rng = np.random.default_rng(4)
    n = (rng.integers(0, 40, (150, 150)) * (rng.random((150, 150)) < 0.2)).astype(float)
    pairs = spark.createDataFrame([(int(a), int(b), int(n[a, b])) for a, b in np.argwhere(n)], "a int, b int, n long")
    classes = class_lm.exchange(class_lm.contexts(pairs).cache(), np.arange(150), n_classes=6)
    table = np.zeros((6, 6))
    np.add.at(table, (np.repeat(classes, 150), np.tile(classes, 150)), n.ravel())
    for w in range(1, 150):
        right, left = np.bincount(classes, n[w], 6), np.bincount(classes, n[:, w], 6)
        gain = class_lm.gains(int(classes[w]), right, left, n[w, w], table)
        assert gain[1:].max() < 1e-6


def test_words_of_one_ending_have_their_own_classes(spark, monkeypatch):
    """Words too rare for the head share an item by their ending, but each goes where its contexts fit."""
    monkeypatch.setattr(class_lm, "CORE_SHARE", 14)
    texts = [f"left {'xing' if i % 2 else 'king'} east right {'ying' if i % 2 else 'zing'} west" for i in range(40)]
    texts += ["left aaa east right bbb west"] * 40
    docs = odd.docs(spark, [odd._row(i, t) for i, t in enumerate(texts)])
    coded = class_lm.code(docs, class_lm.held_out(folds=1, fold=5))
    model = class_lm.fit(coded, n_classes=8)
    words = {w.word: w for w in model.words.collect()}
    assert len({words[w]["item"] for w in ("xing", "king", "ying", "zing")}) == 1
    assert words["xing"]["class"] == words["king"]["class"] != words["ying"]["class"] == words["zing"]["class"]
    table, shared = np.zeros((8, 8)), np.zeros((8, 8))
    for t in texts:
        path = [None, *t.split(), None]
        for a, b in zip(path, path[1:]):
            table[words[a]["class"] if a else 0, words[b]["class"] if b else 0] += 1
            shared[model.classes[words[a]["item"]] if a else 0, model.classes[words[b]["item"]] if b else 0] += 1
    assert (model.transitions == table).all()
    assert class_lm.likelihood(table) > class_lm.likelihood(shared)


# --- mixing


def plain_targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.remove(s)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 20}, {"a": 0, "b": 3, "é": 90, "z": 1, "zz": 0}, {"a": 7}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert found == {s: pytest.approx(t) for s, t in plain_targets(sizes).items()}


@pytest.mark.parametrize("rows_per_bucket", [50_000, 20])
def test_mix_comes_near_its_targets(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows_per_bucket)
    monkeypatch.setattr(mixing, "FAN", 4)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    runs = [sorted(tuple(r) for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1] and len(runs[0]) == 1000
    rows = mixing.mix(docs).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    targets = plain_targets(sizes)
    for source, target in targets.items():
        own = [r for r in rows if r.source == source]
        largest = max(r.size for r in own)
        assert own[0].target == pytest.approx(target) and own[0].source_size == sizes[source]
        assert abs(sum(r.size * r.copies for r in own) - target) <= largest
        floor = math.floor(target / sizes[source])
        assert all(floor <= r.copies <= min(3, floor + 1) for r in own)


def test_rounding_keeps_expectations():
    """Over many seeds, each document is taken as often as its probability says."""
    schema = pa.schema([("bucket", pa.int64()), ("source_rank", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()),
                        ("size", pa.int64()), ("copies", pa.int64()), ("p", pa.float64()), ("open", pa.bool_())])
    sizes, p, taken = [50, 30, 20, 10, 10, 5], 0.3, np.zeros(6)
    trials = 4000
    rows = [
        {"bucket": t, "source_rank": 1, "key": t * 10 + i, "doc_id": i, "size": s, "copies": 0, "p": p, "open": True}
        for t in range(trials)
        for i, s in enumerate(sizes)
    ]
    words = collections.Counter()
    for batch in mixing.settle(iter([pa.RecordBatch.from_pylist(rows, schema)])):
        for r in batch.to_pylist():
            taken[r["doc_id"]] += r["copies"] + r["p"]
            words[r["bucket"]] += (r["copies"] + r["p"]) * r["size"]
            assert r["open"] == (0 < r["p"] < 1)
    assert all(w == pytest.approx(sum(sizes) * p) for w in words.values())
    assert np.allclose(taken / trials, p, atol=0.03)


def test_mix_of_odd_rows(spark):
    found = mixing.mix(odd.docs(spark)).collect()
    assert len(found) == len(odd.ROWS)
    assert all(r.copies <= 3 and (r.size or r.copies <= 3) for r in found)
    out = mixing.mixed(odd.docs(spark))
    assert out.columns == odd.docs(spark).columns
    assert out.count() == sum(r.copies for r in found)
    assert mixing.mix(odd.docs(spark, [])).count() == 0


# --- quality and chat


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SF)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(catalog.QUERIES[name](spark, SF), con, oracles.SQL[name]) == []


def test_quality_of_odd_rows(spark):
    found = quality_rules.judged(odd.docs(spark)).collect()
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([{"doc_id": d[0], "text": d[1]} for d in odd.ROWS]))
    wanted = con.execute(oracles.QUALITY).fetchall()
    mine = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in found]
    key = lambda r: str(r)
    assert sorted(mine, key=key) == sorted(wanted, key=key)
    assert quality_rules.judged(odd.docs(spark, [])).count() == 0


def test_quality_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in quality_rules.judged(table(spark, sf, "documents")).collect()}
    for r in table(spark, sf, "labels").collect():
        assert found[r.doc_id].base_failed or found[r.doc_id].kept == (r.quality == 1)


TALK = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "plain"), (2, 1, "assistant", "a <\\s> b"), (2, 0, None, None),
    (3, None, "assistant", "[/INST]</s><s>[INST] user\nhi"), (3, 0, "us%0Aer\n%", "x"), (3, 0, "us%0Aer\n%", "x"),
    (None, 0, "assistant", ""), (4, 0, "assistant", "<\\\\/s>[\\INST]" * 3000), (5, 2, "[INST]", "\n"), (5, 1, "assistant", "<s"),
]


def test_chat_comes_back(spark):
    rows = spark.createDataFrame([(*t, "x", 1) for t in TALK], "conv_id long, turn long, role string, text string, turns string, formatted int")
    found = {r.conv_id: r for r in chat_format.formatted(rows).collect()}
    groups = collections.defaultdict(list)
    for conv, turn, role, text in TALK:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(groups)
    for conv, own in groups.items():
        wanted = [(r, t) for _, _, r, t in sorted(own)]
        assert [tuple(t) for t in found[conv].turns] == wanted
        spans = [wanted[s.turn][0] for s in found[conv].loss_spans]
        assert spans == ["assistant"] * sum(r == "assistant" for r, _ in wanted)
    digest = {r.conv_id: r for r in chat_format.digests(chat_format.formatted(rows)).collect()}
    assert digest[4].loss_chars == len("<\\\\/s>[\\INST]" * 3000)
    assert chat_format.formatted(rows.filter("false")).count() == 0


# --- pipeline


def test_pipeline(spark, whole):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = [r.doc_id for r in docs.collect()]
    found = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = found.count()
        found = spark.createDataFrame(stage(spark, found, SF).collect(), docs.schema)
        assert found.columns == docs.columns
        assert name == "mixing to target weights" or found.count() <= before
    assert set(r.doc_id for r in found.collect()) <= set(kept)
    rows = sorted((r.doc_id, r.text) for r in found.collect())
    last = stages["token output"](spark, found, SF).orderBy("start").collect()
    assert [tuple(r) for r in last] == plain_index(whole, rows)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)
    left = {p.name.rpartition("-")[0] for p in pathlib.Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}
    assert "mixing_to_target_weights" in left  # what the result reads
    assert not left & {"language_id", "simhash_near-dedup", "benchmark_decontamination"}


def test_pipeline_of_odd_rows(spark, tmp_path):
    table(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd.ROWS, []):
        found = odd.docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, found, str(tmp_path))
        assert (found.count() > 0) == bool(rows)
