"""Line deduplication by an exact set-similarity join, in built-in functions alone.

A line is the set of its five-word shingles (all its words, if fewer). Shingles are ordered by rarity: by the class of
frequency of their hash bucket, which is that of its most frequent shingle among all lines, then by hash. Any
order gives the same result; with this one, passages that many lines share come last. Lines whose Jaccard similarity reaches the threshold share a shingle among the first n - ceil(t * n) + 1 of
each; sizes (length filter) and places of the shared shingle (positional filter) rule out most pairs, and
the rest are verified on the words. A line goes if an earlier one is as similar.

A large group of variants does not make all its pairs: lines meet the earliest line of each posting and the one
before them first, and only those that are not similar to any of these meet the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.text import BLANKS, drop_finished_shuffles, packed, text_key
from footfall.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
BUCKETS = 1 << 16
CLASS_BITS = 6
ID = ["doc_id", "key", "pos", "k1"]


def line_words(line: Column) -> Column:
    """Words in lower case; other blanks are rare, and a split at one character is much cheaper."""
    spaced = F.when(line.rlike(r"[\x09-\x0D]"), F.regexp_replace(line, BLANKS, " ")).otherwise(line)
    return F.array_remove(F.split(F.lower(spaced), " "), "")


def n_starts(words: Column, size: int) -> Column:
    return F.greatest(F.size(words) - (size - 1), F.lit(1))


def starts(words: Column, size: int) -> Column:
    return F.sequence(F.lit(1), n_starts(words, size))


def shingles(words: Column, size: int = SHINGLE) -> Column:
    """Different shingles, joined by blanks."""
    return F.array_distinct(F.transform(starts(words, size), lambda i: F.concat_ws(" ", *_window(words, i, size))))


def _window(words: Column, start: Column, size: int) -> list[Column]:
    """Words from `start`, counted from 1, each by its place: `slice` would read the whole line each time."""
    return [F.get(words, start + (j - 1)) for j in range(size)]


def hashed(words: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*_window(words, start, size))


def all_hashed(words: Column, size: int) -> Column:
    """Hashes of the different shingles, never null."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, size)]))
    return F.array_distinct(F.slice(each, F.lit(1), n_starts(words, size)))


def lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, pos, words, k1): every line with a word, a hash of its text, its place from 0, and a hash of its words.

    Lines are equal where `k1` and the rarest shingle's hash, 121 bits in all, are equal.
    """
    rows = docs.select(F.col(doc).alias("doc_id"), text_key(text).alias("key"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    # A condition on `words` would be moved below them and split each line twice.
    rows = rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select("doc_id", "key", "pos", line_words(F.col("line")).alias("words")).withColumn("k1", F.xxhash64("words"))


def rarity(rows: DataFrame, size: int = SHINGLE) -> Column:
    """Frequency classes of all buckets as one constant, in a token's upper bits: BUCKETS numbers, whatever the data's size.

    A bucket has the class of its most frequent shingle among `rows`: its sum would hide a passage of some hundred lines
    behind the shingles that come once.
    """
    # Exploded, the hashes are compiled with the scan; nothing but hashes and counts is shuffled.
    each = rows.select("words", F.explode(starts(F.col("words"), size)).alias("i"))
    counts = each.groupBy(hashed(F.col("words"), F.col("i"), size).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written, so that the shuffle of all hashes can go before the next begins.
    most = materialise(counts.groupBy(_bucket(F.col("h")).alias("b")).agg(F.max("n").alias("n")), "bucket_counts")
    top = (1 << CLASS_BITS) - 1
    classes = ["0"] * BUCKETS
    for r in most.select("b", F.least(F.lit(top), F.floor(2 * F.log2("n"))).alias("c")).collect():
        classes[r.b] = str(r.c << (63 - CLASS_BITS))
    return F.expr(f"cast(split('{','.join(classes)}', ',') as array<bigint>)")


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def prefixes(rows: DataFrame, classes: Column, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(token, doc_id, pos, k1, n, at): the rarest shingles of each line with their place from 1."""
    # Without nulls, an array of numbers is sorted as such.
    upper = lambda h: F.coalesce(F.get(classes, _bucket(h)), F.lit(0).cast("long"))
    token = lambda h: upper(h).bitwiseOR(F.shiftrightunsigned(h, CLASS_BITS + 1))
    hashes = rows.select(*ID, all_hashed(F.col("words"), size).alias("hashes"))
    ordered = hashes.select(*ID, F.sort_array(F.transform("hashes", token)).alias("tokens"))
    n = F.size("tokens")
    first = F.slice("tokens", 1, (n - F.ceil(n * F.lit(threshold)) + 1).cast("int"))
    return ordered.select(*ID, n.alias("n"), F.posexplode(first).alias("at", "token")).withColumn("at", F.col("at") + 1)


def may_match(a: str, b: str, threshold: float) -> Column:
    """Length, positional and sketch filters for rows `a` and `b` that share a token.

    Every shingle that only one line has flips one of the sketches' 128 bits, so that lines differ in no fewer shingles
    than their sketches differ in bits.
    """
    c = lambda name: (F.col(f"{a}.{name}"), F.col(f"{b}.{name}"))
    (m, n), (i, j), (p0, q0), (p1, q1) = c("n"), c("at"), c("b0"), c("b1")
    sizes = (m >= n * F.lit(threshold)) & (n >= m * F.lit(threshold))
    most = F.least(i, j) + F.least(m - i, n - j)
    differ = F.bit_count(p0.bitwiseXOR(q0)) + F.bit_count(p1.bitwiseXOR(q1))
    allowed = (m + n) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-9)
    return sizes & (most >= F.lit(threshold / (1 + threshold)) * (m + n) - F.lit(1e-9)) & (differ <= allowed)


def postings(prefix: DataFrame) -> DataFrame:
    """The rows of tokens that several different lines have, `lead` for the earliest of these lines; and, marked `equal`,
    the first row of each line that an earlier one is equal to.

    Of equal lines only the earliest is in a posting. Rows of a token are ordered on disk where they do not fit.
    """
    sizes = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("at").cast("long"))
    dealt = prefix.select("token", *ID, sizes.alias("sizes")).repartition("token")  # for all windows
    row = F.struct(*ID, "sizes")
    token, line = Window.partitionBy("token"), Window.partitionBy("token", "k1")
    several = F.max("k1").over(token) != F.min("k1").over(token)
    rows = dealt.withColumn("own", F.min(row).over(line)).withColumn("first", F.min(row).over(token)).withColumn("several", several)
    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    high = lambda c: F.shiftright(F.col(c), 32).cast("int")
    at, equal = low("sizes"), F.struct(*ID) != F.struct(*[F.col(f"own.{c}").alias(c) for c in ID])
    return (
        rows.withColumn("equal", equal)
        .filter((F.col("several") & (F.col("own") == row)) | (F.col("equal") & (at == 1)))
        .select(
            "equal", "token", *ID, high("sizes").alias("n"), at.alias("at"), (F.col("first") == row).alias("lead"),
        )
        .distinct()
    )


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Lines (doc_id, pos, k1) of (x, y) pairs whose shingles have the wanted similarity, each once."""
    pairs = materialise(pairs.distinct(), "pairs")
    # Only words of these lines are sent, once for both sides.
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("line")).distinct()
    own = texts.select(F.struct(*ID).alias("line"), "words").join(wanted, "line", "left_semi").dropDuplicates(["line"])
    side = lambda c: own.select(F.col("line").alias(c), F.col("words").alias(f"{c}_words"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    a, b = shingles(F.col("x_words"), size), shingles(F.col("y_words"), size)
    shared = F.size(F.array_intersect(a, b))
    similar = shared >= F.lit(threshold) * (F.size(a) + F.size(b) - shared) - F.lit(1e-9)
    return both.filter(similar).select("x.*").distinct()


def sketch(hashes: Column, half: int) -> Column:
    """Half of a line's sketch: the parity of its different shingles in each of 64 bits, by their hashes."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    own = lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(1)) == half
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: F.when(own(h), a.bitwiseXOR(bit(h))).otherwise(a))


def near_lines(docs: DataFrame, posts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, pos, k1) of lines to which an earlier, different line is similar; of equal lines the earliest."""
    wanted = posts.select(*ID).distinct()
    # Equal structs may have nulls. A broadcast that proves too large would have documents and lines dealt once more.
    doc = F.struct("doc_id", "key").alias("doc")
    by_doc = wanted.groupBy(doc).agg(F.collect_set("pos").alias("places"))  # lines of one document
    holders = docs.select(F.struct("doc_id", text_key().alias("key")).alias("doc"), "text").join(by_doc.hint("merge"), "doc")
    found = holders.select(
        "doc", F.inline(F.filter(
            F.transform(F.split("text", "\n"), lambda l, i: F.struct(i.alias("pos"), l.alias("line"))),
            lambda r: F.array_contains("places", r["pos"]),
        )),
    )
    texts = found.select("doc", "pos", line_words(F.col("line")).alias("words")).withColumn("k1", F.xxhash64("words"))
    # A document that comes twice has its lines twice; they become one where they are dealt by line.
    texts = texts.select("doc.*", "pos", "k1", "words", all_hashed(F.col("words"), size).alias("h"))
    h = F.col("h")
    texts = texts.select(*ID, "words", F.size(h).alias("n"), sketch(h, 0).alias("b0"), sketch(h, 1).alias("b1"))
    texts = materialise(texts, "line_words")
    drop_finished_shuffles(docs.sparkSession)

    # With the sketches beside them, rows of a token are compared where they meet, and only plausible pairs become rows.
    own = texts.select(*ID, "b0", "b1").distinct().alias("o")
    posts = posts.join(own, [posts[c].eqNullSafe(F.col(f"o.{c}")) for c in ID]).select(*[posts[c] for c in posts.columns], "b0", "b1")
    posts = materialise(posts, "line_postings")
    drop_finished_shuffles(docs.sparkSession)

    line = lambda s: F.struct(*[F.col(f"{s}.{c}").alias(c) for c in ID])
    same, similar = F.col("l.token") == F.col("r.token"), may_match("l", "r", threshold)
    pair = line("l").alias("x"), line("r").alias("y")
    ahead = posts.filter("not lead").alias("l").join(posts.filter("lead").alias("r"), same & similar)
    # Variants may be far from the earliest line of a posting and close to the one before them.
    row = F.struct(*posts.columns)
    beside = posts.select(row.alias("l"), F.lag(row).over(Window.partitionBy("token").orderBy(F.struct(*ID))).alias("r"))
    beside = beside.filter(F.col("r").isNotNull() & (line("r") < line("l")) & similar)
    met = ahead.select(*pair).unionByName(beside.select(*pair))
    early = materialise(verified(met, texts, threshold, size), "early_matches")

    left = posts.join(early, [posts[c].eqNullSafe(early[c]) for c in ID], "left_anti")
    rest = left.alias("l").join(posts.alias("r"), same & (line("r") < line("l")) & similar)
    late = verified(rest.select(*pair), texts, threshold, size)
    return early.unionByName(late)


def duplicate_lines(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key, pos, kind): lines to take out, `equal` to an earlier line or `near` one; `key` is a hash of the text.

    Earlier is by document id, null first, then by that hash and by place. Lines without a word stay. Rows with equal id
    and text are one document; rows of one id with different texts are several. Texts of any length are read whole, an
    empty table has no lines, and other columns are not read.
    """
    classes = rarity(lines(docs), size)
    drop_finished_shuffles(docs.sparkSession)
    found = materialise(postings(prefixes(lines(docs), classes, threshold, size)), "postings")
    drop_finished_shuffles(docs.sparkSession)
    later = found.filter("equal").select("doc_id", "key", "pos", F.lit("equal").alias("kind"))
    near = near_lines(docs, found.filter("not equal").drop("equal"), threshold, size)
    return later.unionByName(near.select("doc_id", "key", "pos", F.lit("near").alias("kind"))).distinct()


def _of_row(id_: str, key: str) -> Column:
    return F.col(id_).eqNullSafe(F.col("g.doc_id")) & (F.col(key) == F.col("g.key"))


def line_counts(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_lines, n_equal, n_near, removed) for every row; null and empty texts have no lines to remove."""
    gone = duplicate_lines(docs, threshold, size)
    count = lambda kind: F.count_if(F.col("kind") == kind)
    by_doc = gone.groupBy("doc_id", "key").agg(
        count("equal").alias("e"), count("near").alias("n"), F.sort_array(F.collect_list("pos")).alias("removed")
    ).alias("g")
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    rows = docs.select(F.col("doc_id").alias("id"), text_key().alias("own"), F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    return rows.join(by_doc, _of_row("id", "own"), "left").select(
        F.col("id").alias("doc_id"),
        "n_lines",
        F.coalesce("e", F.lit(0)).alias("n_equal"),
        F.coalesce("n", F.lit(0)).alias("n_near"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The documents without their duplicate lines; columns stay, and so do null texts."""
    gone = duplicate_lines(docs, threshold, size).groupBy("doc_id", "key").agg(F.collect_set("pos").alias("_gone")).alias("g")
    keyed = docs.select(packed(docs).alias("d"), F.col("doc_id").alias("id"), text_key().alias("own"))
    joined = keyed.join(gone, _of_row("id", "own"), "left")
    kept = F.filter(F.split(F.col("d.text"), "\n"), lambda line, i: ~F.array_contains("g._gone", i))
    text = F.when(F.col("g._gone").isNull(), F.col("d.text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns])
