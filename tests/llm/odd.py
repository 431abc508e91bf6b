"""Small tables of the cases that every operator must stand."""

WORDS = "the quick brown fox jumps over a lazy dog and then runs home to sleep for the rest of that long day"
LONG = " ".join(f"{w}{i % 97}" for i, w in enumerate(WORDS.split() * 1500))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row int, score double, size int, words string, "
    "copies int, places string, _key int, tags map<string,int>"
)


def _row(doc, text, lang="en", source="a"):
    return (doc, text, lang, source, len(text or ""), "k", 1, 0.5, 3, "w", 2, "p", 7, {"x": 1})


ROWS = [
    _row(1, WORDS),
    _row(1, WORDS),  # a repeated row
    _row(2, None),
    _row(3, ""),
    _row(4, " \n\t\r\x0b\x0c "),
    _row(5, LONG, source="b"),
    _row(6, WORDS, source=None),
    _row(None, "words of a row without an id " * 9, lang=None),
    _row(7, "Ünïcödé wörds ünd 中文 😀 <|endoftext|> \x00 it's", lang=None),
    _row(8, "\n".join([WORDS, "", WORDS, "short line", WORDS.replace("lazy", "idle")])),
    _row(2, "another text of an id that is taken", source="b"),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)
