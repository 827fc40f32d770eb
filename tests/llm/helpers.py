"""Small inputs that every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, keys string, score int"


def docs_frame(spark, rows):
    """Documents with columns beside their own that are named like inner ones."""
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), 7, "k", 1) for i, t, lang, src in rows], DOCS)


def odd_docs(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, a repeated row."""
    words = random.Random(5)
    long_text = " ".join("".join(words.choices("abcdefgh", k=5)) for _ in range(30_000))
    rows = [
        (1, "one two three four five six seven", "en", "a"),
        (1, "one two three four five six seven", "en", "a"),
        (2, None, "en", "b"),
        (3, "", "de", None),
        (4, " \n\t ", None, "c"),
        (5, long_text, "en", "a"),
        (6, long_text + " end", "en", "b"),
        (7, "12 34 !!", "fr", "c"),
        (None, "one two three four five six seven", "en", "d"),
        (None, None, None, None),
    ]
    return docs_frame(spark, rows)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
