import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import as_rows, docs_frame, odd_docs

from toolpulse.llm import quality_rules as Q

LABELS = "doc_id long, quality int, toxic int, text string, score int"


def labels_frame(spark, rows):
    return spark.createDataFrame([(*r, "other", 1) for r in rows], LABELS)


def brute_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {p for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for p in (i, i + 1, i + 2)}
    return len(inside)


@pytest.mark.parametrize(
    "text, counts",
    [
        ("", (0, 0, 0, 0, 0)),
        (" \n\t \x0b\x0c\r", (0, 0, 0, 0, 0)),
        ("a a a a", (4, 4, 0, 0, 4)),
        ("a b c d a b c", (7, 7, 0, 0, 6)),
        ("é ü #x#\nz\n \nz\nz", (5, 9, 2, 2, 0)),
        ("<a> $5 & 10% | *", (6, 11, 7, 0, 0)),
    ],
)
def test_base_counts(text, counts):
    assert Q.base_counts(text, text.encode()) == counts


def test_repeats_are_those_of_a_counter():
    numbers = np.random.default_rng(3)
    for size in (0, 1, 2, 3, 4, 5, 50, 400):
        words = [b"w%d" % w for w in numbers.integers(0, 6, size)]
        assert Q.repeated_words(words) == brute_repeats(words)


def test_tokens_are_words_or_signs():
    hashes = Q.TokenHashes()
    hashes.limit = 2
    assert Q._tokens("Für 3$$ a-b\x01".lower().encode()) == ["für".encode(), b"3", b"$$", b"a", b"-", b"b"]
    assert len(Q.gram_buckets(b"One two", hashes)) == 3 and len(Q.gram_buckets(b"", hashes)) == 0
    assert Q.gram_buckets(b"one two three one", hashes).tolist() == Q.gram_buckets(b"ONE two three one", hashes).tolist()


def test_threshold_parts_good_from_bad():
    assert Q.best_threshold([(3, 5, 0), (-2, 0, 4), (1, 2, 1)]) == 1 * Q.BIN
    assert Q.best_threshold([(3, 5, 0)]) is None and Q.best_threshold([]) is None
    assert Q.best_threshold([(0, 1, 0), (9, 0, 1)]) == 0  # scores the wrong way round: keep the good
    assert Q.best_threshold([(0, 1, 9), (1, 1, 0)]) == 1 * Q.BIN


def clean(i):
    return " ".join(f"word{w}" for w in random.Random(i).choices(range(40), k=60 + i % 5))


def junk(i):
    return " ".join(f"word{w}$$$ |" for w in random.Random(-i).choices(range(40), k=60))


def test_junk_goes_and_clean_texts_stay_even_without_a_label(spark):
    rows = [(i, junk(i) if i % 4 == 0 else clean(i), "en", "s") for i in range(160)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(80)]
    out = {r["doc_id"]: r for r in Q.judge_documents(docs_frame(spark, rows), labels_frame(spark, labels)).collect()}
    assert all(out[i]["kept"] == (i % 4 != 0 and not out[i]["base_failed"]) for i in range(160))
    assert sum(r["kept"] for r in out.values()) > 80


def test_only_base_rules_without_labels(spark):
    docs = docs_frame(spark, [(1, clean(1), "en", "s"), (2, "short", "en", "s"), (3, junk(3), "en", "s")])
    for labels in ([], [(1, None, None), (None, 1, 0)], [(1, 1, 0), (9, 0, 0)]):
        out = Q.judge_documents(docs, labels_frame(spark, labels)).collect()
        assert all(r["kept"] != r["base_failed"] for r in out) and len(out) == 3


def test_labels_count_together_and_the_sample_is_bounded(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, None), (4, None, 1)] + [(i, 1, 0) for i in range(10, 400)]
    got = {r["doc_id"]: (r["trusted"], r["bad"]) for r in Q.labelled_sample(labels_frame(spark, rows)).collect()}
    assert (got[1], got[2], got[3]) == ((False, True), (False, False), (True, False)) and 4 not in got
    few = {r["doc_id"] for r in Q.labelled_sample(labels_frame(spark, rows), 50).collect()}
    assert 40 <= len(few) <= 50 and few < set(got)


def test_every_label_takes_part_in_the_fit(spark):
    """More labels than the bound that once was; the fit sees the ids of all trusted documents."""
    labels = spark.range(120_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    got = Q.labelled_sample(labels)
    assert got.count() == 120_000 and got.where("trusted AND NOT held_out").count() > 50_000


def test_odd_documents(spark):
    labels = labels_frame(spark, [(1, 1, 0), (5, 1, 0), (7, 0, 0)])
    out = Q.judge_documents(odd_docs(spark), labels)
    rows = out.collect()
    assert len(rows) == 10
    assert [r for r in rows if r["doc_id"] == 1][0] == [r for r in rows if r["doc_id"] == 1][1]
    assert all(r["base_failed"] and not r["kept"] and r["score"] is None for r in rows if r["doc_id"] in (2, 3, 4))
    assert Q.judge_documents(docs_frame(spark, []), labels_frame(spark, [])).collect() == []


def test_sql_twin_on_odd_and_plain_documents(spark):
    for docs, labels in (
        (odd_docs(spark), [(1, 1, 0), (5, 1, 0), (6, 0, 0), (7, 0, 0)]),
        (docs_frame(spark, [(i, junk(i) if i % 4 == 0 else clean(i), "en", "s") for i in range(120)]), [(i, int(i % 4 > 0), 0) for i in range(60)]),
    ):
        labels = labels_frame(spark, labels)
        base = duckdb.connect()
        for name, df in (("documents", docs), ("labels", labels)):
            frame = df.toPandas()
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            base.register(name, frame)
        out = Q.judge_documents(docs, labels)
        assert as_rows(out) == sorted(base.execute(Q.judge_sql()).fetchall(), key=str)
