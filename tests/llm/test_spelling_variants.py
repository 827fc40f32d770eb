import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import as_rows, docs_frame, odd_docs

from toolpulse.llm import spelling_variants as V


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßé"


def edits_of(w, words):
    letters = LETTERS
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    made = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}
    return [v for v in made if v in words and v != w]


def brute(rows, every=None, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if every:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_length}
    near = {w: edits_of(w, words) if len(words) > 1000 else [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v.encode())) if vs else None for w, vs in near.items()}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def variants_of(count, seed, alphabet="abcdé", lengths=(5, 9)):
    """Words with many neighbours, of falling frequency."""
    rng = random.Random(seed)
    words = {"".join(rng.choices(alphabet, k=rng.randint(*lengths))) for _ in range(count)}
    for word in list(words):
        at = rng.randrange(len(word))
        words |= {word[:at] + rng.choice(alphabet) + word[at + 1 :], word[:at] + word[at + 1 :], word + rng.choice(alphabet)}
    return {w: 3 * 2 ** rng.randint(0, 5) + rng.randint(0, 2) for w in sorted(words)}


def docs_of(spark, words, parts=7):
    rng = random.Random(1)
    flat = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(flat)
    rows = [(i, " ".join(flat[i::parts]), "en", "s") for i in range(parts)]
    return docs_frame(spark, rows), [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("limit", [V.LIMIT, 4])
def test_equals_all_pairs(spark, limit):
    """Small limits split the groups again and again."""
    docs, rows = docs_of(spark, variants_of(60, 4))
    assert as_rows(V.spelling_variants(docs, limit=limit)) == brute(rows)


def test_every_pair_meets_in_one_group(spark):
    words = variants_of(50, 9, "ab", (5, 8))
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    for limit in (V.LIMIT, 8):
        for tile in (V.TILE, 4):
            near = V.near_words(V.grouped(frame, limit), tile).select("word", "near").collect()
            assert len(near) == len(set(near))
            assert {tuple(r) for r in near} == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_words_of_one_group_only(spark):
    """A hot prefix: all words share all but the end."""
    words = {f"common{a}{b}": 3 for a in "abcdefghij" for b in "klmnopqrst"}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = V.near_words(V.grouped(frame, 16), 8).select("word", "near").collect()
    assert len(near) == len(set(near)) == 100 * 18


def test_tiles_measure_both_ends():
    left, right = ["abcde", "abcd", "xbcde", "aébc"], ["abcde", "bcde", "abcdef", "aèbc"]
    kinds = np.array([[0] * 4, [0] * 4, [0] * 4, [99] * 4])
    for longer in range(3, 8):
        kinds[0] = longer
        a, b = V.Tile(left, np.ones(4), kinds), V.Tile(right, np.ones(4), kinds)
        found = {(left[i], right[j]) for i, j in a.near(b)}
        assert found == {(x, y) for x in left for y in right if one_edit(x, y) and max(len(x), len(y)) == longer}


def test_deleted_letters_and_runs(spark):
    rows = [(i, "Straße straße Wörter_wörter x1y abcdefgh " * 3, "de", "s") for i in range(40)] + [(None, "Größe " * 5, "de", "s")]
    for every in (2, 97):
        assert as_rows(V.spelling_variants(docs_frame(spark, rows), delete_every=every)) == brute([r[:2] for r in rows], every)


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"wordz": 10, "wordé": 10, "word": 5, "wordx": 4}
    docs, rows = docs_of(spark, words)
    got = {r["word"]: (r["form"], r["n_near"]) for r in V.spelling_variants(docs, min_length=4).collect()}
    assert got["word"] == ("wordz", 3) and got["wordx"] == ("wordz", 3) and got["wordz"] == (None, 3)


def test_chain_of_forms(spark):
    docs, rows = docs_of(spark, {"abcde": 3, "abcdef": 6, "abcdefg": 12, "abcdefgh": 24, "abcdefghi": 48, "abcdefghij": 96})
    out = {r["word"]: r["root"] for r in V.spelling_variants(docs).collect()}
    assert set(out.values()) == {"abcdefghij"} and len(out) == 6
    assert as_rows(V.spelling_variants(docs)) == brute(rows)


def test_odd_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs(spark).select("doc_id", "text").collect()]
    assert as_rows(V.spelling_variants(odd_docs(spark), min_count=2)) == brute(rows, min_count=2)
    assert V.spelling_variants(docs_frame(spark, [])).collect() == []


def test_very_long_words(spark):
    word = "".join(random.Random(2).choices("abcdefgh", k=20_000))
    words = {word: 6, word[:700] + word[701:]: 3, word + "x": 3, word[::-1]: 3}
    docs, rows = docs_of(spark, words)
    assert as_rows(V.spelling_variants(docs)) == brute(rows)


def test_sql_twin(spark):
    docs, rows = docs_of(spark, variants_of(50, 6))
    for frame, minimum in ((docs, 3), (odd_docs(spark), 2)):
        base = duckdb.connect()
        table = frame.toPandas()
        table["doc_id"] = table["doc_id"].astype("Int64")
        base.register("documents", table)
        wanted = base.execute(V.variants_sql(5, 5, minimum)).fetchall()
        assert as_rows(V.spelling_variants(frame, min_count=minimum, delete_every=5)) == sorted(wanted, key=str)
