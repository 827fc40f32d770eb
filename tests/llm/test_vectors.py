"""Near-duplicate vectors and exact top-k."""

import numpy as np
import pytest
from helpers import as_rows
from oracle_check import compare, connect

from toolpulse.llm import embedding_dups, queries, topk

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, rep string, v int"


@pytest.mark.parametrize("name", ["op3_embedding_near_dedup", "op6_exact_top_k"])
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), queries.ORACLES[name], connect(SF)) is None


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", 2) for i, v in rows], VECTORS)


def cloud(seed, centres, around, noise, width=32):
    rnd = np.random.default_rng(seed)
    out = []
    for c in rnd.standard_normal((centres, width)):
        c /= np.linalg.norm(c)
        out += [c + noise * rnd.standard_normal(width) for _ in range(around)]
    return np.array(out, dtype=np.float32)


def brute_force(vectors, cosine=0.9):
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        near = np.where(linked, label[None, :], len(x)).min(axis=1, initial=len(x))
        new = np.minimum(label, near)
        if (new == label).all():
            return linked, label
        label = new


def test_links_against_brute_force(spark, monkeypatch):
    """Groups with cosines around the threshold, in small blocks; recall 0.9 at least, no false link."""
    for name in ("BUCKET_BLOCK", "EXACT_BLOCK"):
        monkeypatch.setattr(embedding_dups, name, 16)
    vectors = np.concatenate([cloud(1, 6, 40, 0.055), cloud(2, 60, 3, 0.04), cloud(3, 60, 1, 0)])
    linked, label = brute_force(vectors)
    got = {r[0]: r for r in as_rows(embedding_dups.near_duplicates(frame(spark, list(enumerate(vectors)))))}
    wanted = linked.sum(axis=1)
    found = np.array([got[i][1] for i in range(len(vectors))])
    assert (found <= wanted).all() and found.sum() >= 0.97 * wanted.sum()
    agree = np.mean([got[i][2] == label[i] for i in range(len(vectors))])
    assert agree >= 0.97


def test_odd_vectors_link_with_nothing(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, a), (2, a), (3, [2 * x for x in a]), (4, b), (5, None), (6, [0, 0, 0]), (7, [1, None, 3]), (8, [1, float("nan"), 3])]
    rows += [(9, [float("inf"), 2, 3]), (10, []), (11, [1.0, 2.0]), (None, a), (12, [1e-30, 2e-30, 3e-30]), (13, [1e38, 2e38, 3e38])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dups.near_duplicates(frame(spark, rows)).collect()}
    assert got[1] == (4, 1, True)
    assert {got[i] for i in (2, 3, 12, 13)} == {(4, 1, False)}
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert got[None][:2] == (0, None)
    assert embedding_dups.near_duplicates(frame(spark, [])).count() == 0


def test_hot_copies_count_without_pairs(spark):
    got = embedding_dups.near_duplicates(frame(spark, [(i, [1.0, 1.0]) for i in range(3000)] + [(9000, [1.0, 1.01])]))
    assert got.where("n_links = 3000 AND component_id = 0").count() == 3001


def test_spanning_edges_connect_what_near_connects():
    rnd = np.random.default_rng(4)
    near = rnd.random((60, 60)) < 0.02
    near |= near.T
    np.fill_diagonal(near, False)
    a, b = embedding_dups.spanning_edges(np.arange(60), near.__getitem__)
    full, few = np.eye(60, dtype=bool) | near, np.eye(60, dtype=bool)
    few[a, b] = few[b, a] = True
    power = lambda m: np.linalg.matrix_power(m.astype(float), 60) > 0
    assert (power(full) == power(few)).all() and len(a) < 60


def test_runs_cross_batches():
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 3, 4, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 3], "v": list(range(i, min(i + 3, 8)))}) for i in (0, 3, 6)]
    got = [(t.column("k")[0].as_py(), t.column("v").to_pylist()) for t in embedding_dups._runs(batches, 1)]
    assert got == [(1, [0, 1]), (2, [2, 3, 4]), (3, [5]), (4, [6, 7])]


def exact_top(vectors, ids, k, every):
    whole = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64)
    rows = []
    for i, q in zip(ids, whole):
        if i % every == 0:
            order = sorted(((-int(q @ w), j) for j, w in zip(ids, whole) if j != i))[:k]
            rows += [(i, r + 1, j, -s) for r, (s, j) in enumerate(order)]
    return sorted(rows)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK_VALUES", 500)
    monkeypatch.setattr(topk, "QUERY_VALUES", 100)
    monkeypatch.setattr(topk, "RANGE", 5)
    vectors = np.concatenate([cloud(7, 20, 10, 0.05, 16), np.zeros((30, 16), dtype=np.float32)])  # many ties
    ids = [3 * i for i in range(len(vectors))]
    got = topk.top_k_of_table(frame(spark, list(zip(ids, vectors))), every=9, k=7)
    assert sorted(map(tuple, got.collect())) == exact_top(vectors, ids, 7, 9)


def test_top_k_of_odd_rows(spark):
    rows = [(100, [1, 2]), (100, [1, 2]), (1, [1.0]), (2, None), (3, [float("nan"), 1]), (4, [None, 1]), (None, [1, 1]), (5, [-1, -1]), (6, [])]
    got = sorted(map(tuple, topk.top_k_of_table(frame(spark, rows)).collect()))
    m = 1024 * 1024
    assert got == [(100, 1, 1, m), (100, 2, 6, 0), (100, 3, 5, -3 * m)]
    assert topk.top_k_of_table(frame(spark, [])).count() == 0
    assert topk.top_k_of_table(frame(spark, [(1, [1, 2])])).count() == 0
    large = frame(spark, [(0, [2e6, 2e6]), (1, [2e6, 1e6])])
    assert [tuple(r) for r in topk.top_k_of_table(large).collect()] == [(0, 1, 1, 6 * 1024 * 1024 * 10**12)]


def test_stated_recall_at_the_threshold():
    """The p-stable formula at the threshold is what the docstring says."""
    from math import erfc, exp, pi, sqrt

    from toolpulse.llm import embedding_dups as e

    x = e.WIDTH / sqrt(2 - 2 * e.COSINE)
    step = 1 - erfc(x / sqrt(2)) - 2 / (sqrt(2 * pi) * x) * (1 - exp(-x * x / 2))
    recall = 1 - (1 - step**e.PER_TABLE) ** e.TABLES
    assert f"{recall:.3f}" in e.__doc__


def test_many_vectors_against_brute_force(spark, monkeypatch):
    """The buckets for many vectors, cut in small blocks: recall 0.97 at least, no false link, copies counted."""
    monkeypatch.setattr(embedding_dups, "FEW_VECTORS", 0)
    for name in ("CROSS_BLOCK", "EXACT_BLOCK", "SMALL_RUN", "TILE"):
        monkeypatch.setattr(embedding_dups, name, 8)
    vectors = np.concatenate([cloud(1, 6, 40, 0.055), cloud(2, 60, 3, 0.04), cloud(3, 60, 1, 0)])
    vectors = np.concatenate([vectors, vectors[:30], -vectors[-20:]])
    linked, label = brute_force(vectors)
    got = {r[0]: r for r in as_rows(embedding_dups.near_duplicates(frame(spark, list(enumerate(vectors)))))}
    wanted, found = linked.sum(axis=1), np.array([got[i][1] for i in range(len(vectors))])
    assert (found <= wanted).all() and found.sum() >= 0.97 * wanted.sum()
    assert np.mean([got[i][2] == label[i] for i in range(len(vectors))]) >= 0.97


def test_many_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "FEW_VECTORS", 0)
    test_odd_vectors_link_with_nothing(spark)
    test_hot_copies_count_without_pairs(spark)


@pytest.mark.parametrize("share", [0.0, 0.02, 1.0])
def test_bucket_links_connect_the_near_rows_of_a_bucket(monkeypatch, share):
    monkeypatch.setattr(embedding_dups, "TILE", 16)
    rnd = np.random.default_rng(5)
    bucket = np.sort(np.concatenate([rnd.integers(0, 30, 150), np.full(200, 30), np.full(300, 31)]))
    signs = rnd.integers(0, 2**63, (len(bucket), 4), dtype=np.uint64)
    like = rnd.random(len(bucket)) < share
    signs[like] = signs[0] ^ (np.uint64(1) << rnd.integers(0, 63, (like.sum(), 4), dtype=np.uint64))
    a, b = embedding_dups.bucket_links(bucket, signs)
    assert (bucket[a] == bucket[b]).all() and len(a) <= len(bucket)
    near = np.bitwise_count(signs[:, None, :] ^ signs[None, :, :]).sum(axis=2) <= embedding_dups.CROSS_APART
    near &= bucket[:, None] == bucket[None, :]
    few = np.eye(len(bucket))
    few[a, b] = few[b, a] = 1
    reach = lambda m: np.linalg.matrix_power(np.minimum(m, 1) / len(m), 16) > 0
    assert (reach(near.astype(float)) == reach(few)).all()


def test_stated_recall_of_nearest_axes():
    """Two vectors at the cosines of the docstring share a bucket as often as it says."""
    e, rnd = embedding_dups, np.random.default_rng(6)
    for cosine, stated in ((0.90, 0.992), (0.91, 0.995), (0.92, 0.997), (0.95, 0.9999)):
        assert str(stated) in e.__doc__
        one = rnd.standard_normal((60_000, e.AXES), dtype=np.float32)
        other = cosine * one + (1 - cosine**2) ** 0.5 * rnd.standard_normal(one.shape, dtype=np.float32)
        i, j = abs(one).argmax(axis=1), abs(other).argmax(axis=1)
        every = np.arange(len(one))
        p = np.mean((i == j) & (np.sign(one[every, i]) == np.sign(other[every, j])))
        assert 1 - (1 - p**e.CROSS_PER_TABLE) ** e.CROSS_TABLES == pytest.approx(stated, abs=0.001)
