"""Exact inner-product top-k with block-at-a-time pruning.

Candidates are dealt into chunks of bounded size, queries into blocks, and each
task takes one chunk and one block. Inside, candidates lie in ranges of similar
vectors. A range's bound for a query is the sum, over the dimensions, of the
query's weight times the greatest (for negative weights the least) component in
the range. Ranges are scored from the highest bound down, through the range's
own vectors, until the next bound falls below the query's kth score.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolpulse.llm.vectors import is_finite, matrix
from toolpulse.sources.durable import materialise

CHUNK_VALUES = 1 << 16  # components of a chunk of candidates
QUERY_VALUES = 1 << 16  # components of a block of queries
RANGE = 64  # candidates of a range
K = 10


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): components floor(scale * x); rows that take no part are left out.

    Those are null ids, null vectors and vectors with null or non-finite
    components. Rows of one vec_id count as one, the least vector.
    """
    valid = vectors.where(F.col("vec_id").isNotNull() & is_finite(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return valid.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _ranges(ids: np.ndarray, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Runs of vectors that agree in their largest component."""
    if vectors.shape[1]:
        place = abs(vectors).argmax(axis=1)
        peak = vectors[np.arange(len(vectors)), place]
        order = np.lexsort((peak, place))
        ids, vectors = ids[order], vectors[order]
    return [(ids[i : i + RANGE], vectors[i : i + RANGE]) for i in range(0, len(ids), RANGE)]


def search_chunk(ids, vectors, query_ids, queries, k: int) -> tuple[list, list, list]:
    """(query id, id, score) of each query's k best in the chunk, ties to smaller ids."""
    width = max(vectors.shape[1], queries.shape[1])
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    largest = float(abs(vectors).max(initial=0)) * float(abs(queries).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < 2**53 else np.int64  # doubles are exact there
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    ranges = _ranges(ids, vectors)
    high = np.stack([v.max(axis=0) for _, v in ranges])
    low = np.stack([v.min(axis=0) for _, v in ranges])
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    out_query, out_id, out_score = [], [], []
    for own, query, bound in zip(query_ids, queries, bounds):
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=kind)
        for r in np.argsort(-bound, kind="stable"):
            if len(best) == k and bound[r] < best[-1]:
                break
            range_ids, range_vectors = ranges[r]
            scores = range_vectors @ query
            keep = range_ids != own
            if len(best) == k:
                keep &= scores >= best[-1]
            if keep.any():
                best_ids, best = np.concatenate([best_ids, range_ids[keep]]), np.concatenate([best, scores[keep]])
                order = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[order], best[order]
        out_query += [int(own)] * len(best)
        out_id += best_ids.tolist()
        out_score += map(int, best.tolist())
    return out_query, out_id, out_score


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best candidates but itself.

    Both inputs are (vec_id, v) with v an array of longs, ids unique; vectors of
    different sizes count as filled with zeros. Fewer than k candidates give
    fewer rows, an empty input gives none. Scores are exact within 64 bits.
    """
    sizes = lambda df: df.agg(F.coalesce(F.sum(F.greatest(F.size("v"), F.lit(1))), F.lit(0))).first()[0]
    chunks, blocks = -(-sizes(candidates) // CHUNK_VALUES) or 1, -(-sizes(queries) // QUERY_VALUES) or 1
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.select("vec_id", "v", part(chunks).alias("chunk")).withColumn("block", every(blocks))
    right = queries.select("vec_id", "v", part(blocks).alias("block")).withColumn("chunk", every(chunks))

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        rows = ([], [], [])
        if found.num_rows and asked.num_rows:
            sides = [(t.column("vec_id").to_numpy(), matrix(t.column("v"), np.int64)) for t in (found, asked)]
            rows = search_chunk(*sides[0], *sides[1], k)
        return pa.table([pa.array(c, pa.int64()) for c in rows], names=["query_id", "vec_id", "score"])

    grouped = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block"))
    best = grouped.applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k_of_table(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """The k best of all rows for the rows whose id is divisible by ``every``."""
    points = materialise(quantised(vectors), "quantised")
    return top_k(points, points.where(F.col("vec_id") % every == 0), k)


def top_k_sql(every: int = 100, k: int = K) -> str:
    """The same by scoring all, in DuckDB SQL over ``embeddings`` with unique ids."""
    return f"""WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
        FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
      SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
