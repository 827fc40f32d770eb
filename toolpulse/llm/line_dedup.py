"""Removal of lines that spread over many sites.

Every line has a HyperLogLog sketch of the sites (``source``) it occurs on;
partial sketches of a line merge by aggregation. The estimate decides lines far
from the threshold; those near it get an exact distinct count. A line on at
least ``min_sites`` sites is boilerplate: its first occurrence, in the smallest
doc_id, stays and all others go.

Only lines that occur ``min_sites`` times or more can reach that many sites, so
a plain count goes first and the sketches are built for those lines alone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse.llm.common import SALTS, salted_join
from toolpulse.sources.durable import materialise

MIN_SITES = 5
LOG_K = 12  # standard error 1.6 %
MARGIN = 0.25  # estimates within this share of the threshold are counted exactly
LINE = ["h1", "h2"]
DOC = ["rid", "rh"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _keyed(docs: DataFrame) -> DataFrame:
    """A row's key: id and text. Equal rows share one and get the same decision."""
    return docs.withColumns(
        {"rid": F.coalesce("doc_id", F.lit(0)).cast("long"), "rh": F.xxhash64(F.col("doc_id").isNull(), "text")}
    )


def _occurrences(docs: DataFrame) -> DataFrame:
    lines = _keyed(docs.select("doc_id", "text", "source")).select(
        "doc_id", "source", *DOC, F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    lines = lines.withColumn("line", F.trim("line")).where("line <> ''")
    hashes = {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), "line")}
    return lines.withColumns(hashes).drop("line")


def spread_lines(occurrences: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2) of the lines on ``min_sites`` sites or more. A null source is no site."""
    salt = F.pmod(F.xxhash64("rid"), F.lit(SALTS)).alias("salt")
    parts = occurrences.groupBy(*LINE, salt).agg(F.hll_sketch_agg("source", LOG_K).alias("sketch"))
    sketches = parts.groupBy(*LINE).agg(F.hll_union_agg("sketch").alias("sketch"))
    sites = materialise(sketches.select(*LINE, F.hll_sketch_estimate("sketch").alias("sites")), "line-sites")
    low, high = min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)
    near = sites.where(F.col("sites").between(low, high)).select(*LINE)
    exact = salted_join(occurrences.where("source IS NOT NULL"), near, LINE, F.col("rid"), "left_semi")
    exact = exact.select(*LINE, "source").distinct().groupBy(*LINE).count().where(F.col("count") >= min_sites)
    return sites.where(F.col("sites") > high).select(*LINE).union(exact.select(*LINE))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """All input rows and columns, ``text`` without repeated boilerplate, ``n_lines`` and ``n_removed`` added.

    A line is a piece between newlines, compared without outer spaces; blank
    lines never count. Null and empty texts come back as they are, with 0
    removed (null has 0 lines). A null doc_id counts as the smallest. Equal rows
    get equal results. Columns of the input named like an added one are replaced.
    """
    occurrences = _occurrences(docs)
    often = occurrences.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select(*LINE)
    repeated = materialise(salted_join(occurrences, often, LINE, F.col("rid"), "left_semi"), "repeated-lines")
    boilerplate = materialise(spread_lines(repeated, min_sites), "boilerplate")
    gone = salted_join(repeated, boilerplate, LINE, F.col("rid"), "left_semi")
    first = gone.groupBy(*LINE).agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))
    removed = salted_join(gone, first, LINE, F.col("rid"), "inner").where(~is_first)
    removed = removed.groupBy(*DOC).agg(F.collect_set("pos").alias("__gone"))
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    keyed = _keyed(docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in own]).alias("own")))
    joined = keyed.join(removed, DOC, "left")
    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    return joined.select(
        *[F.col("own")[c].alias(c) for c in own],
        F.when(F.col("__gone").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
        .alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def dedup_sql(docs: str = "documents", min_sites: int = MIN_SITES) -> str:
    """doc_id, text, n_lines and n_removed in DuckDB SQL; ``docs`` has unique ids."""
    return f"""WITH src AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS lines FROM {docs}),
      occ AS (SELECT doc_id, source, unnest(range(len(lines))) AS pos, unnest(lines) AS raw FROM src),
      l AS (SELECT doc_id, source, pos, trim(raw, ' ') AS line FROM occ WHERE trim(raw, ' ') <> ''),
      b AS (SELECT line FROM l GROUP BY line HAVING count(DISTINCT source) >= {min_sites}),
      n AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM l SEMI JOIN b USING (line)),
      g AS (SELECT doc_id, list(pos) AS gone FROM n WHERE nth > 1 GROUP BY doc_id)
      SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE
        array_to_string([lines[i + 1] FOR i IN range(len(lines)) IF NOT list_contains(gone, i)], chr(10)) END AS text,
        coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed
      FROM src LEFT JOIN g USING (doc_id)"""
