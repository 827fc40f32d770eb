"""Model registry look-ups and promotion, on a registry derived from orders.

Every order stands for a training run that produced a version of one of its
customer's two models; finished orders moved the production alias.
"""

from pyspark.sql import functions as F

from toolpulse.operators import registry as R
from toolpulse.plans import adapters as A
from toolpulse.plans.catalogue import query

TABLES_SQL = """WITH base AS (SELECT o_orderkey AS k, 'line-' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '-binary' ELSE '-multiclass' END AS model_name,
    o_custkey, o_orderstatus, o_orderdate FROM orders),
  runs AS (SELECT 'run-' || k AS run_id, CASE WHEN k % 50 <> 0 THEN (5000 + (k * 7919) % 5000) / 10000.0::DOUBLE END AS f1_test FROM base),
  versions AS (SELECT model_name, CAST(k AS VARCHAR) AS version, CASE WHEN k % 70 <> 0 THEN 'run-' || k END AS run_id FROM base),
  aliases AS (SELECT model_name, CAST(k AS VARCHAR) AS version, o_orderdate AS set_at FROM base WHERE o_orderstatus = 'F'),
  vm AS (SELECT model_name, version, run_id, f1_test FROM versions LEFT JOIN runs USING (run_id)),
  latest AS (SELECT model_name, CAST(max(CAST(version AS BIGINT)) AS VARCHAR) AS version FROM versions GROUP BY 1),
  held AS (SELECT model_name, version FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY set_at DESC, CAST(version AS BIGINT) DESC) AS rn FROM aliases) WHERE rn = 1),
  prod AS (SELECT l.model_name, held.version AS production_version FROM latest l LEFT JOIN held USING (model_name)),
  decided AS (SELECT c.model_name, c.version AS candidate_version, v.f1_test AS new_f1, production_version, p.f1_test AS production_f1,
    CASE WHEN contains(c.model_name, 'binary') THEN 0.85::DOUBLE ELSE 0.60::DOUBLE END AS min_f1
    FROM latest c JOIN vm v ON c.model_name = v.model_name AND c.version = v.version JOIN prod ON prod.model_name = c.model_name
    LEFT JOIN vm p ON p.model_name = prod.model_name AND p.version = prod.production_version),
  gated AS (SELECT *, production_f1 IS NULL OR new_f1 > production_f1 AS gate_improvement, new_f1 >= min_f1 AS gate_floor FROM decided) """


def tables(spark, sf):
    k, name = F.col("o_orderkey"), F.col("model_name")
    base = A.source(spark, sf, "orders").withColumn(
        "model_name",
        F.concat(
            F.lit("line-"), F.col("o_custkey").cast("string"),
            F.when(k % 2 == 0, F.lit("-binary")).otherwise(F.lit("-multiclass")),
        ),
    )
    key = k.cast("string")
    score = (F.lit(5000) + (k * 7919) % 5000) / F.lit(10000.0)
    runs = base.select(
        F.concat(F.lit("run-"), key).alias("run_id"),
        F.when(k % 50 != 0, F.create_map(F.lit("f1_test"), score))
        .otherwise(F.create_map(F.lit("brier_score"), score))
        .alias("metrics"),
    )
    versions = base.select(name, key.alias("version"), F.when(k % 70 != 0, F.concat(F.lit("run-"), key)).alias("run_id"))
    aliases = base.where("o_orderstatus = 'F'").select(
        name, F.lit(R.PRODUCTION).alias("alias"), key.alias("version"), F.col("o_orderdate").alias("set_at")
    )
    return versions, runs, aliases


@query("j1_version_metrics", TABLES_SQL + "SELECT model_name, version, run_id, f1_test FROM vm")
def j1(spark, sf):
    versions, runs, _ = tables(spark, sf)
    return R.version_metrics(versions, runs)


@query("j2_production_versions", TABLES_SQL + "SELECT model_name, production_version FROM prod")
def j2(spark, sf):
    versions, _, aliases = tables(spark, sf)
    return R.production_versions(R.latest_versions(versions), aliases)


@query("a8_latest_version", TABLES_SQL + "SELECT model_name, version FROM latest")
def a8(spark, sf):
    return R.latest_versions(tables(spark, sf)[0])


@query("m22_promotion_gates", TABLES_SQL + "SELECT model_name, new_f1, production_f1, gate_improvement, gate_floor FROM gated")
def m22(spark, sf):
    versions, runs, aliases = tables(spark, sf)
    return R.promotion_decisions(versions, runs, aliases).select(
        "model_name", "new_f1", "production_f1", "gate_improvement", "gate_floor"
    )


@query(
    "m23_promotion_decisions",
    TABLES_SQL
    + """SELECT model_name, candidate_version, production_version, min_f1, CASE WHEN new_f1 IS NULL THEN 'NO METRIC'
    WHEN gate_improvement AND gate_floor THEN 'WOULD PROMOTE' ELSE 'NOT PROMOTED' END AS outcome,
    round(new_f1 - production_f1, 6) AS f1_gain FROM gated""",
)
def m23(spark, sf):
    versions, runs, aliases = tables(spark, sf)
    return R.promotion_decisions(versions, runs, aliases).select(
        "model_name", "candidate_version", "production_version", "min_f1", "outcome", F.round("f1_gain", 6).alias("f1_gain")
    )


@query(
    "m24_serving_status",
    TABLES_SQL
    + """SELECT service, gate_version, gate_f1, detail_version, detail_f1, CASE WHEN gate_version IS NOT NULL THEN 'ok' ELSE 'degraded' END AS status
    FROM (SELECT 'line-' || c_custkey AS service, gh.version AS gate_version, gm.f1_test AS gate_f1, dh.version AS detail_version, dm.f1_test AS detail_f1
      FROM customer LEFT JOIN held gh ON gh.model_name = 'line-' || c_custkey || '-binary' LEFT JOIN vm gm ON gm.model_name = gh.model_name AND gm.version = gh.version
      LEFT JOIN held dh ON dh.model_name = 'line-' || c_custkey || '-multiclass' LEFT JOIN vm dm ON dm.model_name = dh.model_name AND dm.version = dh.version)""",
)
def m24(spark, sf):
    versions, runs, aliases = tables(spark, sf)
    service = F.concat(F.lit("line-"), F.col("c_custkey").cast("string")).alias("service")
    kinds = F.explode(F.array(F.lit("binary"), F.lit("multiclass"))).alias("kind")
    models = A.source(spark, sf, "customer").select(service, kinds)
    models = models.withColumn("model_name", F.concat_ws("-", "service", "kind"))
    production = R.production_versions(R.latest_versions(versions), aliases)
    return R.serving_status(models, production, R.version_metrics(versions, runs))
