"""Named queries with their SQL twins, one module per group."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the twin a SQL engine runs on the same tables."""

    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> None:
    from toolpulse.plans.catalogue import (  # noqa: F401
        columns,
        drift,
        models,
        registry,
        scores,
        streams,
        tables,
    )
