"""Compare catalogue queries with their SQL twins: python tests/oracle_check.py [sf] [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SPENT = {}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def kind(value):
    return "num" if isinstance(value, (int, float)) and not isinstance(value, bool) else type(value).__name__


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, sql, con):
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    SPENT["spark"] = time.time()
    relation = con.sql(sql)
    wanted = relation.fetchall()
    if sorted(names) != sorted(relation.columns):
        return f"columns {sorted(names)} != {sorted(relation.columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    types_got = {n: {type(r[i]).__name__ for r in got if r[i] is not None} for i, n in enumerate(names)}
    types_want = {n: {type(r[i]).__name__ for r in wanted if r[i] is not None} for i, n in enumerate(relation.columns)}
    if types_got != types_want:
        return "types " + str({n: (types_got[n], types_want[n]) for n in names if types_got[n] != types_want[n]})
    a, b = normal(got, names), normal(wanted, relation.columns)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} rows differ, e.g. {diff[0]}" if diff else None


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        SPENT["spark"] = start
        try:
            if name in oracles:
                problem = compare(run(spark, sf_dir), oracles[name], con)
                note = problem or "ok"
            else:
                problem = None
                note = f"rows only: {len(run(spark, sf_dir).collect())}"
        except Exception as exc:  # report and go on with the next query
            problem = note = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'pass'} {name:34s} {time.time() - start:6.1f}s (spark {SPENT['spark'] - start:5.1f})  {note}", flush=True)
    print(f"{bad} failing", flush=True)


if __name__ == "__main__":
    main()
