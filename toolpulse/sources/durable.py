"""Tables written once to shared storage, to cut lineage and to survive lost executors.

The folder is ``spark.checkpoint.dir`` of the session. Only a local session may
go without it; it then gets a temporary folder that goes away with the process.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}
_shared: dict[tuple[str, str], str] = {}


def work_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/toolpulse-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="toolpulse-")
    return _local_dirs[app].name


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table and read it back with the same schema."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def shared_path(spark: SparkSession, key: str, write) -> str:
    """Path of a table that several queries of one session use; ``write(path)`` runs once."""
    slot = (spark.sparkContext.applicationId, key)
    if slot not in _shared:
        path = new_path(spark, "shared")
        write(path)
        _shared[slot] = path
    return _shared[slot]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
