"""Where intermediate tables may live.

Everything that has to outlive an executor goes to the folder the cluster names in
``spark.checkpoint.dir``.  Only a session whose executors are threads of the driver, and which
names no folder, gets one of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder; a session in one process gets a fresh one if it names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="snapweave-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir() or own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library wrote, wherever Spark can write; no matter if it is missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Delete the folder of one value of a table's partition column."""
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    remove(spark, f"{path.rstrip('/')}/{column}={escaped}")


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small table once, on reliable storage: no lineage, fixed contents."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``store``, and the number of rows, counted while they are written."""
    seen = Observation(name)
    stored = store(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return stored, seen.get["rows"]


def store(df: DataFrame, name: str) -> DataFrame:
    """The same for large tables, as Parquet, so that later reads take only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
