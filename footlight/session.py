"""Where intermediate tables live.

Tables that are read several times, or whose size decides how a join runs, are written once to the
shared folder named by ``spark.checkpoint.dir`` and read back.  A written table survives lost
executors and gives the planner a real size.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables of this application."""
    shared = spark.conf.get(_SETTING, None)
    if shared:
        return f"{shared.rstrip('/')}/footlight-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="footlight-")
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once nothing that reads them is left.

    The folder is handed to the catalog as a database and dropped with it, which works on any file system that Spark writes.
    """
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark)}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")
