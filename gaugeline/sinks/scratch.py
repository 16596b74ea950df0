"""Small intermediate tables: cut off from the plan that made them, and safe from lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Only a local session gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="gaugeline-"))
    return _OWN[0]


def kept(df: DataFrame) -> DataFrame:
    """The rows of df, computed once: written into the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gaugeline/kept/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
