"""Reading tables and episode files, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline.operators.decode import with_defaults
from gaugeline.schemas import EPISODE


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def read_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """With a schema also a folder that a stream has not written rows to yet."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def stream_path(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Episode documents, one JSON object per line, with the per-key defaults."""
    return with_defaults(spark.read.schema(EPISODE).json(path))
