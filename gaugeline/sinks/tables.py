"""Table sinks, comments and properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str) -> None:
    """Create a schema if it is missing. A catalog is session configuration."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def describe_table(
    spark: SparkSession, name: str, comment: str = "", properties: Mapping[str, str] | None = None
) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """An empty table for a stream to append to, if it is missing.

    Its columns are nullable, as a file table's are; partition columns come last.
    """
    fields = sorted(schema.fields, key=lambda f: f.name in partition_by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")
    describe_table(spark, name, comment, properties)


def replace_table(
    df: DataFrame,
    name: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Full recompute of a batch table."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    describe_table(df.sparkSession, name, comment, properties)


def replace_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_stream(
    df: DataFrame, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Append-only sink; progress is kept in ``checkpoint``."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer
