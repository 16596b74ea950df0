"""Decode, quality, nested scoring and kinematics over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import arrays
from gaugeline.functions.payload import gunzip, gzip_text
from gaugeline.operators import decode, quality
from gaugeline.operators.nested import score_nested
from gaugeline.plans import reports
from gaugeline.sinks.publish import publish_frame, size_kb
from gaugeline.sinks.scratch import kept
from gaugeline.streaming import medallion
from gaugeline.testbed import adapters
from gaugeline.testbed.report_queries import Query

FLOATS = [
    "duration_ms",
    "sensor_completeness",
    "temporal_coherence",
    "motion_smoothness",
    "task_completion",
    "trajectory_validity",
    "composite_score",
    "scoring_latency_ms",
]


def comparable(silver: DataFrame) -> DataFrame:
    """Silver columns with 32-bit floats and arrays in engine-neutral form."""
    return silver.withColumns(
        {c: F.round(F.col(c).cast("double"), 3) for c in FLOATS}
    ).withColumn("failure_flags", F.array_join("failure_flags", "|"))


def bronze_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        medallion.bronze(adapters.records(spark, sf_dir))
        .drop("ingested_at")
        .withColumn("payload", F.col("payload").cast("string"))
        .withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("string"))
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.silver_fields(adapters.wire_texts(spark, sf_dir))


def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to gzip records, written and read back, then the silver rows that pass the expectations."""
    zipped = adapters.wire_texts(spark, sf_dir).select(gzip_text(F.col("text")).alias("payload"))
    texts = kept(zipped).select(gunzip(F.col("payload")).alias("text"))
    return comparable(quality.apply(decode.silver_fields(texts)))


def publish_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score nested episodes, publish them, and read silver back."""
    published = publish_frame(adapters.nested_episodes(spark, sf_dir), "episodes")
    texts = published.select(gunzip(F.col("value")).alias("text"))
    return comparable(quality.apply(decode.silver_fields(texts))).drop(
        "scoring_latency_ms", "injected_failure", "duration_ms"
    )


def score_nested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_nested(adapters.nested_episodes(spark, sf_dir))
    return scored.withColumn("failure_flags", F.array_join("failure_flags", "|")).drop(
        "duration_ms", "injected_failure"
    )


def joint_rows(df: DataFrame, values: str) -> DataFrame:
    return df.selectExpr("vec_id", f"posexplode({values}) AS (pos, value)").selectExpr(
        "vec_id", "cast(pos AS bigint) AS pos", "value"
    )


def clean_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = adapters.table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        """transform(embedding, (v, i) -> CASE WHEN (vec_id + i) % 29 = 0
             THEN double('NaN') ELSE cast(v AS double) END) AS readings""",
    )
    return joint_rows(holed, arrays.clean("readings", 6))


def grouped(formula: str, size: int) -> str:
    """A formula on a group of joints ``p``, for all groups of the vector, one after the other."""
    groups = f"sequence(0, cast((size(p) - 1) DIV {size} AS int))"
    return f"flatten(transform({groups}, g -> {formula}))"


def clip_joints(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = adapters.table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "transform(embedding, v -> cast(v AS double) * 20D) AS p"
    )
    clipped = grouped(arrays.clip_joints("slice(p, g * 12 + 1, 12)"), 12)
    return joint_rows(
        scaled.selectExpr("vec_id", f"{clipped} AS p"), "transform(p, v -> round(v, 6))"
    )


def ee_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = adapters.table(spark, sf_dir, "embeddings").selectExpr("vec_id", "embedding AS p")
    return joint_rows(vectors, grouped(arrays.ee_pose("slice(p, g * 5 + 1, 5)"), 5))


def payload_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = size_kb(adapters.table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return sized.withColumn("size_kb", F.round("size_kb", 6))


PAYLOADS: dict[str, Query] = {
    "bronze_project": bronze_project,
    "silver_extract": lambda spark, sf_dir: comparable(extracted(spark, sf_dir)),
    "expect_drop": lambda spark, sf_dir: comparable(quality.apply(extracted(spark, sf_dir))),
    "expect_report": lambda spark, sf_dir: quality.report(extracted(spark, sf_dir)),
    "validate_summary": lambda spark, sf_dir: reports.validate_summary(
        decode.presence(adapters.wire_texts(spark, sf_dir))
    ),
    "payload_roundtrip": payload_roundtrip,
    "score_nested": score_nested_rows,
    "publish_decode": publish_decode,
    "clean_arrays": clean_arrays,
    "clip_joints": clip_joints,
    "ee_pose": ee_pose,
    "payload_size": payload_size,
}
