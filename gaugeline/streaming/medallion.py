"""Topic to bronze to silver as streams, gold as a batch refresh.

All streaming steps are stateless maps and filters. Where a step stops and
resumes is kept in its checkpoint, so a lost executor or driver repeats at most
one micro-batch, and the file sink's commit log keeps the output exactly once.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators import decode, quality
from gaugeline.operators.nested import score_nested
from gaugeline.plans import gold
from gaugeline.schemas import BRONZE, SILVER
from gaugeline.sinks.publish import completed_text
from gaugeline.sinks.tables import (
    append_stream,
    create_schema,
    create_table,
    replace_path,
    replace_table,
)
from gaugeline.sinks.snapshots import expire, publish, read_snapshot
from gaugeline.sources.tables import read_path, stream_path, stream_table
from gaugeline.streaming import live_gold
from gaugeline.streaming.progress import ProgressLog, batch_metrics, violations

GOLD_TABLES: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "gold_daily_robot_stats": gold.gold_daily_robot_stats,
    "gold_sla_compliance": gold.gold_sla_compliance,
    "operator_metrics": gold.operator_metrics,
    "task_type_summary": gold.task_type_summary,
}

GOLD_COMMENTS = {
    "gold_daily_robot_stats": "Episode volume, scores and certified rate per robot, task and day",
    "gold_failure_summary": "Failure flags by day, task and routing decision, ranked",
    "gold_sla_compliance": "Daily certified rate with rolling means and SLA status",
    "operator_metrics": "Episode volume, scores and certified rate per operator",
    "task_type_summary": "Episode volume, scores and certified rate per task type",
}


def checkpoint_dir(spark: SparkSession, root: str, step: str) -> str:
    """A step's progress folder, in the shared folder the cluster names.

    Without ``spark.checkpoint.dir`` it lies next to the tables.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return f"{root}/_checkpoints/{step}"
    tag = hashlib.sha1(root.encode("utf-8")).hexdigest()[:16]
    return f"{shared.rstrip('/')}/gaugeline/{tag}/{step}"


def bronze(records: DataFrame) -> DataFrame:
    """Records as they came, with lineage columns."""
    return records.select(
        F.col("value").alias("payload"),
        F.current_timestamp().alias("ingested_at"),
        F.col("topic").alias("source"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def decoded(bronze_rows: DataFrame, score: bool = False) -> DataFrame:
    """Silver columns of every parsable payload, before expectations.

    score: documents that come without a score get theirs on the way; otherwise they are dropped.
    """
    texts = bronze_rows.select(
        decode.payload_text(F.col("payload")).alias("text"), "ingested_at"
    )
    if score:
        texts = completed_text(texts, keep=("ingested_at",))
    return decode.silver_fields(texts, keep=("ingested_at",)).withColumn(
        "scored_at", F.current_timestamp().cast("string")
    )


def silver(
    bronze_rows: DataFrame, observe_as: str | None = None, score: bool = False
) -> DataFrame:
    rows = decoded(bronze_rows, score)
    if observe_as:
        rows = quality.observed(rows, observe_as)
    return quality.apply(rows)


def quarantine(bronze_rows: DataFrame) -> DataFrame:
    """Payloads that no reader can decode, kept whole for inspection."""
    return decode.payload_text_or_plain(bronze_rows).where(
        "json_object_keys(text) IS NULL"
    ).drop("text")


def rescored(bronze_rows: DataFrame) -> DataFrame:
    """Score the episodes found in bronze, inside the stream."""
    texts = decode.payload_text_or_plain(bronze_rows)
    return score_nested(decode.episode_documents(texts, keep=("ingested_at",)))


def start_bronze(
    records: DataFrame, root: str, trigger: Mapping[str, object]
) -> StreamingQuery:
    spark = records.sparkSession
    writer = append_stream(bronze(records), checkpoint_dir(spark, root, "bronze"))
    return writer.trigger(**trigger).start(f"{root}/bronze_episodes")


def start_silver(
    spark: SparkSession,
    root: str,
    trigger: Mapping[str, object],
    max_files: int | None = None,
    score: bool = False,
) -> StreamingQuery:
    """score: one stream decodes, scores what comes without a score, and passes scored documents on."""
    rows = stream_path(spark, f"{root}/bronze_episodes", BRONZE, max_files)
    writer = append_stream(
        silver(rows, observe_as="silver_expectations", score=score),
        checkpoint_dir(spark, root, "silver"),
        partition_by=["routing_decision"],
    )
    return writer.trigger(**trigger).start(f"{root}/silver_episodes")


def start_rescored(
    spark: SparkSession, root: str, trigger: Mapping[str, object], max_files: int | None = None
) -> StreamingQuery:
    rows = stream_path(spark, f"{root}/bronze_episodes", BRONZE, max_files)
    writer = append_stream(rescored(rows), checkpoint_dir(spark, root, "rescored"))
    return writer.trigger(**trigger).start(f"{root}/rescored_episodes")


def start_quarantine(
    spark: SparkSession, root: str, trigger: Mapping[str, object], max_files: int | None = None
) -> StreamingQuery:
    rows = stream_path(spark, f"{root}/bronze_episodes", BRONZE, max_files)
    writer = append_stream(quarantine(rows), checkpoint_dir(spark, root, "quarantine"))
    return writer.trigger(**trigger).start(f"{root}/quarantined_episodes")


def start_gold(
    spark: SparkSession, root: str, trigger: Mapping[str, object], max_files: int | None = None
) -> StreamingQuery:
    """Keep gold current from silver as it grows; see ``live_gold``."""
    at = checkpoint_dir(spark, root, "live_gold")
    return live_gold.start_gold(spark, root, at, trigger, max_files)


def batch_times(query: StreamingQuery) -> list[dict[str, int]]:
    """Milliseconds per step of each recent micro-batch; the columnar form of a
    scoring latency, which has no meaning for a single row. The session keeps
    only the latest batches (spark.sql.streaming.numRecentProgressUpdates)."""
    return [
        {"batchId": p["batchId"], "numInputRows": p["numInputRows"], **p["durationMs"]}
        for p in query.recentProgress
    ]


def refresh_gold(spark: SparkSession, root: str) -> None:
    """Recompute every gold table from the current silver snapshot.

    Each is published at once: a refresh that fails leaves its old version readable. The ranking of failures reads its counts twice, so they are stored once.
    """
    silver_rows = read_path(spark, f"{root}/silver_episodes", SILVER)
    for name, build in GOLD_TABLES.items():
        publish(build(silver_rows), f"{root}/{name}")
    staged = checkpoint_dir(spark, root, f"failure_counts-{uuid.uuid4().hex}")
    replace_path(gold.failure_counts(silver_rows), staged)
    ranked = gold.rank_failures(read_path(spark, staged))
    publish(ranked, f"{root}/gold_failure_summary")


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A gold table as the last finished refresh left it."""
    return read_snapshot(spark, f"{root}/{name}")


def expire_gold(spark: SparkSession, root: str, older_than: float = 86400.0) -> None:
    """Remove what refreshes replaced more than older_than seconds ago."""
    for name in GOLD_COMMENTS:
        expire(spark, f"{root}/{name}", older_than)


def refresh_gold_tables(silver_rows: DataFrame, schema: str, scratch: str) -> None:
    """The same refresh into catalog tables with comments and properties."""
    spark = silver_rows.sparkSession
    create_schema(spark, schema)
    staged = checkpoint_dir(spark, scratch, f"failure_counts-{uuid.uuid4().hex}")
    replace_path(gold.failure_counts(silver_rows), staged)
    tables = {name: build(silver_rows) for name, build in GOLD_TABLES.items()}
    tables["gold_failure_summary"] = gold.rank_failures(read_path(spark, staged))
    for name, df in tables.items():
        replace_table(df, f"{schema}.{name}", GOLD_COMMENTS[name], {"quality": "gold"})


# Catalog tables: comment and properties of the streamed layers, and silver's partitioning.
STREAMED = {
    "bronze_episodes": ("Topic records as they came, with their lineage", {"quality": "bronze"}, ()),
    "silver_episodes": (
        "Decoded episodes that meet the dropping expectations",
        {"quality": "silver"},
        ("routing_decision",),
    ),
}


def create_streamed_tables(spark: SparkSession, schema: str) -> None:
    """Bronze and silver as named tables, if they are missing."""
    create_schema(spark, schema)
    for name, columns in (("bronze_episodes", BRONZE), ("silver_episodes", SILVER)):
        comment, properties, partition_by = STREAMED[name]
        create_table(spark, f"{schema}.{name}", columns, comment, properties, partition_by)


def start_bronze_table(
    records: DataFrame, schema: str, scratch: str, trigger: Mapping[str, object]
) -> StreamingQuery:
    """The topic into the table ``<schema>.bronze_episodes``."""
    spark = records.sparkSession
    create_streamed_tables(spark, schema)
    writer = append_stream(bronze(records), checkpoint_dir(spark, scratch, f"{schema}.bronze"))
    return writer.trigger(**trigger).toTable(f"{schema}.bronze_episodes")


def start_silver_table(
    spark: SparkSession,
    schema: str,
    scratch: str,
    trigger: Mapping[str, object],
    score: bool = False,
) -> StreamingQuery:
    """One table streams from the other by name."""
    create_streamed_tables(spark, schema)
    rows = silver(stream_table(spark, f"{schema}.bronze_episodes"), "silver_expectations", score)
    _, _, partition_by = STREAMED["silver_episodes"]
    writer = append_stream(rows, checkpoint_dir(spark, scratch, f"{schema}.silver"), partition_by)
    return writer.trigger(**trigger).toTable(f"{schema}.silver_episodes")


def run_once(
    records: DataFrame,
    root: str,
    max_files: int | None = None,
    seconds: float | None = None,
    score: bool = False,
) -> dict[str, int]:
    """Process all waiting records through the three layers, then stop.

    ``max_files`` bounds a micro-batch of the later layers; ``seconds`` is how
    long each stream may take before it is stopped (the next run goes on there).
    Returns the violation counts the silver step observed over all its batches
    (they stay in ``batch_metrics``, with the durations), and ``quarantined``: the payloads that this run set aside.
    """
    spark = records.sparkSession
    now = {"availableNow": True}

    def finish(query: StreamingQuery) -> StreamingQuery:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            query.stop()
        return query

    finish(start_bronze(records, root, now))
    log = ProgressLog(spark, f"{root}/batch_metrics")
    spark.streams.addListener(log)
    try:
        query = finish(start_silver(spark, root, now, max_files, score))
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    done = batch_metrics(spark, log.folder).where(F.col("run_id") == str(query.runId))
    counts: dict[str, int] = {
        r["metric"]: r["n"] for r in violations(done, "silver_expectations").collect()
    }
    aside = f"{root}/quarantined_episodes"
    had = _rows(spark, aside)
    finish(start_quarantine(spark, root, now, max_files))
    counts["quarantined"] = _rows(spark, aside) - had
    refresh_gold(spark, root)
    return counts


def _rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.schema("payload binary").parquet(path).count()
    except AnalysisException:  # nothing was written yet
        return 0
