"""Episodes with their score as topic records."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions import arrays, scoring
from gaugeline.functions.payload import gzip_text
from gaugeline.operators.decode import parsed_object, with_defaults
from gaugeline.operators.nested import scored_rows
from gaugeline.schemas import EPISODE, RECORD
from gaugeline.sinks.snapshots import file_system

# Ship the numbering with the job: executors then need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIRE_COLUMNS = [name for name in EPISODE.fieldNames() if name != "frame_count"]


def _frames(joints: str, force: str) -> str:
    """Sensor frames rebuilt with ``joints`` / ``force`` applied to each array."""
    return f"""transform(sensor_frames, f -> named_struct(
      'timestamp_ns', f.timestamp_ns,
      'joint_positions', {joints.format("f.joint_positions")},
      'joint_velocities', {joints.format("f.joint_velocities")},
      'gripper_force', {force.format("f.gripper_force")},
      'ee_pose', {joints.format("f.ee_pose")},
      'frame_index', f.frame_index))"""


# The wire keeps full precision and only turns NaN into null.
WIRE_FRAMES = _frames(arrays.readings("{0}"), arrays.readings("{0}"))
# The document that is scored and measured has rounded readings.
ROUNDED_FRAMES = _frames(arrays.clean("{0}", 6), arrays.clean("{0}", 4))

SCORE_RECORD = f"""named_struct(
    'episode_id', episode_id, 'robot_id', robot_id, 'operator_id', operator_id,
    'task_type', task_type, 'frame_count', cast(n_frames AS int), 'duration_ms', duration_ms,
    {", ".join(f"'score_{name}', round({name}, 2)" for name in scoring.DIMENSIONS)},
    'composite_score', round(composite, 2), 'routing_decision', routing_decision,
    'failure_flags', failure_flags, 'scoring_latency_ms', round(scoring_latency_ms, 3),
    'scored_at_ns', unix_micros(current_timestamp()) * 1000,
    'injected_failure', injected_failure)"""


def documents(episodes: DataFrame) -> DataFrame:
    """Episodes as documents: readings rounded, ``frame_count`` filled in."""
    others = [c for c in episodes.columns if c not in ("sensor_frames", "frame_count")]
    return episodes.selectExpr(
        *others, f"{ROUNDED_FRAMES} AS sensor_frames", "size(sensor_frames) AS frame_count"
    )


def size_kb(
    episodes: DataFrame, key: str = "episode_id", text: Column | None = None
) -> DataFrame:
    """Characters of each document, in units of 1024: of its text, or of the episode's JSON document."""
    if text is None:
        text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        episodes = documents(episodes)
    return episodes.select(key, (F.length(text) / F.lit(1024.0)).alias("size_kb"))


def with_score(episodes: DataFrame) -> DataFrame:
    """Wire columns plus ``_score``, row by row: no join, no shuffle.

    A per-row latency has no meaning in a columnar plan; the column is carried
    through when the input has one.
    """
    if "scoring_latency_ms" not in episodes.columns:
        episodes = episodes.withColumn("scoring_latency_ms", F.lit(0.0))
    wire = ", ".join(
        f"'{c}', {WIRE_FRAMES if c == 'sensor_frames' else c}" for c in WIRE_COLUMNS
    )
    carried = documents(episodes.selectExpr("*", f"named_struct({wire}) AS wire"))
    return scored_rows(carried).selectExpr("wire.*", f"{SCORE_RECORD} AS _score")


# Of a scored document silver reads these fields; frames and events stay behind.
HEADER = [
    name for name in WIRE_COLUMNS if name not in ("sensor_frames", "camera_frames", "phase_events")
]


def completed_text(texts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``text`` and the kept columns of every row; a document without ``_score`` is scored here.

    Row by row, in one pass over the rows: a text that has a score is not parsed for its
    frames, and goes on as it came. Text that is no JSON object goes on as well, for the
    reader to drop.
    """
    there = "array_contains(json_object_keys(text), '_score')"
    bare = texts.withColumn("bare", F.expr(f"CASE WHEN NOT {there} THEN text END"))
    parsed = with_defaults(parsed_object(bare, "bare", EPISODE, (*keep, "text", "bare")))
    parsed = parsed.withColumn("scoring_latency_ms", F.lit(0.0))
    others = ", ".join(f"'{c}', {c}" for c in HEADER)
    record = f"to_json(named_struct({others}, '_score', {SCORE_RECORD}), map('ignoreNullFields', 'false'))"
    scored = scored_rows(documents(parsed))
    return scored.selectExpr(*keep, f"CASE WHEN bare IS NULL THEN text ELSE {record} END AS text")


def publish_frame(episodes: DataFrame, topic: str) -> DataFrame:
    """Topic records (``key``, ``value``, ``topic``) for scored episodes.

    Nulls are written, as the reader tells a null field from a missing one.
    """
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return with_score(episodes).select(
        F.lit(None).cast("binary").alias("key"),
        gzip_text(text).alias("value"),
        F.lit(topic).alias("topic"),
    )


def to_topic(frame: DataFrame, options: dict[str, str]) -> None:
    """Send a batch of records; batching by size is the connector's job."""
    frame.write.format("kafka").options(**options).save()


# Fixed value: partitions of the topic.
TOPIC_PARTITIONS = 32
NUMBERED = "key binary, value binary, topic string, partition int, task int, place long"


def numbered(frame: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """(key, value, topic, partition, task, place): records by the hash of their key (of their value without one),
    and numbered from 0 within a partition as far as one task sees it. Payloads stay in their task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(partitions, np.int64)
        for batch in batches:
            part = batch.column("partition").to_numpy()
            order = np.argsort(part, kind="stable")
            n = np.bincount(part, minlength=partitions)
            place = np.empty(len(part), np.int64)
            place[order] = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
            place += seen[part]
            seen += n
            tasks = pa.array(np.full(len(part), task, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, tasks, pa.array(place)], names=[*batch.schema.names, "task", "place"]
            )

    at = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    rows = frame.select("key", "value", "topic", at.alias("partition"))
    return rows.mapInArrow(count, NUMBERED)


def to_files(frame: DataFrame, path: str, partitions: int = TOPIC_PARTITIONS) -> None:
    """The same records as files, for a reader of ``file_topic``.

    Offsets of a partition grow by one, and go on after the last published one. Records are first
    written aside, so that their numbers stay as they are whatever is repeated; the counts per task
    and partition give each task its first offset. One writer at a time.
    """
    spark = frame.sparkSession
    aside = f"{path.rstrip('/')}__publishing/{uuid.uuid4().hex}"
    numbered(frame, partitions).write.parquet(aside)
    rows = spark.read.schema(NUMBERED).parquet(aside)
    folder, fs = file_system(spark, path)
    last = spark.createDataFrame([], "partition int, last long")
    if fs.exists(folder):
        there = spark.read.schema(RECORD).parquet(path)
        last = there.groupBy("partition").agg((F.max("offset") + 1).alias("last"))
    before = Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("partition", "task").agg(F.count("*").alias("n"))
    starts = counts.join(last, "partition", "left").select(
        "partition",
        "task",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) + F.coalesce("last", F.lit(0))).alias("first"),
    )
    rows.join(starts, ["partition", "task"]).select(
        "key",
        "value",
        "topic",
        "partition",
        (F.col("first") + F.col("place")).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    ).write.mode("append").parquet(path)
    used, fs = file_system(spark, aside)
    fs.delete(used, True)
