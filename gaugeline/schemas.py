"""Declared schemas and the fixed vocabularies of the episode data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Enum domains of the episode document.
TASK_TYPES = ["pick_place", "sheet_metal", "bin_sort", "fastener_drive", "inspection"]
PHASES = ["idle", "approach", "grasp", "transport", "place", "retract", "complete"]
STATUSES = ["in_progress", "completed", "aborted"]
FAILURE_MODES = [
    "none",
    "sensor_dropout",
    "motion_jitter",
    "timing_gap",
    "incomplete_task",
    "trajectory_anomaly",
    "compound",
]
ROUTINGS = ["CERTIFIED", "BORDERLINE", "REJECTED"]

DOUBLES = T.ArrayType(T.DoubleType(), True)

SENSOR_FRAME = T.StructType(
    [
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("joint_positions", DOUBLES),
        T.StructField("joint_velocities", DOUBLES),
        T.StructField("gripper_force", DOUBLES),
        T.StructField("ee_pose", DOUBLES),
        T.StructField("frame_index", T.IntegerType()),
    ]
)

CAMERA_FRAME = T.StructType(
    [
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("frame_id", T.IntegerType()),
        T.StructField("exposure_ms", T.DoubleType()),
        T.StructField("sync_ok", T.BooleanType()),
        T.StructField("camera_id", T.StringType()),
    ]
)

PHASE_EVENT = T.StructType(
    [
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("phase", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

EPISODE = T.StructType(
    [
        T.StructField("episode_id", T.StringType()),
        T.StructField("robot_id", T.StringType()),
        T.StructField("operator_id", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("session_ts", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("task_completed", T.BooleanType()),
        T.StructField("injected_failure", T.StringType()),
        T.StructField("frame_count", T.IntegerType()),
        T.StructField("sensor_frames", T.ArrayType(SENSOR_FRAME)),
        T.StructField("camera_frames", T.ArrayType(CAMERA_FRAME)),
        T.StructField("phase_events", T.ArrayType(PHASE_EVENT)),
    ]
)

SCORE = T.StructType(
    [
        T.StructField("episode_id", T.StringType()),
        T.StructField("robot_id", T.StringType()),
        T.StructField("operator_id", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("frame_count", T.IntegerType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("score_sensor_completeness", T.DoubleType()),
        T.StructField("score_temporal_coherence", T.DoubleType()),
        T.StructField("score_motion_smoothness", T.DoubleType()),
        T.StructField("score_task_completion", T.DoubleType()),
        T.StructField("score_trajectory_validity", T.DoubleType()),
        T.StructField("composite_score", T.DoubleType()),
        T.StructField("routing_decision", T.StringType()),
        T.StructField("failure_flags", T.ArrayType(T.StringType())),
        T.StructField("scoring_latency_ms", T.DoubleType()),
        T.StructField("scored_at_ns", T.LongType()),
        T.StructField("injected_failure", T.StringType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("episode_id", T.StringType()),
        T.StructField("robot_id", T.StringType()),
        T.StructField("operator_id", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_ms", T.FloatType()),
        T.StructField("frame_count", T.IntegerType()),
        T.StructField("injected_failure", T.StringType()),
        T.StructField("sensor_completeness", T.FloatType()),
        T.StructField("temporal_coherence", T.FloatType()),
        T.StructField("motion_smoothness", T.FloatType()),
        T.StructField("task_completion", T.FloatType()),
        T.StructField("trajectory_validity", T.FloatType()),
        T.StructField("composite_score", T.FloatType()),
        T.StructField("routing_decision", T.StringType(), False),
        T.StructField("failure_flags", T.ArrayType(T.StringType())),
        T.StructField("scoring_latency_ms", T.FloatType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("scored_at", T.StringType()),
    ]
)
