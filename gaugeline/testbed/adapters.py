"""Episode-shaped inputs derived from the generic test tables.

Each function is a plain projection or ranking that the oracle SQL repeats, so
results over the given tables can be compared engine against engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.operators import ordered
from gaugeline.schemas import TASK_TYPES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prop_k(column: str = "props") -> Column:
    return F.get_json_object(column, "$.k").cast("int")


def fleet_id(prefix: str, size: int) -> Column:
    return F.concat(
        F.lit(prefix), F.lpad((F.col("user_id") % size + 1).cast("string"), 3, "0")
    )


def failure_label(k: Column) -> Column:
    return (
        F.when(k < 70, "none")
        .when(k < 76, "sensor_dropout")
        .when(k < 81, "motion_jitter")
        .when(k < 87, "timing_gap")
        .when(k < 93, "incomplete_task")
        .when(k < 97, "trajectory_anomaly")
        .otherwise("compound")
    )


def routing_label(score: Column) -> Column:
    return (
        F.when(score >= 85, "CERTIFIED").when(score >= 70, "BORDERLINE").otherwise("REJECTED")
    )


def scored_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored episode per event, with the columns the reports read."""
    factor = "CASE day(ts) % 3 WHEN 0 THEN 0.20BD WHEN 1 THEN 0.28BD ELSE 0.40BD END"
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", prop_k())
        .selectExpr(
            "cast(event_id AS string) AS episode_id",
            "concat('robot_', lpad(cast(user_id % 5 + 1 AS string), 3, '0')) AS robot_id",
            "concat('operator_', lpad(cast(user_id % 10 + 1 AS string), 3, '0')) AS operator_id",
            "event_type AS task_type",
            "ts AS ingested_at",
            f"""greatest(0D, cast(round(100 - cast(value AS decimal(12,2)) * {factor}, 2)
                AS double)) AS composite_score""",
            """array_compact(array(
                 CASE WHEN k % 10 = 3 THEN concat('SENSOR_COMPLETENESS:DROPOUT_WINDOW(', k + 3,
                   ' consecutive null frames)') END,
                 CASE WHEN k % 7 = 2 THEN concat('  TEMPORAL_COHERENCE:GAP(', k + 51,
                   '.5ms max, 2 violations) ') END,
                 CASE WHEN value > 80 THEN 'TASK_COMPLETION:MISSING_COMPLETE_PHASE' END
               )) AS flags""",
            "k",
            "value / 10 AS scoring_latency_ms",
            "600 + k AS frame_count",
        )
        .withColumn("injected_failure", failure_label(F.col("k")))
        .withColumn("routing_decision", routing_label(F.col("composite_score")))
        # Some unflagged rows have no flags array at all.
        .withColumn(
            "failure_flags", F.expr("CASE WHEN k % 10 <> 9 OR size(flags) > 0 THEN flags END")
        )
        .drop("k", "flags")
    )


def task_of_user() -> Column:
    names = F.array(*[F.lit(t) for t in TASK_TYPES])
    return F.get(names, (F.col("user_id") % 5).cast("int"))


def ranked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their position inside their user and the stall time so far."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", prop_k().alias("k"))
    return ordered.running_totals(
        events.withColumn("chunk", ordered.hour_of(events, "ts")),
        {
            "seen": F.lit(1).cast("long"),
            "stall_ns": F.when(F.col("event_id") % 401 == 0, 100_000_000)
            .otherwise(0)
            .cast("long"),
        },
        order_by=["ts", "event_id"],
        partition_by=["user_id"],
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sensor frame per event, one episode per user, twelve joints."""
    bumps = ranked_events(spark, sf_dir).selectExpr(
        "user_id AS episode_id",
        "seen - 1 AS frame_index",
        "CASE WHEN event_id % 53 <> 0 THEN (seen - 1) * 5000000 + stall_ns END AS timestamp_ns",
        "user_id % 7 = 0 AND seen - 1 BETWEEN 10 AND 10 + user_id % 6 AS gone",
        "event_id % 211 = 0 AS gone_3",
        "CASE WHEN user_id % 11 = 0 AND seen - 1 BETWEEN 20 AND 30 THEN 1D ELSE 0D END AS swing",
        "CASE WHEN user_id % 13 = 0 THEN 0.78D ELSE 0D END AS lift",
        """CASE WHEN user_id % 17 = 0
           THEN 0.70D + CASE WHEN (seen - 1) % 50 = 2 THEN 0.05D ELSE 0D END
           ELSE 0D END AS reach""",
        "(k / 100D - 0.5D) * (1 + user_id % 8) AS speed",
    )
    position = "0.02D * ((frame_index + {j}) % 5) + swing + lift"
    joints = [position.format(j=j) for j in range(12)]
    joints[3] = f"CASE WHEN NOT gone_3 THEN {joints[3]} END"
    joints[7] += " + reach"
    return bumps.selectExpr(
        "episode_id",
        "frame_index",
        f"element_at(array({', '.join(repr(t) for t in TASK_TYPES)}),"
        " cast(episode_id % 5 AS int) + 1) AS task_type",
        "timestamp_ns",
        f"CASE WHEN gone THEN array_repeat(cast(NULL AS double), 12)"
        f" ELSE array({', '.join(joints)}) END AS positions",
        "array_repeat(CASE WHEN NOT gone THEN speed END, 12) AS velocities",
    )


def nested_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same episodes as documents: their frames in one array, in order."""
    frame = F.struct(
        "frame_index",
        "timestamp_ns",
        F.col("positions").alias("joint_positions"),
        F.col("velocities").alias("joint_velocities"),
    )
    return frames(spark, sf_dir).groupBy("episode_id", "task_type").agg(
        F.array_sort(F.collect_list(frame)).alias("sensor_frames")
    )


def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a phase event of its user, by time and then event."""
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "ts", "user_id", "event_type", "props")
        .select(
            F.col("user_id").alias("episode_id"),
            F.struct("ts", "event_id").alias("event_index"),
            F.when(F.col("event_type") == "purchase", "complete")
            .otherwise(F.col("event_type"))
            .alias("phase"),
            (prop_k() / F.lit(100.0)).alias("confidence"),
        )
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: the episode header without frames."""
    return (
        table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(
            F.col("user_id").alias("episode_id"),
            fleet_id("robot_", 5).alias("robot_id"),
            fleet_id("operator_", 10).alias("operator_id"),
            task_of_user().alias("task_type"),
            F.when(F.col("user_id") % 10 == 0, "aborted").otherwise("completed").alias("status"),
        )
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records with an arbitrary text value."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(NULL AS binary) AS key",
        "cast(props AS binary) AS value",
        "event_type AS topic",
        "cast(user_id % 32 AS int) AS partition",
        "event_id AS offset",
        "ts AS timestamp",
    )


def wire_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per event, some of them incomplete or broken."""
    base = (
        table(spark, sf_dir, "events")
        .withColumn("k", prop_k())
        .withColumn("label", failure_label(F.col("k")))
        .selectExpr(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "k",
            "CASE WHEN k >= 50 THEN label END AS label",
            "CASE WHEN event_id % 19 <> 0 THEN 1 END AS filled",
        )
    )
    text = base.selectExpr(
        "event_id",
        """to_json(named_struct(
             'episode_id', CASE WHEN event_id % 41 <> 0 THEN cast(event_id AS string) END,
             'robot_id', concat('robot_', user_id % 5 + 1),
             'operator_id', concat('operator_', user_id % 10 + 1),
             'task_type', event_type,
             'status', CASE WHEN user_id % 10 = 0 THEN 'aborted' ELSE 'completed' END,
             'duration_ms', CASE WHEN event_id % 47 <> 0 THEN value * 10 END,
             'injected_failure', label,
             'sensor_frames', CASE WHEN event_id % 53 <> 0 THEN array(named_struct(
                'timestamp_ns', event_id * 5000000,
                'joint_positions', array_repeat(k / 100D, 12),
                'joint_velocities', array_repeat(value, 12))) END,
             '_score', CASE WHEN event_id % 17 <> 0 THEN named_struct(
                'frame_count', 600 * filled + k,
                'score_sensor_completeness', 100D * filled,
                'score_temporal_coherence', (100D - k) * filled,
                'score_motion_smoothness', value * filled,
                'score_task_completion', 60D * filled,
                'score_trajectory_validity', 12.5D * filled,
                'composite_score', CASE WHEN event_id % 43 = 0 THEN 120D
                                        ELSE greatest(0D, 100D - value) END * filled,
                'routing_decision', CASE
                   WHEN event_id % 31 = 0 OR filled IS NULL THEN NULL
                   WHEN event_id % 37 = 0 THEN 'PENDING'
                   WHEN k < 40 THEN 'CERTIFIED' WHEN k < 70 THEN 'BORDERLINE'
                   ELSE 'REJECTED' END,
                'failure_flags', CASE WHEN k % 3 <> 0 AND filled = 1
                   THEN array(concat('FLAG:', k), 'OTHER') END,
                'scoring_latency_ms', value / 10 * filled) END))
           AS text""",
    )
    return text.selectExpr(
        "event_id",
        """CASE WHEN event_id % 23 = 0 THEN left(text, length(text) - 5)
                WHEN event_id % 29 = 0 THEN concat('[', text, ']')
                ELSE text END AS text""",
    )


def nested_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One episode per embedding: a frame of 12 joints from each 12 components, the last one as short as what is left."""
    frames = """transform(sequence(0, cast((size(embedding) - 1) DIV 12 AS int)), i -> named_struct(
        'timestamp_ns', CASE WHEN (vec_id + i) % 9 <> 0 THEN i * 5000000L
           + CASE WHEN vec_id % 5 = 0 AND i >= 3 THEN 60000000L ELSE 0L END END,
        'joint_positions', CASE WHEN vec_id % 7 = 0 AND i BETWEEN 1 AND 1 + vec_id % 4
           THEN array_repeat(double('NaN'), 12)
           ELSE transform(slice(embedding, 12 * i + 1, 12), v -> v * scale) END,
        'joint_velocities', transform(slice(embedding, 12 * i + 1, 12),
           v -> cast(v AS double) * (1 + vec_id % 6)),
        'gripper_force', array(0D, 0D),
        'ee_pose', cast(array() AS array<double>),
        'frame_index', i))"""
    return (
        table(spark, sf_dir, "embeddings")
        .selectExpr(
            "*", "CASE WHEN vec_id % 3 = 0 THEN 3.0D ELSE 0.1D END AS scale"
        )
        .selectExpr(
            "cast(vec_id AS string) AS episode_id",
            "concat('robot_', vec_id % 5 + 1) AS robot_id",
            "concat('operator_', vec_id % 10 + 1) AS operator_id",
            f"""element_at(array({', '.join(repr(t) for t in TASK_TYPES)}),
                cast(vec_id % 5 AS int) + 1) AS task_type""",
            "vec_id AS session_ts",
            "CASE WHEN vec_id % 8 = 0 THEN 'aborted' ELSE 'completed' END AS status",
            "25D AS duration_ms",
            "vec_id % 8 <> 0 AS task_completed",
            "'none' AS injected_failure",
            "cast((size(embedding) - 1) DIV 12 + 1 AS int) AS frame_count",
            f"CASE WHEN vec_id % 50 = 7 THEN slice({frames}, 1, 0) ELSE {frames} END"
            " AS sensor_frames",
            """cast(array() AS array<struct<timestamp_ns: bigint, frame_id: int,
               exposure_ms: double, sync_ok: boolean, camera_id: string>>) AS camera_frames""",
            """array(
               named_struct('timestamp_ns', 0L, 'phase', 'approach', 'confidence', 0.95D),
               named_struct('timestamp_ns', 1L, 'phase',
                 CASE WHEN vec_id % 6 = 0 THEN 'retract' ELSE 'complete' END,
                 'confidence', (vec_id % 11) / 10D)) AS phase_events""",
        )
    )


def document_episodes(documents: DataFrame) -> DataFrame:
    """One episode per document and one frame per word: realistic lengths."""
    words = documents.selectExpr(
        "doc_id", "transform(split(text, ' ', -1), w -> length(w)) AS lengths"
    )
    return words.selectExpr(
        "cast(doc_id AS string) AS episode_id",
        "concat('robot_', doc_id % 5 + 1) AS robot_id",
        "concat('operator_', doc_id % 10 + 1) AS operator_id",
        f"""element_at(array({', '.join(repr(t) for t in TASK_TYPES)}),
            cast(doc_id % 5 AS int) + 1) AS task_type""",
        "'completed' AS status",
        "cast(size(lengths) * 5 AS double) AS duration_ms",
        "'none' AS injected_failure",
        """transform(lengths, (n, i) -> named_struct(
             'timestamp_ns', CASE WHEN n <> 13 THEN i * 5000000L END,
             'joint_positions', array_repeat(CASE WHEN n > 0 THEN n * 0.01D END, 12),
             'joint_velocities', array_repeat(CASE WHEN n > 0 THEN (n % 10) * 0.3D END, 12)
           )) AS sensor_frames""",
        """array(named_struct('timestamp_ns', 0L, 'phase', 'complete',
                              'confidence', (doc_id % 10) / 10D)) AS phase_events""",
    )
