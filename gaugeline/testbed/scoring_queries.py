"""Scoring operators run over frames and phases derived from the events table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import frames as rows
from gaugeline.plans import score
from gaugeline.testbed import adapters
from gaugeline.testbed.report_queries import Query


def over_frames(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(adapters.frames(spark, sf_dir))


def stats(*columns: str) -> Query:
    """Some of the frame statistics; Catalyst prunes the others."""
    return over_frames(lambda f: rows.frame_stats(f).selectExpr("episode_id", *columns))


def stats_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.episode_stats(
        adapters.episodes(spark, sf_dir),
        adapters.frames(spark, sf_dir),
        adapters.phases(spark, sf_dir),
    )


def dimension(name: str) -> Query:
    return lambda spark, sf_dir: score.dimension_scores(stats_over(spark, sf_dir)).select(
        "episode_id",
        F.col(name).alias("score"),
        F.coalesce(F.col(f"flag_{name}"), F.lit("")).alias("flag"),
    )


def composed(*columns: str) -> Query:
    return lambda spark, sf_dir: score.composite(
        score.dimension_scores(stats_over(spark, sf_dir))
    ).selectExpr("episode_id", *columns)


JOINED_FLAGS = "array_join(failure_flags, '|') AS failure_flags"


def score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score.score_episodes(
        adapters.episodes(spark, sf_dir),
        adapters.frames(spark, sf_dir),
        adapters.phases(spark, sf_dir),
    )
    return scored.withColumn("failure_flags", F.array_join("failure_flags", "|"))


def joints(frames: DataFrame, digits: int) -> DataFrame:
    return rows.explode_joints(frames).select(
        "episode_id",
        "frame_index",
        F.col("joint").cast("long").alias("joint"),
        F.round("position", digits).alias("position"),
        F.round("velocity", digits).alias("velocity"),
    )


def derived_velocity(frames: DataFrame) -> DataFrame:
    derived = rows.finite_diff_velocity(frames).withColumn("positions", F.col("velocities"))
    return joints(derived, 4).drop("position")


SCORING: dict[str, Query] = {
    "explode_frames": lambda spark, sf_dir: joints(
        rows.explode_frames(adapters.nested_frames(spark, sf_dir)), 6
    ).withColumn("frame_index", F.col("frame_index").cast("long")),
    "null_stats": stats("n_values", "n_null"),
    "longest_null_run": stats("max_null_run"),
    "gap_stats": stats(
        "n_stamps",
        "max_gap_ns",
        "n_bad_gaps",
        "round(mean_gap_ns, 3) AS mean_gap_ns",
        "round(abs(mean_gap_ns - 5000000) / 5000000D, 6) AS deviation",
    ),
    "velocity_rms": stats("n_pairs", "round(velocity_rms, 6) AS velocity_rms"),
    "limit_violations": stats("n_checked", "n_hard"),
    "position_jumps": stats("n_jumps"),
    "frame_gaps": over_frames(rows.frame_gaps),
    "finite_diff_velocity": over_frames(derived_velocity),
    "last_complete_phase": lambda spark, sf_dir: rows.last_complete_phase(
        adapters.phases(spark, sf_dir)
    ),
    "score_sensor": dimension("sensor_completeness"),
    "score_temporal": dimension("temporal_coherence"),
    "score_smoothness": dimension("motion_smoothness"),
    "score_task": dimension("task_completion"),
    "score_trajectory": dimension("trajectory_validity"),
    "episode_flags": composed(JOINED_FLAGS),
    "composite_score": composed("round(weighted, 4) AS weighted"),
    "hard_override": composed("overridden", "round(composite, 4) AS composite"),
    "routing": composed("routing_decision"),
    "score_episodes": score_all,
}
