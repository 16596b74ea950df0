"""The whole scorer: statistics in, one score row per episode out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeline.functions import scoring
from gaugeline.operators import frames as rows

SCORE_COLUMNS = [
    *[f"round({name}, 2) AS score_{name}" for name in scoring.DIMENSIONS],
    "round(composite, 2) AS composite_score",
    "routing_decision",
    "failure_flags",
]


def episode_stats(
    episodes: DataFrame, frames: DataFrame, phases: DataFrame
) -> DataFrame:
    """Attach frame and phase statistics to episode headers.

    All three sides have one row per episode and are hashed on ``episode_id``,
    so the joins need no further shuffle of the frame statistics. Headers keep
    episodes without frames.
    """
    return (
        episodes.join(rows.frame_stats(frames), "episode_id", "left")
        .join(rows.last_complete_phase(phases), "episode_id", "left")
        .fillna({"n_frames": 0})
    )


def dimension_scores(stats: DataFrame) -> DataFrame:
    """Add the five dimension scores and their flags."""
    return stats.selectExpr(
        "*",
        *[
            f"CASE WHEN n_frames > 0 THEN {score} ELSE 0D END AS {name}"
            for name, score in scoring.SCORES.items()
        ],
        *[
            f"CASE WHEN n_frames > 0 THEN {flag} END AS flag_{name}"
            for name, flag in scoring.FLAGS.items()
        ],
    )


def composite(scored: DataFrame) -> DataFrame:
    """Weighted sum, overrides and routing on the unrounded composite."""
    flags = ", ".join(f"flag_{name}" for name in scoring.DIMENSIONS)
    return (
        scored.selectExpr(
            "*",
            f"CASE WHEN n_frames > 0 THEN {scoring.WEIGHTED_SUM} ELSE 0D END AS weighted",
            f"coalesce(n_frames > 0 AND {scoring.OVERRIDE_HIT}, false) AS overridden",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN overridden THEN least(weighted, {scoring.OVERRIDE_CAP}D)
                ELSE weighted END AS composite""",
        )
        .selectExpr(
            "*",
            f"{scoring.routing('composite')} AS routing_decision",
            f"""CASE WHEN n_frames > 0 THEN array_compact(array({flags}))
                ELSE array('NO_FRAMES') END AS failure_flags""",
        )
    )


def score_episodes(episodes: DataFrame, frames: DataFrame, phases: DataFrame) -> DataFrame:
    """Score frame, phase and episode tables; one row per episode."""
    scored = composite(dimension_scores(episode_stats(episodes, frames, phases)))
    return scored.selectExpr(
        *episodes.columns, "n_frames AS frame_count", *SCORE_COLUMNS
    )
