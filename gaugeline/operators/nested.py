"""Frame statistics computed inside the episode row.

Higher-order array functions only: one output row per input row, no shuffle and
no state, so it also runs in a stream. Memory per row is the episode itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeline.functions import arrays, scoring
from gaugeline.functions.arrays import JOINTS, number
from gaugeline.plans import score

LIMITS = f"array({', '.join(number(v) for v in scoring.JOINT_LIMITS)})"
JUMP = number(scoring.MAX_JUMP_RAD)

# ``get`` answers NULL for the frame before the first.
BEFORE_P12 = f"coalesce(get(frames, i - 1).p12, {arrays.NO_DOUBLES})"
BEFORE_V = f"coalesce(get(frames, i - 1).v, {arrays.NO_DOUBLES})"
MOVES = f"zip_with(f.p12, {BEFORE_P12}, (x, y) -> abs(x - y))"
EXCESS = f"zip_with(f.p12, {LIMITS}, (x, lim) -> abs(x) - lim * task_scale)"


def over(values: str, limit: str) -> str:
    """How many values exceed ``limit``; mostly settled by the largest one."""
    return (
        f"CASE WHEN array_max({values}) > {limit}"
        f" THEN size(filter({values}, x -> x > {limit})) ELSE 0 END"
    )


# One entry per frame. Lambdas are the cost here, so whatever a native array
# function can settle (no NULLs, nothing above a limit) is asked first.
FRAME_MEASURES = f"""transform(frames, (f, i) -> named_struct(
    'n_values', size(f.p) + size(f.v),
    'n_null', {arrays.count_null("f.p")} + {arrays.count_null("f.v")},
    'sum_sq', aggregate(
        zip_with(f.v, {BEFORE_V}, (x, y) -> {arrays.square("x - y")}),
        {arrays.NO_SQUARES}, (acc, d) -> {arrays.exact_sum(["acc", f"coalesce(d, {arrays.NO_SQUARES})"])}),
    'n_pairs', CASE
        WHEN array_contains(f.v, {arrays.NAN}) = false
             AND array_contains({BEFORE_V}, {arrays.NAN}) = false
          THEN least(size(f.v), size({BEFORE_V}))
        ELSE size(filter(zip_with(f.v, {BEFORE_V}, (x, y) -> x - y), d -> d IS NOT NULL)) END,
    'n_checked', size(f.p12) - ({arrays.count_null("f.p12")}),
    'n_hard', {over(EXCESS, "0D")},
    'n_jumps', {over(MOVES, JUMP)}
  ))"""

LONGEST_RUN = """aggregate(
    measures,
    named_struct('run', 0L, 'best', 0L),
    (acc, m) -> named_struct(
      'run', CASE WHEN m.n_null > 0 THEN acc.run + 1L ELSE 0L END,
      'best', CASE WHEN m.n_null > 0 THEN greatest(acc.best, acc.run + 1L) ELSE acc.best END)
  ).best"""


def summed(field: str) -> str:
    return f"aggregate(measures, 0L, (acc, m) -> acc + m.{field}) AS {field}"


def nested_stats(episodes: DataFrame) -> DataFrame:
    """Add the scorer's statistics columns to nested episode rows."""
    kept = [c for c in episodes.columns if c not in ("sensor_frames", "phase_events")]
    header = [f"`{c}`" for c in kept]
    return (
        episodes.selectExpr(
            *header,
            f"{scoring.TASK_SCALE_OF} AS task_scale",
            f"""transform(coalesce(sensor_frames, array()), f -> named_struct(
                  'ts', f.timestamp_ns,
                  'p', {arrays.readings("f.joint_positions")},
                  'p12', slice({arrays.readings("f.joint_positions")}, 1, {JOINTS}),
                  'v', {arrays.readings("f.joint_velocities")})) AS frames""",
            """filter(coalesce(phase_events, array()), e -> e.phase = 'complete')
               AS completes""",
        )
        .selectExpr(
            *header,
            "completes",
            "cast(size(frames) AS bigint) AS n_frames",
            f"{FRAME_MEASURES} AS measures",
            "transform(filter(frames, f -> f.ts IS NOT NULL), f -> f.ts) AS stamps",
        )
        .selectExpr(
            *header,
            "completes",
            "n_frames",
            "measures",
            "stamps",
            """zip_with(slice(stamps, 2, size(stamps)),
                        slice(stamps, 1, greatest(size(stamps) - 1, 0)),
                        (b, a) -> b - a) AS gaps""",
            f"""aggregate(measures, cast(0 AS {arrays.SQUARES_SUM}),
                 (acc, m) -> cast(acc + m.sum_sq AS {arrays.SQUARES_SUM})) AS sum_sq""",
            summed("n_pairs"),
        )
        .selectExpr(
            *header,
            "n_frames",
            summed("n_values"),
            summed("n_null"),
            f"{LONGEST_RUN} AS max_null_run",
            "cast(size(stamps) AS bigint) AS n_stamps",
            "array_max(gaps) AS max_gap_ns",
            f"cast(size(filter(gaps, g -> g > {scoring.MAX_GAP_NS})) AS bigint) AS n_bad_gaps",
            """(get(stamps, size(stamps) - 1) - get(stamps, 0)) / nullif(size(stamps) - 1, 0)
               AS mean_gap_ns""",
            "n_pairs",
            "sqrt(double(sum_sq) / nullif(n_pairs, 0)) AS velocity_rms",
            summed("n_checked"),
            summed("n_hard"),
            summed("n_jumps"),
            "size(completes) > 0 AS has_complete",
            "get(completes, size(completes) - 1).confidence AS confidence",
        )
    )


def scored_rows(episodes: DataFrame) -> DataFrame:
    """All columns of the scorer, with the input's other columns kept."""
    return score.composite(score.dimension_scores(nested_stats(episodes)))


def score_nested(episodes: DataFrame) -> DataFrame:
    """Score records of nested episodes; the counterpart of ``score_episodes``."""
    return scored_rows(episodes).selectExpr(
        "episode_id",
        "robot_id",
        "operator_id",
        "task_type",
        "cast(n_frames AS int) AS frame_count",
        "duration_ms",
        *score.SCORE_COLUMNS,
        "injected_failure",
    )
