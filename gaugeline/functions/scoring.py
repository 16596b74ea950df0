"""The five dimension scores, overrides and routing, as SQL expressions.

They read the statistics columns (``n_values``, ``n_null``, ``max_null_run``,
``n_stamps``, ``max_gap_ns``, ``n_bad_gaps``, ``mean_gap_ns``, ``n_pairs``,
``velocity_rms``, ``n_checked``, ``n_hard``, ``n_jumps``, ``status``,
``has_complete``, ``confidence``), never the frames, so the table form and the
nested form of the scorer share them. A flag is NULL when it does not apply.
"""

from __future__ import annotations

from gaugeline.functions.arrays import number

# Thresholds, weights and limits of the scoring rules.
CERTIFIED_AT = 85.0
BORDERLINE_AT = 70.0
OVERRIDE_CAP = 69.9
WEIGHTS = {
    "sensor_completeness": 0.20,
    "temporal_coherence": 0.25,
    "motion_smoothness": 0.25,
    "task_completion": 0.20,
    "trajectory_validity": 0.10,
}
FRAME_INTERVAL_NS = 5_000_000
MAX_GAP_NS = 50_000_000
MAX_RMS = 2.2
CLEAN_RMS = 1.65
SEVERE_JITTER_SCORE = 45.0
MAX_JUMP_RAD = 0.15
JOINT_LIMITS = [2.80, 1.40, 2.80, 1.80, 2.80, 1.40, 2.80, 0.90, 0.90, 1.40, 1.40, 1.40]
TASK_SCALE = {
    "pick_place": 0.90,
    "sheet_metal": 0.95,
    "bin_sort": 0.85,
    "fastener_drive": 0.80,
    "inspection": 0.85,
}
DEFAULT_SCALE = 0.90
MIN_DROPOUT_RUN = 3
MAX_NULL_FRACTION = 0.005
MAX_HARD_RATE = 0.005
CLEAN_HARD_RATE = 0.001

DIMENSIONS = list(WEIGHTS)

NULL_FRACTION = "n_null / nullif(n_values, 0)"
HARD_RATE = "n_hard / nullif(n_checked, 0)"
DEVIATION = f"abs(mean_gap_ns - {FRAME_INTERVAL_NS}) / {number(FRAME_INTERVAL_NS)}"

IS_DROPOUT = f"(n_values > 0 AND max_null_run >= {MIN_DROPOUT_RUN})"
IS_SCATTERED = f"({NULL_FRACTION} > {number(MAX_NULL_FRACTION)})"
IS_GAP = f"(n_stamps >= 2 AND max_gap_ns > {MAX_GAP_NS})"
IS_ANOMALY = f"(n_checked > 0 AND ({HARD_RATE} > {number(MAX_HARD_RATE)} OR n_jumps > 0))"
IS_DONE = "(status <=> 'completed' AND coalesce(has_complete, false))"

TASK_SCALE_OF = (
    "CASE task_type "
    + " ".join(f"WHEN '{task}' THEN {number(scale)}" for task, scale in TASK_SCALE.items())
    + f" ELSE {number(DEFAULT_SCALE)} END"
)


def _at_least(floor: float, value: str) -> str:
    return f"round(greatest({number(floor)}, {value}), 2)"


SCORES = {
    "sensor_completeness": f"""CASE
        WHEN n_values = 0 THEN 0D
        WHEN {IS_DROPOUT}
          THEN {_at_least(0, f"75D - (max_null_run - {MIN_DROPOUT_RUN}) * 1.5D")}
        WHEN {IS_SCATTERED} THEN {_at_least(60, f"100D - {NULL_FRACTION} * 2000")}
        ELSE 100D END""",
    "temporal_coherence": f"""CASE
        WHEN n_stamps < 2 THEN 0D
        WHEN {IS_GAP} THEN {_at_least(0, f'''60D
          - (least(max_gap_ns / {number(MAX_GAP_NS)}, 20D) - 1D) * 10''')}
        WHEN {DEVIATION} < 0.05D THEN 100D
        ELSE {_at_least(70, f"100D - {DEVIATION} * 200")} END""",
    "motion_smoothness": f"""CASE
        WHEN n_pairs = 0 THEN 50D
        WHEN velocity_rms <= {CLEAN_RMS}D THEN 100D
        WHEN velocity_rms <= {MAX_RMS}D
          THEN round(100D - (velocity_rms - {CLEAN_RMS}D) / ({MAX_RMS}D - {CLEAN_RMS}D) * 20, 2)
        ELSE {_at_least(0, f"80D - (velocity_rms - {MAX_RMS}D) * 40")} END""",
    "task_completion": f"""CASE
        WHEN {IS_DONE} THEN
          CASE WHEN coalesce(confidence, 0D) >= 0.9D THEN 100D
               WHEN coalesce(confidence, 0D) >= 0.7D THEN 85D ELSE 70D END
        WHEN status <=> 'completed' THEN 60D
        ELSE 0D END""",
    "trajectory_validity": f"""CASE
        WHEN n_checked = 0 THEN 50D
        WHEN n_jumps > 0 THEN {_at_least(0, "85D - n_jumps * 5D")}
        WHEN {HARD_RATE} <= {number(CLEAN_HARD_RATE)} THEN 100D
        ELSE {_at_least(0, f"100D - {HARD_RATE} * 2000")} END""",
}

# The flag texts.
FLAGS = {
    "sensor_completeness": f"""CASE
        WHEN n_values = 0 THEN 'SENSOR_COMPLETENESS:NO_READINGS'
        WHEN {IS_DROPOUT} THEN format_string(
          'SENSOR_COMPLETENESS:DROPOUT_WINDOW(%d consecutive null frames)', max_null_run)
        WHEN {IS_SCATTERED} THEN format_string(
          'SENSOR_COMPLETENESS:SCATTERED_NULLS(%.2f%%)', {NULL_FRACTION} * 100) END""",
    "temporal_coherence": f"""CASE
        WHEN n_stamps < 2 THEN 'TEMPORAL_COHERENCE:TOO_FEW_TIMESTAMPS'
        WHEN {IS_GAP} THEN format_string(
          'TEMPORAL_COHERENCE:GAP(%.1fms max, %d violations)', max_gap_ns / 1e6D, n_bad_gaps)
        END""",
    "motion_smoothness": f"""CASE
        WHEN n_pairs = 0 THEN 'MOTION_SMOOTHNESS:NO_VALID_VELOCITIES'
        WHEN velocity_rms > {MAX_RMS}D THEN format_string(
          'MOTION_SMOOTHNESS:JITTER(RMS=%.3f rad/s, threshold=2.2)', velocity_rms) END""",
    "task_completion": f"""CASE
        WHEN {IS_DONE} THEN
          CASE WHEN coalesce(confidence, 0D) < 0.7D THEN format_string(
            'TASK_COMPLETION:LOW_CONFIDENCE(%.2f)', coalesce(confidence, 0D)) END
        WHEN status <=> 'completed' THEN 'TASK_COMPLETION:MISSING_COMPLETE_PHASE'
        ELSE format_string('TASK_COMPLETION:ABORTED(status=%s)', status) END""",
    "trajectory_validity": f"""CASE WHEN {IS_ANOMALY} THEN format_string(
          'TRAJECTORY_VALIDITY:ANOMALY(hard=%.2f%%, jumps=%d)', {HARD_RATE} * 100, n_jumps)
        END""",
}

# The composite before overrides, added up in dimension order.
WEIGHTED_SUM = " + ".join(f"{name} * {number(w)}" for name, w in WEIGHTS.items())

# Five conditions that good dimensions cannot make up for.
OVERRIDE_HIT = f"""(task_completion = 0 OR motion_smoothness < {SEVERE_JITTER_SCORE}D
    OR {IS_ANOMALY} OR {IS_DROPOUT} OR {IS_GAP})"""


def routing(composite: str) -> str:
    return (
        f"CASE WHEN {composite} >= {CERTIFIED_AT}D THEN 'CERTIFIED'"
        f" WHEN {composite} >= {BORDERLINE_AT}D THEN 'BORDERLINE' ELSE 'REJECTED' END"
    )
