"""Scoring results in SQL, at joint level: no arrays, no chunks."""

from __future__ import annotations

from gaugeline.testbed.report_oracles import EVENTS, rnd

FRAMES = (
    EVENTS
    + """,
ranked AS (
  SELECT event_id, user_id, k,
         row_number() OVER w - 1 AS fi,
         sum(CASE WHEN event_id % 401 = 0 THEN 100000000 ELSE 0 END) OVER w AS stall
  FROM ev
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
),
fr AS (
  SELECT user_id AS episode_id, fi AS frame_index, event_id, k,
         CASE user_id % 5 WHEN 0 THEN 'pick_place' WHEN 1 THEN 'sheet_metal'
              WHEN 2 THEN 'bin_sort' WHEN 3 THEN 'fastener_drive' ELSE 'inspection' END
           AS task_type,
         CASE WHEN event_id % 53 <> 0 THEN cast(fi * 5000000 + stall AS bigint) END
           AS timestamp_ns,
         user_id % 7 = 0 AND fi BETWEEN 10 AND 10 + user_id % 6 AS gone
  FROM ranked
),
jt AS (
  SELECT episode_id, frame_index, task_type, j AS joint,
         CASE WHEN NOT (gone OR (j = 3 AND event_id % 211 = 0)) THEN
           0.02::double * ((frame_index + j) % 5)
           + CASE WHEN episode_id % 11 = 0 AND frame_index BETWEEN 20 AND 30
                  THEN 1.0::double ELSE 0.0::double END
           + CASE WHEN episode_id % 13 = 0 THEN 0.78::double ELSE 0.0::double END
           + CASE WHEN j = 7 AND episode_id % 17 = 0
                  THEN 0.70::double + CASE WHEN frame_index % 50 = 2 THEN 0.05::double
                                           ELSE 0.0::double END
                  ELSE 0.0::double END
         END AS position,
         CASE WHEN NOT gone THEN
           (k / 100.0::double - 0.5::double) * (1 + episode_id % 8) END AS velocity
  FROM fr, (SELECT unnest(range(12)) AS j)
),
moved AS (
  SELECT *, lag(position) OVER w AS position_before, lag(velocity) OVER w AS velocity_before,
         lead(position) OVER w AS position_after
  FROM jt
  WINDOW w AS (PARTITION BY episode_id, joint ORDER BY frame_index)
)"""
)

JOINT_STATS = """
limits(joint, lim) AS (
  VALUES (0, 2.80::double), (1, 1.40::double), (2, 2.80::double), (3, 1.80::double),
         (4, 2.80::double), (5, 1.40::double), (6, 2.80::double), (7, 0.90::double),
         (8, 0.90::double), (9, 1.40::double), (10, 1.40::double), (11, 1.40::double)
),
scales(task_type, scale) AS (
  VALUES ('pick_place', 0.90::double), ('sheet_metal', 0.95::double),
         ('bin_sort', 0.85::double), ('fastener_drive', 0.80::double),
         ('inspection', 0.85::double)
),
joint_stats AS (
  SELECT episode_id,
         2 * count(*) AS n_values,
         2 * count(*) - count(position) - count(velocity) AS n_null,
         count(velocity - velocity_before) AS n_pairs,
         sqrt(avg((velocity - velocity_before) * (velocity - velocity_before))) AS velocity_rms,
         count(position) AS n_checked,
         count(*) FILTER (abs(position) > lim * scale) AS n_hard,
         count(*) FILTER (abs(position - position_before) > 0.15::double) AS n_jumps
  FROM moved JOIN limits USING (joint) JOIN scales USING (task_type)
  GROUP BY episode_id
)"""

RUNS = """
broken AS (
  SELECT episode_id, frame_index, bool_or(position IS NULL OR velocity IS NULL) AS bad
  FROM jt GROUP BY episode_id, frame_index
),
islands AS (
  SELECT episode_id, frame_index - row_number() OVER (PARTITION BY episode_id
         ORDER BY frame_index) AS island
  FROM broken WHERE bad
),
lengths AS (SELECT episode_id, island, count(*) AS n FROM islands GROUP BY 1, 2),
runs AS (
  SELECT episode_id, coalesce(max(n), 0) AS max_null_run
  FROM (SELECT DISTINCT episode_id FROM fr) LEFT JOIN lengths USING (episode_id)
  GROUP BY episode_id
)"""

GAPS = """
gaps AS (
  SELECT episode_id, frame_index, timestamp_ns,
         timestamp_ns - lag(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY frame_index)
           AS gap_ns
  FROM fr WHERE timestamp_ns IS NOT NULL
),
gap_stats AS (
  SELECT f.episode_id, count(g.timestamp_ns) AS n_stamps, max(gap_ns) AS max_gap_ns,
         count(*) FILTER (gap_ns > 50000000) AS n_bad_gaps, avg(gap_ns) AS mean_gap_ns
  FROM (SELECT DISTINCT episode_id FROM fr) f LEFT JOIN gaps g USING (episode_id)
  GROUP BY f.episode_id
)"""

PHASES = """
recent AS (
  SELECT user_id AS episode_id, ts, event_id,
         CASE WHEN event_type = 'purchase' THEN 'complete' ELSE event_type END AS phase,
         k / 100.0::double AS confidence,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
  FROM ev
),
phase_stats AS (
  SELECT episode_id, bool_or(phase = 'complete') AS has_complete,
         arg_min(confidence, back) FILTER (phase = 'complete') AS confidence
  FROM recent GROUP BY episode_id
)"""

HEADERS = """
headers AS (
  SELECT DISTINCT user_id AS episode_id,
         'robot_' || lpad(cast(user_id % 5 + 1 AS varchar), 3, '0') AS robot_id,
         'operator_' || lpad(cast(user_id % 10 + 1 AS varchar), 3, '0') AS operator_id,
         CASE WHEN user_id % 10 = 0 THEN 'aborted' ELSE 'completed' END AS status
  FROM ev
)"""


def fmt(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rnd(x, digits)})"


FRACTION = "(n_null / n_values::double)"
DEVIATION = "(abs(mean_gap_ns - 5000000) / 5000000.0::double)"
RATE = "(n_hard / n_checked::double)"

DROPOUT = rnd("greatest(0, 75 - (max_null_run - 3) * 1.5::double)")
SCATTERED = rnd(f"greatest(60, 100 - {FRACTION} * 2000)")
GAPPY = rnd("greatest(0, 60 - (least(max_gap_ns / 50000000.0::double, 20) - 1) * 10)")
OFF_RATE = rnd(f"greatest(70, 100 - {DEVIATION} * 200)")
ROUGH = rnd("(100 - (velocity_rms - 1.65::double) / (2.2::double - 1.65::double) * 20)")
JITTERY = rnd("greatest(0, 80 - (velocity_rms - 2.2::double) * 40)")
JUMPY = rnd("greatest(0, 85 - n_jumps * 5.0::double)")
OVER = rnd(f"greatest(0, 100 - {RATE} * 2000)")

SCORES = {
    "sensor_completeness": (
        f"""CASE WHEN n_values = 0 THEN 0 WHEN max_null_run >= 3 THEN {DROPOUT}
          WHEN {FRACTION} > 0.005::double THEN {SCATTERED} ELSE 100 END""",
        f"""CASE WHEN n_values = 0 THEN 'SENSOR_COMPLETENESS:NO_READINGS'
          WHEN max_null_run >= 3 THEN 'SENSOR_COMPLETENESS:DROPOUT_WINDOW(' || max_null_run
            || ' consecutive null frames)'
          WHEN {FRACTION} > 0.005::double THEN 'SENSOR_COMPLETENESS:SCATTERED_NULLS('
            || {fmt(f"({FRACTION} * 100)", 2)} || '%)' END""",
    ),
    "temporal_coherence": (
        f"""CASE WHEN n_stamps < 2 THEN 0 WHEN n_bad_gaps > 0 THEN {GAPPY}
          WHEN {DEVIATION} < 0.05::double THEN 100 ELSE {OFF_RATE} END""",
        f"""CASE WHEN n_stamps < 2 THEN 'TEMPORAL_COHERENCE:TOO_FEW_TIMESTAMPS'
          WHEN n_bad_gaps > 0 THEN 'TEMPORAL_COHERENCE:GAP('
            || {fmt("(max_gap_ns / 1000000.0::double)", 1)} || 'ms max, ' || n_bad_gaps
            || ' violations)' END""",
    ),
    "motion_smoothness": (
        f"""CASE WHEN n_pairs = 0 THEN 50 WHEN velocity_rms <= 1.65::double THEN 100
          WHEN velocity_rms <= 2.2::double THEN {ROUGH} ELSE {JITTERY} END""",
        f"""CASE WHEN n_pairs = 0 THEN 'MOTION_SMOOTHNESS:NO_VALID_VELOCITIES'
          WHEN velocity_rms > 2.2::double THEN 'MOTION_SMOOTHNESS:JITTER(RMS='
            || {fmt("velocity_rms", 3)} || ' rad/s, threshold=2.2)' END""",
    ),
    "task_completion": (
        """CASE WHEN status <> 'completed' THEN 0 WHEN NOT has_complete THEN 60
          WHEN confidence >= 0.9::double THEN 100 WHEN confidence >= 0.7::double THEN 85
          ELSE 70 END""",
        f"""CASE WHEN status <> 'completed'
            THEN 'TASK_COMPLETION:ABORTED(status=' || status || ')'
          WHEN NOT has_complete THEN 'TASK_COMPLETION:MISSING_COMPLETE_PHASE'
          WHEN confidence < 0.7::double THEN 'TASK_COMPLETION:LOW_CONFIDENCE('
            || {fmt("confidence", 2)} || ')' END""",
    ),
    "trajectory_validity": (
        f"""CASE WHEN n_checked = 0 THEN 50 WHEN n_jumps > 0 THEN {JUMPY}
          WHEN {RATE} <= 0.001::double THEN 100 ELSE {OVER} END""",
        f"""CASE WHEN n_checked > 0 AND ({RATE} > 0.005::double OR n_jumps > 0)
          THEN 'TRAJECTORY_VALIDITY:ANOMALY(hard=' || {fmt(f"({RATE} * 100)", 2)}
            || '%, jumps=' || n_jumps || ')' END""",
    ),
}

SCORE_SELECT = ", ".join(
    f"cast({score} AS double) AS {name}, {flag} AS flag_{name}"
    for name, (score, flag) in SCORES.items()
)
ALL_FLAGS = ", ".join(f"flag_{name}" for name in SCORES)

ROUTED = f"""
summed AS (
  SELECT *, sensor_completeness * 0.20::double + temporal_coherence * 0.25::double
            + motion_smoothness * 0.25::double + task_completion * 0.20::double
            + trajectory_validity * 0.10::double AS weighted,
         task_completion = 0 OR motion_smoothness < 45
           OR flag_trajectory_validity IS NOT NULL OR max_null_run >= 3
           OR n_bad_gaps > 0 AS overridden,
         concat_ws('|', {ALL_FLAGS}) AS failure_flags
  FROM dims
),
final AS (
  SELECT *, CASE WHEN overridden THEN least(weighted, 69.9::double) ELSE weighted END
    AS composite FROM summed
),
routed AS (
  SELECT *, CASE WHEN composite >= 85 THEN 'CERTIFIED' WHEN composite >= 70 THEN 'BORDERLINE'
                 ELSE 'REJECTED' END AS routing_decision
  FROM final
)
"""

ALL_STATS = f"""WITH {FRAMES}, {JOINT_STATS}, {RUNS}, {GAPS}, {PHASES}, {HEADERS},
counted AS (
  SELECT episode_id, any_value(task_type) AS task_type, count(*) AS frame_count
  FROM fr GROUP BY episode_id
),
dims AS (
  SELECT headers.*, task_type, frame_count, n_checked, n_hard, n_jumps, max_null_run,
         n_bad_gaps, {SCORE_SELECT}
  FROM headers JOIN counted USING (episode_id) JOIN joint_stats USING (episode_id)
       JOIN runs USING (episode_id) JOIN gap_stats USING (episode_id)
       JOIN phase_stats USING (episode_id)
), {ROUTED}"""

SCORE_OUT = f"""{", ".join(f"{rnd(n)} AS score_{n}" for n in SCORES)},
       {rnd("composite")} AS composite_score, routing_decision, failure_flags"""


def dimension(name: str) -> str:
    return f"""{ALL_STATS}
SELECT episode_id, {name} AS score, coalesce(flag_{name}, '') AS flag FROM routed"""


STEP = """(CASE WHEN is_first AND is_last THEN NULL
         WHEN is_first THEN (position_after - position) / 0.005::double
         WHEN is_last THEN (position - position_before) / 0.005::double
         ELSE (position_after - position_before) / 0.01::double END)"""

SCORING = {
    "explode_frames": f"""WITH {FRAMES}
SELECT episode_id, frame_index, joint, {rnd("position", 6)} AS position,
       {rnd("velocity", 6)} AS velocity FROM jt""",
    "null_stats": f"""WITH {FRAMES}, {JOINT_STATS}
SELECT episode_id, n_values, n_null FROM joint_stats""",
    "longest_null_run": f"""WITH {FRAMES}, {RUNS}
SELECT episode_id, max_null_run FROM runs""",
    "gap_stats": f"""WITH {FRAMES}, {GAPS}
SELECT episode_id, n_stamps, max_gap_ns, n_bad_gaps, {rnd("mean_gap_ns", 3)} AS mean_gap_ns,
       {rnd(DEVIATION, 6)} AS deviation FROM gap_stats""",
    "velocity_rms": f"""WITH {FRAMES}, {JOINT_STATS}
SELECT episode_id, n_pairs, {rnd("velocity_rms", 6)} AS velocity_rms FROM joint_stats""",
    "limit_violations": f"""WITH {FRAMES}, {JOINT_STATS}
SELECT episode_id, n_checked, n_hard FROM joint_stats""",
    "position_jumps": f"""WITH {FRAMES}, {JOINT_STATS}
SELECT episode_id, n_jumps FROM joint_stats""",
    "frame_gaps": f"""WITH {FRAMES}, {GAPS}
SELECT episode_id, frame_index, gap_ns FROM gaps WHERE gap_ns IS NOT NULL""",
    "finite_diff_velocity": f"""WITH {FRAMES},
ends AS (
  SELECT *, frame_index = min(frame_index) OVER e AS is_first,
         frame_index = max(frame_index) OVER e AS is_last
  FROM moved WINDOW e AS (PARTITION BY episode_id)
)
SELECT episode_id, frame_index, joint, {rnd(STEP, 4)} AS velocity FROM ends""",
    "last_complete_phase": f"""WITH {EVENTS}, {PHASES}
SELECT episode_id, has_complete, confidence FROM phase_stats""",
    "score_sensor": dimension("sensor_completeness"),
    "score_temporal": dimension("temporal_coherence"),
    "score_smoothness": dimension("motion_smoothness"),
    "score_task": dimension("task_completion"),
    "score_trajectory": dimension("trajectory_validity"),
    "episode_flags": f"{ALL_STATS} SELECT episode_id, failure_flags FROM routed",
    "composite_score": f"""{ALL_STATS}
SELECT episode_id, {rnd("weighted", 4)} AS weighted FROM routed""",
    "hard_override": f"""{ALL_STATS}
SELECT episode_id, overridden, {rnd("composite", 4)} AS composite FROM routed""",
    "routing": f"{ALL_STATS} SELECT episode_id, routing_decision FROM routed",
    "score_episodes": f"""{ALL_STATS}
SELECT episode_id, robot_id, operator_id, task_type, status, frame_count, {SCORE_OUT}
FROM routed""",
}
