"""Decode, quality, nested scoring and kinematics in SQL."""

from __future__ import annotations

from gaugeline.testbed.report_oracles import EVENTS, rnd
from gaugeline.testbed.scoring_oracles import ROUTED, RUNS, SCORE_OUT, SCORE_SELECT


def f32(x: str, name: str) -> str:
    wide = f"cast(cast({x} AS float) AS double)"
    return f"{rnd(wide, 3)} AS {name}"


def score_or_zero(x: str, name: str) -> str:
    return f32(f"coalesce({x}, 0)", name)


# A text survives when it is a whole JSON object with a filled ``_score``.
SILVER = f"""
silver AS (
  SELECT CASE WHEN event_id % 41 <> 0 THEN cast(event_id AS varchar) END AS episode_id,
         'robot_' || (user_id % 5 + 1) AS robot_id,
         'operator_' || (user_id % 10 + 1) AS operator_id,
         event_type AS task_type,
         CASE WHEN user_id % 10 = 0 THEN 'aborted' ELSE 'completed' END AS status,
         {f32("CASE WHEN event_id % 47 <> 0 THEN value * 10 ELSE 0 END", "duration_ms")},
         600 + k AS frame_count,
         CASE WHEN k < 70 THEN 'none' WHEN k < 76 THEN 'sensor_dropout'
              WHEN k < 81 THEN 'motion_jitter' WHEN k < 87 THEN 'timing_gap'
              WHEN k < 93 THEN 'incomplete_task' WHEN k < 97 THEN 'trajectory_anomaly'
              ELSE 'compound' END AS injected_failure,
         100.0::double AS sensor_completeness,
         cast(100 - k AS double) AS temporal_coherence,
         {f32("value", "motion_smoothness")},
         60.0::double AS task_completion,
         12.5::double AS trajectory_validity,
         {f32('''CASE WHEN event_id % 43 = 0 THEN 120
              ELSE greatest(0, 100.0::double - value) END''', "composite_score")},
         CASE WHEN event_id % 31 = 0 THEN 'REJECTED' WHEN event_id % 37 = 0 THEN 'PENDING'
              WHEN k < 40 THEN 'CERTIFIED' WHEN k < 70 THEN 'BORDERLINE'
              ELSE 'REJECTED' END AS routing_decision,
         CASE WHEN k % 3 <> 0 THEN 'FLAG:' || k || '|OTHER' ELSE '' END AS failure_flags,
         {f32("value / 10", "scoring_latency_ms")}
  FROM ev
  WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0
)"""

DROPPED = f"""WITH {EVENTS}, {SILVER}
SELECT * FROM silver
WHERE episode_id IS NOT NULL AND routing_decision IN ('CERTIFIED', 'BORDERLINE', 'REJECTED')"""

NESTED = """
vectors AS (
  SELECT vec_id, embedding, CASE WHEN vec_id % 3 = 0 THEN 3.0::double ELSE 0.1::double END AS scale
  FROM embeddings
),
fr AS (
  SELECT vec_id AS episode_id, i AS frame_index, embedding, scale,
         CASE WHEN (vec_id + i) % 9 <> 0 THEN i * 5000000
           + CASE WHEN vec_id % 5 = 0 AND i >= 3 THEN 60000000 ELSE 0 END END AS timestamp_ns
  FROM vectors, (SELECT unnest(range(6)) AS i)
  WHERE vec_id % 50 <> 7
),
jt AS (
  SELECT episode_id, frame_index, j AS joint,
         CASE WHEN NOT (episode_id % 7 = 0 AND frame_index BETWEEN 1 AND 1 + episode_id % 4)
           THEN round(cast(cast(cast(embedding[12 * frame_index + j + 1] AS double) * scale
                AS varchar) AS decimal(30,15)), {digits})::double END AS position,
         round(cast(cast(cast(embedding[12 * frame_index + j + 1] AS double)
                * (1 + episode_id % 6) AS varchar) AS decimal(30,15)), {digits})::double AS velocity
  FROM fr, (SELECT unnest(range(12)) AS j)
  WHERE 12 * frame_index + j < 64
),
moved AS (
  SELECT *, lag(position) OVER w AS position_before, lag(velocity) OVER w AS velocity_before
  FROM jt WINDOW w AS (PARTITION BY episode_id, joint ORDER BY frame_index)
),
limits AS (
  SELECT unnest(range(12)) AS joint,
         unnest([2.80, 1.40, 2.80, 1.80, 2.80, 1.40, 2.80, 0.90, 0.90, 1.40, 1.40, 1.40])::double
           AS lim
),
joint_stats AS (
  SELECT episode_id, 2 * count(*) AS n_values,
         2 * count(*) - count(position) - count(velocity) AS n_null,
         count(velocity - velocity_before) AS n_pairs,
         sqrt(avg((velocity - velocity_before) * (velocity - velocity_before))) AS velocity_rms,
         count(position) AS n_checked,
         count(*) FILTER (abs(position) > lim * CASE episode_id % 5 WHEN 0 THEN 0.90::double
           WHEN 1 THEN 0.95::double WHEN 2 THEN 0.85::double WHEN 3 THEN 0.80::double
           ELSE 0.85::double END) AS n_hard,
         count(*) FILTER (abs(position - position_before) > 0.15::double) AS n_jumps
  FROM moved JOIN limits USING (joint) GROUP BY episode_id
),
gaps AS (
  SELECT episode_id, timestamp_ns, timestamp_ns - lag(timestamp_ns) OVER (
           PARTITION BY episode_id ORDER BY frame_index) AS gap_ns
  FROM fr WHERE timestamp_ns IS NOT NULL
),
gap_stats AS (
  SELECT f.episode_id, count(g.timestamp_ns) AS n_stamps, max(gap_ns) AS max_gap_ns,
         count(*) FILTER (gap_ns > 50000000) AS n_bad_gaps, avg(gap_ns) AS mean_gap_ns
  FROM (SELECT DISTINCT episode_id FROM fr) f LEFT JOIN gaps g USING (episode_id)
  GROUP BY f.episode_id
),
headers AS (
  SELECT vec_id AS episode_id, 'robot_' || (vec_id % 5 + 1) AS robot_id,
         'operator_' || (vec_id % 10 + 1) AS operator_id,
         CASE vec_id % 5 WHEN 0 THEN 'pick_place' WHEN 1 THEN 'sheet_metal'
              WHEN 2 THEN 'bin_sort' WHEN 3 THEN 'fastener_drive' ELSE 'inspection' END
           AS task_type,
         CASE WHEN vec_id % 8 = 0 THEN 'aborted' ELSE 'completed' END AS status,
         vec_id % 6 <> 0 AS has_complete, (vec_id % 11) / 10.0::double AS confidence
  FROM embeddings
)"""


def nested_scores(digits: int, extra: str, select: str) -> str:
    """Scores of all episodes; those without frames are added at the end."""
    nested = NESTED.replace("{digits}", str(digits))
    empty = ", ".join(
        f"0.0::double AS score_{n}"
        for n in (
            "sensor_completeness",
            "temporal_coherence",
            "motion_smoothness",
            "task_completion",
            "trajectory_validity",
        )
    )
    return f"""WITH {nested}, {RUNS},
dims AS (
  SELECT headers.*, 6 AS frame_count, n_checked, n_hard, n_jumps, max_null_run, n_bad_gaps,
         {SCORE_SELECT}
  FROM headers JOIN joint_stats USING (episode_id) JOIN runs USING (episode_id)
       JOIN gap_stats USING (episode_id)
), {ROUTED},
results AS (
  SELECT cast(episode_id AS varchar) AS episode_id, robot_id, operator_id, task_type,
         {extra} frame_count, {SCORE_OUT} FROM routed
  UNION ALL
  SELECT cast(episode_id AS varchar), robot_id, operator_id, task_type, {extra} 0, {empty},
         0.0::double, 'REJECTED', 'NO_FRAMES'
  FROM headers WHERE episode_id % 50 = 7
)
SELECT {select} FROM results"""


P = [f"cast(embedding[5 * g + {j + 1}] AS double)" for j in range(5)]
Q = [f"(sin({P[j]} / 2) * 0.1::double)" for j in (2, 3, 4)]
POSE = [
    f"0.3::double + 0.2::double * sin({P[0]}) * cos({P[1]})",
    f"0.1::double + 0.2::double * sin({P[1]})",
    f"0.8::double + 0.15::double * cos({P[0]})",
    *Q,
    f"CASE WHEN {P[4]} IS NOT NULL THEN"
    f" sqrt(greatest(0, 1 - {Q[0]} * {Q[0]} - {Q[1]} * {Q[1]} - {Q[2]} * {Q[2]})) END",
]

PAYLOADS = {
    "bronze_project": """SELECT props AS payload, event_type AS source,
       cast(user_id % 32 AS integer) AS kafka_partition, event_id AS kafka_offset,
       cast(ts AS varchar) AS kafka_timestamp FROM events""",
    "silver_extract": f"WITH {EVENTS}, {SILVER} SELECT * FROM silver",
    "expect_drop": DROPPED,
    "payload_roundtrip": DROPPED,
    "expect_report": f"""WITH {EVENTS}, {SILVER},
checks AS (
  SELECT 'valid_episode_id' AS expectation, 'drop' AS action, episode_id IS NOT NULL AS ok
  FROM silver
  UNION ALL
  SELECT 'valid_routing', 'drop', routing_decision IN ('CERTIFIED', 'BORDERLINE', 'REJECTED')
  FROM silver
  UNION ALL
  SELECT 'valid_score', 'warn', composite_score BETWEEN 0 AND 100 FROM silver
)
SELECT expectation, action, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed
FROM checks GROUP BY 1, 2""",
    "validate_summary": f"""WITH {EVENTS},
seen AS (
  SELECT event_id % 23 <> 0 AND event_id % 29 <> 0 AS readable,
         event_id % 41 <> 0 AND event_id % 53 <> 0 AND event_id % 17 <> 0 AS complete,
         CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 31 = 0 THEN 'UNKNOWN'
              WHEN event_id % 37 = 0 THEN 'PENDING' WHEN k < 40 THEN 'CERTIFIED'
              WHEN k < 70 THEN 'BORDERLINE' ELSE 'REJECTED' END AS label
  FROM ev
)
SELECT count(*) FILTER (readable) AS received, count(*) FILTER (NOT readable) AS errors,
       count(*) FILTER (readable AND label = 'CERTIFIED') AS certified,
       count(*) FILTER (readable AND label = 'BORDERLINE') AS borderline,
       count(*) FILTER (readable AND label = 'REJECTED') AS rejected,
       count(*) FILTER (readable AND label = 'UNKNOWN') AS unknown,
       bool_and(complete) FILTER (readable) AS schema_valid
FROM seen""",
    "score_nested": nested_scores(12, "", "*"),
    "publish_decode": nested_scores(
        6,
        "status,",
        """episode_id, robot_id, operator_id, task_type, status, frame_count,
        score_sensor_completeness AS sensor_completeness,
        score_temporal_coherence AS temporal_coherence,
        score_motion_smoothness AS motion_smoothness,
        score_task_completion AS task_completion,
        score_trajectory_validity AS trajectory_validity,
        composite_score, routing_decision, failure_flags""",
    ),
    "clean_arrays": f"""SELECT vec_id, i AS pos,
       CASE WHEN (vec_id + i) % 29 <> 0
         THEN {rnd("cast(embedding[i + 1] AS double)", 6)} END AS value
FROM embeddings, (SELECT unnest(range(64)) AS i)""",
    "clip_joints": f"""SELECT vec_id, j AS pos,
       {rnd('''least(greatest(cast(embedding[j + 1] AS double) * 20, lo), hi)''', 6)} AS value
FROM embeddings, (
  SELECT j,
         [-3.14, -1.57, -3.14, -2.09, -3.14, -1.57, -3.14, -1, -1, 0, 0, 0][j % 12 + 1]::double AS lo,
         [3.14, 1.57, 3.14, 0.17, 3.14, 1.57, 3.14, 1, 1, 1.5, 1.5, 1.5][j % 12 + 1]::double AS hi
  FROM range(64) r(j)
)""",
    "ee_pose": f"""SELECT vec_id, 7 * g + unnest(range(7)) AS pos,
       unnest([{", ".join(rnd(f"({v})", 6) for v in POSE)}]) AS value
FROM embeddings, range(13) r(g)""",
    "payload_size": f"""SELECT doc_id, {rnd("(length(text) / 1024.0::double)", 6)} AS size_kb
FROM documents""",
}
