"""ANSI SQL that computes each registered query's result independently."""

from __future__ import annotations


def rnd(x: str, digits: int = 2) -> str:
    """Round on the decimal text of a double, half away from zero."""
    return f"round(cast(cast({x} AS varchar) AS decimal(30,15)), {digits})::double"


EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') AS integer) AS k
  FROM events
)"""

SCORED = (
    EVENTS
    + f""",
scored_base AS (
  SELECT cast(event_id AS varchar) AS episode_id,
         'robot_' || lpad(cast(user_id % 5 + 1 AS varchar), 3, '0') AS robot_id,
         'operator_' || lpad(cast(user_id % 10 + 1 AS varchar), 3, '0') AS operator_id,
         event_type AS task_type, ts AS ingested_at, k, value,
         greatest(0.0, cast(round(100 - cast(value AS decimal(12,2)) *
           cast(CASE day(ts) % 3 WHEN 0 THEN '0.20' WHEN 1 THEN '0.28' ELSE '0.40' END
                AS decimal(4,2)), 2) AS double)) AS composite_score,
         CASE WHEN k < 70 THEN 'none' WHEN k < 76 THEN 'sensor_dropout'
              WHEN k < 81 THEN 'motion_jitter' WHEN k < 87 THEN 'timing_gap'
              WHEN k < 93 THEN 'incomplete_task' WHEN k < 97 THEN 'trajectory_anomaly'
              ELSE 'compound' END AS injected_failure,
         value / 10 AS scoring_latency_ms, 600 + k AS frame_count
  FROM ev
),
scored AS (
  SELECT *, cast(ingested_at AS date) AS day,
         CASE WHEN composite_score >= 85 THEN 'CERTIFIED'
              WHEN composite_score >= 70 THEN 'BORDERLINE' ELSE 'REJECTED' END
           AS routing_decision
  FROM scored_base
),
flagged AS (
  SELECT *, 'SENSOR_COMPLETENESS:DROPOUT_WINDOW(' || (k + 3) || ' consecutive null frames)'
           AS failure_flag, 'SENSOR_COMPLETENESS:DROPOUT_WINDOW' AS kind
  FROM scored WHERE k % 10 = 3
  UNION ALL
  SELECT *, 'TEMPORAL_COHERENCE:GAP(' || (k + 51) || '.5ms max, 2 violations)',
         'TEMPORAL_COHERENCE:GAP'
  FROM scored WHERE k % 7 = 2
  UNION ALL
  SELECT *, 'TASK_COMPLETION:MISSING_COMPLETE_PHASE', 'TASK_COMPLETION:MISSING_COMPLETE_PHASE'
  FROM scored WHERE value > 80
)"""
)

COUNTS = """count(*) FILTER (routing_decision = 'CERTIFIED') AS {c},
  count(*) FILTER (routing_decision = 'BORDERLINE') AS {b},
  count(*) FILTER (routing_decision = 'REJECTED') AS {r}"""

CENTS_MEAN = "sum(round(composite_score * 100)) / (count(composite_score) * 100.0::double)"


def percentile(p: float) -> str:
    """Interpolate between the two rows next to position (n - 1) * p."""
    at = f"(max(n) - 1) * {p}::double"
    low = f"max(composite_score) FILTER (i = floor((n - 1) * {p}::double))"
    high = f"max(composite_score) FILTER (i = ceil((n - 1) * {p}::double))"
    between = f"(ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high}"
    return rnd(f"(CASE WHEN floor({at}) = ceil({at}) THEN {low} ELSE {between} END)")


def placed(keys: str) -> str:
    return f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY composite_score) - 1 AS i,
         count(*) OVER (PARTITION BY {keys}) AS n
  FROM scored
)"""


def stats(keys: list[tuple[str, str]]) -> str:
    select = ", ".join(f"{expr} AS {name}" for expr, name in keys)
    by = ", ".join(expr for expr, _ in keys)
    return f"""WITH {SCORED}, {placed(by)}
SELECT {select}, count(*) AS total_episodes,
  {rnd(CENTS_MEAN)} AS avg_composite_score,
  min(composite_score) AS min_score, max(composite_score) AS max_score,
  {percentile(0.5)} AS p50_score, {percentile(0.95)} AS p95_score,
  {COUNTS.format(c="certified_count", b="borderline_count", r="rejected_count")},
  {rnd("100.0::double * count(*) FILTER (routing_decision = 'CERTIFIED') / count(*)")}
    AS certified_rate_pct
FROM placed GROUP BY {by}"""


def failures(flag: str) -> str:
    return f"""WITH {SCORED},
grouped AS (
  SELECT day, task_type, routing_decision, {flag} AS failure_flag,
         count(DISTINCT episode_id) AS affected_episodes,
         {rnd(CENTS_MEAN)} AS avg_score_when_flagged,
         min(composite_score) AS min_score_when_flagged
  FROM flagged GROUP BY 1, 2, 3, 4
)
SELECT cast(day AS varchar) AS report_date, task_type, routing_decision, failure_flag,
       affected_episodes, avg_score_when_flagged, min_score_when_flagged,
       cast(row_number() OVER (PARTITION BY day, task_type
            ORDER BY affected_episodes DESC, routing_decision, failure_flag) AS integer)
         AS failure_rank
FROM grouped"""


DAILY = f"""daily AS (
  SELECT day, count(*) AS total_episodes,
         {COUNTS.format(c="certified", b="borderline", r="rejected")},
         {rnd(CENTS_MEAN)} AS avg_composite_score,
         {rnd("100.0::double * count(*) FILTER (routing_decision = 'CERTIFIED') / count(*)")}
           AS certified_rate_pct
  FROM scored GROUP BY day
)"""

SLA_CASE = """CASE WHEN certified_rate_pct >= 70 THEN 'MET'
       WHEN certified_rate_pct >= 60 THEN 'AT_RISK' ELSE 'BREACHED' END AS sla_status"""


def sla(window: str) -> str:
    rolling = (
        "(sum(round(certified_rate_pct * 100)) OVER w) / ((count(*) OVER w) * 100.0::double)"
    )
    return f"""WITH {SCORED}, {DAILY}
SELECT cast(day AS varchar) AS report_date, total_episodes, certified, borderline, rejected,
       avg_composite_score, certified_rate_pct,
       {rnd(rolling)} AS rolling_7d_certified_rate_pct,
       round(avg(total_episodes) OVER w, 0) AS rolling_7d_avg_episodes,
       {SLA_CASE}
FROM daily WINDOW w AS ({window})"""


DATE = ("cast(day AS varchar)", "report_date")

GOLD = {
    "gold_daily_robot_stats": stats(
        [DATE, ("robot_id", "robot_id"), ("task_type", "task_type")]
    ),
    "operator_metrics": stats([("operator_id", "operator_id")]),
    "task_type_summary": stats([("task_type", "task_type")]),
    "score_percentiles": f"""WITH {SCORED}, {placed("robot_id, operator_id")}
SELECT robot_id, operator_id, {percentile(0.5)} AS p50_score, {percentile(0.95)} AS p95_score
FROM placed GROUP BY robot_id, operator_id""",
    "gold_failure_summary": failures("failure_flag"),
    "failure_kind_summary": failures("kind"),
    "gold_sla_compliance": sla("ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"),
    "sla_calendar_7d": sla(
        "ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW"
    ),
    "sla_status": f"""WITH {SCORED}, {DAILY}
SELECT cast(day AS varchar) AS report_date, certified_rate_pct, {SLA_CASE} FROM daily""",
    "routing_counts": f"""WITH {SCORED}
SELECT cast(day AS varchar) AS report_date,
  {COUNTS.format(c="certified_count", b="borderline_count", r="rejected_count")}
FROM scored GROUP BY day""",
    "distinct_affected": f"""WITH {SCORED}
SELECT failure_flag, count(DISTINCT episode_id) AS affected_episodes
FROM flagged GROUP BY failure_flag""",
    "run_summary": f"""WITH {SCORED},
run AS (
  SELECT count(*) AS n_episodes,
         {COUNTS.format(c="certified", b="borderline", r="rejected")},
         (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1000000.0::double AS elapsed
  FROM scored
)
SELECT n_episodes, certified, borderline, rejected,
       {rnd("100.0::double * certified / n_episodes")} AS certified_pct,
       {rnd("100.0::double * borderline / n_episodes")} AS borderline_pct,
       {rnd("100.0::double * rejected / n_episodes")} AS rejected_pct,
       {rnd("elapsed")} AS elapsed_s,
       {rnd("n_episodes / elapsed", 1)} AS throughput_eps,
       {rnd("n_episodes / elapsed * 3600", 0)} AS throughput_eph
FROM run""",
    "index_percentiles": f"""WITH {SCORED},
sorted AS (
  SELECT scoring_latency_ms AS v, row_number() OVER (ORDER BY scoring_latency_ms) - 1 AS i,
         count(*) OVER () AS n
  FROM scored
)
SELECT {rnd("max(v) FILTER (i = floor(n * 0.50::double))")} AS p50,
       {rnd("max(v) FILTER (i = floor(n * 0.99::double))")} AS p99
FROM sorted""",
    "detection_rate": f"""WITH {SCORED}
SELECT count(*) FILTER (injected_failure <> 'none') AS with_failure,
       count(*) FILTER (injected_failure <> 'none' AND routing_decision <> 'CERTIFIED') AS detected,
       {rnd('''100.0::double * count(*) FILTER (injected_failure <> 'none'
         AND routing_decision <> 'CERTIFIED') / count(*) FILTER (injected_failure <> 'none')''')}
         AS detection_rate_pct
FROM scored""",
    "detection_by_mode": f"""WITH {SCORED}
SELECT injected_failure, count(*) AS episodes,
       count(*) FILTER (routing_decision <> 'CERTIFIED') AS detected,
       {rnd("100.0::double * count(*) FILTER (routing_decision <> 'CERTIFIED') / count(*)")}
         AS detected_pct
FROM scored GROUP BY injected_failure""",
    "running_tally": f"""WITH {SCORED},
tally AS (
  SELECT row_number() OVER w AS n,
         cast(sum(CASE WHEN routing_decision = 'CERTIFIED' THEN 1 ELSE 0 END) OVER w AS bigint)
           AS certified,
         cast(sum(CASE WHEN routing_decision = 'BORDERLINE' THEN 1 ELSE 0 END) OVER w AS bigint)
           AS borderline,
         cast(sum(CASE WHEN routing_decision = 'REJECTED' THEN 1 ELSE 0 END) OVER w AS bigint)
           AS rejected
  FROM scored
  WINDOW w AS (ORDER BY ingested_at, episode_id ROWS UNBOUNDED PRECEDING)
)
SELECT n, certified, borderline, rejected FROM tally WHERE n % 100 = 0""",
    "category_shares": f"""WITH {SCORED},
domain(category, label) AS (
  VALUES ('failure_mode', 'none'), ('failure_mode', 'sensor_dropout'),
         ('failure_mode', 'motion_jitter'), ('failure_mode', 'timing_gap'),
         ('failure_mode', 'incomplete_task'), ('failure_mode', 'trajectory_anomaly'),
         ('failure_mode', 'compound'), ('task_type', 'pick_place'), ('task_type', 'sheet_metal'),
         ('task_type', 'bin_sort'), ('task_type', 'fastener_drive'), ('task_type', 'inspection')
),
labels_seen AS (
  SELECT 'failure_mode' AS category, injected_failure AS label FROM scored
  UNION ALL
  SELECT 'task_type', CASE frame_count % 4 WHEN 0 THEN 'pick_place' WHEN 1 THEN 'sheet_metal'
                      WHEN 2 THEN 'bin_sort' ELSE 'fastener_drive' END
  FROM scored
),
counted AS (SELECT category, label, count(*) AS n FROM labels_seen GROUP BY 1, 2),
total AS (SELECT count(*) AS total_episodes, cast(sum(frame_count) AS bigint) AS total_frames
          FROM scored)
SELECT category, label, coalesce(n, 0) AS episodes,
       {rnd("100.0::double * coalesce(n, 0) / total_episodes")} AS pct,
       total_episodes, total_frames
FROM domain LEFT JOIN counted USING (category, label) CROSS JOIN total""",
    "sample_limit": """SELECT event_id, user_id, event_type FROM events
ORDER BY event_id LIMIT 50""",
}

