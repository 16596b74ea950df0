"""Gold tables and reports against brute force on small inputs."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import gold, reports
from gaugeline.schemas import FAILURE_MODES, TASK_TYPES

SCHEMA = (
    "episode_id string, robot_id string, operator_id string, task_type string,"
    " ingested_at timestamp, composite_score float, routing_decision string,"
    " failure_flags array<string>, injected_failure string, scoring_latency_ms double,"
    " frame_count int"
)


def label(score):
    return "CERTIFIED" if score >= 85 else "BORDERLINE" if score >= 70 else "REJECTED"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    made = []
    for i in range(400):
        score = round(rng.choice([69.9, 100.0, rng.uniform(40, 100)]), 2)
        flags = rng.choice(
            [None, [], [" A_B:GAP(1.0ms max) "], ["A_B:GAP(1.0ms max)", "C_D:X"], ["NO_FRAMES"]]
        )
        # A third of the rows share one robot, task and day.
        hot = i % 3 == 0
        day = 3 if hot else rng.choice([1, 2, 3, 5, 6, 9, 20])
        made.append(
            (
                f"e{i % 350}",
                "r1" if hot else f"r{rng.randrange(1, 4)}",
                f"o{rng.randrange(3)}",
                "pick_place" if hot else rng.choice(TASK_TYPES[:3]),
                dt.datetime(2024, 1, day, 12, rng.randrange(60), tzinfo=dt.timezone.utc),
                score,
                label(score),
                flags,
                rng.choice(FAILURE_MODES[:5]),
                rng.choice([0.0, 1.25, -0.5, round(rng.uniform(0, 9), 3)]),
                600,
            )
        )
    return made


@pytest.fixture(scope="module")
def silver(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def half_up(x, digits=2):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def percentile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = int(at), -int(-at // 1)
    if low == high:
        return values[low]
    return (high - at) * values[low] + (at - low) * values[high]


def test_daily_robot_stats(silver, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[4].date(), r[1], r[3])].append(r)
    found = gold.gold_daily_robot_stats(silver).collect()
    keys = [(r["report_date"], r["robot_id"], r["task_type"]) for r in found]
    assert keys == sorted(groups)
    for r, key in zip(found, keys):
        scores = [x[5] for x in groups[key]]
        labels = Counter(x[6] for x in groups[key])
        n = len(scores)
        assert r["total_episodes"] == n
        assert r["avg_composite_score"] == half_up(round(sum(s * 100 for s in scores)) / (n * 100))
        assert (r["min_score"], r["max_score"]) == (min(scores), max(scores))
        assert r["p50_score"] == half_up(percentile(scores, 0.5))
        assert r["p95_score"] == half_up(percentile(scores, 0.95))
        assert r["certified_count"] == labels["CERTIFIED"]
        assert r["borderline_count"] == labels["BORDERLINE"]
        assert r["rejected_count"] == labels["REJECTED"]
        assert r["certified_rate_pct"] == half_up(100.0 * labels["CERTIFIED"] / n)


def test_percentiles_equal_the_built_in(silver):
    ours = gold.operator_metrics(silver).select("operator_id", "p50_score", "p95_score")
    built_in = silver.groupBy("operator_id").agg(
        F.round(F.expr("percentile(round(cast(composite_score AS double), 2), 0.5)"), 2),
        F.round(F.expr("percentile(round(cast(composite_score AS double), 2), 0.95)"), 2),
    )
    assert ours.collect() == built_in.orderBy("operator_id").collect()


def test_failure_summary(silver, rows):
    groups = defaultdict(list)
    for r in rows:
        for flag in r[7] or []:
            groups[(r[4].date(), r[3], r[6], flag.strip())].append(r)
    found = gold.gold_failure_summary(silver).collect()
    assert len(found) == len(groups)
    per_task = defaultdict(list)
    for r in found:
        members = groups[
            (r["report_date"], r["task_type"], r["routing_decision"], r["failure_flag"])
        ]
        assert r["affected_episodes"] == len({m[0] for m in members})
        assert r["min_score_when_flagged"] == min(m[5] for m in members)
        mean = round(sum(m[5] * 100 for m in members)) / (len(members) * 100)
        assert r["avg_score_when_flagged"] == half_up(mean)
        per_task[(r["report_date"], r["task_type"])].append(r)
    for members in per_task.values():
        ranked = sorted(
            members,
            key=lambda r: (-r["affected_episodes"], r["routing_decision"], r["failure_flag"]),
        )
        assert [r["failure_rank"] for r in ranked] == list(range(1, len(members) + 1))
    order = [(r["report_date"], r["task_type"], r["failure_rank"]) for r in found]
    assert order == sorted(order)


def test_missing_tasks_and_flags_are_ranked_too(spark):
    rows = []
    for i, flags in enumerate([["A"], ["A", "B"], [None, "B"], ["C", "A" * 60, "A" * 59 + "B"]]):
        for task in (None, "pick_place"):
            rows.append((f"e{i}", task, flags))
    df = spark.createDataFrame(
        rows, "episode_id string, task_type string, failure_flags array<string>"
    ).selectExpr(
        "*", "timestamp'2024-01-01' AS ingested_at", "cast(50 AS float) AS composite_score",
        "'REJECTED' AS routing_decision",
    )
    found = gold.gold_failure_summary(df).collect()
    for task in (None, "pick_place"):
        ranked = [(r["failure_rank"], r["failure_flag"]) for r in found if r["task_type"] == task]
        assert sorted(ranked) == [
            (1, "A"), (2, "B"), (3, None), (4, "A" * 60), (5, "A" * 59 + "B"), (6, "C"),
        ]


def test_failure_kinds(silver):
    kinds = {r["failure_flag"] for r in gold.failure_kind_summary(silver).collect()}
    assert kinds == {"A_B:GAP", "C_D:X", "NO_FRAMES"}


def test_sla(silver, rows):
    days = defaultdict(list)
    for r in rows:
        days[r[4].date()].append(r)
    rates = {
        d: half_up(100.0 * sum(r[6] == "CERTIFIED" for r in m) / len(m)) for d, m in days.items()
    }
    ordered = sorted(days)
    found = gold.gold_sla_compliance(silver).collect()
    assert [r["report_date"] for r in found] == ordered[::-1]
    calendar = {r["report_date"]: r for r in gold.sla_calendar_7d(silver).collect()}
    for r in found:
        day = r["report_date"]
        week = ordered[max(0, ordered.index(day) - 6) : ordered.index(day) + 1]
        mean = sum(round(rates[d] * 100) for d in week) / (len(week) * 100)
        assert r["rolling_7d_certified_rate_pct"] == half_up(mean)
        assert r["rolling_7d_avg_episodes"] == half_up(
            sum(len(days[d]) for d in week) / len(week), 0
        )
        rate = r["certified_rate_pct"]
        assert r["sla_status"] == ("MET" if rate >= 70 else "AT_RISK" if rate >= 60 else "BREACHED")
        near = [d for d in ordered if 0 <= (day - d).days <= 6]
        mean = sum(round(rates[d] * 100) for d in near) / (len(near) * 100)
        assert calendar[day]["rolling_7d_certified_rate_pct"] == half_up(mean)


def test_sla_labels_sit_on_the_rounded_rate(spark):
    df = spark.createDataFrame([(70.0,), (69.99,), (60.0,), (59.99,)], "rate double")
    labels = [r[0] for r in df.select(gold.sla_status(F.col("rate"))).collect()]
    assert labels == ["MET", "AT_RISK", "AT_RISK", "BREACHED"]


@pytest.mark.parametrize("n", [1, 2, 99, 100, 101, 400])
def test_index_percentiles(spark, rows, n):
    values = [r[9] for r in rows[:n]]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = reports.index_percentiles(df, "v").first()
    values.sort()
    assert row["p50"] == half_up(values[int(n * 0.5)])
    assert row["p99"] == half_up(values[int(n * 0.99)])


def test_index_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert reports.index_percentiles(df, "v").collect() == [(None, None)]


def test_category_shares_fill_zeros(silver, rows):
    found = {(r["category"], r["label"]): r for r in reports.category_shares(silver).collect()}
    assert len(found) == len(FAILURE_MODES) + len(TASK_TYPES)
    modes, tasks = Counter(r[8] for r in rows), Counter(r[3] for r in rows)
    for mode in FAILURE_MODES:
        assert found["failure_mode", mode]["episodes"] == modes[mode]
    for task in TASK_TYPES:
        row = found["task_type", task]
        assert row["episodes"] == tasks[task]
        assert row["pct"] == half_up(100.0 * tasks[task] / len(rows))
        assert (row["total_episodes"], row["total_frames"]) == (400, 240_000)


def test_category_shares_of_nothing(spark):
    found = reports.category_shares(spark.createDataFrame([], SCHEMA)).collect()
    assert {r["pct"] for r in found} == {0.0} and {r["total_episodes"] for r in found} == {0}


def test_detection(silver, rows):
    failed = [r for r in rows if r[8] != "none"]
    caught = sum(r[6] != "CERTIFIED" for r in failed)
    row = reports.detection_rate(silver).first()
    assert (row["with_failure"], row["detected"]) == (len(failed), caught)
    by_mode = {r["injected_failure"]: r for r in reports.detection_by_mode(silver).collect()}
    clean = [r for r in rows if r[8] == "none"]
    assert by_mode["none"]["detected"] == sum(r[6] != "CERTIFIED" for r in clean)


def test_run_summary_counts_unknown_labels_as_rejected(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [
            ("CERTIFIED", at),
            ("BORDERLINE", at),
            ("PENDING", at + dt.timedelta(hours=26, seconds=4)),
        ],
        "routing_decision string, ingested_at timestamp",
    )
    row = reports.run_summary(df).first()
    assert (row["n_episodes"], row["certified"], row["borderline"], row["rejected"]) == (3, 1, 1, 1)
    assert row["elapsed_s"] == 93604.0


def test_running_tally(silver, rows):
    found = reports.running_tally(silver, every=50).orderBy("n").collect()
    ordered = sorted(rows, key=lambda r: (r[4], r[0]))
    assert [r["n"] for r in found] == list(range(50, 401, 50))
    for r in found:
        seen = Counter(x[6] for x in ordered[: r["n"]])
        assert r["certified"] + r["borderline"] + r["rejected"] == r["n"]
        # Rows with equal time and id may swap; counts then differ by at most those.
        assert abs(r["certified"] - seen["CERTIFIED"]) <= 2
