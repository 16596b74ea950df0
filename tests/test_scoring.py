"""Hand-made episodes through the nested form and the table form."""

from __future__ import annotations

import pytest
from episodes import baseline, build, lines
from pyspark.sql import functions as F

from gaugeline.functions import scoring
from gaugeline.operators import frames as rows
from gaugeline.operators.nested import nested_stats, score_nested
from gaugeline.plans import score
from gaugeline.schemas import EPISODE
from gaugeline.sources.tables import read_episodes

CASES = build()
DIMS = [f"score_{name}" for name in scoring.DIMENSIONS]


@pytest.fixture(scope="module")
def episodes(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("episodes") / "episodes.json"
    path.write_text("\n".join(lines()))
    return read_episodes(spark, str(path)).cache()


def as_tables(episodes, chunk_frames=None):
    frames = rows.explode_frames(episodes)
    if chunk_frames:
        frames = rows.with_chunk(frames, chunk_frames)
    phases = episodes.selectExpr(
        "episode_id", "posexplode(phase_events) AS (event_index, e)"
    ).selectExpr("episode_id", "event_index", "e.phase AS phase", "e.confidence AS confidence")
    headers = episodes.select(
        "episode_id", "robot_id", "operator_id", "task_type", "status", "injected_failure"
    )
    return headers, frames, phases


def check(scored):
    found = {r["episode_id"]: r for r in scored.collect()}
    assert set(found) == set(CASES)
    for name, (episode, dims, composite, routing, flags) in CASES.items():
        row = found[name]
        assert [row[d] for d in DIMS] == dims, name
        assert row["composite_score"] == composite, name
        assert row["routing_decision"] == routing, name
        assert row["failure_flags"] == flags, name
        assert row["frame_count"] == len(episode["sensor_frames"]), name


def test_nested_form(episodes):
    check(score_nested(episodes))


def test_table_form(episodes):
    check(score.score_episodes(*as_tables(episodes)))


@pytest.mark.parametrize("chunk_frames", [1, 3, 7])
def test_table_form_across_chunks(episodes, chunk_frames):
    check(score.score_episodes(*as_tables(episodes, chunk_frames)))


def test_scored_parameters_at_their_thresholds(spark):
    """One side and the other of every threshold, on statistics rows."""
    clean = dict(
        n_frames=10, n_values=24000, n_null=0, max_null_run=0, n_stamps=10, max_gap_ns=5_000_000,
        n_bad_gaps=0, mean_gap_ns=5e6, n_pairs=100, velocity_rms=1.0, n_checked=12000, n_hard=0,
        n_jumps=0, status="completed", has_complete=True, confidence=1.0,
    )
    wanted = [
        (dict(max_null_run=2), "sensor_completeness", 100.0, True),
        (dict(max_null_run=3), "sensor_completeness", 75.0, False),
        (dict(n_null=120), "sensor_completeness", 100.0, True),
        (dict(n_null=121), "sensor_completeness", 89.92, True),
        (dict(max_gap_ns=50_000_000), "temporal_coherence", 100.0, True),
        (dict(max_gap_ns=50_000_001, n_bad_gaps=1), "temporal_coherence", 60.0, False),
        (dict(mean_gap_ns=5.25e6), "temporal_coherence", 90.0, True),
        (dict(mean_gap_ns=5.24e6), "temporal_coherence", 100.0, True),
        (dict(velocity_rms=1.65), "motion_smoothness", 100.0, True),
        (dict(velocity_rms=1.66), "motion_smoothness", 99.64, True),
        (dict(velocity_rms=2.2), "motion_smoothness", 80.0, True),
        (dict(velocity_rms=3.075), "motion_smoothness", 45.0, True),
        (dict(velocity_rms=3.08), "motion_smoothness", 44.8, False),
        (dict(confidence=0.9), "task_completion", 100.0, True),
        (dict(confidence=0.89), "task_completion", 85.0, True),
        (dict(confidence=0.7), "task_completion", 85.0, True),
        (dict(confidence=0.69), "task_completion", 70.0, True),
        (dict(confidence=None), "task_completion", 70.0, True),
        (dict(n_hard=12), "trajectory_validity", 100.0, True),
        (dict(n_hard=13), "trajectory_validity", 97.83, True),
        (dict(n_hard=60), "trajectory_validity", 90.0, True),
        (dict(n_hard=61), "trajectory_validity", 89.83, False),
        (dict(n_jumps=1), "trajectory_validity", 80.0, False),
        (dict(n_jumps=17), "trajectory_validity", 0.0, False),
    ]
    schema = (
        "case int, n_frames long, n_values long, n_null long, max_null_run long, n_stamps long,"
        " max_gap_ns long, n_bad_gaps long, mean_gap_ns double, n_pairs long, velocity_rms double,"
        " n_checked long, n_hard long, n_jumps long, status string, has_complete boolean,"
        " confidence double"
    )
    data = [(i, *{**clean, **change}.values()) for i, (change, *_) in enumerate(wanted)]
    scored = score.composite(score.dimension_scores(spark.createDataFrame(data, schema)))
    found = {r["case"]: r for r in scored.collect()}
    for i, (change, dimension, value, free) in enumerate(wanted):
        assert found[i][dimension] == value, change
        assert found[i]["overridden"] is not free, change
        if not free:
            assert found[i]["composite"] == 69.9 and found[i]["routing_decision"] == "REJECTED"


def test_routing_uses_the_unrounded_composite(spark):
    values = [84.996, 85.0, 69.999, 70.0, 69.9]
    df = spark.createDataFrame([(v,) for v in values], "composite double")
    found = df.selectExpr(
        "round(composite, 2) AS shown", f"{scoring.routing('composite')} AS label"
    ).collect()
    assert [r["label"] for r in found] == [
        "BORDERLINE", "CERTIFIED", "REJECTED", "BORDERLINE", "REJECTED",
    ]
    assert found[0]["shown"] == 85.0


def test_nan_counts_as_null_and_extra_joints_count_for_completeness(spark):
    e = baseline(4)
    for f in e["sensor_frames"]:
        f["joint_positions"] = [0.0] * 13
        f["joint_velocities"] = [0.0] * 14
    e["sensor_frames"][1]["joint_positions"][2] = float("nan")
    e["sensor_frames"][2]["joint_velocities"][13] = 2.0
    e["sensor_frames"][3]["joint_velocities"][13] = 2.0
    episodes = spark.createDataFrame([e], EPISODE)
    for stats in (
        nested_stats(episodes),
        rows.frame_stats(rows.explode_frames(episodes)),
        rows.frame_stats(rows.with_chunk(rows.explode_frames(episodes), 2)),
    ):
        row = stats.first()
        assert (row["n_values"], row["n_null"], row["max_null_run"]) == (108, 1, 1)
        assert (row["n_checked"], row["n_jumps"], row["n_pairs"]) == (47, 0, 42)
        assert row["velocity_rms"] == pytest.approx((4.0 / 42) ** 0.5)


def test_both_forms_agree_on_every_statistic(spark, episodes):
    columns = [
        "episode_id", "n_frames", "n_values", "n_null", "max_null_run", "n_stamps", "max_gap_ns",
        "n_bad_gaps", "mean_gap_ns", "n_pairs", "velocity_rms", "n_checked", "n_hard", "n_jumps",
    ]
    nested = nested_stats(episodes).where("n_frames > 0").select(*columns)
    table = rows.frame_stats(rows.explode_frames(episodes)).select(*columns)
    by_id = lambda df: sorted(tuple(r) for r in df.withColumn(
        "velocity_rms", F.round("velocity_rms", 9)).collect())
    assert by_id(nested) == by_id(table)


def test_finite_differences_and_gaps_do_not_depend_on_chunks(spark):
    e = baseline(9)
    for i, f in enumerate(e["sensor_frames"]):
        f["joint_positions"] = [0.01 * i * i] * 12
        f["timestamp_ns"] = None if i in (2, 3, 4, 8) else i * 5_000_000
    frames = rows.explode_frames(spark.createDataFrame([e], EPISODE))
    expected_v = [2.0] + [0.01 * ((i + 1) ** 2 - (i - 1) ** 2) / 0.01 for i in range(1, 8)] + [30.0]
    expected_gaps = [(1, 5_000_000), (5, 20_000_000), (6, 5_000_000), (7, 5_000_000)]
    for size in (1 << 16, 3, 1):
        cut = rows.with_chunk(frames, size)
        velocities = rows.finite_diff_velocity(cut).orderBy("frame_index").collect()
        assert [r["velocities"][0] for r in velocities] == pytest.approx(expected_v)
        gaps = rows.frame_gaps(cut).orderBy("frame_index").collect()
        assert [(r["frame_index"], r["gap_ns"]) for r in gaps] == expected_gaps


def test_one_frame_has_no_velocity(spark):
    frames = rows.explode_frames(spark.createDataFrame([baseline(1)], EPISODE))
    assert rows.finite_diff_velocity(frames).first()["velocities"] == [None] * 12


def test_velocity_rms_does_not_depend_on_how_rows_are_split(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    draw = random.Random(7)
    e = baseline(200)
    for f in e["sensor_frames"]:
        f["joint_velocities"] = [draw.randrange(100) / 100 * 3 - 1.5 for _ in range(12)]
    episodes = spark.createDataFrame([e], EPISODE)
    frames = rows.explode_frames(episodes)
    v = [f["joint_velocities"] for f in e["sensor_frames"]]
    squares = [
        Decimal((a - b) * (a - b)).quantize(Decimal("1e-18"), ROUND_HALF_UP)
        for now, before in zip(v[1:], v[:-1])
        for a, b in zip(now, before)
    ]
    expected = (float(sum(squares)) / len(squares)) ** 0.5
    found = {nested_stats(episodes).first()["velocity_rms"]}
    for size in (1 << 16, 7, 3, 1):
        stats = rows.frame_stats(rows.with_chunk(frames, size).repartition(3))
        found.add(stats.first()["velocity_rms"])
    assert found == {expected}
