"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from gaugeline.operators import frames as rows
from gaugeline.operators.nested import score_nested
from gaugeline.streaming import medallion
from gaugeline.testbed import adapters
from gaugeline.testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"
WITH_PYTHON = {"payload_roundtrip", "publish_decode"}
# Windows over one row per day or per minute: their input is aggregated first.
ONE_TASK_WINDOW = {
    "gold_sla_compliance", "sla_calendar_7d", "index_percentiles", "running_tally",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_needs_a_driver_or_a_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "ExistingRDD" not in text
    assert ("EvalPython" in text) == (name in WITH_PYTHON)
    single = "Exchange SinglePartition" in text and "Window [" in text
    if single and name not in ONE_TASK_WINDOW:
        # A global aggregate is fine, an unpartitioned window is not.
        assert not re.search(r"Window .*windowspecdefinition\((?!.*\], \[)", text)


def test_nothing_is_broadcast_by_hint(spark):
    df = adapters.frames(spark, SF)
    assert "rightHint=(strategy=broadcast)" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_frames_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "frames")
    adapters.frames(spark, SF).drop("chunk").write.parquet(path)
    text = plan(rows.frame_stats(spark.read.parquet(path)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(exchanges) == 2
    assert re.match(r"episode_id#\d+L, 4", exchanges[0])
    assert re.match(r"episode_id#\d+L, chunk#\d+L, 4", exchanges[1])


def test_neighbour_lookups_share_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "frames")
    adapters.frames(spark, SF).drop("chunk").write.parquet(path)
    frames = spark.read.parquet(path)
    for build in (rows.finite_diff_velocity, rows.frame_gaps):
        df = build(rows.with_chunk(frames, 10))
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final
        assert len(re.findall(r"FileScan", final)) == 1
        # Whole episodes need no look across chunks: the join disappears.
        df = build(frames)
        df.collect()
        assert "Join" not in plan(df).split("== Initial Plan ==")[0]


def test_columns_are_pruned(spark):
    text = plan(QUERIES["routing_counts"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text
    text = plan(QUERIES["gap_stats"](spark, SF))
    assert "transform(" not in text and "lag(" not in text


def test_phases_need_no_window(spark):
    assert "Window" not in plan(adapters.phases(spark, SF))


def test_decoding_runs_python_once(spark):
    bronze = spark.createDataFrame([], "payload binary, ingested_at timestamp")
    text = plan(medallion.silver(bronze))
    assert text.count("EvalPython") == 1


def test_nested_scoring_does_not_shuffle(spark):
    assert "Exchange" not in plan(score_nested(adapters.nested_episodes(spark, SF)))
