"""Gold kept current by batches, publication at once, and metrics that outlast their query."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import gold
from gaugeline.schemas import SILVER
from gaugeline.sinks import snapshots
from gaugeline.streaming import live_gold, medallion, progress


def silver(spark, rows):
    """Rows (episode, robot, task, operator, score, decision, flags, day)."""
    made = []
    for episode, robot, task, operator, score, decision, flags, day in rows:
        row = dict.fromkeys(SILVER.fieldNames())
        row |= {"episode_id": episode, "robot_id": robot, "task_type": task, "operator_id": operator}
        row |= {"composite_score": score, "routing_decision": decision, "failure_flags": flags}
        row["ingested_at"] = dt.datetime(2024, 5, day, 12) if day else None
        made.append(tuple(row.values()))
    return spark.createDataFrame(made, SILVER)


def made(first, n, days):
    for k in range(first, first + n):
        score = None if k % 13 == 0 else float(k * 7 % 101) + k % 4 * 0.25
        decision = ("CERTIFIED", "BORDERLINE", "REJECTED")[k % 3]
        flags = [None, [], ["A:1"], ["A:1", " A:1 ", f"B:{k % 5}"]][k % 4]
        yield (f"e{k % 17}", f"r{k % 3}", f"t{k % 2}", f"o{k % 4}", score, decision, flags, days[k % len(days)])


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    key = lambda rows: sorted(map(str, rows))
    assert key(left.select(columns).collect()) == key(right.select(columns).collect())


FULL = {
    "gold_daily_robot_stats": gold.gold_daily_robot_stats,
    "gold_failure_summary": gold.gold_failure_summary,
    "gold_sla_compliance": gold.gold_sla_compliance,
    "operator_metrics": gold.operator_metrics,
    "task_type_summary": gold.task_type_summary,
}


def is_full(spark, root, batches):
    whole = silver(spark, [r for b in batches for r in b])
    for name, build in FULL.items():
        same(live_gold.read_live(spark, root, name), build(whole))


def test_batches_give_what_a_full_recompute_gives(spark, tmp_path):
    """Overlapping days, a repeated batch, a batch without flags, and days that are null."""
    root = str(tmp_path)
    batches = [
        list(made(0, 60, [1, 2])),
        list(made(60, 50, [2, 3])),
        [("x", "r9", "t9", "o9", 50.0, "CERTIFIED", [], 7)],
        list(made(200, 9, [None, 1])),
    ]
    for k, rows in enumerate(batches):
        live_gold.fold(silver(spark, rows), k, root)
        if k == 1:
            live_gold.fold(silver(spark, rows), k, root)
    is_full(spark, root, batches)
    live_gold.fold(silver(spark, []), 4, root)
    is_full(spark, root, batches)


def test_untouched_days_are_not_written(spark, tmp_path):
    root = str(tmp_path)
    live_gold.fold(silver(spark, list(made(0, 40, [1, 2]))), 0, root)
    path = tmp_path / "live" / "gold_daily_robot_stats"
    before = {p: p.stat().st_mtime_ns for p in path.glob("report_date=2024-05-01/*.parquet")}
    live_gold.fold(silver(spark, list(made(40, 10, [2]))), 1, root)
    assert before == {p: p.stat().st_mtime_ns for p in path.glob("report_date=2024-05-01/*.parquet")}


def test_merged_state_is_the_same_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batches = [list(made(30 * k, 30, [k % 3 + 1, 1])) for k in range(5)]
    for k, rows in enumerate(batches[:4]):
        live_gold.fold(silver(spark, rows), k, root)
    # A merge that fails before its commit changes nothing.
    with monkeypatch.context() as broken:
        broken.setattr(live_gold, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            live_gold.compact(spark, root, 2)
    live_gold.compact(spark, root, 2)
    assert live_gold._batches(spark, root, "scores") == [3]
    live_gold.compact(spark, root, 2)
    # The newest batch can still be repeated.
    live_gold.fold(silver(spark, batches[3]), 3, root)
    live_gold.fold(silver(spark, batches[4]), 4, root)
    is_full(spark, root, batches)
    monkeypatch.setattr(live_gold, "APART", 1)
    live_gold.fold(silver(spark, batches[4]), 4, root)
    assert live_gold._batches(spark, root, "flags") == [4]
    is_full(spark, root, batches)


def test_gold_follows_the_silver_stream(spark, tmp_path):
    root = str(tmp_path)
    now = {"availableNow": True}
    batches = []
    for k in range(3):
        batches.append(list(made(40 * k, 40, [k + 1, 1])))
        silver(spark, batches[-1]).coalesce(1).write.mode("append").parquet(f"{root}/silver_episodes")
        medallion.start_gold(spark, root, now, max_files=1).awaitTermination()
        is_full(spark, root, batches)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path)
    first = snapshots.publish(spark.range(3), path)
    fails = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(fails, path)
    assert snapshots.read_snapshot(spark, path).count() == 3
    second = snapshots.publish(spark.range(5), path)
    assert snapshots.read_snapshot(spark, path).count() == 5
    assert snapshots.read_snapshot(spark, path, first).count() == 3
    # A reader of the old version goes on until it is old enough; then only the current one is left.
    assert snapshots.expire(spark, path, 3600) == []
    assert len(snapshots.expire(spark, path, -5)) == 2
    assert [v for _, v in snapshots.commits(spark, path)] == [second]
    assert snapshots.read_snapshot(spark, path).count() == 5


def test_a_failed_refresh_leaves_gold_readable(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = list(made(0, 30, [1]))
    silver(spark, rows).write.parquet(f"{root}/silver_episodes")
    medallion.refresh_gold(spark, root)
    want = medallion.read_gold(spark, root, "task_type_summary").collect()
    silver(spark, rows).write.mode("append").parquet(f"{root}/silver_episodes")
    broken = lambda df: gold.task_type_summary(df).withColumn("total_episodes", F.raise_error(F.lit("lost")).cast("long"))
    monkeypatch.setattr(medallion, "GOLD_TABLES", {"task_type_summary": broken})
    with pytest.raises(Exception, match="lost"):
        medallion.refresh_gold(spark, root)
    assert medallion.read_gold(spark, root, "task_type_summary").collect() == want
    monkeypatch.undo()
    medallion.refresh_gold(spark, root)
    medallion.expire_gold(spark, root, -5)
    assert sum(r["total_episodes"] for r in medallion.read_gold(spark, root, "task_type_summary").collect()) == 60


def test_metrics_of_two_hundred_batches(spark, tmp_path):
    """Counts over all batches equal those of one batch job; the driver keeps nothing per batch."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "metrics")
    spark.range(2000).repartition(200).write.parquet(source)
    log = progress.ProgressLog(spark, folder)
    spark.streams.addListener(log)
    try:
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        seen = rows.observe("seen", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("id") % 7 == 0).alias("sevens"))
        query = seen.writeStream.queryName("counted").format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    got = progress.batch_metrics(spark, folder)
    assert got.count() == 200 and got.select("batch_id").distinct().count() == 200
    assert {r["metric"]: r["n"] for r in progress.violations(got, "seen").collect()} == {"rows": 2000, "sevens": 286}
    row = progress.latencies(got).first()
    assert (row["name"], row["batches"], row["input_rows"]) == ("counted", 200, 2000) and 0 < row["p50_ms"] <= row["p99_ms"] <= row["total_ms"]
    assert len(query.recentProgress) <= 100 and len(vars(log)["_ended"]) == 1
    # A batch that is repeated replaces its own row.
    event = type("E", (), {"progress": type("P", (), {"id": row["query_id"], "runId": "again", "name": "counted", "batchId": 3, "timestamp": "t", "numInputRows": 10, "durationMs": {"triggerExecution": 1}, "observedMetrics": {}})()})()
    log.onQueryProgress(event)
    assert progress.batch_metrics(spark, folder).count() == 200
    assert json.loads((tmp_path / "metrics" / f"{row['query_id']}-{3:012d}.json").read_text())["run_id"] == "again"
    assert progress.batch_metrics(spark, str(tmp_path / "none")).count() == 0
