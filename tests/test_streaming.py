"""Topic files through bronze, silver and gold with restarts."""

from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from episodes import build
from pyspark.sql import functions as F

from gaugeline.operators.nested import score_nested
from gaugeline.plans.reports import validate_records
from gaugeline.schemas import EPISODE, RECORD
from gaugeline.sinks.publish import publish_frame, size_kb, to_files
from gaugeline.sources.topic import file_topic
from gaugeline.streaming import medallion

CASES = build()
AT = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def episodes(spark):
    return spark.createDataFrame([e for e, *_ in CASES.values()], EPISODE).cache()


def as_records(spark, values, first_offset=0):
    rows = [
        (None, bytearray(v) if v is not None else None, "episodes", 0, first_offset + i, AT)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RECORD).coalesce(1)


def test_bronze_to_gold_with_restart(spark, episodes, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "tables")
    values = [bytes(r["value"]) for r in publish_frame(episodes, "episodes").collect()]
    half = len(values) // 2
    as_records(spark, values[:half] + [None, b"junk"]).write.mode("append").parquet(topic)
    counts = medallion.run_once(file_topic(spark, topic), root)
    assert counts["rows"] == half
    assert spark.read.parquet(f"{root}/bronze_episodes").count() == half + 2

    # Restart on the same checkpoint: only the new records are processed.
    as_records(spark, values[half:], first_offset=1000).write.mode("append").parquet(topic)
    counts = medallion.run_once(file_topic(spark, topic, max_files=1), root)
    assert counts["rows"] == len(values) - half
    counts = medallion.run_once(file_topic(spark, topic), root)
    assert counts.get("rows", 0) == 0

    silver = spark.read.parquet(f"{root}/silver_episodes")
    found = {r["episode_id"]: r for r in silver.collect()}
    assert silver.count() == len(CASES) == len(found)
    for name, (_, dims, composite, routing, flags) in CASES.items():
        row = found[name]
        assert row["routing_decision"] == routing and row["failure_flags"] == flags
        assert row["composite_score"] == pytest.approx(composite, abs=1e-4)
        assert row["sensor_completeness"] == pytest.approx(dims[0])
        assert row["scored_at"] and row["ingested_at"]

    certified = sum(c[3] == "CERTIFIED" for c in CASES.values())
    sla = medallion.read_gold(spark, root, "gold_sla_compliance").agg(
        F.sum("total_episodes"), F.sum("certified")
    )
    assert tuple(sla.first()) == (len(CASES), certified)
    stats = medallion.read_gold(spark, root, "gold_daily_robot_stats")
    assert stats.agg(F.min("min_score")).first()[0] == 0.0
    failures = medallion.read_gold(spark, root, "gold_failure_summary").collect()
    assert "NO_FRAMES" in {r["failure_flag"] for r in failures}
    pruned = silver.where("routing_decision = 'CERTIFIED'")
    text = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(routing_decision" in text


def test_scoring_inside_the_stream(spark, episodes, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "tables")
    texts = [json.loads(r[0]) for r in episodes.select(F.to_json(F.struct("*"))).collect()]
    values = [gzip.compress(json.dumps(t).encode()) for t in texts[:4]]
    values += [json.dumps(t).encode() for t in texts[4:]] + [b"junk"]
    as_records(spark, values).write.parquet(topic)
    now = {"availableNow": True}
    medallion.start_bronze(file_topic(spark, topic), root, now).awaitTermination()
    query = medallion.start_rescored(spark, root, now)
    query.awaitTermination()
    times = [t for t in medallion.batch_times(query) if t["numInputRows"]]
    assert len(times) == 1 and times[0]["triggerExecution"] > 0
    found = spark.read.parquet(f"{root}/rescored_episodes")
    wanted = score_nested(episodes)
    columns = wanted.columns
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, wanted.collect()))


def test_published_files_are_a_topic(spark, episodes, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "tables")
    to_files(publish_frame(episodes, "episodes"), topic)
    records = spark.read.schema(RECORD).parquet(topic)
    row = validate_records(records).first()
    assert row["received"] == len(CASES) and row["errors"] == 0 and row["schema_valid"] is True
    assert row["certified"] == sum(c[3] == "CERTIFIED" for c in CASES.values())
    assert validate_records(records, max_events=5).first()["received"] == 5
    assert medallion.run_once(file_topic(spark, topic), root)["rows"] == len(CASES)


def test_counts_survive_many_batches(spark, episodes, tmp_path):
    """More batches than a query lists; broken payloads are set aside and counted."""
    topic, root = str(tmp_path / "topic"), str(tmp_path / "tables")
    good = json.loads(episodes.select(F.to_json(F.struct("*"))).first()[0])
    good["_score"] = {"routing_decision": "CERTIFIED", "composite_score": 1.0}
    null = good | {"_score": {"routing_decision": None, "composite_score": 1.0}}
    for _ in range(4):
        as_records(spark, [gzip.compress(json.dumps(v).encode()) for v in (good, null)] + [b"junk"]).write.mode("append").parquet(topic)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        counts = medallion.run_once(file_topic(spark, topic, max_files=1), root, max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert counts["rows"] == 8 and counts["quarantined"] == 4
    assert spark.read.parquet(f"{root}/silver_episodes").count() == 4
    assert spark.read.parquet(f"{root}/quarantined_episodes").count() == 4


def test_published_payload_is_the_wire_format(spark, episodes):
    sent = publish_frame(episodes.where("episode_id IN ('E3', 'E6c')"), "episodes").collect()
    docs = [json.loads(gzip.decompress(bytes(r["value"]))) for r in sent]
    assert {r["topic"] for r in sent} == {"episodes"} and {r["key"] for r in sent} == {None}
    by_id = {d["episode_id"]: d for d in docs}
    e3 = by_id["E3"]
    assert "frame_count" not in e3 and e3["_score"]["frame_count"] == 10
    assert len(e3["_score"]) == 17
    assert e3["sensor_frames"][3]["joint_positions"] == [None] * 12
    assert by_id["E6c"]["sensor_frames"][5]["timestamp_ns"] is None
    assert b": " not in gzip.decompress(bytes(sent[0]["value"]))


def test_nan_is_sent_as_null_and_scored_rounded(spark, episodes):
    odd = episodes.where("episode_id = 'E1'").withColumn(
        "sensor_frames",
        F.expr(
            """transform(sensor_frames, f -> named_struct('timestamp_ns', f.timestamp_ns,
               'joint_positions', array_repeat(0.12345678D, 12),
               'joint_velocities', array_repeat(double('NaN'), 12),
               'gripper_force', f.gripper_force, 'ee_pose', f.ee_pose,
               'frame_index', f.frame_index))"""
        ),
    )
    doc = json.loads(gzip.decompress(bytes(publish_frame(odd, "t").first()["value"])))
    assert doc["sensor_frames"][0]["joint_velocities"] == [None] * 12
    assert doc["sensor_frames"][0]["joint_positions"][0] == 0.12345678
    assert doc["_score"]["score_sensor_completeness"] == 64.5


def test_document_size(spark, episodes):
    row = size_kb(episodes.where("episode_id = 'E2'")).first()
    assert 0.2 < row["size_kb"] < 1.0


def test_checkpoints_follow_the_session(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert medallion.checkpoint_dir(spark, str(tmp_path), "bronze").startswith(shared)


def test_a_mixed_topic_is_scored_on_the_way(spark, episodes, tmp_path):
    """Episodes with and without a score give the silver and gold of a topic where all were scored before."""
    columns = ["episode_id", "frame_count", "composite_score", "routing_decision", "failure_flags", "sensor_completeness", "injected_failure", "status", "duration_ms"]
    scored = [bytes(r["value"]) for r in publish_frame(episodes, "episodes").collect()]
    bare = [
        gzip.compress(json.dumps({k: v for k, v in json.loads(gzip.decompress(v)).items() if k != "_score"}).encode())
        for v in scored
    ]
    mixed = [b if k % 2 else s for k, (s, b) in enumerate(zip(scored, bare, strict=True))]
    found = {}
    for name, values in (("scored", scored), ("mixed", mixed), ("bare", bare)):
        topic, root = str(tmp_path / name / "topic"), str(tmp_path / name / "tables")
        as_records(spark, [*values, b"junk", gzip.compress(b"[1]"), None]).write.parquet(topic)
        counts = medallion.run_once(file_topic(spark, topic), root, score=True)
        silver = spark.read.parquet(f"{root}/silver_episodes").select(columns).collect()
        gold = medallion.read_gold(spark, root, "gold_failure_summary").drop("report_date").collect()
        found[name] = (counts, sorted(map(str, silver)), sorted(map(str, gold)))
    assert found["scored"] == found["mixed"] == found["bare"] and len(found["bare"][1]) == len(CASES)
    # Without scoring they are dropped, as before.
    root = str(tmp_path / "dropped")
    assert medallion.run_once(file_topic(spark, str(tmp_path / "bare" / "topic")), root)["rows"] == 0


def test_offsets_grow_without_gaps(spark, episodes, tmp_path):
    """Three appends, with and without keys: (partition, offset) is unique and dense, and earlier offsets stay."""
    topic = str(tmp_path / "topic")
    payloads = spark.range(1000).repartition(7).selectExpr("CASE WHEN id % 3 = 0 THEN cast(cast(id % 20 AS string) AS binary) END AS key", "cast(cast(id AS string) AS binary) AS value", "'t' AS topic")
    seen = {}
    for k in range(3):
        to_files(payloads.selectExpr("key", f"concat(value, cast('-{k}' AS binary)) AS value", "topic"), topic)
        rows = spark.read.schema(RECORD).parquet(topic).collect()
        assert len(rows) == 1000 * (k + 1)
        at = {(r["partition"], r["offset"]): bytes(r["value"]) for r in rows}
        assert len(at) == len(rows) and seen.items() <= at.items()
        for p in {p for p, _ in at}:
            assert sorted(o for q, o in at if q == p) == list(range(sum(q == p for q, _ in at)))
        seen = at
    assert {p for p, _ in seen} == set(range(32))
    keyed = spark.read.schema(RECORD).parquet(topic).where("key IS NOT NULL").groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert keyed.where("n > 1").count() == 0
    plain = str(tmp_path / "one")
    to_files(publish_frame(episodes, "episodes"), plain, partitions=1)
    rows = spark.read.schema(RECORD).parquet(plain).collect()
    assert sorted(r["offset"] for r in rows) == list(range(len(CASES)))
    assert not (tmp_path / "one__publishing").exists() or not list((tmp_path / "one__publishing").iterdir())


def test_named_tables_stream_from_each_other(spark, episodes, tmp_path):
    topic, scratch = str(tmp_path / "topic"), str(tmp_path / "scratch")
    values = [bytes(r["value"]) for r in publish_frame(episodes, "episodes").collect()]
    half = len(values) // 2
    now = {"availableNow": True}

    def run():
        medallion.start_bronze_table(file_topic(spark, topic), "line", scratch, now).awaitTermination()
        medallion.start_silver_table(spark, "line", scratch, now).awaitTermination()

    as_records(spark, values[:half] + [b"junk"]).write.mode("append").parquet(topic)
    run()
    assert spark.read.table("line.silver_episodes").count() == half
    as_records(spark, values[half:], first_offset=1000).write.mode("append").parquet(topic)
    run()
    run()
    silver = spark.read.table("line.silver_episodes")
    assert spark.read.table("line.bronze_episodes").count() == len(values) + 1
    found = {r["episode_id"]: r["routing_decision"] for r in silver.collect()}
    assert found == {name: case[3] for name, case in CASES.items()}
    for name, (comment, properties, parts) in medallion.STREAMED.items():
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED line.{name}").collect()
        described = {r["col_name"]: r["data_type"] for r in rows}
        assert described["Comment"] == comment
        assert all(f"{k}={v}" in described["Table Properties"] for k, v in properties.items())
        listed = [r["col_name"] for r in rows]
        assert all(c in listed[listed.index("# Partition Information") :] for c in parts)
    text = silver.where("routing_decision = 'CERTIFIED'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(routing_decision" in text
