"""Tables, comments, properties and broker options."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gaugeline.sinks import tables as sinks
from gaugeline.sources import tables as sources
from gaugeline.sources.topic import kafka_options

CONNECTION = "Endpoint=sb://fleet-7.servicebus.windows.net/;SharedAccessKeyName=k"


def test_kafka_options():
    options = kafka_options(CONNECTION, "episodes")
    assert options["kafka.bootstrap.servers"] == "fleet-7.servicebus.windows.net:9093"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"] == (
        "org.apache.kafka.common.security.plain.PlainLoginModule required"
        f' username="$ConnectionString" password="{CONNECTION}";'
    )
    assert options["kafka.request.timeout.ms"] == "60000"
    assert options["kafka.session.timeout.ms"] == "30000"
    assert (options["subscribe"], options["startingOffsets"]) == ("episodes", "latest")
    assert options["failOnDataLoss"] == "false"


def test_kafka_options_for_a_relocated_client_and_replay():
    options = kafka_options(CONNECTION, "t", "earliest", login_module_prefix="shaded.")
    assert options["kafka.sasl.jaas.config"].startswith("shaded.org.apache.kafka.")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    options = kafka_options(CONNECTION, "t", max_offsets_per_trigger=50)
    assert options["maxOffsetsPerTrigger"] == "50"


def test_bad_connection_string():
    with pytest.raises(ValueError):
        kafka_options("nothing here", "t")


def test_table_comment_properties_and_replacement(spark):
    sinks.create_schema(spark, "fleet")
    sinks.create_schema(spark, "fleet")
    for n in (3, 5):
        sinks.replace_table(
            spark.range(n).withColumn("part", F.col("id") % 2),
            "fleet.gold_table",
            comment="Daily rate, 'rolling'",
            properties={"quality": "gold"},
            partition_by=["part"],
        )
    assert sources.read_table(spark, "fleet.gold_table").count() == 5
    described = {
        r["col_name"]: r["data_type"]
        for r in spark.sql("DESCRIBE TABLE EXTENDED fleet.gold_table").collect()
    }
    assert described["Comment"] == "Daily rate, 'rolling'"
    assert "quality=gold" in described["Table Properties"]
    assert sources.stream_table(spark, "fleet.gold_table").isStreaming
    spark.sql("DROP TABLE fleet.gold_table")


def test_episode_files_take_defaults(spark, tmp_path):
    path = tmp_path / "e.json"
    path.write_text(json.dumps({"episode_id": "a", "robot_id": "r", "operator_id": "o"}))
    row = sources.read_episodes(spark, str(path)).first()
    assert (row["frame_count"], row["duration_ms"], row["injected_failure"]) == (0, 0.0, "none")
    assert (row["status"], row["task_type"]) == ("aborted", "pick_place")
    assert row["sensor_frames"] == [] and row["phase_events"] == []


def test_gold_tables_in_the_catalog(spark, tmp_path):
    from gaugeline.plans import gold
    from gaugeline.streaming import medallion
    from gaugeline.testbed.adapters import scored_episodes

    silver = scored_episodes(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        medallion.refresh_gold_tables(silver, "reports", str(tmp_path))
    for name, comment in medallion.GOLD_COMMENTS.items():
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED reports.{name}").collect()
        described = {r["col_name"]: r["data_type"] for r in rows}
        assert described["Comment"] == comment and "quality=gold" in described["Table Properties"]
    stored = spark.read.table("reports.gold_failure_summary")
    wanted = gold.gold_failure_summary(silver)
    assert sorted(map(str, stored.collect())) == sorted(map(str, wanted.collect()))
