"""Payload decoding, expectations and the validation report."""

from __future__ import annotations

import gzip
import json

import pytest
from episodes import baseline
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeline.functions.payload import gunzip, gzip_text
from gaugeline.operators import decode, quality
from gaugeline.plans import reports
from gaugeline.streaming import medallion


def score_record(**change) -> dict:
    record = {
        "frame_count": 10,
        "score_sensor_completeness": 100.0,
        "score_temporal_coherence": 99.5,
        "score_motion_smoothness": 98,
        "score_task_completion": 85.0,
        "score_trajectory_validity": 70.25,
        "composite_score": 93.1,
        "routing_decision": "CERTIFIED",
        "failure_flags": ["A:B"],
        "scoring_latency_ms": 1.234,
    }
    return {**record, **change}


def document(score=None, **change) -> dict:
    doc = baseline(2)
    doc.pop("frame_count")
    doc["_score"] = score_record() if score is None else score
    return {**doc, **change}


def zipped(doc) -> bytes:
    return gzip.compress(json.dumps(doc).encode())


def without(record: dict, key: str) -> dict:
    return {k: v for k, v in record.items() if k != key}


GOOD = document(episode_id="good")
CORRUPT = zipped(GOOD)[:40] + b"xxxx"

# name -> (payload, silver row survives the expectations, received by validation)
PAYLOADS = {
    "good": (zipped(GOOD), True, True),
    "plain": (json.dumps(document(episode_id="plain")).encode(), False, True),
    "null": (None, False, False),
    "empty": (b"", False, False),
    "corrupt": (CORRUPT, False, False),
    "no_json": (gzip.compress(b"hello there"), False, False),
    "truncated": (gzip.compress(json.dumps(GOOD).encode()[:-9]), False, False),
    "array": (zipped([GOOD]), False, False),
    "number": (zipped(17), False, False),
    "string": (zipped("text"), False, False),
    "not_utf8": (gzip.compress(b"\xff\xfe{}"), False, False),
    "no_score": (zipped(without(document(episode_id="no_score"), "_score")), False, True),
    "empty_score": (zipped(document({}, episode_id="empty_score")), False, True),
    "null_score": (zipped({**document(episode_id="null_score"), "_score": None}), False, True),
    "odd_score": (zipped(document(5, episode_id="odd_score")), False, True),
    "no_routing": (
        zipped(document(without(score_record(), "routing_decision"), episode_id="no_routing")),
        True,
        True,
    ),
    "no_flags": (
        zipped(document(without(score_record(), "failure_flags"), episode_id="no_flags")),
        True,
        True,
    ),
    "pending": (
        zipped(document(score_record(routing_decision="PENDING"), episode_id="pending")),
        False,
        True,
    ),
    "no_id": (zipped(without(document(), "episode_id")), False, True),
    "too_high": (
        zipped(document(score_record(composite_score=120.0), episode_id="too_high")),
        True,
        True,
    ),
    "null_duration": (zipped(document(episode_id="null_duration", duration_ms=None)), True, True),
    "text_numbers": (
        zipped(
            document(
                score_record(composite_score="12.5", frame_count="7"),
                episode_id="text_numbers",
                duration_ms="abc",
            )
        ),
        True,
        True,
    ),
}


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(bytearray(p) if p is not None else None,) for p, *_ in PAYLOADS.values()]
    return spark.createDataFrame(rows, "payload binary").withColumn(
        "ingested_at", F.current_timestamp()
    ).cache()


def test_silver_rows(bronze):
    found = {r["episode_id"]: r for r in medallion.silver(bronze).collect()}
    assert set(found) == {name for name, (_, kept, _) in PAYLOADS.items() if kept}
    good = found["good"]
    assert good["routing_decision"] == "CERTIFIED" and good["failure_flags"] == ["A:B"]
    assert good["temporal_coherence"] == 99.5 and good["motion_smoothness"] == 98.0
    assert good["frame_count"] == 10 and good["duration_ms"] == 50.0
    assert good["injected_failure"] == "none" and good["status"] == "completed"
    assert found["no_routing"]["routing_decision"] == "REJECTED"
    assert found["no_flags"]["failure_flags"] == []
    assert found["null_duration"]["duration_ms"] == 0.0
    assert found["text_numbers"]["duration_ms"] == 0.0
    assert found["text_numbers"]["composite_score"] == 12.5
    assert found["text_numbers"]["frame_count"] == 7


def test_silver_schema(bronze):
    from gaugeline.schemas import SILVER

    types = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    found = medallion.silver(bronze).schema
    assert sorted(types(found)) == sorted(types(SILVER))
    assert found["routing_decision"].nullable  # a null is left for the expectation


def test_null_is_not_a_missing_key(spark):
    from gaugeline.operators import quality

    texts = [
        '{"episode_id": "a", "injected_failure": null, "_score": {"routing_decision": null, "failure_flags": null}}',
        '{"episode_id": "b", "_score": {"x": {"routing_decision": null}}}',
        '{"episode_id": "c", "injected_failure": "x", "_score": {"routing_decision": "CERTIFIED"}}',
    ]
    df = decode.silver_fields(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = {r["episode_id"]: (r["injected_failure"], r["routing_decision"], r["failure_flags"]) for r in df.collect()}
    assert got == {"a": (None, None, None), "b": ("none", "REJECTED", []), "c": ("x", "CERTIFIED", [])}
    assert {r["episode_id"] for r in quality.apply(df).collect()} == {"b", "c"}


def test_missing_fields_take_their_defaults(spark):
    texts = spark.createDataFrame([('{"_score": {"x": 1}}',)], "text string")
    row = decode.silver_fields(texts).first()
    assert row["episode_id"] is None and row["routing_decision"] == "REJECTED"
    assert row["injected_failure"] == "none" and row["failure_flags"] == []
    assert row["composite_score"] == 0.0 and row["frame_count"] == 0


def test_expectations_are_counted(spark, bronze):
    rows = {r["expectation"]: r for r in quality.report(medallion.decoded(bronze)).collect()}
    total = rows["valid_score"]["passed"] + rows["valid_score"]["failed"]
    assert rows["valid_episode_id"]["failed"] == 1
    assert rows["valid_routing"]["failed"] == 1
    assert rows["valid_score"]["failed"] == 1 and total == 8
    seen = Observation("seen")
    quality.observed(medallion.decoded(bronze), seen).count()
    assert seen.get == {
        "rows": 8,
        "valid_episode_id_failed": 1,
        "valid_routing_failed": 1,
        "valid_score_failed": 1,
    }


def test_null_answers_violate(spark):
    df = spark.createDataFrame(
        [(None, "a"), ("CERTIFIED", "b")], "routing_decision string, episode_id string"
    )
    kept = quality.apply(df, [e for e in quality.SILVER_EXPECTATIONS if e.drop]).collect()
    assert [r["episode_id"] for r in kept] == ["b"]


def test_validation_report(bronze):
    texts = decode.payload_text_or_plain(bronze)
    row = reports.validate_summary(decode.presence(texts)).first()
    received = [name for name, (_, _, got) in PAYLOADS.items() if got]
    assert row["received"] == len(received)
    assert row["errors"] == len(PAYLOADS) - len(received)
    # good, plain, no_flags, no_id, too_high, null_duration, text_numbers
    assert row["certified"] == 7 and row["borderline"] == 0 and row["rejected"] == 0
    # no_score, empty_score, null_score, odd_score, no_routing
    assert row["unknown"] == 5
    assert row["schema_valid"] is False


def test_validation_of_good_records_and_of_none(spark, bronze):
    texts = decode.payload_text_or_plain(bronze.limit(2))
    assert reports.validate_summary(decode.presence(texts)).first()["schema_valid"] is True
    texts = decode.payload_text_or_plain(bronze.where("false"))
    row = reports.validate_summary(decode.presence(texts)).first()
    assert row["received"] == 0 and row["schema_valid"] is True


def test_quarantine_keeps_what_nobody_can_read(bronze):
    unreadable = [name for name, (_, _, got) in PAYLOADS.items() if not got]
    assert medallion.quarantine(bronze).count() == len(unreadable)


def test_gzip_round_trip_keeps_long_and_odd_texts(spark):
    df = spark.range(40).selectExpr(
        "id", "concat(repeat('äß€ ', cast(id * id * 500 AS int)), id) AS text"
    )
    back = df.withColumn("zipped", gzip_text(F.col("text"))).withColumn(
        "back", gunzip(F.col("zipped"))
    )
    assert back.where("back <=> text").count() == 40
    assert gzip.decompress(bytes(back.where("id = 1").first()["zipped"])).decode().endswith("1")


def test_size_slices_do_not_change_the_answer(spark, monkeypatch):
    from gaugeline.functions import payload

    monkeypatch.setattr(payload, "SLICE_BYTES", 10)
    import pyarrow as pa

    batches = [pa.array([b"abc", None, b"", b"0123456789ab", b"z"]), pa.array([], pa.binary())]
    out = list(payload._sliced(iter(batches), lambda b: b.decode(), pa.string()))
    assert [v for a in out for v in a.to_pylist()] == ["abc", None, None, "0123456789ab", "z"]
    assert len(out) > 2


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Workers start in another folder, without the package on their path."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession, functions as F\n"
        "from gaugeline.functions.payload import gunzip, gzip_text\n"
        "spark = SparkSession.builder.master('local[1]')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "df = spark.range(3).select(gzip_text(F.col('id').cast('string')).alias('z'))\n"
        "print('back', sorted(r[0] for r in df.select(gunzip(F.col('z'))).collect()))\n"
    )
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "back ['0', '1', '2']" in done.stdout, done.stderr[-2000:]
