"""From stored payloads to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.payload import gunzip
from gaugeline.schemas import EPISODE

STRICT_JSON = {"allowSingleQuotes": "false"}
GZIP_MAGIC = "X'1F8B'"

# Numbers are read as text and cast afterwards: a bad value then falls back to
# its default instead of spoiling the record or failing the stream.
HEADER_SCHEMA = (
    "episode_id STRING, robot_id STRING, operator_id STRING, task_type STRING, status STRING,"
    " duration_ms STRING, injected_failure STRING, _score STRING"
)
SCORE_SCHEMA = (
    "frame_count STRING, score_sensor_completeness STRING, score_temporal_coherence STRING,"
    " score_motion_smoothness STRING, score_task_completion STRING,"
    " score_trajectory_validity STRING, composite_score STRING, routing_decision STRING,"
    " failure_flags ARRAY<STRING>, scoring_latency_ms STRING"
)


def float32(field: str, name: str) -> str:
    return f"cast(coalesce(try_cast({field} AS double), 0D) AS float) AS {name}"


def payload_text(payload: Column) -> Column:
    """Text of a gzip payload, else NULL."""
    return gunzip(payload)


def payload_text_or_plain(df: DataFrame, column: str = "payload") -> DataFrame:
    """Add ``text``: gzip payloads inflated, anything else taken as plain text."""
    is_gzip = f"substring({column}, 1, 2) = {GZIP_MAGIC}"
    return df.withColumn(
        "inflated", gunzip(F.expr(f"CASE WHEN {is_gzip} THEN {column} END"))
    ).selectExpr(
        *df.columns, f"CASE WHEN {is_gzip} THEN inflated ELSE cast({column} AS string) END AS text"
    )


def parsed_object(df: DataFrame, text: str, schema, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of a JSON object as columns; all NULL when the text is none.

    ``inline`` makes the parsed fields generated columns: a later filter on them
    stays above, so each text is parsed once.
    """
    is_object = F.col(text).rlike(r"^\s*\{")
    parsed = F.from_json(F.when(is_object, F.col(text)), schema, STRICT_JSON)
    return df.select(*keep, F.inline_outer(F.array(parsed)))


def keyed(column: str, text: str, default: str) -> str:
    """A field, NULL where its key holds null; the default only where the key is missing."""
    there = f"coalesce(array_contains(json_object_keys({text}), '{column}'), false)"
    return f"CASE WHEN {column} IS NOT NULL OR {there} THEN {column} ELSE {default} END AS {column}"


def silver_fields(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Extract the silver columns from JSON text and drop unparsable rows.

    A row is dropped when the text is not a JSON object or its ``_score`` is
    missing, empty or not an object. Only the fields named above are parsed;
    the frames are skipped inside the JSON parser. A key that holds null is not a
    missing key: it stays NULL, and the expectation on routing drops such a row.
    """
    whole = "__text"
    return (
        parsed_object(df.withColumn(whole, F.col(text)), whole, HEADER_SCHEMA, (*keep, whole))
        .where("size(json_object_keys(_score)) > 0")
        .select("*", F.inline_outer(F.array(F.from_json("_score", SCORE_SCHEMA, STRICT_JSON))))
        .selectExpr(
            "episode_id",
            "robot_id",
            "operator_id",
            "task_type",
            "status",
            float32("duration_ms", "duration_ms"),
            """coalesce(try_cast(try_cast(frame_count AS double) AS int), 0)
               AS frame_count""",
            keyed("injected_failure", whole, "'none'"),
            float32("score_sensor_completeness", "sensor_completeness"),
            float32("score_temporal_coherence", "temporal_coherence"),
            float32("score_motion_smoothness", "motion_smoothness"),
            float32("score_task_completion", "task_completion"),
            float32("score_trajectory_validity", "trajectory_validity"),
            float32("composite_score", "composite_score"),
            keyed("routing_decision", "_score", "'REJECTED'"),
            keyed("failure_flags", "_score", "cast(array() AS array<string>)"),
            float32("scoring_latency_ms", "scoring_latency_ms"),
            *keep,
        )
    )


def presence(df: DataFrame, text: str = "text") -> DataFrame:
    """What the validation report asks of each record."""
    keyed = df.select(text, F.expr(f"json_object_keys({text})").alias("keys"))
    return parsed_object(
        keyed, text, "_score STRUCT<routing_decision: STRING>", keep=("keys",)
    ).selectExpr(
        "keys IS NOT NULL AS readable",
        "coalesce(array_contains(keys, 'episode_id'), false) AS has_episode_id",
        "coalesce(array_contains(keys, 'sensor_frames'), false) AS has_sensor_frames",
        "coalesce(array_contains(keys, '_score'), false) AS has_score",
        "_score.routing_decision AS routing_decision",
    )


def with_defaults(episodes: DataFrame) -> DataFrame:
    """Fill the per-key defaults of an episode document."""
    return episodes.fillna(
        {
            "frame_count": 0,
            "duration_ms": 0.0,
            "injected_failure": "none",
            "status": "aborted",
            "task_type": "pick_place",
        }
    ).withColumns(
        {
            "sensor_frames": F.expr("coalesce(sensor_frames, array())"),
            "phase_events": F.expr("coalesce(phase_events, array())"),
        }
    )


def episode_documents(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse whole episode documents; rows that are no JSON object are dropped."""
    return with_defaults(
        parsed_object(df, text, EPISODE, keep).where("episode_id IS NOT NULL")
    )
