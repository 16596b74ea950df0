"""Run, validation and detection reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.decode import payload_text_or_plain, presence
from gaugeline.operators.ordered import first_rows, minute_of, running_totals
from gaugeline.schemas import FAILURE_MODES, TASK_TYPES


def _decided(label: str) -> Column:
    return F.count_if(F.col("routing_decision") == label)


def _share(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2)


def validate_summary(decoded: DataFrame) -> DataFrame:
    """One row on decoded records: counts per decision and schema validity.

    ``decoded`` has ``readable`` (the payload is a JSON object), the presence
    flags ``has_episode_id``, ``has_sensor_frames``, ``has_score`` and
    ``routing_decision`` (NULL when absent).
    """
    complete = F.col("has_episode_id") & F.col("has_sensor_frames") & F.col("has_score")
    label = F.when(
        F.col("readable"), F.coalesce(F.col("routing_decision"), F.lit("UNKNOWN"))
    )
    return decoded.agg(
        F.count_if(F.col("readable")).alias("received"),
        F.count_if(~F.col("readable")).alias("errors"),
        F.count_if(label == "CERTIFIED").alias("certified"),
        F.count_if(label == "BORDERLINE").alias("borderline"),
        F.count_if(label == "REJECTED").alias("rejected"),
        F.count_if(label == "UNKNOWN").alias("unknown"),
        F.coalesce(F.bool_and(F.when(F.col("readable"), complete)), F.lit(True)).alias(
            "schema_valid"
        ),
    )


def validate_records(
    records: DataFrame, max_events: int | None = None, column: str = "value"
) -> DataFrame:
    """Validation report on topic records, gzip or plain, oldest first."""
    if max_events is not None:
        records = read_at_most(records, max_events, ["timestamp", "partition", "offset"])
    return validate_summary(presence(payload_text_or_plain(records, column)))


def _seconds(span: str) -> Column:
    return F.expr(
        f"cast(extract(DAY FROM {span}) * 86400 + extract(HOUR FROM {span}) * 3600"
        f" + extract(MINUTE FROM {span}) * 60 + extract(SECOND FROM {span}) AS double)"
    )


def run_summary(scored: DataFrame, at: str = "ingested_at") -> DataFrame:
    """One row per run: decision counts, shares and throughput in event time.

    Whatever is neither CERTIFIED nor BORDERLINE counts as rejected.
    """
    counts = scored.agg(
        F.count("*").alias("n_episodes"),
        _decided("CERTIFIED").alias("certified"),
        _decided("BORDERLINE").alias("borderline"),
        (F.max(at) - F.min(at)).alias("span"),
    )
    n = F.col("n_episodes")
    rejected = n - F.col("certified") - F.col("borderline")
    rate = n / F.nullif(F.col("elapsed"), F.lit(0.0))
    return (
        counts.withColumn("rejected", rejected)
        .withColumn("elapsed", _seconds("span"))
        .select(
            "n_episodes",
            "certified",
            "borderline",
            "rejected",
            _share(F.col("certified"), n).alias("certified_pct"),
            _share(F.col("borderline"), n).alias("borderline_pct"),
            _share(F.col("rejected"), n).alias("rejected_pct"),
            F.round("elapsed", 2).alias("elapsed_s"),
            F.round(rate, 1).alias("throughput_eps"),
            F.round(rate * 3600, 0).alias("throughput_eph"),
        )
    )


def index_percentiles(
    df: DataFrame, column: str, points: Sequence[float] = (0.50, 0.99)
) -> DataFrame:
    """``sorted(values)[int(n * p)]`` for each point, without sorting the rows.

    Rows collapse to distinct values on the map side. A bucket of the value's
    magnitude gives each value its rank range, so no task sees more than the
    distinct values of one bucket. The number of buckets does not grow with the
    data: 4,096 per doubling, that is some ten thousand for usual latencies.
    """
    value = F.col("value")
    # Parts of an octave on either side of zero; zero has its own bucket. The
    # shift exceeds the exponent range of a double, so the sign decides first.
    magnitude = F.floor(F.log2(F.abs(value)) * 4096) + 5_000_000
    bucket = (
        F.when(F.isnan(value), F.lit(10_000_000))  # sorts above every number
        .when(value > 0, magnitude)
        .when(value < 0, -magnitude)
        .otherwise(F.lit(0))
        .cast("long")
    )
    values = (
        df.select(F.col(column).cast("double").alias("value"))
        .where(value.isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
        .withColumn("chunk", bucket)
    )
    ranked = running_totals(values, {"upto": F.col("n")}, order_by=["value"])
    total = values.agg(F.sum("n").alias("total")).scalar()
    placed = ranked.withColumn("total", total)
    picks = []
    for p in points:
        index = F.floor(F.col("total") * F.lit(p))
        hit = (F.col("upto") - F.col("n") <= index) & (index < F.col("upto"))
        picks.append(F.round(F.max(F.when(hit, value)), 2).alias(f"p{round(p * 100)}"))
    return placed.agg(*picks)


def detection_rate(scored: DataFrame) -> DataFrame:
    """Share of episodes with an injected failure routed below CERTIFIED."""
    failed = F.col("injected_failure") != "none"
    caught = failed & F.col("routing_decision").isin("BORDERLINE", "REJECTED")
    return scored.agg(
        F.count_if(failed).alias("with_failure"), F.count_if(caught).alias("detected")
    ).withColumn("detection_rate_pct", _share(F.col("detected"), F.col("with_failure")))


def detection_by_mode(scored: DataFrame) -> DataFrame:
    """Detection per failure mode; for ``none`` it is the false-positive rate."""
    return (
        scored.groupBy("injected_failure")
        .agg(
            F.count("*").alias("episodes"),
            F.count_if(F.col("routing_decision").isin("BORDERLINE", "REJECTED")).alias("detected"),
        )
        .withColumn("detected_pct", _share(F.col("detected"), F.col("episodes")))
    )


def category_shares(
    episodes: DataFrame, failure: str = "injected_failure", task: str = "task_type"
) -> DataFrame:
    """Share of each failure mode and task type, zero-filled over the domains.

    Both breakdowns come from one aggregate over (failure, task); the result of
    that aggregate is at most a few hundred rows whatever the input size.
    """
    spark = episodes.sparkSession
    counts = episodes.groupBy(
        F.col(failure).alias("failure_mode"), F.col(task).alias("task_type")
    ).agg(F.count("*").alias("n"), F.sum("frame_count").alias("frames"))
    by_label = (
        counts.unpivot("n", ["failure_mode", "task_type"], "category", "label")
        .groupBy("category", "label")
        .agg(F.sum("n").alias("n"))
    )
    total_episodes = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    total_frames = counts.agg(F.coalesce(F.sum("frames"), F.lit(0)).alias("n")).scalar()
    labels = [("failure_mode", m) for m in FAILURE_MODES] + [("task_type", t) for t in TASK_TYPES]
    values = ", ".join(f"('{category}', '{label}')" for category, label in labels)
    domain = spark.sql(f"SELECT * FROM VALUES {values} AS domain(category, label)")
    n = F.coalesce(F.col("n"), F.lit(0))
    return (
        domain.join(by_label, ["category", "label"], "left")
        .withColumn("total_episodes", total_episodes)
        .withColumn("total_frames", total_frames)
        .select(
            "category",
            "label",
            n.alias("episodes"),
            F.round(100.0 * n / F.greatest(F.col("total_episodes"), F.lit(1)), 2).alias("pct"),
            "total_episodes",
            "total_frames",
        )
    )


def running_tally(scored: DataFrame, every: int = 100, at: str = "ingested_at") -> DataFrame:
    """Decision counts so far after each ``every`` episodes, in arrival order."""
    one = F.lit(1).cast("long")

    def is_label(label: str) -> Column:
        return F.when(F.col("routing_decision") == label, one).otherwise(one - 1)

    tally = running_totals(
        scored.select("episode_id", at, "routing_decision").withColumn(
            "chunk", minute_of(scored, at)
        ),
        {
            "n": one,
            "certified": is_label("CERTIFIED"),
            "borderline": is_label("BORDERLINE"),
        },
        order_by=[at, "episode_id"],
    )
    return tally.where(F.col("n") % every == 0).select(
        "n",
        "certified",
        "borderline",
        (F.col("n") - F.col("certified") - F.col("borderline")).alias("rejected"),
    )


def read_at_most(records: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` records in order (the validation reader's bound); payloads stay where they are."""
    return first_rows(records, n, order_by)
