"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.plans import gold, reports
from gaugeline.testbed import adapters

Query = Callable[[SparkSession, str], DataFrame]


def text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("report_date", F.col("report_date").cast("string"))


def over_scored(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(adapters.scored_episodes(spark, sf_dir))



GOLD: dict[str, Query] = {
    "gold_daily_robot_stats": over_scored(lambda s: text_date(gold.gold_daily_robot_stats(s))),
    "gold_failure_summary": over_scored(lambda s: text_date(gold.gold_failure_summary(s))),
    "gold_sla_compliance": over_scored(lambda s: text_date(gold.gold_sla_compliance(s))),
    "failure_kind_summary": over_scored(lambda s: text_date(gold.failure_kind_summary(s))),
    "sla_calendar_7d": over_scored(lambda s: text_date(gold.sla_calendar_7d(s))),
    "sla_status": over_scored(
        lambda s: text_date(gold.daily_totals(s)).select(
            "report_date",
            "certified_rate_pct",
            gold.sla_status(F.col("certified_rate_pct")).alias("sla_status"),
        )
    ),
    "operator_metrics": over_scored(gold.operator_metrics),
    "task_type_summary": over_scored(gold.task_type_summary),
    "score_percentiles": over_scored(
        lambda s: gold.score_stats(
            s, [F.col("robot_id"), F.col("operator_id")], ["robot_id", "operator_id"]
        ).select("robot_id", "operator_id", "p50_score", "p95_score")
    ),
    "routing_counts": over_scored(gold.routing_counts),
    "distinct_affected": over_scored(gold.distinct_affected),
    "run_summary": over_scored(reports.run_summary),
    "index_percentiles": over_scored(
        lambda s: reports.index_percentiles(s, "scoring_latency_ms")
    ),
    "detection_rate": over_scored(reports.detection_rate),
    "detection_by_mode": over_scored(reports.detection_by_mode),
    "running_tally": over_scored(reports.running_tally),
    "category_shares": lambda spark, sf_dir: reports.category_shares(
        adapters.scored_episodes(spark, sf_dir).withColumn(
            "task_type",
            F.get(
                F.array(*[F.lit(t) for t in adapters.TASK_TYPES]),
                (F.col("frame_count") % 4).cast("int"),
            ),
        )
    ),
    "sample_limit": lambda spark, sf_dir: reports.read_at_most(
        adapters.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"),
        50,
        ["event_id"],
    ),
}

