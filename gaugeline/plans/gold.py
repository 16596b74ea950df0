"""Gold tables: business aggregates over the silver table.

All functions take and return DataFrames. Aggregates are split so that one hot
robot, task or day is first combined on the map side and spread over its
distinct scores or flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.rounding import hundredths, two_digits
from gaugeline.operators.ordered import (
    ROWS_PER_CHUNK,
    running_totals,
    sort_key,
    split_by_key,
)
from gaugeline.sinks.scratch import kept

# SLA limits on the daily certified rate, in percent.
SLA_MET = 70
SLA_AT_RISK = 60

FLAG_KIND = "^[A-Z_]+(:[A-Z_]+)?"


def report_date() -> Column:
    return F.to_date("ingested_at").alias("report_date")


def decision(label: str) -> Column:
    return F.col("routing_decision") == label


def rate_pct(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / whole, 2)


def mean_score(total: str, n: str) -> Column:
    """Mean of scores summed in hundredths; NULL for an empty group."""
    return F.round(F.col(total) / F.nullif(F.col(n) * 100.0, F.lit(0.0)), 2)


def score_counts(silver: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """(names, score, n, c, b, r): episodes and decisions per score. Rows of several batches merge by sums.

    Map-side combining shrinks a hot group to its distinct scores, and those are
    hashed to many tasks.
    """
    return (
        silver.select(
            *keys, "routing_decision", two_digits(F.col("composite_score")).alias("score")
        )
        .groupBy(*names, "score")
        .agg(
            F.count("*").alias("n"),
            F.count_if(decision("CERTIFIED")).alias("c"),
            F.count_if(decision("BORDERLINE")).alias("b"),
            F.count_if(decision("REJECTED")).alias("r"),
        )
    )


def score_stats(silver: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """Counts, score spread and interpolated percentiles per group."""
    return stats_of_counts(score_counts(silver, keys, names), names)


def stats_of_counts(counts: DataFrame, names: list[str]) -> DataFrame:
    """The same from score counts, one row per (names, score); exact percentiles walk the counts, never the rows."""
    by_score = counts.withColumn(
        "scored", F.when(F.col("score").isNotNull(), F.col("n")).otherwise(0)
    )
    group = Window.partitionBy(*names)
    upto = group.orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = by_score.select(
        "*",
        F.sum("scored").over(upto).alias("upto"),
        F.sum("scored").over(group).alias("all_scored"),
    )

    def spot(p: float) -> Column:
        return (F.col("all_scored") - 1) * F.lit(p)

    def score_at(index: Column) -> Column:
        here = (F.col("upto") - F.col("scored") <= index) & (index < F.col("upto"))
        return F.max(F.when(here, F.col("score")))

    sums = walked.groupBy(*names).agg(
        F.sum("n").alias("total_episodes"),
        F.sum("scored").alias("scored"),
        F.sum(hundredths(F.col("score")) * F.col("scored")).alias("cents"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.sum("c").alias("certified_count"),
        F.sum("b").alias("borderline_count"),
        F.sum("r").alias("rejected_count"),
        *[
            column
            for tag, p in (("p50", 0.5), ("p95", 0.95))
            for column in (
                score_at(F.floor(spot(p))).alias(f"{tag}_low"),
                score_at(F.ceil(spot(p))).alias(f"{tag}_high"),
            )
        ],
    )

    def percentile(tag: str, p: float) -> Column:
        at = (F.col("scored") - 1) * F.lit(p)
        low, high = F.col(f"{tag}_low"), F.col(f"{tag}_high")
        between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        return F.round(F.when(F.floor(at) == F.ceil(at), low).otherwise(between), 2)

    return sums.select(
        *names,
        "total_episodes",
        mean_score("cents", "scored").alias("avg_composite_score"),
        "min_score",
        "max_score",
        percentile("p50", 0.5).alias("p50_score"),
        percentile("p95", 0.95).alias("p95_score"),
        "certified_count",
        "borderline_count",
        "rejected_count",
        rate_pct(F.col("certified_count"), F.col("total_episodes")).alias("certified_rate_pct"),
    )


def gold_daily_robot_stats(silver: DataFrame) -> DataFrame:
    names = ["report_date", "robot_id", "task_type"]
    keys = [report_date(), F.col("robot_id"), F.col("task_type")]
    return score_stats(silver, keys, names).orderBy(*names)


def operator_metrics(silver: DataFrame) -> DataFrame:
    return score_stats(silver, [F.col("operator_id")], ["operator_id"]).orderBy("operator_id")


def task_type_summary(silver: DataFrame) -> DataFrame:
    return score_stats(silver, [F.col("task_type")], ["task_type"]).orderBy("task_type")


FLAG_KEYS = ["report_date", "task_type", "routing_decision", "failure_flag"]


def flagged_episodes(silver: DataFrame, flag: Column | None = None) -> DataFrame:
    """(day, task, routing, flag, episode, cents, scored, min_score): rows of several batches merge by sums and minima."""
    flag = F.trim("failure_flag") if flag is None else flag
    exploded = silver.where(F.size("failure_flags") > 0).select(
        report_date(),
        "task_type",
        "routing_decision",
        "episode_id",
        two_digits(F.col("composite_score")).alias("score"),
        F.explode("failure_flags").alias("failure_flag"),
    )
    return (
        exploded.withColumn("failure_flag", flag)
        .groupBy(*FLAG_KEYS, "episode_id")
        .agg(
            F.sum(hundredths(F.col("score"))).alias("cents"),
            F.count("score").alias("scored"),
            F.min("score").alias("min_score"),
        )
    )


def failures_of_episodes(flagged: DataFrame) -> DataFrame:
    """Episodes and scores per (day, task, routing, flag), from one row per flagged episode."""
    return (
        flagged.groupBy(*FLAG_KEYS)
        .agg(
            F.count("episode_id").alias("affected_episodes"),
            F.sum("cents").alias("cents"),
            F.sum("scored").alias("scored"),
            F.min("min_score").alias("min_score_when_flagged"),
        )
        .select(
            *FLAG_KEYS,
            "affected_episodes",
            mean_score("cents", "scored").alias("avg_score_when_flagged"),
            "min_score_when_flagged",
        )
    )


def failure_counts(silver: DataFrame, flag: Column | None = None) -> DataFrame:
    """Episodes and scores per (day, task, routing, flag), not ranked yet.

    Split by episode first, so one hot flag is spread over many tasks.
    """
    return failures_of_episodes(flagged_episodes(silver, flag))


def routing_counts(scored: DataFrame) -> DataFrame:
    """Episodes per day and decision."""
    return scored.groupBy(report_date().cast("string").alias("report_date")).agg(
        F.count_if(decision("CERTIFIED")).alias("certified_count"),
        F.count_if(decision("BORDERLINE")).alias("borderline_count"),
        F.count_if(decision("REJECTED")).alias("rejected_count"),
    )


def distinct_affected(scored: DataFrame) -> DataFrame:
    """Episodes that carry each flag, over all days."""
    return (
        scored.where(F.size("failure_flags") > 0)
        .select("episode_id", F.explode("failure_flags").alias("flag"))
        .groupBy(F.trim("flag").alias("failure_flag"))
        .agg(F.count_distinct("episode_id").alias("affected_episodes"))
    )


def rank_failures(failures: DataFrame, most: int = ROWS_PER_CHUNK) -> DataFrame:
    """Rank flags inside (report_date, task_type), most affected first.

    Flag texts carry measured numbers, so one date and task can have a great
    many of them. Its flags are split by a histogram of their sort key into chunks
    that many tasks rank. The sort direction is expressed by the negated count so
    that the key sorts ascending.

    ``failures`` is read once per round of the histogram and twice for the ranks; on
    large data store it first, as the gold refresh does.
    """
    order = failures.withColumn("more_affected", -F.col("affected_episodes"))
    key = sort_key(order, ["more_affected", "routing_decision", "failure_flag"])
    # Structs compare field by field and are never NULL themselves, so a missing
    # task still finds its group.
    packed = order.withColumn("task_day", F.struct("report_date", "task_type")).withColumn(
        "rank_key", key
    )
    split = split_by_key(packed, "rank_key", ["task_day"], most)
    return (
        running_totals(
            split,
            {"failure_rank": F.lit(1).cast("long")},
            order_by=["rank_key"],
            partition_by=["task_day"],
        )
        .withColumn("failure_rank", F.col("failure_rank").cast("int"))
        .drop("task_day", "chunk", "rank_key", "more_affected")
        .orderBy("report_date", "task_type", "failure_rank")
    )


def gold_failure_summary(silver: DataFrame) -> DataFrame:
    """Flag frequency with the raw flag text, as stored."""
    return rank_failures(kept(failure_counts(silver)))


def failure_kind_summary(silver: DataFrame) -> DataFrame:
    """The same summary per flag kind: measured numbers are stripped."""
    kinds = failure_counts(silver, F.regexp_extract(F.trim("failure_flag"), FLAG_KIND, 0))
    # A date and task have about a dozen kinds.
    by = Window.partitionBy("report_date", "task_type").orderBy(
        F.desc("affected_episodes"), "routing_decision", "failure_flag"
    )
    return kinds.withColumn("failure_rank", F.row_number().over(by)).orderBy(
        "report_date", "task_type", "failure_rank"
    )


def sla_status(rate: Column) -> Column:
    return (
        F.when(rate >= SLA_MET, "MET").when(rate >= SLA_AT_RISK, "AT_RISK").otherwise("BREACHED")
    )


def daily_totals(silver: DataFrame) -> DataFrame:
    return (
        silver.select(
            report_date(),
            "routing_decision",
            two_digits(F.col("composite_score")).alias("score"),
        )
        .groupBy("report_date")
        .agg(
            F.count("*").alias("total_episodes"),
            F.count_if(decision("CERTIFIED")).alias("certified"),
            F.count_if(decision("BORDERLINE")).alias("borderline"),
            F.count_if(decision("REJECTED")).alias("rejected"),
            F.sum(hundredths(F.col("score"))).alias("cents"),
            F.count("score").alias("scored"),
        )
        .select(
            "report_date",
            "total_episodes",
            "certified",
            "borderline",
            "rejected",
            mean_score("cents", "scored").alias("avg_composite_score"),
            rate_pct(F.col("certified"), F.col("total_episodes")).alias("certified_rate_pct"),
        )
    )


def totals_of_counts(counts: DataFrame) -> DataFrame:
    """The same daily totals from score counts that have a report_date."""
    scored = F.when(F.col("score").isNotNull(), F.col("n"))
    return (
        counts.groupBy("report_date")
        .agg(
            F.sum("n").alias("total_episodes"),
            F.sum("c").alias("certified"),
            F.sum("b").alias("borderline"),
            F.sum("r").alias("rejected"),
            F.sum(hundredths(F.col("score")) * scored).alias("cents"),
            F.coalesce(F.sum(scored), F.lit(0)).alias("scored"),
        )
        .select(
            "report_date",
            "total_episodes",
            "certified",
            "borderline",
            "rejected",
            mean_score("cents", "scored").alias("avg_composite_score"),
            rate_pct(F.col("certified"), F.col("total_episodes")).alias("certified_rate_pct"),
        )
    )


def _sla(totals: DataFrame, week) -> DataFrame:
    # Unpartitioned window on purpose: the input has one row per calendar day.
    return (
        totals
        .withColumn(
            "rolling_7d_certified_rate_pct",
            F.round(
                F.sum(hundredths(F.col("certified_rate_pct"))).over(week)
                / (F.count("certified_rate_pct").over(week) * 100.0),
                2,
            ),
        )
        .withColumn(
            "rolling_7d_avg_episodes",
            F.round(F.avg(F.col("total_episodes")).over(week), 0),
        )
        .withColumn("sla_status", sla_status(F.col("certified_rate_pct")))
        .orderBy(F.desc("report_date"))
    )


def gold_sla_compliance(silver: DataFrame) -> DataFrame:
    """Daily certified rate with means over the last seven reported days."""
    return sla_of_totals(daily_totals(silver))


def sla_of_totals(totals: DataFrame) -> DataFrame:
    return _sla(totals, Window.orderBy("report_date").rowsBetween(-6, 0))


def sla_calendar_7d(silver: DataFrame) -> DataFrame:
    """The same table with means over the last seven calendar days."""
    return _sla(daily_totals(silver), Window.orderBy(F.unix_date("report_date")).rangeBetween(-6, 0))
