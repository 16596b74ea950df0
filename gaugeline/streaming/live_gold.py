"""Gold kept current while the streams run.

Every micro-batch of silver is reduced to two aggregates: score counts per day, robot, task, operator
and score, and the flagged episodes per day, task, decision and flag. They are stored under the
batch's number, so a repeated batch replaces its own. Sums, minima and sets of episodes merge, so
the tables of the days that a batch touches are made from the state of these days alone, and
replace just these days.

Old batches' state is merged into a base from time to time. The base is a snapshot whose name says
up to which batch it reaches; readers leave those batches out, so a merge that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.plans import gold
from gaugeline.schemas import SILVER
from gaugeline.sinks.snapshots import (
    VERSIONS,
    current,
    file_system,
    names_in,
    publish,
    read_snapshot,
)
from gaugeline.sources.tables import stream_path

CUBE = ["report_date", "robot_id", "task_type", "operator_id"]
SCORES = (
    "robot_id string, task_type string, operator_id string, score double,"
    " n long, c long, b long, r long, report_date date"
)
FLAGS = (
    "task_type string, routing_decision string, failure_flag string, episode_id string,"
    " cents double, scored long, min_score double, report_date date"
)
STATES = {"scores": SCORES, "flags": FLAGS}
#: Tables that have rows of one day only, and are replaced by days; the others are snapshots.
DAILY = ("gold_daily_robot_stats", "gold_failure_summary")
WHOLE = ("gold_sla_compliance", "operator_metrics", "task_type_summary")
#: Batches whose state lies apart before they are merged into the base.
APART = 50


def live_path(root: str, name: str) -> str:
    return f"{root}/live/{name}"


def _state(root: str, name: str) -> str:
    return f"{root}/live/_state/{name}"


def _batches(spark: SparkSession, root: str, name: str) -> list[int]:
    found = names_in(spark, f"{_state(root, name)}/batches")
    return [int(n.removeprefix("batch=")) for n, _ in found if n.startswith("batch=")]


def _reach(spark: SparkSession, root: str, name: str) -> int:
    """The last batch in the base; -1 without one."""
    version = current(spark, f"{_state(root, name)}/base")
    return int(version.split("-")[1]) if version else -1


def merged(name: str, rows: DataFrame) -> DataFrame:
    """State rows with the same keys as one: sums and minima, whatever the order or the grouping."""
    if name == "scores":
        sums = [F.sum(c).alias(c) for c in ("n", "c", "b", "r")]
        return rows.groupBy(*CUBE, "score").agg(*sums)
    keys = ["report_date", "task_type", "routing_decision", "failure_flag", "episode_id"]
    return rows.groupBy(*keys).agg(
        F.sum("cents").alias("cents"), F.sum("scored").alias("scored"), F.min("min_score").alias("min_score")
    )


def state(spark: SparkSession, root: str, name: str, upto: int | None = None) -> DataFrame:
    """All state rows of a kind, as of a batch if one is given: the base and the batches after it.

    Days are folders, so a day's rows are found without reading others.
    """
    reach = _reach(spark, root, name)
    out = spark.createDataFrame([], STATES[name])
    paths = []
    if reach >= 0:
        base = f"{_state(root, name)}/base"
        paths.append(f"{base}/{VERSIONS}/{current(spark, base)}")
    for batch in _batches(spark, root, name):
        if batch > reach and (upto is None or batch <= upto):
            paths.append(f"{_state(root, name)}/batches/batch={batch:012d}")
    for path in paths:
        out = out.unionByName(spark.read.schema(STATES[name]).parquet(path).select(out.columns))
    return out


def _stats(counts: DataFrame, names: list[str]) -> DataFrame:
    summed = counts.groupBy(*names, "score").agg(*[F.sum(c).alias(c) for c in ("n", "c", "b", "r")])
    return gold.stats_of_counts(summed, names)


def fold(batch: DataFrame, batch_id: int, root: str) -> None:
    """Take one batch of silver into the live tables; the same batch again changes nothing."""
    spark = batch.sparkSession
    keys = [gold.report_date(), *[F.col(c) for c in CUBE[1:]]]
    new = {"scores": gold.score_counts(batch, keys, CUBE), "flags": gold.flagged_episodes(batch)}
    for name, rows in new.items():
        path = f"{_state(root, name)}/batches/batch={batch_id:012d}"
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("report_date").parquet(path)
    touched = spark.read.schema(SCORES).parquet(
        f"{_state(root, 'scores')}/batches/batch={batch_id:012d}"
    )
    _refresh_days(spark, root, touched.select("report_date").distinct())
    _refresh_whole(spark, root)
    if len(_batches(spark, root, "scores")) > APART:
        compact(spark, root, batch_id - 1)


def _of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    days = days.select(F.col("report_date").alias("_day"))
    return rows.join(days, F.col("report_date").eqNullSafe(F.col("_day")), "left_semi")


def _refresh_days(spark: SparkSession, root: str, days: DataFrame) -> None:
    """Replace the folders of these days, and of no others."""
    names = ["report_date", "robot_id", "task_type"]
    stats = _stats(_of_days(state(spark, root, "scores"), days), names)
    flags = merged("flags", _of_days(state(spark, root, "flags"), days))
    counts = f"{_state(root, 'flags')}/counts"
    gold.failures_of_episodes(flags).write.mode("overwrite").parquet(counts)
    ranked = gold.rank_failures(spark.read.parquet(counts))
    for name, df in zip(DAILY, (stats, ranked), strict=True):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("report_date")
            .parquet(live_path(root, name))
        )


def _refresh_whole(spark: SparkSession, root: str) -> None:
    """Tables over all days: from the state, never from silver."""
    counts = state(spark, root, "scores")
    made = (
        gold.sla_of_totals(gold.totals_of_counts(counts)),
        _stats(counts, ["operator_id"]).orderBy("operator_id"),
        _stats(counts, ["task_type"]).orderBy("task_type"),
    )
    for name, df in zip(WHOLE, made, strict=True):
        publish(df, live_path(root, name))


def compact(spark: SparkSession, root: str, upto: int) -> None:
    """Merge the state of batches up to one into the base. The newest batch may be repeated, so it stays apart."""
    for name in STATES:
        old = [b for b in _batches(spark, root, name) if b <= upto]
        if any(b > _reach(spark, root, name) for b in old):
            rows = merged(name, state(spark, root, name, upto))
            base = f"{_state(root, name)}/base"
            publish(rows, base, ["report_date"], f"upto-{upto:012d}")
        for batch in old:  # no reader looks at them any more
            folder, fs = file_system(spark, f"{_state(root, name)}/batches/batch={batch:012d}")
            fs.delete(folder, True)


def read_live(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name in DAILY:
        return spark.read.parquet(live_path(root, name))
    return read_snapshot(spark, live_path(root, name))


def start_gold(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object],
    max_files: int | None = None,
) -> StreamingQuery:
    """Follow the silver table; every batch refreshes what it touches."""
    rows = stream_path(spark, f"{root}/silver_episodes", SILVER, max_files)
    writer = rows.writeStream.queryName("live_gold").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda df, n: fold(df, n, root)).trigger(**trigger).start()
