"""Batch metrics that outlast their query: counts and durations of every micro-batch as a table.

A listener writes one small JSON file per batch, named by query and batch number. The driver keeps
nothing, a batch that is repeated after a restart replaces its own file, and the files are a table
that any session can read.
"""

from __future__ import annotations

import json
import threading
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from gaugeline.sinks.snapshots import file_system

METRICS = (
    "query_id string, run_id string, name string, batch_id long, at string, input_rows long,"
    " durations map<string, long>, observed map<string, map<string, long>>"
)
#: Ended runs whose end is remembered for whoever waits.
REMEMBERED = 1000


class ProgressLog(StreamingQueryListener):
    """Appends every batch of the session's queries to the table in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.failed: str | None = None
        self._ended: OrderedDict[str, bool] = OrderedDict()
        self._news = threading.Condition()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        line = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "name": p.name,
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "durations": dict(p.durationMs),
            "observed": {k: v.asDict() for k, v in p.observedMetrics.items()},
        }
        try:
            path, fs = file_system(self.spark, f"{self.folder}/{p.id}-{p.batchId:012d}.json")
            out = fs.create(path, True)
            out.write(bytearray(json.dumps(line).encode("utf-8")))
            out.close()
        except Exception as error:  # a listener must not stop the query; whoever waits hears of it
            self.failed = str(error)

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self._news:
            self._ended[str(event.runId)] = True
            while len(self._ended) > REMEMBERED:
                self._ended.popitem(last=False)
            self._news.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Until all batches of a run that has ended are in the table; events come some time later."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the end of the query was not reported")
        if self.failed:
            raise OSError(self.failed)


def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """query_id, run_id, name, batch_id, at, input_rows, durations (milliseconds per step), observed."""
    path, fs = file_system(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).json(folder)


def violations(metrics: DataFrame, observation: str) -> DataFrame:
    """(metric, n) of one observation, summed over all batches given."""
    return (
        metrics.select(F.explode(F.col("observed")[observation]).alias("metric", "n"))
        .groupBy("metric")
        .agg(F.sum("n").alias("n"))
    )


def latencies(metrics: DataFrame) -> DataFrame:
    """Batches and their whole durations per query: the columnar form of a scoring latency."""
    took = F.col("durations")["triggerExecution"]
    return (
        metrics.where("input_rows > 0")
        .groupBy("query_id", "name")
        .agg(
            F.count("*").alias("batches"),
            F.sum("input_rows").alias("input_rows"),
            F.sum(took).alias("total_ms"),
            F.percentile(took, 0.5).alias("p50_ms"),
            F.percentile(took, 0.99).alias("p99_ms"),
        )
    )
