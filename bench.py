"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder with the tables; BENCH_CPUS: cores for local mode.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeline.operators.nested import score_nested  # noqa: E402
from gaugeline.testbed import adapters  # noqa: E402
from gaugeline.testbed.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gaugeline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def timed(build, spark: SparkSession) -> float:
    """Building, planning and running, once the JVM is warm."""
    started = time.perf_counter()
    seconds(build(spark, SF_DIR))
    return time.perf_counter() - started


def main() -> None:
    spark = session()
    timed(QUERIES["routing_counts"], spark)
    spent = {name: round(timed(build, spark), 3) for name, build in QUERIES.items()}
    episodes = adapters.episodes(spark, SF_DIR).count()
    nested = adapters.nested_episodes(spark, SF_DIR).count()
    # Long episodes: one per document, one frame per word. The table is a single
    # small file here, so spread it over the cores first.
    spread = 4 * spark.sparkContext.defaultParallelism
    documents = adapters.document_episodes(
        adapters.table(spark, SF_DIR, "documents").repartition(spread)
    )
    long_seconds = seconds(score_nested(documents))
    long_frames = documents.selectExpr("sum(size(sensor_frames))").first()[0]
    long_episodes = documents.count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "episodes_per_second": {
                    "frame_tables": round(episodes / spent["score_episodes"], 1),
                    "nested_documents": round(nested / spent["score_nested"], 1),
                    "publish_and_decode": round(nested / spent["publish_decode"], 1),
                    "long_documents": round(long_episodes / long_seconds, 1),
                    "baseline": 2.8,
                },
                "frames_per_second": {"long_documents": round(long_frames / long_seconds)},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
