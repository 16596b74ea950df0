"""Tables that are replaced as a whole, and seen either old or new.

A version is written into a folder of its own. A commit is one empty file whose name says which
version it stands for; creating a file is one step on every file system that Spark writes to.
Readers follow the greatest commit, so a write that fails leaves the table as it was, and one
that is running is not seen. Versions that no reader can still be using are removed by age.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

VERSIONS, COMMITS = "versions", "commits"


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and its file system, as Spark's own connectors see them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change in milliseconds) of what a folder holds; nothing if there is none."""
    folder, fs = file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(folder))


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every commit, the oldest first."""
    out = []
    for name, _ in names_in(spark, f"{path}/{COMMITS}"):
        number, _, version = name.partition("-")
        if number.isdigit() and version:
            out.append((int(number), version))
    return sorted(out)


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), label: str = ""
) -> str:
    """Write a new version, then commit it. Of two writers at once the later commit wins."""
    spark = df.sparkSession
    version = f"{label or 'v'}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{VERSIONS}/{version}")
    before = commits(spark, path)
    number = before[-1][0] + 1 if before else 0
    pointer, fs = file_system(spark, f"{path}/{COMMITS}/{number:020d}-{version}")
    if not fs.createNewFile(pointer):
        raise FileExistsError(str(pointer))
    return version


def current(spark: SparkSession, path: str) -> str | None:
    """The version that readers see."""
    there = commits(spark, path)
    return there[-1][1] if there else None


def read_snapshot(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The newest committed version, or an older one that is still kept."""
    version = version or current(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    return spark.read.parquet(f"{path}/{VERSIONS}/{version}")


def expire(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Remove versions that are not current and were replaced, or given up, more than older_than seconds ago.

    A committed version's age counts from the commit that replaced it, as readers may have begun
    until then; a version without commit is aged by its folder, so that a running write stays.
    """
    there = commits(spark, path)
    if not there:
        return []
    limit = (time.time() - older_than) * 1000
    changed = dict(names_in(spark, f"{path}/{COMMITS}"))
    stamp = {version: changed[f"{number:020d}-{version}"] for number, version in there}
    replaced = {a: stamp[b] for (_, a), (_, b) in zip(there, there[1:], strict=False)}
    gone = []
    for version, folder_time in names_in(spark, f"{path}/{VERSIONS}"):
        if version == there[-1][1] or replaced.get(version, folder_time) > limit:
            continue
        folder, fs = file_system(spark, f"{path}/{VERSIONS}/{version}")
        fs.delete(folder, True)
        gone.append(version)
    for number, version in there[:-1]:
        if version in gone:
            pointer, fs = file_system(spark, f"{path}/{COMMITS}/{number:020d}-{version}")
            fs.delete(pointer, False)
    return gone
