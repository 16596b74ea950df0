"""Helpers that several operators share: scratch tables, word hashing, packed arrays, components.

Operators that run numpy inside tasks read rows through ``mapInArrow``; the package has to
be importable on the executors (installed there, or sent with ``--py-files``).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that is hashed at once inside a task.
CHUNK_BYTES = 4 << 20
#: Words as the contracts write them.
WORD = r"[^\x20\x09-\x0D]+"

_ZSTD = pa.Codec("zstd", compression_level=1)
_FALLBACK: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a local session gets a folder of its
    own; on a cluster that would be one for each machine, so it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _FALLBACK:
        _FALLBACK.append(tempfile.mkdtemp(prefix="gaugeline-"))
    return _FALLBACK[0]


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes a table into the shared folder and reads it again: later readers don't recompute it,
    and it survives the loss of executors."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, ids as long and texts as string."""
    kinds = {"doc_id": "long", "text": "string"}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in cols])


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of whole rows with about limit bytes of text, and their texts; a null text is empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            start = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, start + limit, side="right")))
            yield batch.slice(at, to - at), texts.slice(at, to - at).to_pylist()
            at = to


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit SipHash of each word."""
    if not words:
        return np.zeros(0, np.uint64)
    cells = np.empty(len(words), object)
    cells[:] = words
    return pd.util.hash_array(cells, categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, with its byte length in front."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if raw else b""


def unpack(blob: bytes, dtype: type) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype)
    return np.frombuffer(_ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True), dtype)


def spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive runs with these lengths."""
    ends = np.cumsum(counts, dtype=np.int64)
    return ends - counts, ends


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in links (a, b): component is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014) on a table of edges:
    both aggregate with map-side combining and join on the node, so that a node with very many
    links is a skewed join, which adaptive execution splits. Every step's edges are stored.
    """
    def step(edges: DataFrame, both: bool) -> DataFrame:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = ways.where("v > u") if both else ways
        moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not both:
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        return moved.where("u <> v").distinct()

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    sums = None
    for _ in range(rounds):
        nxt = stored(step(step(edges, True), False), "edges")
        now = nxt.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        edges = nxt
        if now == sums:
            break
        sums = now
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
