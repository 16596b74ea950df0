"""From documents to packed training sequences, in stages that hand on their table as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import jaccard_join, mixing, packing, quality, substring_dedup
from gaugeline.llm.common import stored
from gaugeline.llm.queries import table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")), whole=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that windows of 20 words repeat are cut out of the texts."""
    return substring_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of the mix: rows are left out or repeated, up to three times."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Training, hashing and packing can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
