"""Data expectations: rows that violate one are dropped or only counted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    drop: bool = False

    @property
    def holds(self) -> str:
        """A NULL answer counts as a violation."""
        return f"coalesce({self.predicate}, false)"


SILVER_EXPECTATIONS = [
    Expectation("valid_episode_id", "episode_id IS NOT NULL", drop=True),
    Expectation(
        "valid_routing", "routing_decision IN ('CERTIFIED', 'BORDERLINE', 'REJECTED')", drop=True
    ),
    Expectation("valid_score", "composite_score BETWEEN 0 AND 100"),
]


def apply(df: DataFrame, expectations: Sequence[Expectation] = SILVER_EXPECTATIONS) -> DataFrame:
    for e in expectations:
        if e.drop:
            df = df.where(e.holds)
    return df


def observed(
    df: DataFrame,
    name: str | Observation,
    expectations: Sequence[Expectation] = SILVER_EXPECTATIONS,
) -> DataFrame:
    """Count violations while the rows pass by, in a batch or in a stream."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"count_if(NOT {e.holds})").alias(f"{e.name}_failed") for e in expectations],
    )


def report(df: DataFrame, expectations: Sequence[Expectation] = SILVER_EXPECTATIONS) -> DataFrame:
    """Passed and failed rows per expectation, from one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"count_if({e.holds})").alias(e.name) for e in expectations],
    )
    entries = ", ".join(
        f"'{e.name}', '{'drop' if e.drop else 'warn'}', {e.name}, n - {e.name}"
        for e in expectations
    )
    return counts.selectExpr(
        f"stack({len(expectations)}, {entries}) AS (expectation, action, passed, failed)"
    )
