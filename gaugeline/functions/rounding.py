"""Order-independent means of two-digit scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_digits(score: Column) -> Column:
    """A stored 32-bit score as the two-digit double it stands for."""
    return F.round(score.cast("double"), 2)


def hundredths(score: Column) -> Column:
    """A two-digit score as a whole number of hundredths, still a double.

    Whole doubles add exactly up to 2^53, so sums do not depend on how Spark
    split the rows, and ties in the final rounding always fall the same way.
    """
    return F.round(score * 100.0, 0)
