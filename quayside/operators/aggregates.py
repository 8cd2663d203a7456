"""Aggregations (A1-A4) and percentage helpers.

Grouped sums compile to a partial (map-side) hash aggregate, one exchange on the group
keys and a final aggregate, so a hot key costs one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions._col import col_of


def sum_by(df: DataFrame, keys, value: str, alias: str) -> DataFrame:
    """A1/A2: ``SELECT keys, SUM(value) AS alias GROUP BY keys``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def percent_of(part, whole, digits: int) -> Column:
    """A4: ``ROUND(part * 100.0 / whole, digits)`` in exact decimal arithmetic.

    ``100.0`` is a decimal literal, so integer and decimal inputs stay decimal and the
    rounding is half away from zero on the exact quotient.  A zero ``whole`` gives null
    instead of an error.
    """
    hundred = F.lit(100.0).cast("decimal(4,1)")
    return F.round(F.try_divide(col_of(part) * hundred, col_of(whole)), digits)
