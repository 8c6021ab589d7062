"""Sketches of distinct values that are stored by part and merged later, so that no part is read again when others come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sketches(df: DataFrame, column: str, *by: str, bits: int = 14) -> DataFrame:
    """(*by, sketch) of the distinct values of a column, as text, in 2^bits registers; null values count for nothing."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(column).cast("string"), bits).alias("sketch"))


def merged(stored: DataFrame, *by: str) -> DataFrame:
    """(*by, n): how many distinct values the sketches of each group have seen, about; the same however these were cut into parts.

    A sketch that was never merged estimates by the order of its updates, a merged one by its registers alone: so each comes twice."""
    each = stored.select(*by, "sketch")
    return each.unionByName(each).groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
