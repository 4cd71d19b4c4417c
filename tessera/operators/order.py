"""Sorted output and top-k (O1, O2); arg-max lives in functions.rows (O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sorted_output(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in ``order`` (one range-partitioned sort)."""
    return df.orderBy(*order)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows in ``order`` (per-partition top-k, then merge) with
    a 0-based ``rank``; the window runs over the k survivors only."""
    head = df.orderBy(*order).limit(k)
    return head.withColumn(rank, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
