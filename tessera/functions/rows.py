"""Row-wise statistics across several columns of one row (array
expressions, JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import col


def _values(cols: Sequence) -> Column:
    return F.array_compact(F.array(*[col(c).cast("double") for c in cols]))


def row_nunique(cols: Sequence) -> Column:
    """Distinct non-null values across the columns of a row."""
    return F.size(F.array_distinct(F.array_compact(F.array(*[col(c) for c in cols]))))


def row_count(cols: Sequence) -> Column:
    return F.size(_values(cols))


def row_sum(cols: Sequence) -> Column:
    """Sum skipping nulls, 0 when all are null."""
    return F.aggregate(_values(cols), F.lit(0.0), lambda acc, x: acc + x)


def row_mean(cols: Sequence) -> Column:
    v = _values(cols)
    return F.try_divide(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x), F.size(v).cast("double"))


def row_var(cols: Sequence) -> Column:
    """Sample variance (n-1) skipping nulls; null for fewer than 2 values."""
    v = _values(cols)
    n = F.size(v).cast("double")
    mean = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n >= 2, ss / (n - F.lit(1.0)))


def row_std(cols: Sequence) -> Column:
    return F.sqrt(row_var(cols))


def row_min(cols: Sequence) -> Column:
    return F.least(*[col(c) for c in cols])


def row_max(cols: Sequence) -> Column:
    return F.greatest(*[col(c) for c in cols])


def row_second_min(cols: Sequence) -> Column:
    """Second smallest non-null value; null when fewer than 2 values."""
    return F.try_element_at(F.array_sort(_values(cols)), F.lit(2))


def row_mode_count(cols: Sequence) -> Column:
    """Occurrences of the most frequent non-null value (null if none)."""
    v = _values(cols)
    counts = F.transform(v, lambda x: F.size(F.filter(v, lambda y: y == x)))
    return F.array_max(counts)


def argmax(cols: Sequence) -> Column:
    """0-based index of the largest column (first one on ties)."""
    arr = F.array(*[col(c) for c in cols])
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
