"""Row filters and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.util import col
from tessera.operators.keys import as_list

SENTINEL_LABEL = 999999  # fixed value: label code of rows to discard


def filter_sentinel(df: DataFrame, label: str, sentinel=SENTINEL_LABEL) -> DataFrame:
    """Drop rows whose label is the sentinel; null labels are kept
    (pandas ``!=`` is true for NaN)."""
    c = F.col(label)
    if sentinel is None:
        return df
    s = F.lit(sentinel).cast(df.schema[label].dataType)  # same type as the label column
    return df.filter(c.isNull() | (c != s))


def split_by_null_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(labelled rows, rows to score)."""
    c = F.col(label)
    return df.filter(c.isNotNull()), df.filter(c.isNull())


def filter_segment(df: DataFrame, column: str, value, equal: bool = True) -> DataFrame:
    """``column == value`` or ``column != value`` (the latter keeps nulls)."""
    c = F.col(column)
    if equal:
        return df.filter(c == F.lit(value))
    return df.filter(c.isNull() | (c != F.lit(value)))


def null_out_invalid(df: DataFrame, column: str, invalid: Column) -> DataFrame:
    """Set ``column`` to null where ``invalid`` is true (null predicate = keep)."""
    return df.withColumn(column, F.when(~F.coalesce(invalid, F.lit(False)), F.col(column)))


def fillna_const(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    """Replace nulls in ``columns`` by a constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in as_list(columns)})


def select_predictors(df: DataFrame, deny: Sequence[str] = (), deny_substrings: Sequence[str] = ()) -> DataFrame:
    """All columns except a deny-list and names containing any substring."""
    keep = [c for c in df.columns
            if c not in set(deny) and not any(s in c for s in deny_substrings)]
    return df.select(*keep)


def predictor_names(df: DataFrame, deny: Sequence[str] = (), deny_substrings: Sequence[str] = ()) -> list[str]:
    return select_predictors(df, deny, deny_substrings).columns


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*as_list(columns))


def source_flag(df: DataFrame, name: str, value) -> DataFrame:
    """Tag every row with a constant provenance value."""
    return df.withColumn(name, F.lit(value))


def slice_by_source(df: DataFrame, name: str, value) -> DataFrame:
    """Recover the rows of one source (provenance column, never positions)."""
    return df.filter(F.col(name) == F.lit(value))


def when_valid(c, invalid: Column) -> Column:
    """Column form of :func:`null_out_invalid`."""
    return F.when(~F.coalesce(invalid, F.lit(False)), col(c))
