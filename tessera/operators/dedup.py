"""Duplicate handling with explicit order.

pandas ``drop_duplicates`` keeps the first row in file order and treats
nulls as equal.  A Spark frame has no file order, so every call names the
order; ``groupBy`` already groups null keys together.  The survivor is
chosen with ``min_by``/``max_by``, which aggregate partially on the map
side: a key holding a third of the table is reduced to one row per task
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import as_list, join_on, tmp_names


def _pick(df: DataFrame, subset: Sequence[str], order: Sequence[Column | str], last: bool) -> DataFrame:
    subset = as_list(subset)
    rest = [c for c in df.columns if c not in subset]
    (best,) = tmp_names(df, "best")
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    if not rest:
        return df.select(*subset).distinct()
    payload = F.struct(*[F.col(c) for c in rest])
    agg = F.max_by(payload, ordering) if last else F.min_by(payload, ordering)
    out = df.groupBy(*subset).agg(agg.alias(best))
    return out.select(*[F.col(c) for c in df.columns if c in subset] + [F.col(f"{best}.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def dedup_first(df: DataFrame, subset: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``subset`` value: the first in ``order`` (keep='first')."""
    return _pick(df, subset, order, last=False)


def dedup_last(df: DataFrame, subset: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``subset`` value: the last in ``order`` (keep='last')."""
    return _pick(df, subset, order, last=True)


def flag_duplicates(df: DataFrame, subset: Sequence[str], name: str = "is_duplicated") -> DataFrame:
    """1 for every member of a duplicate group (keep=False), else 0.

    Group sizes come from a partial aggregate joined back null-safely.
    """
    subset = as_list(subset)
    (n,) = tmp_names(df, "n")
    sizes = df.groupBy(*subset).agg(F.count(F.lit(1)).alias(n))
    out = join_on(df, sizes, subset, "left", null_safe=True)
    return out.withColumn(name, (F.col(n) > 1).cast("int")).drop(n)
