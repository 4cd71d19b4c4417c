"""Joins between stage outputs and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import dedup_first
from tessera.operators.keys import as_list, join_on, tmp_names


def stack_join(df: DataFrame, stage: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left-join a stage output on the row key, its columns prefixed."""
    ren = {c: f"{prefix}{c}" for c in stage.columns if c != key}
    return df.join(stage.withColumnsRenamed(ren), on=key, how="left")


def left_merge(df: DataFrame, other: DataFrame, on: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Left join returning ``keep`` columns of ``df`` plus the new columns of
    ``other``.  Duplicate keys in ``other`` multiply rows, as in a merge."""
    on = as_list(on)
    new = [c for c in other.columns if c not in on]
    out = join_on(df.select(*dict.fromkeys(list(keep) + on)), other, on, "left", null_safe=True)
    return out.select(*dict.fromkeys(list(keep) + on + new))


def override_join(pred: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """Replace ``column`` by the override value where the key is listed.

    ``overrides`` must hold one row per key (see :func:`exact_match_transfer`).
    """
    (ov,) = tmp_names(pred, "override")
    o = overrides.select(key, F.col(column).alias(ov))
    return (pred.join(o, on=key, how="left")
                .withColumn(column, F.coalesce(F.col(ov), F.col(column)))
                .drop(ov))


def semi_join(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``other`` (``isin``)."""
    return df.join(other.select(*as_list(key)), on=as_list(key), how="left_semi")


def map_codes(c, mapping: dict) -> Column:
    """Map values through a small literal dict; unmapped → null."""
    c = F.col(c) if isinstance(c, str) else c
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), c)


def concat_columns(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Column-wise concatenation of frames sharing a row key; a later frame's
    column replaces an earlier one of the same name."""
    out = frames[0]
    for f in frames[1:]:
        dup = [c for c in f.columns if c != key and c in out.columns]
        out = out.drop(*dup).join(f, on=key, how="left")
    return out


def exact_match_transfer(target: DataFrame, source: DataFrame, keys: Sequence[str], id_col: str,
                         label: str, order: Sequence[Column | str]) -> DataFrame:
    """(target id, source label) for target rows that equal a source row on
    every key (null matches null); the source is first deduplicated on the
    keys keeping the first row in ``order``; rows without a label dropped."""
    keys = as_list(keys)
    src = dedup_first(source.select(*keys, label, *[o for o in order if isinstance(o, str) and o not in keys + [label]]),
                      keys, order).select(*keys, label)
    m = join_on(target.select(id_col, *keys), src, keys, "inner", null_safe=True)
    return m.filter(F.col(label).isNotNull()).select(id_col, F.col(label))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_dedup_prefer_first(frames: Sequence[DataFrame], subset: Sequence[str],
                             order: Sequence[Column | str] = (), source_col: str = "__src") -> DataFrame:
    """Union of frames, deduplicated on ``subset``: a row of an earlier frame
    wins over a later one; inside a frame ``order`` decides."""
    tagged = [f.withColumn(source_col, F.lit(i)) for i, f in enumerate(frames)]
    u = union_by_name(tagged)
    return dedup_first(u, subset, [F.col(source_col)] + list(order)).drop(source_col)


def upweight(df: DataFrame, subset_keys: DataFrame, key: str, weight_col: str = "weight",
             factor: float = 2.0) -> DataFrame:
    """Weight column instead of appending a subset twice: rows whose key is in
    ``subset_keys`` get ``factor``, others 1."""
    (hit,) = tmp_names(df, "hit")
    flags = subset_keys.select(key).distinct().withColumn(hit, F.lit(True))
    return (df.join(flags, on=key, how="left")
              .withColumn(weight_col, F.when(F.col(hit), F.lit(float(factor))).otherwise(F.lit(1.0)))
              .drop(hit))


def union_fill(frames: Sequence[DataFrame], value=0) -> DataFrame:
    """Union by name, columns absent in a frame filled with ``value``."""
    cols = list(dict.fromkeys(c for f in frames for c in f.columns))
    filled = [f.withColumns({c: F.lit(value) for c in cols if c not in f.columns}).select(*cols) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), filled)
