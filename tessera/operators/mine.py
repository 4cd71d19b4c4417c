"""Value-to-value association mining over a set of related columns
(the "most associated next amount" lookup) and its use as a feature."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rows import row_nunique
from tessera.operators.keys import join_back, join_on


def ordered_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """All ordered pairs of distinct columns, in column order."""
    return list(permutations(cols, 2))


def pair_stream(df: DataFrame, cols: Sequence[str], tag: bool = False) -> DataFrame:
    """Unpivot every ordered column pair of each row into (first, second) rows.

    One ``inline`` over an array of structs: a single narrow projection, no
    join per pair.  Pairs with a null side are dropped (group-by semantics).
    """
    pairs = ordered_pairs(cols)
    structs = []
    for a, b in pairs:
        fields = [F.col(a).alias("first"), F.col(b).alias("second")]
        if tag:
            fields.append(F.lit(f"{a}_{b}").alias("pair"))
        structs.append(F.struct(*fields))
    out = df.select(F.inline(F.array(*structs)))
    return out.filter(F.col("first").isNotNull() & F.col("second").isNotNull())


def pair_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(first, second) with one count column per ordered column pair (null
    where the pair never occurs, like a chain of full outer joins) and their
    sum ``pair_count``.  One shuffle: union of tagged pair streams + groupBy.
    """
    pairs = ordered_pairs(cols)
    s = pair_stream(df, cols, tag=True)
    aggs = [F.nullif(F.count(F.when(F.col("pair") == f"{a}_{b}", 1)), F.lit(0)).alias(f"{a}_{b}")
            for a, b in pairs]
    return s.groupBy("first", "second").agg(*aggs, F.count(F.lit(1)).alias("pair_count"))


def share_of_group(df: DataFrame, value: str, group: str, name: str = "rate",
                   total_name: str | None = None) -> DataFrame:
    """``value / sum(value) per group`` (partial aggregate + join-back)."""
    tot = df.groupBy(group).agg(F.sum(value).alias(total_name or "__total"))
    out = join_on(df, tot, [group], "left", null_safe=True)
    out = out.withColumn(name, F.col(value) / F.col(total_name or "__total"))
    return out if total_name else out.drop("__total")


def top1_per_key(df: DataFrame, key: str, value: str, order: Sequence) -> DataFrame:
    """Per ``key`` the row maximising ``order`` (a struct order, earlier
    fields first).  ``max_by`` is a partial aggregate, so a hot key is
    reduced map-side before the shuffle."""
    cols = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order))
    return df.groupBy(key).agg(best.alias("__best")).select(key, *[F.col(f"__best.{c}").alias(c) for c in cols])


def mine_pair_lookup(df: DataFrame, cols: Sequence[str], min_count: int = 10,
                     min_distinct: int = 2, drop_second=0) -> DataFrame:
    """For each value ``first`` the value ``second`` it most often co-occurs
    with across the ordered column pairs.

    Steps: distinct value tuples with more than ``min_distinct`` distinct
    non-null values; all ordered pairs counted; pairs with
    ``second == drop_second`` removed; ``rate = count / total count of that
    second``; pairs with ``count > min_count`` kept; per ``first`` the pair with
    the highest count, then rate, then the smallest ``second``.
    Returns (first, second, pair_count, rate).
    """
    rows = (df.select(*cols).distinct()
              .filter(row_nunique(cols) > min_distinct))
    counts = (pair_stream(rows, cols)
              .groupBy("first", "second").agg(F.count(F.lit(1)).alias("pair_count")))
    if drop_second is not None:
        counts = counts.filter(F.col("second") != F.lit(drop_second))
    rated = share_of_group(counts, "pair_count", "second", "rate")
    kept = rated.filter(F.col("pair_count") > min_count)
    return top1_per_key(kept, "first", "second",
                        [F.col("pair_count"), F.col("rate"), -F.col("second")]) \
        .select("first", "second", "pair_count", "rate")


def filter_support(df: DataFrame, count_col: str, min_count: int) -> DataFrame:
    """Keep rows whose support is above ``min_count`` (HAVING)."""
    return df.filter(F.col(count_col) > min_count)


def lookup_most(df: DataFrame, lookup: DataFrame, cols: Sequence[str], suffix: str = "_most",
                key: str = "first", value: str = "second") -> DataFrame:
    """Left-join the mined lookup on each column in turn: ``<col><suffix>``.

    The lookup has one row per key; AQE broadcasts it when small at runtime
    and splits a hot value's rows otherwise (see ``keys.join_back``).
    """
    lk = lookup.select(key, value)
    out = df
    for c in cols:
        out = join_back(out, lk.withColumnsRenamed({key: c, value: f"{c}{suffix}"}), [c])
    return out
