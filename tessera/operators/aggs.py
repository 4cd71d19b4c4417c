"""Group statistics joined back to rows, frequency tables and per-key
aggregates (A1–A6, A9, A13, A14, A19, A23, A25–A28).

Every join-back computes the statistics with ``groupBy`` (partial
aggregation: a hot key costs one buffer per map task) and attaches them
with ``keys.join_back``, which AQE broadcasts or skew-splits at runtime.  pandas
``groupby`` drops null keys, so rows with a null key get null statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import any_null, as_list, global_position, join_back, ordinal_within, tmp_names


# ---------------------------------------------------------------- registry
def _skew_adjusted(x: Column) -> Column:
    """Bias-adjusted sample skewness (pandas ``skew``): null for n < 3, 0 for
    a constant group."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (F.when(n < 3, F.lit(None).cast("double"))
             .when(F.var_pop(x) == 0, F.lit(0.0))
             .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def stat(name: str, x: str) -> Column:
    """Aggregate ``Column`` for a pandas-style statistic name."""
    c = F.col(x)
    table = {
        "min": lambda: F.min(c),
        "max": lambda: F.max(c),
        "mean": lambda: F.avg(c),
        "sum": lambda: F.coalesce(F.sum(c), F.lit(0)),
        "count": lambda: F.count(c),
        "size": lambda: F.count(F.lit(1)),
        "var": lambda: F.var_samp(c),
        "std": lambda: F.stddev_samp(c),
        "skew": lambda: _skew_adjusted(c),
        "nunique": lambda: F.count_distinct(c),
    }
    if name not in table:
        raise ValueError(f"unknown statistic {name!r}; known: {sorted(table)}")
    return table[name]()


# ---------------------------------------------------------------- A1, A2, A3
def group_size(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Rows per key tuple as ``<keys>_count``; null when any key is null."""
    keys = as_list(keys)
    name = name or "_".join(keys) + "_count"
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_back(df, sizes.filter(~any_null(keys)), keys)


def distinct_pairs(df: DataFrame, base: Sequence[str], other: Sequence[str], name: str | None = None) -> DataFrame:
    """Number of distinct ``base`` tuples per ``other`` tuple (``base`` ⊇
    ``other``), joined back on ``other``.  Tuples with nulls are ignored."""
    base, other = as_list(base), as_list(other)
    name = name or "_".join(base) + "_count_" + "_".join(other)
    tuples = df.select(*base).filter(~any_null(base)).distinct()
    counts = tuples.groupBy(*other).agg(F.count(F.lit(1)).alias(name))
    return join_back(df, counts, other)


def distinct_sketch(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = 12, name: str = "sketch") -> DataFrame:
    """(keys, sketch): a mergeable sketch of the distinct values per key, built
    before the shuffle, so that a key costs at most one sketch a task whatever
    its rows.  Its estimate has a relative standard error of some
    ``1.04 / sqrt(2 ** lg_k)`` and is exact for a few values.  Null keys and
    values are ignored."""
    keys = as_list(keys)
    rows = df.filter(~any_null(keys) & F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), F.lit(lg_k)).alias(name))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches of parts (days, sources) united per ``keys``."""
    return sketches.groupBy(*as_list(keys)).agg(F.hll_union_agg(name).alias(name))


def distinct_estimate(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = 12, name: str | None = None) -> DataFrame:
    """Estimated distinct ``value`` per ``keys``, joined back: one shuffle of
    sketches instead of one of all distinct pairs (:func:`distinct_pairs`)."""
    keys = as_list(keys)
    per = distinct_sketch(df, keys, value, lg_k, "__sketch")
    name = name or f"{value}_distinct_{'_'.join(keys)}"
    return join_back(df, per.select(*keys, F.hll_sketch_estimate("__sketch").alias(name)), keys)


def stat_name(base: Sequence[str], other: Sequence[str], stats: Sequence[str], s: str) -> str:
    return "_".join(base) + "_" + "_".join(other) + "_" + "_".join(stats) + s


def group_stats(df: DataFrame, keys: Sequence[str], value: str,
                stats: Sequence[str] = ("min", "max", "var", "size", "mean", "skew")) -> DataFrame:
    """Statistics of ``value`` per key joined back, one aggregate pass for
    all stats (``median`` is exact and rank-based, see :func:`group_median`).
    Names follow ``<keys>_<value>_<stats joined><stat>``."""
    keys = as_list(keys)
    plain = [s for s in stats if s != "median"]
    aggs = [stat(s, value).alias(stat_name(keys, [value], stats, s)) for s in plain]
    out = join_back(df, df.groupBy(*keys).agg(*aggs), keys) if aggs else df
    if "median" in stats:
        out = join_back(out, group_median(df, keys, value, stat_name(keys, [value], stats, "median")), keys)
    return out


def group_deviation(df: DataFrame, key: str | Sequence[str], values: Sequence[str],
                    suffix: str = "_comp") -> DataFrame:
    """``x - mean(x) per key`` for each value column (``<x>_comp``)."""
    keys = as_list(key)
    names = tmp_names(df, *[f"m_{v}" for v in values])
    means = df.groupBy(*keys).agg(*[F.avg(v).alias(n) for v, n in zip(values, names)])
    out = join_back(df, means, keys)
    return out.withColumns({f"{v}{suffix}": F.col(v) - F.col(n) for v, n in zip(values, names)}).drop(*names)


def groupby_join(data: DataFrame, stats_source: DataFrame, keys: Sequence[str], value: str,
                 func: str, name: str = "feat") -> DataFrame:
    """Aggregate ``value`` on ``stats_source`` per key, attach to ``data``."""
    keys = as_list(keys)
    if func == "median":
        st = group_median(stats_source, keys, value, name)
    else:
        st = stats_source.groupBy(*keys).agg(stat(func, value).alias(name))
    return join_back(data, st, keys)


# ---------------------------------------------------------------- A6, A9
def rate_by_category(df: DataFrame, category: str, label: str) -> DataFrame:
    """Per category: labelled count, label sum and their ratio (null keys
    dropped)."""
    return (df.filter(F.col(category).isNotNull())
              .groupBy(category)
              .agg(F.count(label).alias("count"), F.sum(label).alias("sum"))
              .withColumn("rate", F.try_divide(F.col("sum").cast("double"), F.col("count"))))


def rate_by_other_key(df: DataFrame, category: str, other: str, label: str, name: str = "rate") -> DataFrame:
    """Label rate grouped by ``other`` and looked up by this row's
    ``category`` value."""
    st = (df.filter(F.col(other).isNotNull()).groupBy(other)
            .agg(F.try_divide(F.sum(label).cast("double"), F.count(label)).alias(name))
            .withColumnRenamed(other, category))
    return join_back(df, st, [category])


# ---------------------------------------------------------------- A13, A14
def count_encoding(df: DataFrame, column: str | Column, name: str) -> DataFrame:
    """Frequency of this row's value (null stays null)."""
    (v,) = tmp_names(df, "v")
    d = df.withColumn(v, F.col(column) if isinstance(column, str) else column)
    counts = d.filter(F.col(v).isNotNull()).groupBy(v).agg(F.count(F.lit(1)).alias(name))
    return join_back(d, counts, [v]).drop(v)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) sorted by descending count (null is a value)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(column))


# ---------------------------------------------------------------- A19
def pair_association(df: DataFrame, key1: Sequence[str], key2: Sequence[str]) -> DataFrame:
    """``n(k1,k2) / n(k1) / n(k2)`` over the pair table; one row per pair."""
    key1, key2 = as_list(key1), as_list(key2)
    keys = key1 + key2
    name = "_".join(keys) + "_tfidf2"
    pairs = df.filter(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("key_count"))
    n1 = pairs.groupBy(*key1).agg(F.sum("key_count").alias("key1_count"))
    n2 = pairs.groupBy(*key2).agg(F.sum("key_count").alias("key2_count"))
    out = join_back(join_back(pairs, n1, key1), n2, key2)
    return out.withColumn(name, F.col("key_count") / F.col("key2_count") / F.col("key1_count"))


# ---------------------------------------------------------------- A23
def mode_per_key(df: DataFrame, key: str, value: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per key if it occurs more than once
    (smallest on ties), else null.  Two partial aggregates, no per-key list."""
    cnt = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    best = cnt.groupBy(key).agg(
        F.min_by(F.struct(F.col("__n"), F.col(value)), F.struct(-F.col("__n"), F.col(value))).alias("__b"))
    return best.select(key, F.when(F.col("__b.__n") > 1, F.col(f"__b.{value}")).alias(name))


def nunique_per_key(df: DataFrame, key: str, value: str, name: str = "nunique") -> DataFrame:
    """Size of the set of values per key; null counts as one value."""
    d = df.select(key, value).distinct()
    return d.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def trend_per_key(df: DataFrame, key: str, value: str, order: Sequence[Column | str],
                  name: str = "trend") -> DataFrame:
    """Least-squares slope of ``value`` against its 0-based position in
    ``order`` within the key; null when any value is null; 0 for one row."""
    p = ordinal_within(df, [key], order, "__x")  # Catalyst prunes unused columns
    x, y = F.col("__x").cast("double"), F.col(value).cast("double")
    return p.groupBy(key).agg(
        F.when(F.count(y) < F.count(F.lit(1)), F.lit(None).cast("double"))
         .when(F.count(F.lit(1)) == 1, F.lit(0.0))
         .otherwise(F.regr_slope(y, x)).alias(name))


# ---------------------------------------------------------------- A25, A26, W10
def dense_codes(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Table (keys, name) numbering the sorted distinct non-null key tuples
    0..n-1.  The distinct table is ranked with a range-partitioned global
    position, never an unpartitioned window."""
    keys = as_list(keys)
    d = df.select(*keys).filter(~any_null(keys)).distinct()
    return global_position(d, [F.col(k) for k in keys], name)


def label_index(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Sorted distinct labels → 0..k-1 (the mapping table)."""
    return dense_codes(df, [label], name)


def label_encode(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Codes of the sorted distinct string forms, null encoded as ``'nan'``."""
    name = name or column
    (s,) = tmp_names(df, "s")
    d = df.withColumn(s, F.coalesce(F.col(column).cast("string"), F.lit("nan")))
    codes = dense_codes(d, [s], "__code")
    out = join_back(d, codes, [s])
    return out.withColumn(name, F.col("__code")).drop(s, "__code")


def ngroup(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """0-based number of the sorted key tuple; -1 when any key is null."""
    keys = as_list(keys)
    name = name or "_".join(keys) + "_ngroup"
    codes = dense_codes(df, keys, name)
    return join_back(df, codes, keys).withColumn(name, F.coalesce(F.col(name), F.lit(-1).cast("bigint")))


# ---------------------------------------------------------------- A27
def narrow_types_report(df: DataFrame) -> DataFrame:
    """Per numeric column: min, max and the narrowest type that holds them
    (one aggregate pass for all columns)."""
    numeric = [f for f in df.schema.fields
               if f.dataType.typeName() in ("long", "integer", "short", "double", "float")]
    aggs = []
    for f in numeric:
        aggs += [F.min(f.name).cast("double").alias(f"{f.name}__min"), F.max(f.name).cast("double").alias(f"{f.name}__max")]
    stats = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("source_type"),
                     F.col(f"{f.name}__min").alias("min"), F.col(f"{f.name}__max").alias("max"))
            for f in numeric]
    rep = stats.select(F.inline(F.array(*rows)))
    # fixed values: the bounds of the narrow types, and of what is kept as float
    integral = F.col("source_type").isin("bigint", "int", "smallint")
    int_choice = (F.when(integral & (F.col("max") <= 127) & (F.col("min") >= -128), F.lit("tinyint"))
                   .when(integral & (F.col("max") <= 32767) & (F.col("min") >= -32768), F.lit("smallint"))
                   .when(integral & (F.col("max") <= 2147483647) & (F.col("min") >= -2147483648), F.lit("int")))
    float_choice = F.when(~integral & (F.col("max") < 2147483600) & (F.col("min") > -2147483600), F.lit("float"))
    return rep.withColumn("chosen_type", F.coalesce(int_choice, float_choice, F.col("source_type")))


def narrow_types(df: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """Cast every numeric column to its chosen narrow type.  The report has
    one row per column, so collecting it is bounded by the schema width."""
    rep = (report or narrow_types_report(df)).select("column", "chosen_type").collect()
    casts = {r["column"]: F.col(r["column"]).cast(r["chosen_type"]) for r in rep}
    return df.withColumns(casts)


# ---------------------------------------------------------------- A28
def importance_summary(imp: DataFrame, top: int | None = None, by: str = "gain") -> DataFrame:
    """Mean split and gain per feature over folds, by descending ``by``."""
    out = imp.groupBy("feature").agg(F.avg("split").alias("split"), F.avg("gain").alias("gain"))
    out = out.orderBy(F.col(by).desc(), F.col("feature"))
    return out.limit(top) if top else out


# ---------------------------------------------------------------- exact per-key median
def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of ``value`` per key (mean of the two middle values for
    an even count).  Equal values are counted first, so that ties collapse
    before the shuffle, and the distinct values' positions are running counts
    within the key; no key's values are ever gathered in one buffer."""
    keys = as_list(keys)
    d = df.select(*keys, value).filter(F.col(value).isNotNull() & ~any_null(keys))
    c = d.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    n = c.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    j = join_back(ordinal_within(c, keys, [F.col(value)], "__before", weight="__c"), n, keys)
    lo, hi = F.floor((F.col("__n") - 1) / 2), F.ceil((F.col("__n") - 1) / 2)
    holds = lambda at: F.min(F.when(F.col("__before") + F.col("__c") > at, F.col(value).cast("double")))
    return j.groupBy(*keys).agg(((holds(lo) + holds(hi)) / 2).alias(name))
