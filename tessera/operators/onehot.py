"""One-hot encodings.

The values that get a dummy are found by an aggregate and stay a table: the
encodings come in long form, one row ``(keys, dummy, value)`` per 1-entry,
for any number of values.  :func:`one_hot_wide` makes 0/1 columns of the
values that the caller names, :func:`one_hot_vector` a sparse vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggs import dense_codes
from tessera.operators.keys import as_list, join_back, tmp_names
from tessera.session import cut_lineage


def frequent_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Table of the non-null values that occur more than ``n`` times."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > n).select(column))


def _entry(column: str, value: Column, infix: str) -> Column:
    return F.concat(F.lit(f"{column}{infix}"), F.coalesce(value.cast("string"), F.lit("nan")))


def one_hot_frequent(df: DataFrame, keys: Sequence[str], column: str, n: int = 100) -> DataFrame:
    """``(keys, dummy, value)`` of the 1-entries of the dummies
    ``<col>N_<value>`` of values with frequency > n."""
    (hit,) = tmp_names(df, "hit")
    f = join_back(df.select(*as_list(keys), column), frequent_values(df, column, n).withColumn(hit, F.lit(1)), [column])
    return f.filter(F.col(hit).isNotNull()).select(*as_list(keys), _entry(column, F.col(column), "N_").alias("dummy"),
                                                   F.col(hit).alias("value"))


def dummies_with_null(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(keys, dummy, value)`` of the 1-entries of the dummies of every value
    and of ``<col>_nan``: one per row and column."""
    entries = [F.struct(_entry(c, F.col(c), "_").alias("dummy"), F.lit(1).alias("value")) for c in as_list(columns)]
    return df.select(*as_list(keys), F.inline(F.array(*entries)))


def one_hot_pruned(df: DataFrame, keys: Sequence[str], min_count: int = 100, nan_as_category: bool = True,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """As :func:`dummies_with_null` for all string columns, without dummies
    of fewer than ``min_count`` ones or zeros.  The (column, value) counts
    come from one unpivot and one aggregate."""
    keys = as_list(keys)
    cols = as_list(columns) if columns is not None else [f.name for f in df.schema.fields
                                                         if f.dataType.typeName() == "string" and f.name not in keys]
    if not cols:
        return df.select(*keys, F.lit("").alias("dummy"), F.lit(1).alias("value")).limit(0)
    unp = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val"))
                                              for c in cols])))
    if not nan_as_category:
        unp = unp.filter(F.col("val").isNotNull())
    unp = unp.withColumn("dummy", F.concat("col", F.lit("_"), F.coalesce("val", F.lit("nan"))))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = (unp.groupBy("dummy").agg(F.count(F.lit(1)).alias("n")).withColumn("total", total)
            .filter((F.col("n") >= min_count) & (F.col("total") - F.col("n") >= min_count))
            .select("dummy", F.lit(1).alias("value")))
    return join_back(unp.select(*keys, "dummy"), kept, ["dummy"]).filter(F.col("value").isNotNull()).select(*keys, "dummy", "value")


def one_hot_wide(df: DataFrame, column: str, values: Sequence, infix: str = "_", nan: bool = False) -> DataFrame:
    """0/1 columns ``<col><infix><value>`` of the named values (and
    ``<col><infix>nan``)."""
    c = F.col(column)
    new = {f"{column}{infix}{v}": F.coalesce(c == F.lit(v), F.lit(False)).cast("int") for v in values}
    if nan:
        new[f"{column}{infix}nan"] = c.isNull().cast("int")
    return df.withColumns(new)


def one_hot_vector(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Sparse-vector one-hot of any number of values: places in the order of the
    sorted values from a table of codes, the last place for null."""
    from pyspark.ml.feature import OneHotEncoder
    (idx,) = tmp_names(df, "idx")
    codes = cut_lineage(dense_codes(df, [column], idx), "codes")
    size = codes.count()
    d = join_back(df, codes, [column])
    d = d.withColumn(idx, F.coalesce(F.col(idx), F.lit(size)).cast("double"))
    encoder = OneHotEncoder(inputCol=idx, outputCol=output or f"{column}_vec", dropLast=False)
    places = df.sparkSession.range(1).select(F.lit(float(size)).alias(idx))  # the largest place
    return encoder.fit(places).transform(d).select(*df.columns, encoder.getOutputCol())
