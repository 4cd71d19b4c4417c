"""Stand-in inputs built from the driver's TPC-H-like tables.

The reference works on a wide per-user telecom table that is not part of the
test data.  These frames only reshape the given tables into rows of the
schema the operators expect (four monthly amounts per row, raw text amounts,
ordered per-user events, class probabilities); they do none of the
operators' work.  Each has a twin SQL text in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keys import ordinal_within
from tessera.session import read_table


def _wide(df: DataFrame, key: str, order, value, n: int, prefix: str) -> DataFrame:
    """Per key and ``chunk`` of ``n`` rows in ``order``: their values as
    columns prefix1..prefixn (null-padded), so that every row has a place."""
    o = ordinal_within(df, [key], order, "_ord")
    o = o.withColumn("chunk", F.floor(F.col("_ord") / n).cast("bigint"))
    return o.groupBy(key, "chunk").agg(*[
        F.max(F.when(F.pmod("_ord", F.lit(n)) == i, value)).alias(f"{prefix}{i + 1}") for i in range(n)
    ])


def line4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order and chunk of four lines: their discount cents (v1..v4)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    order = [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]
    cents = F.rint(F.col("l_discount") * 100.0).cast("bigint")
    return _wide(li, "l_orderkey", order, cents, 4, "v")


def fees4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and chunk of four orders, latest first: the cents of their
    totals (f1..f4), with customer attributes and a number of the row.
    Customers without orders have one row of nulls."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    cents = F.rint(F.col("o_totalprice") * 100.0).cast("bigint")
    wide = _wide(o, "o_custkey", order, cents, 4, "f")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    j = cust.join(wide, wide.o_custkey == cust.c_custkey, "left").drop("o_custkey")
    j = j.withColumn("chunk", F.coalesce("chunk", F.lit(0).cast("bigint")))
    return j.withColumn("row_id", F.col("c_custkey") * 1048576 + F.col("chunk"))


def rawtext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a raw text amount ``fee``: ``\\N``, whole-number text or
    two-decimal text."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    k = F.col("o_orderkey")
    fee = (F.when(F.pmod(k, F.lit(17)) == 0, F.lit("\\N"))
           .when(F.pmod(k, F.lit(13)) == 0, F.floor(F.col("o_totalprice")).cast("bigint").cast("string"))
           .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")))
    return o.withColumn("fee", fee)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user event rows (ordered by ts, event_id within a user)."""
    return read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")


def _hash_slice(c, i: int):
    h = F.md5(c.cast("string"))
    return F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("double")


def prob3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with three pseudo class probabilities (md5 slices of the key,
    normalised) and the true class ``o_orderkey % 3``."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    a, b, c = _hash_slice(k, 0), _hash_slice(k, 1), _hash_slice(k, 2)
    s = a + b + c
    return o.select(
        "o_orderkey",
        (a / s).alias("p_0"), (b / s).alias("p_1"), (c / s).alias("p_2"),
        F.pmod(k, F.lit(3)).cast("int").alias("true_class"))
