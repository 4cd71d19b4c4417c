"""Queries: filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean
from tessera.operators.relate import union_by_name
from tessera.plans.registry import query
from tessera.session import read_table

_LABEL = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END"
_SEGMENT = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END"


def _cust(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.withColumn("label", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")))


@query("filter_sentinel", f"""
SELECT c_custkey, label FROM (SELECT c_custkey, {_LABEL} AS label FROM customer) t
WHERE label IS NULL OR label <> 24""")
def filter_sentinel(spark, sf_dir):
    """Drop rows whose label is the sentinel (24); null labels stay."""
    return clean.filter_sentinel(_cust(spark, sf_dir), "label", 24).select("c_custkey", "label")


@query("split_null_label", f"""
SELECT c_custkey, label, CASE WHEN label IS NULL THEN 'score' ELSE 'labelled' END AS part
FROM (SELECT c_custkey, {_LABEL} AS label FROM customer) t""")
def split_null_label(spark, sf_dir):
    """Labelled rows and rows to score, tagged by part."""
    lab, score = clean.split_by_null_label(_cust(spark, sf_dir), "label")
    return union_by_name([lab.select("c_custkey", "label", F.lit("labelled").alias("part")),
                          score.select("c_custkey", "label", F.lit("score").alias("part"))])


@query("filter_segment", f"""
SELECT c_custkey, segment FROM (SELECT c_custkey, {_SEGMENT} AS segment FROM customer) t
WHERE segment IS NULL OR segment <> 'BUILDING'""")
def filter_segment(spark, sf_dir):
    """Rows outside one segment (``!=`` keeps null segments)."""
    c = read_table(spark, sf_dir, "customer").withColumn(
        "segment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return clean.filter_segment(c, "segment", "BUILDING", equal=False).select("c_custkey", "segment")


@query("null_out_invalid", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""")
def null_out_invalid(spark, sf_dir):
    """Negative balances set to null."""
    c = read_table(spark, sf_dir, "customer")
    return clean.null_out_invalid(c, "c_acctbal", F.col("c_acctbal") < 0).select("c_custkey", "c_acctbal")


@query("fillna_const", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, -1.0) AS c_acctbal FROM customer""")
def fillna_const(spark, sf_dir):
    """Nulls (from invalid balances) replaced by -1."""
    c = read_table(spark, sf_dir, "customer")
    c = clean.null_out_invalid(c, "c_acctbal", F.col("c_acctbal") < 0)
    return clean.fillna_const(c, ["c_acctbal"], -1.0).select("c_custkey", "c_acctbal")


@query("select_predictors", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def select_predictors(spark, sf_dir):
    """All columns except a deny-list and names containing 'nation'."""
    c = read_table(spark, sf_dir, "customer")
    return clean.select_predictors(c, deny=["c_name"], deny_substrings=["nation"])


@query("rename_columns", """
SELECT c_custkey AS user_id, c_name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer""")
def rename_columns(spark, sf_dir):
    """Mapped rename of two columns."""
    c = read_table(spark, sf_dir, "customer")
    return clean.rename_columns(c, {"c_custkey": "user_id", "c_mktsegment": "segment"})


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_columns(spark, sf_dir):
    """Two columns dropped."""
    return clean.drop_columns(read_table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


@query("source_flag", """
SELECT c_custkey, c_mktsegment, 0 AS is_b FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT c_custkey, c_mktsegment, 1 AS is_b FROM customer WHERE c_custkey % 2 = 1 AND c_mktsegment = 'BUILDING'""")
def source_flag(spark, sf_dir):
    """Two sources tagged with a constant flag before the union; then one
    source recovered by its flag (not by position) and filtered."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    a = clean.source_flag(c.filter(F.pmod("c_custkey", F.lit(2)) == 0), "is_b", 0)
    b = clean.source_flag(c.filter(F.pmod("c_custkey", F.lit(2)) == 1), "is_b", 1)
    u = union_by_name([a, b])
    b_only = clean.slice_by_source(u, "is_b", 1).filter(F.col("c_mktsegment") == "BUILDING")
    return union_by_name([clean.slice_by_source(u, "is_b", 0), b_only])
