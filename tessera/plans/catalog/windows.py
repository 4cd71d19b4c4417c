"""Queries: per-group scaling, ranks and shifts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import windows as Wn
from tessera.plans.catalog.sqlutil import r6, spark_r6
from tessera.plans.frames import users
from tessera.plans.registry import query
from tessera.session import read_table


def _r(c):
    return spark_r6(c)


def _cust(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.withColumn("seg", F.when(F.pmod("c_custkey", F.lit(50)) != 0, F.col("c_mktsegment")))


_SEG = "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_mktsegment END"


@query("grp_standard", f"""
WITH t AS (SELECT c_custkey, {_SEG} AS seg, c_acctbal FROM customer),
g AS (SELECT seg, avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM t GROUP BY seg)
SELECT t.c_custkey, {r6('coalesce((t.c_acctbal - g.mu) / nullif(g.sd, 0), 0.0)')} AS c_acctbal_seg_standardize
FROM t LEFT JOIN g ON t.seg = g.seg""")
def grp_standard(spark, sf_dir):
    """Balance standardised within its segment (null segment → 0)."""
    out = Wn.grp_standard(_cust(spark, sf_dir), "seg", ["c_acctbal"])
    return out.select("c_custkey", _r(F.col("c_acctbal_seg_standardize")).alias("c_acctbal_seg_standardize"))


@query("grp_normalize", f"""
WITH t AS (SELECT c_custkey, {_SEG} AS seg, c_acctbal FROM customer),
g AS (SELECT seg, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM t GROUP BY seg)
SELECT t.c_custkey, {r6('coalesce((t.c_acctbal - g.lo) / nullif(g.hi - g.lo, 0), 0.0)')} AS c_acctbal_seg_normalize
FROM t LEFT JOIN g ON t.seg = g.seg""")
def grp_normalize(spark, sf_dir):
    """Balance min-max scaled within its segment (undefined → 0)."""
    out = Wn.grp_normalize(_cust(spark, sf_dir), "seg", ["c_acctbal"])
    return out.select("c_custkey", _r(F.col("c_acctbal_seg_normalize")).alias("c_acctbal_seg_normalize"))


@query("grp_rank", f"""
SELECT c_custkey,
  CASE WHEN seg IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY seg ORDER BY c_acctbal ASC NULLS LAST, c_custkey) - 1 END AS c_acctbal_rank,
  CASE WHEN seg IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY seg ORDER BY c_nationkey ASC NULLS LAST, c_custkey) - 1 END AS c_nationkey_rank
FROM (SELECT c_custkey, {_SEG} AS seg, c_acctbal, c_nationkey FROM customer) t""")
def grp_rank(spark, sf_dir):
    """0-based rank of balance and nation within the segment."""
    out = Wn.grp_rank(_cust(spark, sf_dir), "seg", ["c_acctbal", "c_nationkey"], ["c_custkey"])
    return out.select("c_custkey", "c_acctbal_rank", "c_nationkey_rank")


@query("group_rank", f"""
SELECT c_custkey,
  CASE WHEN seg IS NULL OR c_nationkey IS NULL THEN NULL
       ELSE row_number() OVER (PARTITION BY seg, c_nationkey ORDER BY c_acctbal DESC NULLS LAST, c_custkey) - 1 END AS rank
FROM (SELECT c_custkey, {_SEG} AS seg, c_nationkey, c_acctbal FROM customer) t""")
def group_rank(spark, sf_dir):
    """Descending balance rank within (segment, nation)."""
    out = Wn.group_rank(_cust(spark, sf_dir), ["seg", "c_nationkey"], "c_acctbal", ["c_custkey"], ascending=False)
    return out.select("c_custkey", "rank")


@query("diff_prev", f"""
SELECT event_id, {r6('value - lag(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id)')} AS value_diff2
FROM events""")
def diff_prev(spark, sf_dir):
    """Value minus the value two events earlier for the same user."""
    out = Wn.diff_prev(users(spark, sf_dir), ["user_id"], "value", 2, [F.col("ts"), F.col("event_id")])
    return out.select("event_id", _r(F.col("value_diff2")).alias("value_diff2"))


@query("nth_from_last", """
WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS back
           FROM events),
u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, s.value AS value FROM u LEFT JOIN s ON u.user_id = s.user_id AND s.back = 3""")
def nth_from_last(spark, sf_dir):
    """Per user: the value 3 events before the last one."""
    e = users(spark, sf_dir)
    data = e.select("user_id").distinct()
    return Wn.nth_from_last(data, e, ["user_id"], [F.col("ts"), F.col("event_id")], "value", 3).select(
        "user_id", "value")


@query("nth_from_first", """
WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS fwd
           FROM events),
u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, s.value AS value FROM u LEFT JOIN s ON u.user_id = s.user_id AND s.fwd = 2""")
def nth_from_first(spark, sf_dir):
    """Per user: the value 2 events after the first one."""
    e = users(spark, sf_dir)
    data = e.select("user_id").distinct()
    return Wn.nth_from_first(data, e, ["user_id"], [F.col("ts"), F.col("event_id")], "value", 2).select(
        "user_id", "value")
