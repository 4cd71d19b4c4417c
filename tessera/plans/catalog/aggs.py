"""Queries: group statistics, frequency tables and per-key aggregates
(A1–A6, A9, A13, A14, A19, A22, A23, A25–A27, W10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import rows as RW
from tessera.operators import aggs
from tessera.plans.catalog.sqlutil import cents_sql, pmod, r6, rint, spark_r6
from tessera.plans.frames import fees4, line4, users
from tessera.plans.oracle_frames import with_frames
from tessera.plans.registry import query
from tessera.session import read_table


def _r(c):
    return spark_r6(c)


def _orders_nullstatus(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.withColumn("st", F.when(F.pmod("o_orderkey", F.lit(11)) != 0, F.col("o_orderstatus")))


_ST = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END"


@query("group_size", f"""
SELECT o_orderkey, CASE WHEN st IS NULL OR o_orderpriority IS NULL THEN NULL
                        ELSE count(*) OVER (PARTITION BY st, o_orderpriority) END AS st_o_orderpriority_count
FROM (SELECT o_orderkey, {_ST} AS st, o_orderpriority FROM orders) t""")
def group_size(spark, sf_dir):
    """Rows per (status, priority) joined back; null for a null key."""
    o = _orders_nullstatus(spark, sf_dir)
    return aggs.group_size(o, ["st", "o_orderpriority"]).select("o_orderkey", "st_o_orderpriority_count")


@query("distinct_pairs", """
SELECT p.p_partkey, c.n AS p_brand_p_type_count_p_brand
FROM part p LEFT JOIN (SELECT p_brand, count(*) AS n FROM (SELECT DISTINCT p_brand, p_type FROM part
                        WHERE p_brand IS NOT NULL AND p_type IS NOT NULL) d GROUP BY p_brand) c
ON p.p_brand = c.p_brand""")
def distinct_pairs(spark, sf_dir):
    """Distinct types per brand, joined back to each part."""
    p = read_table(spark, sf_dir, "part")
    return aggs.distinct_pairs(p, ["p_brand", "p_type"], ["p_brand"]).select(
        "p_partkey", "p_brand_p_type_count_p_brand")


@query("distinct_sketch", """
SELECT o.o_orderkey, c.n AS o_orderpriority_distinct_o_custkey
FROM orders o LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY o_custkey) c
ON o.o_custkey = c.o_custkey""")
def distinct_sketch(spark, sf_dir):
    """Priorities per customer by sketches (exact for as few), joined back."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return aggs.distinct_estimate(o, ["o_custkey"], "o_orderpriority").drop("o_custkey", "o_orderpriority")


_STATS = ["min", "max", "var", "size", "mean", "skew"]
_SN = {s: aggs.stat_name(["p_brand"], ["p_retailprice"], _STATS, s) for s in _STATS}


@query("group_stats", f"""
WITH m AS (SELECT p_brand, avg(p_retailprice) AS mu FROM part GROUP BY p_brand),
g AS (SELECT p.p_brand, min(p_retailprice) AS mn, max(p_retailprice) AS mx, var_samp(p_retailprice) AS v,
             count(*) AS sz, avg(p_retailprice) AS mean, count(p_retailprice) AS n,
             avg(power(p_retailprice - mu, 2)) AS m2, avg(power(p_retailprice - mu, 3)) AS m3
      FROM part p JOIN m ON p.p_brand = m.p_brand GROUP BY p.p_brand)
SELECT p.p_partkey, g.mn AS {_SN['min']}, g.mx AS {_SN['max']}, {r6('g.v')} AS {_SN['var']},
       g.sz AS {_SN['size']}, {r6('g.mean')} AS {_SN['mean']},
       {r6("CASE WHEN g.n < 3 THEN NULL WHEN g.m2 = 0 THEN 0.0 ELSE g.m3 / power(g.m2, 1.5) * sqrt(g.n * (g.n - 1.0)) / (g.n - 2) END")} AS {_SN['skew']}
FROM part p LEFT JOIN g ON p.p_brand = g.p_brand""")
def group_stats(spark, sf_dir):
    """min, max, var, size, mean, adjusted skew of price per brand, one
    aggregate pass, joined back."""
    p = read_table(spark, sf_dir, "part")
    out = aggs.group_stats(p, ["p_brand"], "p_retailprice", _STATS)
    return out.select("p_partkey", *[(_r(F.col(_SN[s])) if s in ("var", "mean", "skew") else F.col(_SN[s])).alias(_SN[s])
                                     for s in _STATS])


@query("group_deviation", f"""
SELECT o_orderkey, {r6('o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderpriority)')} AS o_totalprice_comp
FROM orders""")
def group_deviation(spark, sf_dir):
    """Price minus the mean price of its priority."""
    o = read_table(spark, sf_dir, "orders")
    out = aggs.group_deviation(o, "o_orderpriority", ["o_totalprice"])
    return out.select("o_orderkey", _r(F.col("o_totalprice_comp")).alias("o_totalprice_comp"))


@query("groupby_join", f"""
SELECT o.o_orderkey, {r6('m.feat')} AS feat
FROM orders o LEFT JOIN (SELECT o_custkey, median(o_totalprice) AS feat FROM orders
                         WHERE o_orderstatus = 'F' GROUP BY o_custkey) m ON o.o_custkey = m.o_custkey""")
def groupby_join(spark, sf_dir):
    """Median price of each customer's finished orders attached to all its
    orders (exact per-key median without per-key value lists)."""
    o = read_table(spark, sf_dir, "orders")
    out = aggs.groupby_join(o, o.filter(F.col("o_orderstatus") == "F"), ["o_custkey"], "o_totalprice", "median")
    return out.select("o_orderkey", _r(F.col("feat")).alias("feat"))


_LABEL_F = "CAST(o_orderstatus = 'F' AS INTEGER)"


@query("rate_by_category", f"""
SELECT o_orderpriority, count({_LABEL_F}) AS count, CAST(sum({_LABEL_F}) AS BIGINT) AS sum,
       {r6(f'sum({_LABEL_F}) / count({_LABEL_F})')} AS rate
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def rate_by_category(spark, sf_dir):
    """Count, sum and rate of a 0/1 label per category."""
    o = read_table(spark, sf_dir, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    out = aggs.rate_by_category(o, "o_orderpriority", "label")
    return out.select("o_orderpriority", "count", F.col("sum").cast("bigint").alias("sum"), _r(F.col("rate")).alias("rate"))


@query("rate_by_other_key", with_frames(f"""
SELECT l.l_orderkey, {r6('r.rate')} AS rate
FROM line4 l LEFT JOIN (SELECT v2, sum(CAST(v4 IS NULL AS INTEGER)) / count(CAST(v4 IS NULL AS INTEGER)) AS rate
                        FROM line4 WHERE v2 IS NOT NULL GROUP BY v2) r ON l.v1 = r.v2""", "line4"))
def rate_by_other_key(spark, sf_dir):
    """Label rate grouped by v2, looked up by each row's v1."""
    l4 = line4(spark, sf_dir).withColumn("label", F.col("v4").isNull().cast("int"))
    out = aggs.rate_by_other_key(l4, "v1", "v2", "label")
    return out.select("l_orderkey", _r(F.col("rate")).alias("rate"))


_D0 = f"CAST({pmod(cents_sql('(f1 / 100.0)'), 10)} AS INTEGER)"
_T = "CAST(floor(coalesce(f1 / 100.0, -1.0) / 10.0) AS BIGINT)"


@query("count_encoding", with_frames(f"""
SELECT c_custkey, count(*) OVER (PARTITION BY {_D0}) AS f1_last0_number,
       count(*) OVER (PARTITION BY {_T}) AS f1_last3_number
FROM fees4""", "fees4"))
def count_encoding(spark, sf_dir):
    """Frequency of each row's last cent digit and of its tens."""
    f = fees4(spark, sf_dir).withColumn("m1", F.col("f1") / 100.0)
    f = aggs.count_encoding(f, N.money_digit("m1", 0), "f1_last0_number")
    f = aggs.count_encoding(f, N.tens("m1"), "f1_last3_number")
    return f.select("c_custkey", "f1_last0_number", "f1_last3_number")


@query("value_counts", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def value_counts(spark, sf_dir):
    """Frequency table of return flags, descending."""
    return aggs.value_counts(read_table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("pair_association", f"""
WITH k AS (SELECT user_id, event_type, count(*) AS key_count FROM events
           WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type),
k1 AS (SELECT user_id, sum(key_count) AS key1_count FROM k GROUP BY user_id),
k2 AS (SELECT event_type, sum(key_count) AS key2_count FROM k GROUP BY event_type)
SELECT k.user_id, k.event_type, k.key_count, CAST(key1_count AS BIGINT) AS key1_count,
       CAST(key2_count AS BIGINT) AS key2_count,
       {r6('k.key_count / key2_count / key1_count * 1000000.0')} AS user_id_event_type_tfidf2
FROM k JOIN k1 ON k.user_id = k1.user_id JOIN k2 ON k.event_type = k2.event_type""")
def pair_association(spark, sf_dir):
    """``n(user, type) / n(user) / n(type)`` (scaled by 1e6 for display)."""
    e = read_table(spark, sf_dir, "events")
    out = aggs.pair_association(e, ["user_id"], ["event_type"])
    return out.select("user_id", "event_type", "key_count", F.col("key1_count").cast("bigint").alias("key1_count"),
                      F.col("key2_count").cast("bigint").alias("key2_count"),
                      _r(F.col("user_id_event_type_tfidf2") * 1000000.0).alias("user_id_event_type_tfidf2"))


_MS = [f"(f{i} / 100.0)" for i in range(1, 5)]
_LIST = "list_filter([" + ", ".join(_MS) + "], lambda x: x IS NOT NULL)"


_X = [f"(f{i} / 100.0)" for i in range(1, 5)]
# sums written left to right, nulls adding 0.0: the same operation order as
# Spark's aggregate() over the compacted array, so both are bitwise equal
_S = "(" * 4 + "0.0" + "".join(f" + coalesce({x}, 0.0))" for x in _X)
_N = " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in _X)
_SS = "(" * 4 + "0.0" + "".join(
    f" + CASE WHEN {x} IS NULL THEN 0.0 ELSE ({x} - s / n) * ({x} - s / n) END)" for x in _X)


@query("row_stats", with_frames(f"""
SELECT c_custkey, {r6('s')} AS row_sum, {r6('s / nullif(n, 0)')} AS row_mean,
  {r6('CASE WHEN n >= 2 THEN ss / (n - 1.0) END')} AS row_var,
  {r6('sqrt(CASE WHEN n >= 2 THEN ss / (n - 1.0) END)')} AS row_std,
  least({', '.join(_MS)}) AS row_min, greatest({', '.join(_MS)}) AS row_max,
  CASE WHEN n >= 2 THEN list_sort(l)[2] END AS row_second_min,
  CAST(CASE WHEN n >= 1 THEN list_max(list_transform(l, lambda x: len(list_filter(l, lambda y: y = x)))) END AS INTEGER) AS row_mode_count
FROM (SELECT *, {_SS} AS ss
      FROM (SELECT c_custkey, f1, f2, f3, f4, {_LIST} AS l, {_S} AS s, CAST({_N} AS DOUBLE) AS n FROM fees4) a) b""", "fees4"))
def row_stats(spark, sf_dir):
    """Row-wise sum, mean, var, std, min, max, second smallest and mode
    count across the four amounts, nulls skipped."""
    f = fees4(spark, sf_dir).withColumns({f"m{i}": F.col(f"f{i}") / 100.0 for i in range(1, 5)})
    ms = ["m1", "m2", "m3", "m4"]
    return f.select("c_custkey", _r(RW.row_sum(ms)).alias("row_sum"), _r(RW.row_mean(ms)).alias("row_mean"),
                    _r(RW.row_var(ms)).alias("row_var"), _r(RW.row_std(ms)).alias("row_std"),
                    RW.row_min(ms).alias("row_min"), RW.row_max(ms).alias("row_max"),
                    RW.row_second_min(ms).alias("row_second_min"), RW.row_mode_count(ms).alias("row_mode_count"))


@query("mode_per_key", """
SELECT user_id, CASE WHEN n > 1 THEN event_type END AS mode FROM (
  SELECT user_id, event_type, count(*) AS n,
         row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
  FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) t WHERE rn = 1""")
def mode_per_key(spark, sf_dir):
    """Most frequent event type per user if repeated (smallest on ties)."""
    return aggs.mode_per_key(users(spark, sf_dir), "user_id", "event_type")


@query("nunique_per_key", """
SELECT user_id, count(*) AS nunique FROM (SELECT DISTINCT user_id, event_type FROM events) t GROUP BY user_id""")
def nunique_per_key(spark, sf_dir):
    """Distinct event types per user (null counts as a value)."""
    return aggs.nunique_per_key(users(spark, sf_dir), "user_id", "event_type")


@query("trend_per_key", f"""
SELECT user_id, CASE WHEN count(value) < count(*) THEN NULL WHEN count(*) = 1 THEN 0.0
                     ELSE {r6('regr_slope(value, pos)')} END AS trend
FROM (SELECT user_id, value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS DOUBLE) AS pos
      FROM events) t GROUP BY user_id""")
def trend_per_key(spark, sf_dir):
    """Least-squares slope of value over event order per user."""
    out = aggs.trend_per_key(users(spark, sf_dir), "user_id", "value", [F.col("ts"), F.col("event_id")])
    return out.select("user_id", _r(F.col("trend")).alias("trend"))


@query("label_index", """
SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS label_index
FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL) t""")
def label_index(spark, sf_dir):
    """Sorted distinct labels numbered 0..k-1."""
    return aggs.label_index(read_table(spark, sf_dir, "orders"), "o_orderpriority")


@query("label_encode", f"""
WITH t AS (SELECT o_orderkey, coalesce({_ST}, 'nan') AS s FROM orders),
c AS (SELECT s, CAST(row_number() OVER (ORDER BY s) - 1 AS BIGINT) AS status_code FROM (SELECT DISTINCT s FROM t) d)
SELECT t.o_orderkey, c.status_code FROM t JOIN c ON t.s = c.s""")
def label_encode(spark, sf_dir):
    """Codes of the sorted string forms, null encoded as 'nan'."""
    o = _orders_nullstatus(spark, sf_dir)
    return aggs.label_encode(o, "st", "status_code").select("o_orderkey", "status_code")


@query("ngroup", """
WITH t AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey % 3 END AS band
           FROM customer),
g AS (SELECT c_mktsegment, band, CAST(row_number() OVER (ORDER BY c_mktsegment, band) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT c_mktsegment, band FROM t WHERE c_mktsegment IS NOT NULL AND band IS NOT NULL) d)
SELECT t.c_custkey, coalesce(g.code, -1) AS c_mktsegment_band_ngroup
FROM t LEFT JOIN g ON t.c_mktsegment = g.c_mktsegment AND t.band = g.band""")
def ngroup(spark, sf_dir):
    """0-based number of the sorted (segment, band) tuple; -1 for a null key."""
    c = read_table(spark, sf_dir, "customer").withColumn(
        "band", F.when(F.col("c_acctbal") >= 0, F.pmod("c_nationkey", F.lit(3))))
    return aggs.ngroup(c, ["c_mktsegment", "band"]).select("c_custkey", "c_mktsegment_band_ngroup")


def _narrow_sql(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in cols:
        integral = t in ("bigint", "int")
        choice = ("CASE WHEN mx <= 127 AND mn >= -128 THEN 'tinyint' WHEN mx <= 32767 AND mn >= -32768 THEN 'smallint' "
                  "WHEN mx <= 2147483647 AND mn >= -2147483648 THEN 'int' ELSE '" + t + "' END") if integral else \
                 ("CASE WHEN mx < 2147483600 AND mn > -2147483600 THEN 'float' ELSE '" + t + "' END")
        parts.append(f"SELECT '{table}' AS tbl, '{c}' AS column, '{t}' AS source_type, mn AS min, mx AS max, "
                     f"{choice} AS chosen_type FROM (SELECT CAST(min({c}) AS DOUBLE) AS mn, "
                     f"CAST(max({c}) AS DOUBLE) AS mx FROM {table}) s")
    return "\nUNION ALL\n".join(parts)


_LI_NUM = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
           ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double")]
_PART_NUM = [("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "double")]


@query("narrow_types", _narrow_sql("lineitem", _LI_NUM) + "\nUNION ALL\n" + _narrow_sql("part", _PART_NUM))
def narrow_types(spark, sf_dir):
    """Per numeric column: min, max and the narrowest holding type (one
    aggregate pass per table)."""
    li = aggs.narrow_types_report(read_table(spark, sf_dir, "lineitem")).withColumn("tbl", F.lit("lineitem"))
    pa = aggs.narrow_types_report(read_table(spark, sf_dir, "part")).withColumn("tbl", F.lit("part"))
    return li.unionByName(pa).select("tbl", "column", "source_type", "min", "max", "chosen_type")


@query("narrow_types_cast", """
SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS TINYINT) AS p_size,
       CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part""")
def narrow_types_cast(spark, sf_dir):
    """Parts with every numeric column cast to its narrowest holding type
    (the types stated in SQL hold up to 32,767 parts)."""
    return aggs.narrow_types(read_table(spark, sf_dir, "part"))
