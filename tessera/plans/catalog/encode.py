"""Queries: bins, target rates and one-hot encodings (A7, A8, A10–A12,
A15–A18, A24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.ml.folds import hash_bucket
from tessera.operators import bins, onehot, rates
from tessera.plans.catalog.sqlutil import r6, spark_r6
from tessera.plans.registry import query
from tessera.session import read_table


def _r(c):
    return spark_r6(c)


# ------------------------------------------------------------------ bins
def _edges_sql_width(src: str, x: str, k: int) -> str:
    """1-row CTE body with e0..ek as pd.cut builds them."""
    es = []
    for j in range(k + 1):
        if j == k:
            e = "hi"
        else:
            e = f"{float(j)} * ((hi - lo) / {float(k)}) + lo"
        if j == 0:
            e = f"CASE WHEN mn = mx THEN {e} ELSE {e} - (mx - mn) * 0.001 END"
        es.append(f"{e} AS e{j}")
    return f"""SELECT {', '.join(es)} FROM (
  SELECT mn, mx,
    CASE WHEN mn = mx THEN (CASE WHEN mn = 0 THEN -0.001 ELSE mn - 0.001 * abs(mn) END) ELSE mn END AS lo,
    CASE WHEN mn = mx THEN (CASE WHEN mx = 0 THEN 0.001 ELSE mx + 0.001 * abs(mx) END) ELSE mx END AS hi
  FROM (SELECT CAST(min({x}) AS DOUBLE) AS mn, CAST(max({x}) AS DOUBLE) AS mx FROM {src}) s) t"""


def _edges_sql_quantile(src: str, x: str, k: int) -> str:
    """Exact linear-interpolated quantile edges e0..ek as a 1-row CTE body."""
    q = " UNION ALL ".join(
        f"SELECT {j} AS j, (n - 1) * ({'1.0' if j == k else f'{j} * (1.0 / {k})'}) AS h FROM qn" for j in range(k + 1))
    piv = ", ".join(f"max(CASE WHEN j = {j} THEN e END) AS e{j}" for j in range(k + 1))
    return f"""SELECT {piv} FROM (
  SELECT qt.j, CASE WHEN qt.h - floor(qt.h) = 0 THEN a.x ELSE a.x + (b.x - a.x) * (qt.h - floor(qt.h)) END AS e
  FROM (WITH qs AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS pos
                    FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {src}) v WHERE x IS NOT NULL),
             qn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM qs)
        SELECT * FROM ({q}) z) qt
  LEFT JOIN (SELECT x, row_number() OVER (ORDER BY x) - 1 AS pos
             FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {src}) v WHERE x IS NOT NULL) a ON a.pos = floor(qt.h)
  LEFT JOIN (SELECT x, row_number() OVER (ORDER BY x) - 1 AS pos
             FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {src}) v WHERE x IS NOT NULL) b ON b.pos = floor(qt.h) + 1
) w"""


def _bin_sql(x: str, k: int) -> str:
    inner = " + ".join(f"CASE WHEN ed.e{j} < {x} THEN 1 ELSE 0 END" for j in range(1, k))
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE CAST(1 + {inner} AS INTEGER) END"


def _bin_rates_sql(src: str, x: str, label: str, k: int, edges_body: str) -> str:
    bounds = " UNION ALL ".join(f"SELECT {j} AS bin, e{j - 1} AS lo, e{j} AS hi FROM ed" for j in range(1, k + 1))
    return f"""WITH ed AS ({edges_body}),
b AS (SELECT {_bin_sql(f'CAST({x} AS DOUBLE)', k)} AS bin, {label} AS label FROM {src}, ed),
per AS (SELECT bin, coalesce(sum(label), 0) AS s, count(label) AS c FROM b WHERE bin IS NOT NULL GROUP BY bin),
allb AS ({bounds})
SELECT allb.bin, {r6('allb.lo')} AS lo, {r6('allb.hi')} AS hi, CAST(coalesce(per.s, 0) AS BIGINT) AS sum,
       CAST(coalesce(per.c, 0) AS BIGINT) AS count, {r6('per.s / per.c')} AS rate
FROM allb LEFT JOIN per ON allb.bin = per.bin"""


def _round_bounds(df):
    return df.withColumn("lo", _r(F.col("lo"))).withColumn("hi", _r(F.col("hi"))).withColumn("rate", _r(F.col("rate")))


@query("rate_equal_width", _bin_rates_sql("customer", "c_acctbal", "CAST(c_mktsegment = 'BUILDING' AS INTEGER)", 10,
                                          _edges_sql_width("customer", "c_acctbal", 10)))
def rate_equal_width(spark, sf_dir):
    """Label rate per equal-width balance bin (all 10 bins)."""
    c = read_table(spark, sf_dir, "customer").withColumn("label", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    return _round_bounds(bins.rate_equal_width(c, "c_acctbal", "label", 10))


@query("rate_equal_freq", _bin_rates_sql("orders", "o_totalprice", "CAST(o_orderstatus = 'F' AS INTEGER)", 10,
                                         _edges_sql_quantile("orders", "o_totalprice", 10)))
def rate_equal_freq(spark, sf_dir):
    """Label rate per equal-frequency price bin."""
    o = read_table(spark, sf_dir, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    return _round_bounds(bins.rate_equal_freq(o, "o_totalprice", "label", 10))


@query("qcut_bins", f"""
WITH ed AS ({_edges_sql_quantile('orders', 'o_totalprice', 10)})
SELECT o_orderkey, {_bin_sql('o_totalprice', 10)} AS price_bin FROM orders, ed""")
def qcut_bins(spark, sf_dir):
    """Equal-frequency bin (1..10) of each order's price."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return bins.qcut_bins(o, "o_totalprice", 10, "price_bin").select("o_orderkey", "price_bin")


_QOH = ", ".join(f"CAST(coalesce(b = {j}, false) AS INTEGER) AS c_acctbal_scatter_{j}" for j in range(1, 6))


@query("quantile_one_hot", f"""
WITH ed AS ({_edges_sql_quantile('customer', 'c_acctbal', 5)}),
t AS (SELECT c_custkey, c_acctbal, {_bin_sql('c_acctbal', 5)} AS b FROM customer, ed)
SELECT c_custkey, c_acctbal, {_QOH}, CAST(b IS NULL AS INTEGER) AS c_acctbal_scatter_nan FROM t""")
def quantile_one_hot(spark, sf_dir):
    """Quantile-bin dummies of the balance (5 bins + null indicator)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return bins.quantile_one_hot(c, "c_acctbal", 5)


# ------------------------------------------------------------------ rates
CLASSES = [0, 1, 2, 3, 4]
_LABEL_SQL = "CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 1 END"
_FOLD_SQL = "CAST(('0x' || substr(md5(CAST(o.o_orderkey AS VARCHAR) || ':66'), 1, 8))::UBIGINT % 5 AS INTEGER)"
_RATE_BASE = f"""base AS (SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, {_LABEL_SQL} AS label, {_FOLD_SQL} AS fold
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _rate_base(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    label = F.when(F.pmod("o_orderkey", F.lit(10)) != 0, F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    j = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_mktsegment",
                                                     label.alias("label"))
    return j.withColumn("fold", hash_bucket("o_orderkey", 5, 66))


_CR_COLS = ", ".join(
    f"{r6(f'CASE WHEN s.n >= 20 AND s.m > 0 THEN s.c{c} / s.n END')} AS o_custkey_{c}_conversion" for c in CLASSES)
_CR_AGG = ", ".join(f"count(*) FILTER (WHERE label = {c}) AS c{c}" for c in CLASSES)


@query("class_rates", f"""
WITH {_RATE_BASE},
s AS (SELECT o_custkey, count(*) AS n, count(label) AS m, {_CR_AGG} FROM base
      WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT b.o_orderkey, {_CR_COLS} FROM base b LEFT JOIN s ON b.o_custkey = s.o_custkey""")
def class_rates(spark, sf_dir):
    """In-sample P(priority class | customer), support >= 20 else null."""
    out = rates.class_rates(_rate_base(spark, sf_dir), "o_custkey", "label", CLASSES, min_support=20)
    return out.select("o_orderkey", *[_r(F.col(f"o_custkey_{c}_conversion")).alias(f"o_custkey_{c}_conversion")
                                      for c in CLASSES])


_OOF_COLS = ", ".join(
    f"{r6(f'(t.C{c} - p.c{c}) / nullif(t.M - p.m, 0)')} AS c_mktsegment_{c}_conversion" for c in CLASSES)
_OOF_AGG = ", ".join(f"count(*) FILTER (WHERE label = {c}) AS c{c}" for c in CLASSES)
_OOF_TOT = ", ".join(f"sum(c{c}) AS C{c}" for c in CLASSES)


@query("oof_class_rates", f"""
WITH {_RATE_BASE},
p AS (SELECT c_mktsegment, fold, count(label) AS m, {_OOF_AGG} FROM base WHERE c_mktsegment IS NOT NULL
      GROUP BY c_mktsegment, fold),
t AS (SELECT c_mktsegment, sum(m) AS M, {_OOF_TOT} FROM p GROUP BY c_mktsegment)
SELECT b.o_orderkey, {_OOF_COLS}
FROM base b LEFT JOIN p ON b.c_mktsegment = p.c_mktsegment AND b.fold = p.fold
LEFT JOIN t ON b.c_mktsegment = t.c_mktsegment""")
def oof_class_rates(spark, sf_dir):
    """Out-of-fold P(priority class | segment): each row's rates use the
    other four folds only."""
    out = rates.oof_class_rates(_rate_base(spark, sf_dir), "c_mktsegment", "label", "fold", CLASSES)
    return out.select("o_orderkey", *[_r(F.col(f"c_mktsegment_{c}_conversion")).alias(f"c_mktsegment_{c}_conversion")
                                      for c in CLASSES])


@query("beta_smoothed_rate", f"""
WITH {_RATE_BASE},
ci AS (SELECT o_custkey, count(*) FILTER (WHERE label = 0) AS C, count(*) AS I FROM base GROUP BY o_custkey),
st AS (SELECT avg(C / I) AS mean, var_samp(C / I) AS var FROM ci),
ab AS (SELECT (mean + 1e-6) * ((mean + 1e-6) * (1.000001 - mean) / (var + 1e-6) - 1) AS alpha,
              (1.000001 - mean) * ((mean + 1e-6) * (1.000001 - mean) / (var + 1e-6) - 1) AS beta FROM st)
SELECT o_custkey, {r6('(alpha + C) / (alpha + beta + I)')} AS bayes_rate FROM ci, ab""")
def beta_smoothed_rate(spark, sf_dir):
    """Beta-smoothed urgent-order rate per customer (moment fit)."""
    b = _rate_base(spark, sf_dir)
    ci = b.groupBy("o_custkey").agg(F.count(F.when(F.col("label") == 0, 1)).alias("C"), F.count(F.lit(1)).alias("I"))
    out = rates.beta_smoothed_rate(ci, "C", "I")
    return out.select("o_custkey", _r(F.col("bayes_rate")).alias("bayes_rate"))


# ------------------------------------------------------------------ one-hot (long form: key, dummy, 1)
@query("one_hot_frequent", """
SELECT p_partkey, 'p_typeN_' || p_type AS dummy, 1 AS value
FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_type IS NOT NULL GROUP BY p_type HAVING count(*) > 300)""")
def one_hot_frequent(spark, sf_dir):
    """Dummies for types occurring more than 300 times (1-entries)."""
    return onehot.one_hot_frequent(read_table(spark, sf_dir, "part"), ["p_partkey"], "p_type", 300)


_SEG_NULL = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END"


@query("dummies_with_null", f"""
SELECT c_custkey, 'seg_' || coalesce({_SEG_NULL}, 'nan') AS dummy, 1 AS value FROM customer""")
def dummies_with_null(spark, sf_dir):
    """Dummies of every segment plus a null indicator (1-entries)."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"))
    return onehot.dummies_with_null(c, ["c_custkey"], ["seg"])


@query("one_hot_wide", f"""
SELECT c_custkey, {', '.join(f"CAST(coalesce(seg = '{v}', false) AS INTEGER) AS seg_{v}" for v in ('BUILDING', 'MACHINERY'))},
       CAST(seg IS NULL AS INTEGER) AS seg_nan
FROM (SELECT c_custkey, {_SEG_NULL} AS seg FROM customer) t""")
def one_hot_wide(spark, sf_dir):
    """0/1 columns of two named segments and of null."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"))
    return onehot.one_hot_wide(c, "seg", ["BUILDING", "MACHINERY"], nan=True).drop("seg")


@query("one_hot_pruned", """
WITH u AS (SELECT p_partkey, 'p_brand_' || coalesce(p_brand, 'nan') AS dummy FROM part
           UNION ALL SELECT p_partkey, 'p_type_' || coalesce(p_type, 'nan') AS dummy FROM part)
SELECT p_partkey, dummy, 1 AS value FROM u WHERE dummy IN (
  SELECT dummy FROM u GROUP BY dummy HAVING count(*) >= 70 AND (SELECT count(*) FROM part) - count(*) >= 70)""")
def one_hot_pruned(spark, sf_dir):
    """Dummies of all string columns, near-constant ones (<70 ones or
    zeros) dropped (1-entries)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return onehot.one_hot_pruned(p, ["p_partkey"], min_count=70)


@query("class_rate_table", f"""
WITH {_RATE_BASE},
n AS (SELECT c_mktsegment, count(*) AS n FROM base WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
SELECT b.c_mktsegment, b.label AS class, {r6('count(*) / max(n.n)')} AS rate
FROM base b JOIN n ON b.c_mktsegment = n.c_mktsegment WHERE b.label IS NOT NULL AND n.n >= 20
GROUP BY b.c_mktsegment, b.label""")
def class_rate_table(spark, sf_dir):
    """P(priority class | segment) as a table of classes."""
    t = rates.class_rate_table(_rate_base(spark, sf_dir), "c_mktsegment", "label")
    return t.withColumn("rate", _r("rate"))


@query("one_hot_vector", """
WITH c AS (SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 AS i FROM (SELECT DISTINCT l_suppkey FROM lineitem) t)
SELECT l_orderkey, l_linenumber, l_partkey,
       '(' || ((SELECT count(*) FROM c) + 1) || ',[' || c.i || '],[1.0])' AS vector
FROM lineitem l JOIN c ON l.l_suppkey = c.l_suppkey""")
def one_hot_vector(spark, sf_dir):
    """Suppliers of line items as sparse vectors (printed)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return onehot.one_hot_vector(li, "l_suppkey", "vector").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("vector").cast("string").alias("vector"))
