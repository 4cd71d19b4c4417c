"""Queries: dedup, joins between stages, unions, ordering, metrics and
folds (D1–D3, J1, J2, J5–J9, U1–U4, O1–O3, E1–E6, M1–M3, M6, M11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.rows import argmax
from tessera.ml import folds
from tessera.operators import dedup, metrics, order, relate
from tessera.plans.catalog.sqlutil import r6, spark_r6
from tessera.plans.frames import prob3
from tessera.plans.oracle_frames import with_frames
from tessera.plans.registry import query
from tessera.session import read_table


def _r(c):
    return spark_r6(c)


# ------------------------------------------------------------------ dedup
_LI_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]
_LI_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"


def _li(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@query("dedup_first", f"""
SELECT {_LI_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                        ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) t WHERE rn = 1""")
def dedup_first(spark, sf_dir):
    """One line per (order, line number): the first by part, supplier, price."""
    return dedup.dedup_first(_li(spark, sf_dir), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@query("dedup_last", f"""
SELECT {_LI_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                        ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) t WHERE rn = 1""")
def dedup_last(spark, sf_dir):
    """One line per (order, line number): the last by part, supplier, price."""
    return dedup.dedup_last(_li(spark, sf_dir), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@query("flag_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS INTEGER) AS is_duplicated
FROM lineitem""")
def flag_duplicates(spark, sf_dir):
    """Every member of a duplicated (order, line number) group flagged."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup.flag_duplicates(li, ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------ joins
def _halves(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    even = c.filter(F.pmod("c_custkey", F.lit(2)) == 0)
    odd = c.filter(F.pmod("c_custkey", F.lit(2)) == 1)
    return even, odd


@query("stack_join", """
WITH s AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_mktsegment, s.n AS m1_n, round_even(s.total * 1000000.0, 0) / 1000000.0 AS m1_total
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey""")
def stack_join(spark, sf_dir):
    """A stage output (per-customer order stats) left-joined on the row key
    with a model prefix."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    s = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))
    out = relate.stack_join(c, s, "c_custkey", "m1_")
    return out.withColumn("m1_total", _r(F.col("m1_total")))


@query("left_merge", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def left_merge(spark, sf_dir):
    """Orders keep their key; customer columns merged in."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return relate.left_merge(o, c, ["o_custkey"], keep=["o_orderkey"])


@query("override_join", """
WITH w AS (SELECT o_custkey, CAST(min(substr(o_orderpriority, 1, 1)) AS INTEGER) AS pred
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c.c_custkey, coalesce(w.pred, c.c_nationkey % 5) AS pred
FROM customer c LEFT JOIN w ON c.c_custkey = w.o_custkey""")
def override_join(spark, sf_dir):
    """Predictions replaced by listed values where the key is listed."""
    c = read_table(spark, sf_dir, "customer")
    pred = c.select("c_custkey", F.pmod("c_nationkey", F.lit(5)).alias("pred"))
    white = (read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
             .groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.min(F.substring("o_orderpriority", 1, 1)).cast("int").alias("pred")))
    return relate.override_join(pred, white, "c_custkey", "pred")


@query("semi_join", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def semi_join(spark, sf_dir):
    """Customers that placed an urgent order (``isin``)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    u = (read_table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
         .select(F.col("o_custkey").alias("c_custkey")))
    return relate.semi_join(c, u, "c_custkey")


_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}


@query("map_codes", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS code
FROM orders""")
def map_codes(spark, sf_dir):
    """Priority mapped through a small dict; unmapped → null."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", relate.map_codes("o_orderpriority", _CODES).alias("code"))


@query("concat_columns", """
SELECT c.c_custkey, c.c_mktsegment, a.c_acctbal, b.n_orders
FROM customer c
LEFT JOIN (SELECT c_custkey, round_even(c_acctbal * 2 * 1000000.0, 0) / 1000000.0 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0) a
  ON c.c_custkey = a.c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) b ON c.c_custkey = b.o_custkey""")
def concat_columns(spark, sf_dir):
    """Column blocks of several frames aligned on the row key; a later
    block's column replaces the earlier one."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    a = (read_table(spark, sf_dir, "customer").filter(F.pmod("c_custkey", F.lit(2)) == 0)
         .select("c_custkey", _r(F.col("c_acctbal") * 2).alias("c_acctbal")))
    b = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    return relate.concat_columns([c, a, b], "c_custkey")


_BAND = "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal / 2500) AS BIGINT) END"


@query("exact_match_transfer", f"""
WITH t AS (SELECT c_custkey, c_nationkey, c_mktsegment, {_BAND} AS band FROM customer WHERE c_custkey % 2 = 0),
s AS (SELECT c_nationkey, c_mktsegment, {_BAND} AS band, c_custkey % 7 AS label,
             row_number() OVER (PARTITION BY c_nationkey, c_mktsegment, {_BAND} ORDER BY c_custkey) AS rn
      FROM customer WHERE c_custkey % 2 = 1)
SELECT t.c_custkey, s.label FROM t JOIN s
  ON t.c_nationkey IS NOT DISTINCT FROM s.c_nationkey AND t.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment
 AND t.band IS NOT DISTINCT FROM s.band
WHERE s.rn = 1 AND s.label IS NOT NULL""")
def exact_match_transfer(spark, sf_dir):
    """Labels carried from odd to even customers equal on (nation, segment,
    balance band); the band is null for negative balances and null matches
    null."""
    even, odd = _halves(spark, sf_dir)
    band = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 2500).cast("bigint"))
    t = even.select("c_custkey", "c_nationkey", "c_mktsegment", band.alias("band"))
    s = odd.select("c_custkey", "c_nationkey", "c_mktsegment", band.alias("band"),
                   F.pmod("c_custkey", F.lit(7)).alias("label"))
    return relate.exact_match_transfer(t, s, ["c_nationkey", "c_mktsegment", "band"], "c_custkey", "label",
                                       ["c_custkey"])


# ------------------------------------------------------------------ unions
# two overlapping sources that together cover the whole customer table
_A = "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 5000"
_B = "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal >= 2000"


def _slices(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    a = c.filter(F.col("c_acctbal") < 5000).select("c_custkey", "c_mktsegment", "c_acctbal")
    b = c.filter(F.col("c_acctbal") >= 2000).select("c_custkey", "c_mktsegment", "c_nationkey")
    return a, b


@query("union_by_name", f"""
SELECT c_custkey, c_mktsegment, c_acctbal, NULL::INTEGER AS c_nationkey FROM ({_A}) a
UNION ALL SELECT c_custkey, c_mktsegment, NULL::DOUBLE AS c_acctbal, c_nationkey FROM ({_B}) b""")
def union_by_name(spark, sf_dir):
    """Two overlapping slices stacked by column name."""
    a, b = _slices(spark, sf_dir)
    return relate.union_by_name([a, b])


@query("union_dedup_prefer_first", f"""
SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY src) AS rn FROM (
    SELECT c_custkey, c_mktsegment, c_acctbal, NULL::INTEGER AS c_nationkey, 0 AS src FROM ({_A}) a
    UNION ALL SELECT c_custkey, c_mktsegment, NULL::DOUBLE, c_nationkey, 1 AS src FROM ({_B}) b) u) t
WHERE rn = 1""")
def union_dedup_prefer_first(spark, sf_dir):
    """Union deduplicated on the key; the earlier slice wins."""
    a, b = _slices(spark, sf_dir)
    return relate.union_dedup_prefer_first([a, b], ["c_custkey"])


@query("upweight", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
                                     THEN CAST(2.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS weight
FROM customer""")
def upweight(spark, sf_dir):
    """Weight 2 for customers in a subset (instead of appending them twice)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sub = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"))
    return relate.upweight(c, sub, "c_custkey")


@query("union_fill", f"""
SELECT c_custkey, c_mktsegment, c_acctbal, 0 AS c_nationkey FROM ({_A}) a
UNION ALL SELECT c_custkey, c_mktsegment, 0 AS c_acctbal, c_nationkey FROM ({_B}) b""")
def union_fill(spark, sf_dir):
    """Union with absent columns filled by 0."""
    a, b = _slices(spark, sf_dir)
    return relate.union_fill([a, b], 0)


# ------------------------------------------------------------------ order
@query("sorted_output", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def sorted_output(spark, sf_dir):
    """Orders by descending price."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return order.sorted_output(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("top_k", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 60""")
def top_k(spark, sf_dir):
    """The 60 most expensive orders with their rank."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return order.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 60)


_ARGMAX = "CASE WHEN p_0 >= p_1 AND p_0 >= p_2 THEN 0 WHEN p_1 >= p_2 THEN 1 ELSE 2 END"


@query("argmax_class", with_frames(f"SELECT o_orderkey, {_ARGMAX} AS pred FROM prob3", "prob3"))
def argmax_class(spark, sf_dir):
    """Index of the largest class probability (first on ties)."""
    return prob3(spark, sf_dir).select("o_orderkey", argmax(["p_0", "p_1", "p_2"]).alias("pred"))


# ------------------------------------------------------------------ metrics
@query("smape", f"""
SELECT {r6('avg(abs(l_extendedprice - l_extendedprice * (1 - l_discount)) / nullif(l_extendedprice + l_extendedprice * (1 - l_discount), 0)) * 2')} AS smape
FROM lineitem""")
def smape(spark, sf_dir):
    """SMAPE between list and discounted price."""
    li = read_table(spark, sf_dir, "lineitem").withColumn(
        "net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return metrics.smape(li, "l_extendedprice", "net").select(_r(F.col("smape")).alias("smape"))


@query("macro_f1", with_frames(f"""
SELECT {r6('avg(coalesce(2.0 * tp / (n_true + coalesce(n_pred, 0)), 0.0))')} AS macro_f1, count(*) AS n_classes
FROM t LEFT JOIN q ON t.cls = q.cls""", "prob3", extra=f"""p AS (SELECT true_class, {_ARGMAX} AS pred FROM prob3),
t AS (SELECT true_class AS cls, count(*) AS n_true, count(*) FILTER (WHERE true_class = pred) AS tp FROM p GROUP BY 1),
q AS (SELECT pred AS cls, count(*) AS n_pred FROM p GROUP BY 1)"""))
def macro_f1(spark, sf_dir):
    """Macro F1 over the true classes of the arg-max prediction."""
    p = prob3(spark, sf_dir).withColumn("pred", argmax(["p_0", "p_1", "p_2"]))
    return metrics.macro_f1(p, "true_class", "pred").select(_r(F.col("macro_f1")).alias("macro_f1"), "n_classes")


_E3 = " + ".join(
    f"2 * coalesce(sum(p_{i}) FILTER (WHERE pred = {i}), 0) / (count(*) FILTER (WHERE pred = {i}) + sum(p_{i}))"
    for i in range(3))


@query("expected_macro_f1", with_frames(f"""
SELECT {r6(f'({_E3}) / 3.0')} AS expected_macro_f1 FROM (SELECT *, {_ARGMAX} AS pred FROM prob3) p""", "prob3"))
def expected_macro_f1(spark, sf_dir):
    """Expected macro F1 of the arg-max prediction under the probabilities."""
    p = prob3(spark, sf_dir).withColumn("pred", argmax(["p_0", "p_1", "p_2"]))
    out = metrics.expected_macro_f1(p, ["p_0", "p_1", "p_2"], "pred")
    return out.select(_r(F.col("expected_macro_f1")).alias("expected_macro_f1"))


@query("f1_threshold", with_frames("""
SELECT o_orderkey, CAST(coalesce(p_0 > th.threshold, false) AS INTEGER) AS pred FROM prob3, th""", "prob3", extra="""g AS (SELECT p_0 AS v, CAST(count(*) AS DOUBLE) AS c, sum(p_0) AS s FROM prob3 WHERE p_0 IS NOT NULL GROUP BY p_0),
r AS (SELECT v, coalesce(sum(c) OVER (ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m_before,
             coalesce(sum(s) OVER (ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e_before
      FROM g),
n AS (SELECT sum(p_0) AS n FROM prob3),
th AS (SELECT coalesce(max(CASE WHEN v < e_before / (m_before + n.n) THEN v END), min(v)) AS threshold FROM r, n)"""))
def f1_threshold(spark, sf_dir):
    """Expected-F1 optimal cut on class-0 probabilities."""
    return metrics.f1_threshold(prob3(spark, sf_dir), "p_0").select("o_orderkey", "pred")


def _mft_sql(passes: int = 3) -> str:
    ctes = [f"s0 AS (SELECT o_orderkey, p_0, p_1, p_2, {_ARGMAX} AS pred, greatest(p_0, p_1, p_2) > 0.5 AS flag FROM prob3)"]
    for k in range(passes):
        aggs = ", ".join(
            f"sum(p_{i}) AS m{i}, CAST(count(*) FILTER (WHERE pred = {i}) AS DOUBLE) AS n{i}, "
            f"coalesce(sum(p_{i}) FILTER (WHERE pred = {i}), 0.0) AS r{i}" for i in range(3))
        ctes.append(f"a{k} AS (SELECT {aggs} FROM s{k})")
        g = [f"2 * (p_{i} * (m{i} + n{i}) - r{i}) / ((m{i} + n{i}) + 1) / (m{i} + n{i})" for i in range(3)]
        best = (f"CASE WHEN {g[0]} >= {g[1]} AND {g[0]} >= {g[2]} THEN 0 WHEN {g[1]} >= {g[2]} THEN 1 ELSE 2 END")
        ctes.append(f"s{k + 1} AS (SELECT o_orderkey, p_0, p_1, p_2, CASE WHEN flag THEN pred ELSE {best} END AS pred, flag "
                    f"FROM s{k}, a{k})")
    return ",\n".join(ctes)


@query("multi_f1_threshold", with_frames("SELECT o_orderkey, pred FROM s3", "prob3", extra=_mft_sql(3)))
def multi_f1_threshold(spark, sf_dir):
    """Uncertain rows re-assigned by expected-F1 gain, three passes."""
    out = metrics.multi_f1_threshold(prob3(spark, sf_dir), ["p_0", "p_1", "p_2"])
    return out.select("o_orderkey", "pred")


_FOLD_L = "CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':7'), 1, 8))::UBIGINT % 5 AS INTEGER)"


@query("fold_mae", f"""
SELECT fold, {r6('avg(abs(l_extendedprice - l_quantity * 1000.0))')} AS mae, count(*) AS n
FROM (SELECT *, {_FOLD_L} AS fold FROM lineitem) t GROUP BY fold""")
def fold_mae(spark, sf_dir):
    """Mean absolute error of a naive price guess per validation fold."""
    li = folds.kfold(read_table(spark, sf_dir, "lineitem"), "l_orderkey", 5, seed=7).withColumn(
        "guess", F.col("l_quantity") * 1000.0)
    out = metrics.fold_mae(li, "l_extendedprice", "guess", "fold")
    return out.select("fold", _r(F.col("mae")).alias("mae"), "n")


# ------------------------------------------------------------------ folds
def _h(key: str, seed) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::UBIGINT"


@query("kfold", f"SELECT o_orderkey, CAST({_h('o_orderkey', 66)} % 5 AS INTEGER) AS fold FROM orders")
def kfold(spark, sf_dir):
    """Hash folds of the order key."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.kfold(o, "o_orderkey", 5, 66)


@query("stratified_folds", """
SELECT o_orderkey, o_orderpriority,
  CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':66'), o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def stratified_folds(spark, sf_dir):
    """Class-balanced folds: round-robin in hash order inside each priority."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return folds.stratified_folds(o, "o_orderkey", "o_orderpriority", 5, 66)


@query("group_folds", f"SELECT o_orderkey, o_custkey, CAST({_h('o_custkey', 66)} % 5 AS INTEGER) AS fold FROM orders")
def group_folds(spark, sf_dir):
    """All orders of a customer in one fold."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return folds.group_folds(o, "o_custkey", 5, 66)


@query("random_split", f"SELECT o_orderkey, CAST({_h('o_orderkey', 520)} % 3 AS INTEGER) AS sample FROM orders")
def random_split(spark, sf_dir):
    """Three disjoint hash samples of the orders."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.random_split(o, "o_orderkey", 3, 520)


@query("equal_samples", """
WITH t AS (SELECT o_orderkey, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':520'), 1, 15))::BIGINT AS h FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h) - 1 AS i, count(*) OVER () // 7 AS size FROM t)
SELECT o_orderkey, CAST(i // size AS INTEGER) AS sample FROM r WHERE i < 7 * size""")
def equal_samples(spark, sf_dir):
    """Seven disjoint samples of the orders of one size, without a sort."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.equal_samples(o, "o_orderkey", 7, 520)


@query("augmented_training_rows", f"""
WITH f AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -1 ELSE CAST({_h('o_orderkey', 66)} % 5 AS INTEGER) END AS fold
           FROM orders),
k AS (SELECT range::INTEGER AS fold FROM range(5))
SELECT k.fold, (SELECT count(*) FROM f) - count(f.fold) AS n_train, count(f.fold) AS n_valid
FROM k LEFT JOIN f ON k.fold = f.fold GROUP BY k.fold""")
def augmented_training_rows(spark, sf_dir):
    """Training/validation rows per fold when extra rows (fold -1) are
    appended to every training fold."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    f = folds.kfold(o, "o_orderkey", 5, 66).withColumn(
        "fold", F.when(F.col("o_orderstatus") == "P", F.lit(-1)).otherwise(F.col("fold")))
    return folds.training_rows_per_fold(f, "fold", 5)


@query("white_list", """
WITH s AS (SELECT c_nationkey, c_mktsegment, c_custkey % 7 AS label,
                  row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn
           FROM customer WHERE c_acctbal >= 0 AND c_custkey % 7 <> 6),
t AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)
SELECT t.c_custkey, s.label FROM t JOIN s
  ON t.c_nationkey IS NOT DISTINCT FROM s.c_nationkey AND t.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment
WHERE s.rn = 1 AND s.label IS NOT NULL""")
def white_list(spark, sf_dir):
    """Labels for rows to score (negative balances) copied from the first
    labelled row (non-negative balances, sentinel label 6 removed first) that
    equals them on (nation, segment)."""
    from tessera.plans import chains
    c = read_table(spark, sf_dir, "customer")
    train = c.filter(F.col("c_acctbal") >= 0).select(
        "c_custkey", "c_nationkey", "c_mktsegment", F.pmod("c_custkey", F.lit(7)).alias("label"))
    test = c.filter(F.col("c_acctbal") < 0).select("c_custkey", "c_nationkey", "c_mktsegment")
    return chains.white_list(train, test, ["c_nationkey", "c_mktsegment"], "c_custkey", "label", ["c_custkey"],
                             sentinel=6)
