"""Queries: sources/sinks (S1–S6) and learned stages.

Forests, boosted trees, LDA and ALS cannot be reproduced by SQL; they are
registered without an oracle and checked by properties in the tests.  The same
stages run with learners that SQL can state (``*_counts``, ``*_line``,
``stump_*``) and are compared with it.  ``term_counts`` (the
document-term table behind the topic factors) has one.
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.functions import numeric as N
from tessera.functions import rows as RW
from tessera.ml import folds, models, topics
from tessera.ml.bayes import CategoricalNaiveBayes, CategoricalNaiveBayesModel
from tessera.operators import aggs, relate
from tessera.plans.catalog.sqlutil import r6, spark_r6
from tessera.plans.frames import fees4, rawtext
from tessera.plans.oracle_frames import with_frames
from tessera.plans.registry import query
from tessera.session import checkpoint_dir, read_table
from tessera.sources import csv as C
from tessera.sources.store import load_models, materialize, save_models


def _fresh(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


_ORDERS_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                             StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
                             StructField("o_orderpriority", StringType())])


@query("csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderpriority FROM orders""")
def csv_roundtrip(spark, sf_dir):
    """Orders written as header CSV (4-decimal floats) to a fresh folder in
    the shared checkpoint location and scanned back with an explicit schema."""
    o = read_table(spark, sf_dir, "orders")
    path = _fresh(spark, "csv")
    C.sink_csv(o, path, [f.name for f in _ORDERS_SCHEMA.fields], float_digits=4)
    return C.scan_csv(spark, path, _ORDERS_SCHEMA)


_RAW_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("fee", DoubleType())])


@query("csv_typed_scan", with_frames("""
SELECT o_orderkey, fee AS fee_raw, TRY_CAST(trim(fee) AS DOUBLE) AS fee FROM rawtext""", "rawtext"))
def csv_typed_scan(spark, sf_dir):
    """Raw text amounts written to CSV and scanned back keeping the text
    (``fee_raw``) next to its lenient numeric value."""
    r = rawtext(spark, sf_dir).select("o_orderkey", "fee")
    path = _fresh(spark, "rawcsv")
    C.sink_csv(r, path, float_digits=None)
    return C.scan_csv_typed(spark, path, _RAW_SCHEMA, ["fee"])


@query("materialize", with_frames("SELECT * FROM fees4", "fees4"))
def materialize_q(spark, sf_dir):
    """The per-customer amount table written once and read back."""
    return materialize(fees4(spark, sf_dir), "fees4")


# ------------------------------------------------------------------ learned stages on fees4
FEATS = ["m1", "m2", "m3", "m4", "c_acctbal", "c_nationkey", "row_mean", "row_std", "m1_d0", "m1_d1"]


def _features(spark, sf_dir):
    """fees4 with features, label index of the segment, folds by customer;
    customers with key % 10 == 0 play the rows to score (label withheld)."""
    f = fees4(spark, sf_dir).withColumns({f"m{i}": F.col(f"f{i}") / 100.0 for i in range(1, 5)})
    ms = ["m1", "m2", "m3", "m4"]
    f = f.withColumns({"row_mean": RW.row_mean(ms), "row_std": RW.row_std(ms),
                       "m1_d0": N.money_digit("m1", 0), "m1_d1": N.money_digit("m1", 1)})
    idx = aggs.label_index(f, "c_mktsegment", "label")
    f = f.join(idx, "c_mktsegment", "left")
    f = folds.kfold(f, "c_custkey", 5, 66)
    test = F.pmod("c_custkey", F.lit(10)) == 0
    f = materialize(f, "features")
    return f.filter(~test), f.filter(test).drop("label")


def _rf():
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=66)


def _prob_cols(n=5):
    return [f"class_{i}" for i in range(n)]


def _both(res):
    """Out-of-fold rows of the labelled part and mean scores of the rest."""
    return relate.union_by_name([res.oof.withColumn("part", F.lit("oof")),
                                 res.scored.withColumn("part", F.lit("score"))])


@query("oof_classify")
def oof_classify(spark, sf_dir):
    """5-fold out-of-fold segment probabilities (random forest) for the
    labelled rows plus fold-averaged probabilities for the rest."""
    train, test = _features(spark, sf_dir)
    return _both(models.oof_classify(train, FEATS, "label", "fold", "row_id", 5, test, _rf()))


@query("oof_regress")
def oof_regress(spark, sf_dir):
    """5-fold out-of-fold prediction of the latest amount from the others
    (boosted trees), and the mean of the folds' predictions for the rest."""
    train, test = _features(spark, sf_dir)
    feats = [c for c in FEATS if c not in ("m1", "row_mean", "row_std", "m1_d0", "m1_d1")]
    return _both(models.oof_regress(train.filter(F.col("m1").isNotNull()), feats, "m1", "fold", "row_id", test))


_LINE_FOLD = "CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':66'), 1, 8))::UBIGINT % 5 AS INTEGER)"
_THOUSANDS = "round_even(({}), 0) / 1000.0"


@query("oof_regress_line", with_frames(f"""
SELECT t.row_id, CAST(t.fold AS INTEGER) AS fold, t.m1, {_THOUSANDS.format('l.a + l.b * t.x')} AS pred, 'oof' AS part
FROM t JOIN l ON t.fold = l.f WHERE t.m1 IS NOT NULL AND t.c_custkey % 10 <> 0
UNION ALL
SELECT t.row_id, NULL AS fold, NULL AS m1, {_THOUSANDS.format('avg(l.a + l.b * t.x)')} AS pred, 'score' AS part
FROM t, l WHERE t.c_custkey % 10 = 0 GROUP BY t.row_id""", "fees4", extra=f"""
t AS (SELECT row_id, c_custkey, f1 / 100.0 AS m1, coalesce(f2 / 100.0, -999.0) AS x, {_LINE_FOLD} AS fold FROM fees4),
l AS (SELECT f, regr_intercept(m1, x) AS a, regr_slope(m1, x) AS b
      FROM t, (SELECT unnest([0, 1, 2, 3, 4]) AS f) k
      WHERE t.fold <> k.f AND m1 IS NOT NULL AND c_custkey % 10 <> 0 GROUP BY f)"""))
def oof_regress_line(spark, sf_dir):
    """The out-of-fold regression with a learner of closed form (a line
    through one feature), so that SQL can state it; thousands, 3 decimals."""
    train, test = _features(spark, sf_dir)
    res = _both(models.oof_regress(train.filter(F.col("m1").isNotNull()), ["m2"], "m1", "fold", "row_id", test,
                                   LinearRegression(solver="normal", standardization=False)))
    return res.select("row_id", "fold", "m1", (F.rint("pred") / 1000.0).alias("pred"), "part")


@query("segment_models")
def segment_models(spark, sf_dir):
    """Separate models for nations < 12 and the rest, each with its own
    class map; outputs on the full 5-class layout."""
    train, test = _features(spark, sf_dir)
    return _both(models.segment_models(train, F.col("c_nationkey") < 12, FEATS, "label", "fold", "row_id",
                                       list(range(5)), test, _rf()))


@query("stacking")
def stacking(spark, sf_dir):
    """Second-level model on first-level out-of-fold probabilities."""
    train, test = _features(spark, sf_dir)
    first = models.oof_classify(train, FEATS, "label", "fold", "row_id", 5, test, _rf())
    return _both(models.stacking(train, [first.oof], "row_id", ["c_acctbal"], "label", "fold", 5,
                                 test, [first.scored], _rf()))


@query("fold_importance")
def fold_importance(spark, sf_dir):
    """Per-fold split counts and gain (%) of every feature."""
    train, test = _features(spark, sf_dir)
    return models.oof_classify(train, FEATS, "label", "fold", "row_id", 5, None, _rf()).importance


@query("importance_summary")
def importance_summary(spark, sf_dir):
    """Mean split/gain per feature over folds, top 8 by gain."""
    train, test = _features(spark, sf_dir)
    imp = models.oof_classify(train, FEATS, "label", "fold", "row_id", 5, None, _rf()).importance
    return aggs.importance_summary(imp, top=8)


@query("save_models")
def save_models_q(spark, sf_dir):
    """Fold models saved to the shared folder, loaded back and used to
    score the withheld customers (mean over folds)."""
    train, test = _features(spark, sf_dir)
    feats = [c for c in FEATS]
    tr = models.fill_missing(train, feats)
    asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    fitted = [RandomForestClassifier(numTrees=10, maxDepth=5, seed=66, labelCol="label")
              .fit(asm.transform(tr.filter(F.col("fold") != i)).withColumn("label", F.col("label").cast("double")))
              for i in range(5)]
    loaded = load_models(RandomForestClassificationModel, save_models(fitted, spark=spark))
    te = asm.transform(models.fill_missing(test, feats))
    parts = [m.transform(te).select("row_id", vector_to_array("probability").alias("p")) for m in loaded]
    u = relate.union_by_name(parts)
    return u.groupBy("row_id").agg(*[F.avg(F.col("p")[i]).alias(f"class_{i}") for i in range(5)])


# ------------------------------------------------------------------ stages with learners that SQL can state
_COUNT_FEATS = ["x0", "x1", "x2", "x3"]
_COUNT_T = f"""
t AS (SELECT row_id, c_custkey, c_custkey % 10 = 0 AS test, {_LINE_FOLD} AS fold, c_nationkey < 12 AS low,
             dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS label, CAST(c_nationkey % 5 AS DOUBLE) AS x0,
             CAST(least(chunk, 3) AS DOUBLE) AS x1, CAST(coalesce(f1 % 10, -999) AS DOUBLE) AS x2,
             CAST(coalesce(f2 % 7, -999) AS DOUBLE) AS x3 FROM fees4),
k AS (SELECT unnest([0, 1, 2, 3, 4]) AS m)"""


def _count_frames(spark, sf_dir):
    """Four categorical features of the amounts; see ``_COUNT_T``."""
    f = fees4(spark, sf_dir)
    f = f.join(aggs.label_index(f, "c_mktsegment", "label"), "c_mktsegment", "left")
    f = folds.kfold(f, "c_custkey", 5, 66).select(
        "row_id", "c_custkey", "c_nationkey", "fold", "label", (F.col("c_nationkey") % 5).alias("x0"),
        F.least("chunk", F.lit(3)).alias("x1"), (F.col("f1") % 10).alias("x2"), (F.col("f2") % 7).alias("x3"))
    f = materialize(f, "count-features")
    test = F.pmod("c_custkey", F.lit(10)) == 0
    return f.filter(~test), f.filter(test).drop("label")


def _bayes_sql(name, train, rows, feats, where="true", width=None):
    """CTEs ``<name>`` (m, row_id, part, p0 .. p4): naive Bayes of fold m on
    ``train``'s other folds, for the fold's own rows and the rows to score."""
    value = f"floor(v / {width})" if width else "v"
    xs, n = ", ".join(feats), len(feats)
    cells = f"unnest(range({n})) AS j, unnest([{xs}]) AS v"
    probs = ", ".join(f"coalesce(max(p) FILTER (WHERE label = {c}), 0.0) AS p{c}" for c in range(5))
    return f"""
{name}_l AS (SELECT m, j, {value} AS v, label FROM (
  SELECT k.m, label, {cells} FROM {train} t JOIN k ON t.fold <> k.m WHERE NOT test AND {where})),
{name}_n AS (SELECT m, j, v, label, count(*) AS n FROM {name}_l GROUP BY ALL),
{name}_c AS (SELECT m, label, sum(n) AS nc, sum(sum(n)) OVER (PARTITION BY m) AS nt,
                    count(*) OVER (PARTITION BY m) AS c FROM {name}_n WHERE j = 0 GROUP BY m, label),
{name}_v AS (SELECT m, j, count(DISTINCT v) AS nv FROM {name}_n GROUP BY m, j),
{name}_r AS (SELECT m, row_id, part, j, {value} AS v FROM (
  SELECT k.m, row_id, CASE WHEN test THEN 'score' ELSE 'oof' END AS part, {cells}
  FROM {rows} t JOIN k ON test OR t.fold = k.m WHERE {where})),
{name}_s AS (SELECT r.m, r.row_id, r.part, c.label, ln((any_value(c.nc) + 1.0) / (any_value(c.nt) + any_value(c.c)))
                    + sum(ln((coalesce(n.n, 0) + 1.0) / (c.nc + v.nv + 1.0))) AS s
  FROM {name}_r r JOIN {name}_c c ON c.m = r.m JOIN {name}_v v ON v.m = r.m AND v.j = r.j
  LEFT JOIN {name}_n n ON n.m = r.m AND n.j = r.j AND n.v = r.v AND n.label = c.label
  GROUP BY r.m, r.row_id, r.part, c.label),
{name}_e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY m, row_id)) AS e FROM {name}_s),
{name}_p AS (SELECT *, e / sum(e) OVER (PARTITION BY m, row_id) AS p FROM {name}_e),
{name} AS (SELECT m, row_id, part, {probs} FROM {name}_p GROUP BY m, row_id, part)"""


def _both_sql(*names):
    cols = lambda f: ", ".join(f"{r6(f.format(c))} AS class_{c}" for c in range(5))
    return "\nUNION ALL\n".join(
        f"SELECT row_id, m AS fold, {cols('p{}')}, part FROM {n} WHERE part = 'oof'\nUNION ALL\n"
        f"SELECT row_id, NULL AS fold, {cols('avg(p{})')}, part FROM {n} WHERE part = 'score' GROUP BY row_id, part"
        for n in names)


def _both_rounded(res):
    return _both(res).withColumns({c: spark_r6(c) for c in _prob_cols()})


@query("oof_classify_counts", with_frames(_both_sql("a"), "fees4", extra=_COUNT_T + "," + _bayes_sql("a", "t", "t", _COUNT_FEATS)))
def oof_classify_counts(spark, sf_dir):
    """5-fold out-of-fold segment probabilities of the count learner, and the
    folds' mean for the withheld customers."""
    train, test = _count_frames(spark, sf_dir)
    return _both_rounded(models.oof_classify(train, _COUNT_FEATS, "label", "fold", "row_id", 5, test,
                                             CategoricalNaiveBayes()))


_LOW = "low AND (test OR label NOT IN (1, 4))"


@query("segment_models_counts", with_frames(
    _both_sql("b", "c"), "fees4",
    extra=_COUNT_T + "," + _bayes_sql("b", "t", "t", _COUNT_FEATS, _LOW) + "," + _bayes_sql("c", "t", "t", _COUNT_FEATS, "NOT low")))
def segment_models_counts(spark, sf_dir):
    """Separate count learners for nations < 12, where two of the classes are
    left out, and the rest; outputs on the full 5-class layout."""
    train, test = _count_frames(spark, sf_dir)
    low = F.col("c_nationkey") < 12
    return _both_rounded(models.segment_models(train.filter(~(low & F.col("label").isin(1, 4))), low, _COUNT_FEATS, "label",
                                               "fold", "row_id", list(range(5)), test, CategoricalNaiveBayes()))


_STACK_FEATS = ["x0", "p0", "p1", "p2", "p3", "p4"]


@query("stacking_counts", with_frames(_both_sql("z"), "fees4", extra=_COUNT_T + "," + _bayes_sql("a", "t", "t", _COUNT_FEATS) + """,
a2 AS (SELECT row_id, avg(p0) AS p0, avg(p1) AS p1, avg(p2) AS p2, avg(p3) AS p3, avg(p4) AS p4 FROM a GROUP BY row_id),
t2 AS (SELECT t.*, p0, p1, p2, p3, p4 FROM t JOIN a2 ON t.row_id = a2.row_id),"""
                                      + _bayes_sql("z", "t2", "t2", _STACK_FEATS, width=0.03)))
def stacking_counts(spark, sf_dir):
    """Second-level count learner on a feature and the first level's
    out-of-fold probabilities, in bins."""
    train, test = _count_frames(spark, sf_dir)
    first = models.oof_classify(train, _COUNT_FEATS, "label", "fold", "row_id", 5, test, CategoricalNaiveBayes())
    return _both_rounded(models.stacking(train, [first.oof], "row_id", ["x0"], "label", "fold", 5, test, [first.scored],
                                         CategoricalNaiveBayes(binWidth=0.03)))


@query("save_models_counts", with_frames(f"""
SELECT row_id, {', '.join(f'{r6(f"avg(p{c})")} AS class_{c}' for c in range(5))} FROM a WHERE part = 'score'
GROUP BY row_id""", "fees4", extra=_COUNT_T + "," + _bayes_sql("a", "t", "t", _COUNT_FEATS)))
def save_models_counts(spark, sf_dir):
    """Count learners of the folds saved to the shared folder, loaded back and
    used to score the withheld customers."""
    train, test = _count_frames(spark, sf_dir)
    asm = models.assemble(_COUNT_FEATS)
    d = asm.transform(models.fill_missing(train, _COUNT_FEATS))
    paths = save_models([CategoricalNaiveBayes().fit(d.filter(F.col("fold") != i)) for i in range(5)], spark=spark)
    te = asm.transform(models.fill_missing(test, _COUNT_FEATS))
    u = relate.union_by_name([m.transform(te).select("row_id", "probability")
                              for m in load_models(CategoricalNaiveBayesModel, paths)])
    return u.groupBy("row_id").agg(*[spark_r6(F.avg(F.col("probability")[i])).alias(f"class_{i}") for i in range(5)])


@query("oof_fold_scores", with_frames(f"""
SELECT m AS fold, count(*) AS n, {r6("avg(-ln(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END))")} AS log_loss
FROM a JOIN t ON a.row_id = t.row_id WHERE part = 'oof' GROUP BY m""", "fees4",
                                      extra=_COUNT_T + "," + _bayes_sql("a", "t", "t", _COUNT_FEATS)))
def oof_fold_scores(spark, sf_dir):
    """A metric callback on each fold's validation rows: their logarithmic loss."""
    train, _ = _count_frames(spark, sf_dir)

    def log_loss(val):
        p = F.array(*_prob_cols())[F.col("label").cast("int")]
        return val.agg(F.count(F.lit(1)).alias("n"), spark_r6(F.avg(-F.log(p))).alias("log_loss"))
    return models.oof_classify(train, _COUNT_FEATS, "label", "fold", "row_id", 5, None, CategoricalNaiveBayes(),
                               metric=log_loss).fold_scores


# a split of a 0/1 feature takes sum over both sides of n_side * gini_side from n * gini
_STUMP_SQL = """
b AS (SELECT k.m, label, unnest([0, 1]) AS feature, unnest([low::INT, (chunk > 0)::INT]) AS x
      FROM (SELECT t.*, f.chunk FROM t JOIN fees4 f ON t.row_id = f.row_id) t JOIN k ON t.fold <> k.m WHERE NOT test),
h AS (SELECT m, feature, x, label, count(*) AS n FROM b GROUP BY ALL),
s AS (SELECT m, feature, x, sum(n) AS n, sum(n) - sum(n * n) / sum(n) AS g FROM h GROUP BY ALL),
r AS (SELECT m, sum(n) AS n, sum(n) - sum(n * n) / sum(n) AS g
      FROM (SELECT m, label, count(*) AS n FROM b WHERE feature = 0 GROUP BY ALL) GROUP BY m),
gains AS (SELECT s.m, s.feature, any_value(r.n) AS n, any_value(r.g) / any_value(r.n) AS impurity,
                 (any_value(r.g) - sum(s.g)) / any_value(r.n) AS gain
          FROM s JOIN r ON s.m = r.m GROUP BY s.m, s.feature),
-- the tree learner takes a split back whose two leaves predict one class
leaf AS (SELECT m, feature, count(DISTINCT label) AS kinds
         FROM (SELECT *, row_number() OVER (PARTITION BY m, feature, x ORDER BY n DESC, label) AS i FROM h)
         WHERE i = 1 GROUP BY m, feature),
best AS (SELECT g.m, g.n, g.impurity, CASE WHEN kinds > 1 THEN g.feature END AS feature, CASE WHEN kinds > 1 THEN gain END AS gain,
                row_number() OVER (PARTITION BY g.m ORDER BY g.gain DESC, g.feature) AS i
         FROM gains g JOIN leaf ON leaf.m = g.m AND leaf.feature = g.feature)"""


def _stump_models(spark, sf_dir):
    f = fees4(spark, sf_dir)
    f = f.join(aggs.label_index(f, "c_mktsegment", "label"), "c_mktsegment", "left")
    f = folds.kfold(f, "c_custkey", 5, 66).filter(F.pmod("c_custkey", F.lit(10)) != 0)
    f = f.select("row_id", "fold", "label", (F.col("c_nationkey") < 12).cast("int").alias("low"),
                 (F.col("chunk") > 0).cast("int").alias("later"))
    est = RandomForestClassifier(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=66)
    return models.oof_classify(f, ["low", "later"], "label", "fold", "row_id", 5, None, est)


@query("stump_nodes", with_frames(f"""
SELECT m AS fold, feature, CAST(n AS BIGINT) AS rows, {r6('impurity')} AS impurity, {r6('gain')} AS gain FROM best WHERE i = 1""",
                                  "fees4", extra=_COUNT_T + "," + _STUMP_SQL))
def stump_nodes(spark, sf_dir):
    """Root nodes of one-split trees, one a fold, from the saved models' node
    tables."""
    nodes = models.tree_nodes(_stump_models(spark, sf_dir).models)
    return nodes.filter("node = 0").select("fold", "feature", "rows", spark_r6("impurity").alias("impurity"),
                                           spark_r6("gain").alias("gain"))


@query("stump_importance", with_frames("""
SELECT n.name AS feature, avg(CASE WHEN b.feature = n.f THEN 1.0::DOUBLE ELSE 0.0 END) AS split, avg(CASE WHEN b.feature = n.f THEN 100.0::DOUBLE ELSE 0.0 END) AS gain
FROM best b, (SELECT unnest(['low', 'later']) AS name, unnest([0, 1]) AS f) n WHERE i = 1 GROUP BY n.name""",
                                       "fees4", extra=_COUNT_T + "," + _STUMP_SQL))
def stump_importance(spark, sf_dir):
    """Mean split count and gain (%) over the folds' one-split trees."""
    return aggs.importance_summary(_stump_models(spark, sf_dir).importance).select("feature", "split", "gain")


# ------------------------------------------------------------------ topic factors: supplier → brand terms
def _supplier_brands(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select("l_suppkey", "p_brand")


@query("term_counts", """
WITH t AS (SELECT l.l_suppkey, unnest(string_split_regex(lower(p.p_brand), '\\W+')) AS term
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
c AS (SELECT l_suppkey, term, count(*) AS n FROM t WHERE length(term) > 0 GROUP BY l_suppkey, term),
v AS (SELECT term FROM c GROUP BY term HAVING count(*) >= 2)
SELECT c.l_suppkey, c.term, c.n FROM c JOIN v ON c.term = v.term""")
def term_counts(spark, sf_dir):
    """Document-term counts (supplier documents of brand tokens) restricted
    to terms in at least 2 documents."""
    c = topics.term_counts(_supplier_brands(spark, sf_dir), "l_suppkey", "p_brand")
    v = topics.vocabulary(c, "l_suppkey", 2)
    return c.join(v.select("term"), "term").select("l_suppkey", "term", "n")


@query("topic_factors")
def topic_factors(spark, sf_dir):
    """5 LDA topics, 5 SVD components and 5 NMF factors per supplier."""
    d = _supplier_brands(spark, sf_dir)
    return topics.topic_factors(d, d, "l_suppkey", "p_brand", k=5)


# two terms: the eigenvalues of a 2 x 2 matrix
@query("svd_two_terms", f"""
WITH c AS (SELECT l_suppkey, count(*) FILTER (WHERE l_linestatus = 'F') AS f, count(*) FILTER (WHERE l_linestatus = 'O') AS o
           FROM lineitem GROUP BY l_suppkey),
g AS (SELECT sum(f * f)::DOUBLE AS a, sum(f * o)::DOUBLE AS b, sum(o * o)::DOUBLE AS d FROM c),
e AS (SELECT a, b, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS l1, (a + d) / 2 - sqrt((a - d) * (a - d) / 4 + b * b) AS l2 FROM g),
v AS (SELECT sqrt(l1) AS s1, sqrt(l2) AS s2, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS x1, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS y1,
             b / sqrt(b * b + (l2 - a) * (l2 - a)) AS x2, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS y2 FROM e),
w AS (SELECT *, CASE WHEN abs(x2) >= abs(y2) THEN sign(x2) ELSE sign(y2) END AS sg FROM v)
SELECT l_suppkey, {_THOUSANDS.format('1000 * s1')} AS sigma_0, {_THOUSANDS.format('1000 * s2')} AS sigma_1,
       {_THOUSANDS.format('1000 * (f * x1 + o * y1)')} AS svd_0, {_THOUSANDS.format('1000 * sg * (f * x2 + o * y2)')} AS svd_1
FROM c, w""")
def svd_two_terms(spark, sf_dir):
    """SVD of the suppliers' line statuses: singular values and components, 3 decimals."""
    c = topics.term_counts(read_table(spark, sf_dir, "lineitem"), "l_suppkey", "l_linestatus")
    sigma, right = topics.svd_tables(c, "l_suppkey", 2)
    wide = c.join(right, "term").groupBy("l_suppkey").agg(*[F.sum(F.col("n") * F.col("x")[i]).alias(f"svd_{i}") for i in range(2)])
    thousands = lambda x: F.rint(x * 1000) / 1000.0
    return wide.select("l_suppkey", *[thousands(F.lit(x)).alias(f"sigma_{i}") for i, x in enumerate(sigma)],
                       *[thousands(F.col(f"svd_{i}")).alias(f"svd_{i}") for i in range(2)])


@query("stacked_prediction")
def stacked_prediction(spark, sf_dir):
    """The best-single-model flow on the per-customer amounts:
    value-association lookup mined from all rows, feature block, 5-fold
    random forest on the labelled customers (those with key % 10 == 1 play
    the old rows, in training folds only), a second one on the features and
    the first one's out-of-fold probabilities, arg-max segment for the
    withheld ones, overridden where an exact-match label exists."""
    from tessera.plans import chains
    f = fees4(spark, sf_dir).withColumns({f"m{i}": F.col(f"f{i}") / 100.0 for i in range(1, 5)})
    f = folds.kfold(f, "c_custkey", 5, 66)
    is_test = F.pmod("c_custkey", F.lit(10)) == 0
    train, test = f.filter(~is_test), f.filter(is_test).drop("c_mktsegment")
    fee = ["m1", "m2", "m3", "m4"]
    lookup, _ = chains.magic_lookups(train, test, None, ["c_nationkey", "f1", "f2", "f3", "f4"],
                                     ["f1", "f2", "f3", "f4"], ["row_id"], min_count=1)
    # keys stay integer cents; the looked-up value is an amount
    lookup = lookup.select("first", (F.col("second") / 100.0).alias("second"))
    feats_all = chains.build_features(f, fee, lookup, size_cols=["c_nationkey"], group_key="c_nationkey",
                                      group_values=["m1"])
    feats_all = materialize(feats_all, "stack-features")
    predictors = [c for c, t in feats_all.dtypes
                  if c not in ("c_custkey", "row_id", "chunk", "c_mktsegment", "fold", "f1", "f2", "f3", "f4")
                  and t in ("double", "int", "bigint", "float")]
    is_old = F.pmod("c_custkey", F.lit(10)) == 1
    tr = feats_all.filter(~is_test & ~is_old)
    te = feats_all.filter(is_test).drop("c_mktsegment")
    classes = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    white = chains.white_list(tr, te, ["c_nationkey", "f4"], "row_id", "c_mktsegment", ["row_id"])
    return chains.stacked_prediction(tr, te, predictors, "c_mktsegment", "row_id", classes, white, _rf(),
                                     old=feats_all.filter(is_old))


_STAGE_SCHEMA = StructType([StructField("c_custkey", LongType()), StructField("n", LongType()),
                            StructField("total", DoubleType())])


@query("load_stack_table", """
WITH s AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_mktsegment, s.n AS m1_n,
       round_even(round(s.total, 4) * 1000000.0, 0) / 1000000.0 AS m1_total
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey""")
def load_stack_table(spark, sf_dir):
    """An earlier stage's per-customer output written as CSV (4-decimal
    floats), read back with a model prefix and stacked onto the customers."""
    stage = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))
    path = _fresh(spark, "stage")
    C.sink_csv(stage, path, float_digits=4)
    st = C.load_stack_table(spark, path, "c_custkey", "m1_", _STAGE_SCHEMA)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = relate.stack_join(c, st.withColumnsRenamed({"m1_n": "n", "m1_total": "total"}), "c_custkey", "m1_")
    return out.withColumn("m1_total", F.rint(F.col("m1_total") * 1000000.0) / 1000000.0)
