"""Properties and brute-force comparisons for operators whose results SQL
cannot state directly (learned stages, iterative thresholds) and for the
skew-safe ordering machinery."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.ml import folds, models, topics
from tessera.operators import aggs, bins, keys, metrics, mine, relate, windows


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    n = 3000
    data = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}", rnd.randint(0, 50), i) for i in range(n)]
    return spark.createDataFrame(data, "k string, v int, id int")


def test_global_position_is_a_permutation(skewed):
    p = keys.global_position(skewed, [F.col("v"), F.col("id")], "pos")
    got = sorted(r["pos"] for r in p.collect())
    assert got == list(range(3000))
    ordered = [r["id"] for r in p.orderBy("pos").collect()]
    expect = [r["id"] for r in skewed.orderBy("v", "id").collect()]
    assert ordered == expect


def test_ordinal_within_hot_key_matches_row_number(skewed):
    o = keys.ordinal_within(skewed, ["k"], [F.col("v"), F.col("id")], "o")
    w = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")) - 1)
    a = {r["id"]: r["o"] for r in o.collect()}
    b = {r["id"]: r["rn"] for r in w.collect()}
    assert a == b


def test_ordinal_within_weights_and_directions(skewed):
    r = keys.ordinal_within(skewed.withColumn("all", F.lit(1)), ["all"], [F.col("id")], "cum", weight="v")
    got = {x["id"]: x["cum"] for x in r.collect()}
    vals = {x["id"]: x["v"] for x in skewed.collect()}
    acc = 0
    for i in range(3000):
        assert got[i] == acc
        acc += vals[i]
    holes = skewed.withColumn("v", F.when(F.col("id") % 7 != 0, F.col("v"))).withColumn("t", F.col("v").cast("string"))
    for order in ([F.col("v").desc(), F.col("id")], [F.col("v").asc_nulls_last(), F.col("id").desc()],
                  [F.col("v").desc_nulls_first(), F.col("id")], [F.col("t"), F.col("id")], [F.col("t").desc(), F.col("id")]):
        want = holes.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)) - 1)
        a = {r["id"]: r["o"] for r in keys.ordinal_within(holes, ["k"], order, "o").collect()}
        assert a == {r["id"]: r["rn"] for r in want.collect()}


def test_parts_of_a_hot_key_grow_with_its_rows(spark):
    """A key with a third of the rows fills as many parts as the rows need, and
    few rows carry its earlier parts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (8, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
            index = keys.rank_index(df, ["k"], ["id"])
            hot = index.rows.filter("k = -1").groupBy(index.part).count().collect()
            assert len(hot) >= parts // 3 and max(r["count"] for r in hot) < 2 * 30_000 / parts
            assert index.carried.count() < parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_of_odd_values_equal_row_number(spark):
    """NaN, infinities, the smallest integers, null keys, expressions as order."""
    nan, inf = float("nan"), float("inf")
    rows = [(None if i % 11 == 0 else i % 3, [nan, -inf, inf, -0.0, 0.0, None, 1.5][i % 7] if i % 2 else float(i),
             [-2 ** 31, 2 ** 31 - 1, 0, None][i % 4], [-128, 127, 0][i % 3], i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, d double, n int, t int, id int").withColumn("t", F.col("t").cast("tinyint"))
    for order in ([F.col("d").desc(), "id"], [F.col("d"), F.col("id").desc()], [F.col("n").desc(), "id"],
                  [F.col("t").desc_nulls_first(), F.col("id")], [(F.col("id") * -2).desc()], [F.col("id").cast("string").desc()]):
        w = Window.partitionBy("k").orderBy(*order)
        want = {r["id"]: (r["a"], r["b"], r["c"]) for r in df.withColumns(
            {"a": F.row_number().over(w) - 1, "b": F.lag("n", 3).over(w), "c": F.lead("d", 2).over(w).cast("string")}).collect()}
        got = keys.ordinal_within(df, ["k"], order, "a")
        got = keys.lag_within(got, ["k"], order, "n", 3, "b")
        got = keys.lag_within(got, ["k"], order, "d", -2, "c")
        assert {r["id"]: (r["a"], r["b"], r["c"] if r["c"] is None else str(r["c"]).replace("inf", "Infinity").replace("nan", "NaN"))
                for r in got.collect()} == want


@pytest.mark.parametrize("n", [1, 4, 700, -1, -5, 0])
def test_lag_across_parts_of_a_hot_key(skewed, n):
    w = Window.partitionBy("k").orderBy("v", "id")
    want = {r["id"]: r["x"] for r in skewed.withColumn("x", F.lag("id", n).over(w) if n >= 0 else F.lead("id", -n).over(w)).collect()}
    got = keys.lag_within(skewed, ["k"], ["v", "id"], "id", n, "x")
    assert got.columns == skewed.columns + ["x"]
    assert {r["id"]: r["x"] for r in got.collect()} == want


def _leaves(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_input_is_read_once_whatever_the_number_of_columns(spark, skewed, tmp_path):
    """The source is scanned while the index is written; the plan that is left
    reads written tables, and grows by a constant for each ranked column."""
    skewed.withColumns({"x": F.col("v") * 2, "y": -F.col("v")}).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    leaves = []
    for names in (["v"], ["v", "x"], ["v", "x", "y"]):
        out = windows.grp_rank(df, "k", names, ["id"])
        assert out.columns == df.columns + [f"{c}_rank" for c in names]
        leaves.append(_leaves(out))
        for c in names:
            rn = Window.partitionBy("k").orderBy(F.col(c).asc_nulls_last(), "id")
            want = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(rn) - 1).collect()}
            assert {r["id"]: r[f"{c}_rank"] for r in out.collect()} == want
    assert leaves[2] - leaves[1] <= 3 and leaves[0] <= 3


def test_quantiles_of_many_values_by_two_scans(spark):
    """More values than the sketch keeps, half of them equal."""
    df = spark.range(90_000).select(F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.pmod(F.hash("id"), F.lit(10 ** 6)) / 7.0).alias("x"))
    x = np.array([r.x for r in df.collect()])
    for k in (4, 10):
        got = bins.quantile_edges(df, "x", k, accuracy=2000).first()["edges"]
        want = np.quantile(x, [j / k for j in range(k)] + [1.0])
        assert np.allclose(got, want, rtol=1e-12, atol=0)
    assert bins.quantile_edges(df.limit(0), "x", 3).first()["edges"] == [None] * 4


def test_no_job_while_a_plan_is_built(spark, skewed):
    """Operators without ordered work; a rank index is written when they are called."""
    seen = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = seen()
    aggs.group_stats(skewed, ["k"], "v", ["mean", "max"])
    aggs.count_encoding(skewed, "k", "n")
    aggs.pair_association(skewed, ["k"], ["v"])
    windows.grp_standard(skewed, "k", ["v", "id"])
    mine.mine_pair_lookup(skewed, ["v", "id"], min_count=1)
    bins.equal_width_bins(skewed, "v", 5)
    assert seen() == before


@pytest.mark.parametrize("name", ["group_size", "distinct_pairs", "group_stats", "group_deviation", "groupby_join",
                                  "rate_by_other_key", "class_rates", "oof_class_rates", "count_encoding",
                                  "pair_association", "grp_standard", "grp_normalize", "nth_from_last"])
def test_join_back_splits_a_hot_key(spark, name):
    from tessera.operators import rates, windows
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    n = 120_000
    d = spark.range(n).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("k"),
                              (F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 3).cast("int").alias("y"),
                              (F.col("id") % 5).cast("int").alias("fold"), F.col("id").alias("j"), F.col("id"),
                              F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("k2"))
    run = {"group_size": lambda: aggs.group_size(d, ["k"]),
           "distinct_pairs": lambda: aggs.distinct_pairs(d, ["k", "v"], ["k"]),
           "group_stats": lambda: aggs.group_stats(d, ["k"], "v", ["mean", "max"]),
           "group_deviation": lambda: aggs.group_deviation(d, "k", ["v"]),
           "groupby_join": lambda: aggs.groupby_join(d, d, ["k"], "v", "median"),
           "rate_by_other_key": lambda: aggs.rate_by_other_key(d, "k", "k2", "y"),
           "class_rates": lambda: rates.class_rates(d, "k", "y", [0, 1, 2]),
           "oof_class_rates": lambda: rates.oof_class_rates(d.withColumn("fold", F.lit(1)), "k", "y", "fold", [0, 1, 2]),
           "count_encoding": lambda: aggs.count_encoding(d, "k", "c"),
           "pair_association": lambda: aggs.pair_association(d, ["k"], ["j"]),
           "grp_standard": lambda: windows.grp_standard(d, "k", ["v"]),
           "grp_normalize": lambda: windows.grp_normalize(d, "k", ["v"]),
           "nth_from_last": lambda: windows.nth_from_last(d, d, ["k"], ["id"], "v", 2)}[name]
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = run()
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        from tessera.session import apply_scale_conf
        apply_scale_conf(spark)


def test_group_median_exact(skewed):
    out = {r["k"]: r["median"] for r in aggs.group_median(skewed, ["k"], "v").collect()}
    pdf = skewed.toPandas()
    expect = pdf.groupby("k")["v"].median().to_dict()
    assert out == pytest.approx(expect)


def test_folds_partition_and_stratify(skewed):
    f = folds.kfold(skewed, "id", 5, 66).collect()
    assert all(0 <= r["fold"] < 5 for r in f) and len(f) == 3000
    s = folds.stratified_folds(skewed, "id", "k", 5, 66)
    sizes = s.groupBy("k", "fold").count().toPandas().pivot(index="k", columns="fold", values="count").fillna(0)
    assert ((sizes.max(axis=1) - sizes.min(axis=1)) <= 1).all()
    g = folds.group_folds(skewed, "k", 5).groupBy("k").agg(F.countDistinct("fold").alias("n")).collect()
    assert all(r["n"] == 1 for r in g)


def _ref_threshold(preds):
    """Plain loop of the expected-F1 walk (reference semantics)."""
    s = sorted(preds, reverse=True)
    n, m, e, f1 = sum(preds), 0, 0.0, 0.0
    threshold = None
    for threshold in s:
        e += threshold
        m += 1
        t = e / (m + n)
        if f1 > t:
            break
        f1 = t
    return [1 if p > threshold else 0 for p in preds]


def test_f1_threshold_matches_loop(spark):
    rnd = random.Random(5)
    preds = [round(rnd.betavariate(0.5, 2), 3) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(preds)), "id int, p double")
    got = {r["id"]: r["pred"] for r in metrics.f1_threshold(df, "p").collect()}
    assert [got[i] for i in range(800)] == _ref_threshold(preds)


def _ref_multi(p, passes=3):
    pred = p.argmax(axis=1)
    flag = p.max(axis=1) > 0.5
    for _ in range(passes):
        stats = []
        for j in range(p.shape[1]):
            stats.append((p[:, j].sum(), (pred == j).sum(), p[pred == j, j].sum()))
        new = pred.copy()
        for i in range(len(p)):
            if not flag[i]:
                g = [2 * (p[i, j] * (m + n) - r) / ((m + n) + 1) / (m + n) for j, (m, n, r) in enumerate(stats)]
                new[i] = int(np.argmax(g))
        pred = new
    return pred


def test_multi_f1_threshold_matches_numpy(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([1, 1, 1], size=500)
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(p)], "id int, a double, b double, c double")
    got = {r["id"]: r["pred"] for r in metrics.multi_f1_threshold(df, ["a", "b", "c"]).collect()}
    assert [got[i] for i in range(500)] == list(_ref_multi(p))


def test_quantile_edges_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=997).round(2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    e = bins.quantile_edges(df, "x", 10).first()["edges"]
    assert e == pytest.approx(list(np.percentile(x, np.linspace(0, 100, 11))), abs=1e-12)
    b = {r["x"]: r["x_qbin"] for r in bins.qcut_bins(df, "x", 10).collect()}
    edges = np.array(e)
    for v in x[:100]:
        expect = max(1, int(np.searchsorted(edges, v, side="left")))
        assert b[float(v)] == expect


def test_equal_width_bins_like_cut(spark):
    x = [0.0, 1.0, 2.5, 10.0, 7.3, None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = {r["x"]: r["x_bin"] for r in bins.equal_width_bins(df, "x", 4).collect()}
    assert got == {0.0: 1, 1.0: 1, 2.5: 1, 10.0: 4, 7.3: 3, None: None}


def _ref_mine(rows, min_count):
    cols = range(4)
    d = {tuple(r) for r in rows}
    d = [r for r in d if len({v for v in r if v is not None}) > 2]
    cnt = {}
    for r in d:
        for a, b in itertools.permutations(cols, 2):
            if r[a] is not None and r[b] is not None:
                cnt[(r[a], r[b])] = cnt.get((r[a], r[b]), 0) + 1
    cnt = {k: v for k, v in cnt.items() if k[1] != 0}
    tot = {}
    for (f, s), v in cnt.items():
        tot[s] = tot.get(s, 0) + v
    best = {}
    for (f, s), v in cnt.items():
        if v <= min_count:
            continue
        key = (v, v / tot[s], -s)
        if f not in best or key > best[f][0]:
            best[f] = (key, s)
    return {f: s for f, (k, s) in best.items()}


def test_mine_pair_lookup_brute_force(spark):
    rnd = random.Random(9)
    rows = [tuple(rnd.choice([None, 0, 1, 2, 3, 4, 5]) for _ in range(4)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "v1 int, v2 int, v3 int, v4 int")
    got = {r["first"]: r["second"] for r in mine.mine_pair_lookup(df, ["v1", "v2", "v3", "v4"], 3).collect()}
    assert got == _ref_mine(rows, 3)


@pytest.fixture(scope="module")
def train_frame(spark):
    rnd = random.Random(4)
    data = []
    for i in range(400):
        y = i % 3
        data.append((i, y, y + rnd.random(), rnd.random() if i % 7 else None, i % 5 if i % 11 else -1))
    return spark.createDataFrame(data, "id int, label int, x1 double, x2 double, fold int")


def test_oof_classify_properties(train_frame):
    test = train_frame.filter(F.col("id") < 30).drop("label")
    res = models.oof_classify(train_frame, ["x1", "x2"], "label", "fold", "id", 3, test)
    oof = res.oof.collect()
    ids = [r["id"] for r in oof]
    assert len(ids) == len(set(ids))                                      # each labelled row once
    expect = {r["id"] for r in train_frame.filter(F.col("fold") >= 0).collect()}
    assert set(ids) == expect                                             # fold -1 rows never validated
    src = {r["id"]: r["fold"] for r in train_frame.collect()}
    assert all(src[r["id"]] == r["fold"] for r in oof)                    # predicted by its own fold's model
    assert all(abs(r["class_0"] + r["class_1"] + r["class_2"] - 1) < 1e-9 for r in oof)
    sc = res.scored.collect()
    assert len(sc) == 30 and all(abs(r["class_0"] + r["class_1"] + r["class_2"] - 1) < 1e-9 for r in sc)
    assert res.importance.count() == 5 * 2
    summ = aggs.importance_summary(res.importance, top=1).collect()
    assert summ[0]["feature"] == "x1"


def test_segment_models_fill_absent_classes(train_frame):
    res = models.segment_models(train_frame.filter(F.col("fold") >= 0), F.col("label") < 2, ["x1", "x2"], "label",
                                "fold", "id", [0, 1, 2])
    rows = res.oof.collect()
    assert all(r["class_2"] == 0.0 for r in rows if r["id"] % 3 < 2)
    assert all(r["class_0"] == 0.0 and r["class_1"] == 0.0 for r in rows if r["id"] % 3 == 2)


def test_override_touches_listed_only(spark):
    pred = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, c int")
    white = spark.createDataFrame([(2, 9), (5, 9), (42, 9)], "id int, c int")
    out = {r["id"]: r["c"] for r in relate.override_join(pred, white, "id", "c").collect()}
    assert out == {i: (9 if i in (2, 5) else i % 3) for i in range(10)}


def test_union_dedup_idempotent(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, s string")
    b = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, s string")
    once = relate.union_dedup_prefer_first([a, b], ["k"], ["s"])
    twice = relate.union_dedup_prefer_first([once, once], ["k"], ["s"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert {r["k"]: r["s"] for r in once.collect()} == {1: "a", 2: "b", 3: "C", None: "n"}


def test_exact_match_is_null_safe(spark):
    t = spark.createDataFrame([(1, "x", None), (2, "y", 1)], "id int, a string, b int")
    s = spark.createDataFrame([(10, "x", None, 7), (11, "x", None, 8), (12, "y", 2, 9)], "sid int, a string, b int, lab int")
    out = relate.exact_match_transfer(t, s, ["a", "b"], "id", "lab", ["sid"]).collect()
    assert [tuple(r) for r in out] == [(1, 7)]


def test_topic_factors_rows(spark):
    rnd = random.Random(2)
    data = [(k, rnd.choice(["Brand#1", "Brand#2", "Brand#33", "x y"])) for k in range(30) for _ in range(5)]
    df = spark.createDataFrame(data, "k int, f string")
    out = topics.topic_factors(df, df, "k", "f", k=3, max_iter=5).collect()
    assert len(out) == 30
    assert all(abs(sum(r[f"lda_f_{i}"] for i in range(3)) - 1) < 1e-6 for r in out)


def test_hot_key_path_shift_median_nth(skewed):
    from tessera.operators import windows
    d = windows.diff_prev(skewed, ["k"], "v", 3, ["id"], "d")
    lag = skewed.withColumn("d2", F.col("v") - F.lag("v", 3).over(Window.partitionBy("k").orderBy("id")))
    assert {r["id"]: r["d"] for r in d.collect()} == {r["id"]: r["d2"] for r in lag.collect()}
    med = {r["k"]: r["median"] for r in aggs.group_median(skewed, ["k"], "v").collect()}
    assert med == pytest.approx(skewed.toPandas().groupby("k")["v"].median().to_dict())
    data = skewed.select("k").distinct()
    last = {r["k"]: r["value"] for r in windows.nth_from_last(data, skewed, ["k"], ["id"], "v", 2).collect()}
    pdf = skewed.toPandas().sort_values("id")
    expect = {k: (g["v"].iloc[-3] if len(g) > 2 else None) for k, g in pdf.groupby("k")}
    assert last == expect


def test_doc_vectors_and_truncated_svd(spark):
    counts = spark.createDataFrame([(1, "a", 2), (1, "c", 1), (2, "b", 5), (3, "a", 1), (3, "x", 9), (4, "x", 1)],
                                   "k int, term string, n long")
    v = topics.doc_vectors(counts, ["a", "b", "c"], "k")
    rows = {r["k"]: r["tf"].toArray().tolist() for r in v.collect()}
    assert rows == {1: [2.0, 0.0, 1.0], 2: [0.0, 5.0, 0.0], 3: [1.0, 0.0, 0.0], 4: [0.0, 0.0, 0.0]}
    s, right = topics.truncated_svd(v, "tf", 2)
    m = np.array([rows[k] for k in sorted(rows)])
    _, want, vt = np.linalg.svd(m, full_matrices=False)  # not centred
    assert s == pytest.approx(want[:2])
    assert np.abs(np.array(right).T) == pytest.approx(np.abs(vt[:2]), abs=1e-9)


def test_doc_vectors_do_not_expand_counts(spark):
    """A count that no array of tokens could hold is one entry."""
    counts = spark.createDataFrame([(1, "a", 3_000_000_000), (1, "b", 2), (2, "z", 1)], "k int, term string, n long")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "term string, idx long")
    rows = {r["k"]: r["tf"] for r in topics.doc_vectors(counts, vocab, "k").collect()}
    assert rows[1].toArray().tolist() == [3e9, 2.0] and len(rows[1].indices) == 2 and rows[2].numNonzeros() == 0


def test_split_counts_are_all_splits(train_frame):
    from pyspark.ml.classification import RandomForestClassifier
    est = RandomForestClassifier(numTrees=3, maxDepth=3, seed=1)
    res = models.oof_classify(train_frame, ["x1", "x2"], "label", "fold", "id", 3, None, est)
    for i, m in enumerate(res.models):
        splits = sum(r["split"] for r in res.importance.filter(F.col("fold") == i).collect())
        assert splits == sum((t.numNodes - 1) // 2 for t in m.stages[-1].trees) > 0


def test_segment_models_keep_rows_without_segment(train_frame):
    d = train_frame.filter(F.col("fold") >= 0).withColumn("seg", F.when(F.col("id") % 4 != 0, F.col("id") % 2 == 0))
    res = models.segment_models(d, F.col("seg"), ["x1", "x2"], "label", "fold", "id", [0, 1, 2], d.drop("label"))
    assert res.oof.count() == res.scored.count() == d.count()


def test_oof_classify_one_vs_rest_boosting(train_frame):
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    est = OneVsRest(classifier=GBTClassifier(maxIter=5, maxDepth=3, seed=1))
    res = models.oof_classify(train_frame.filter(F.col("fold") >= 0), ["x1", "x2"], "label", "fold", "id", 3,
                              estimator=est, folds=[0, 1])
    rows = res.oof.collect()
    assert rows and all(abs(r["class_0"] + r["class_1"] + r["class_2"] - 1) < 1e-9 for r in rows)
    assert res.importance.count() == 2 * 2


def test_aggregate_operators_with_a_hot_key(skewed):
    from tessera.operators import dedup
    pdf = skewed.toPandas()
    sizes = {r["id"]: r["k_count"] for r in aggs.group_size(skewed, ["k"]).collect()}
    expect = pdf.groupby("k")["id"].transform("size")
    assert all(sizes[i] == n for i, n in zip(pdf["id"], expect))
    first = {r["k"]: r["id"] for r in dedup.dedup_first(skewed, ["k"], ["v", "id"]).collect()}
    exp_first = pdf.sort_values(["v", "id"]).drop_duplicates("k", keep="first").set_index("k")["id"].to_dict()
    assert first == exp_first
    flags = {r["id"]: r["is_duplicated"] for r in dedup.flag_duplicates(skewed, ["k", "v"]).collect()}
    exp_flags = pdf.duplicated(["k", "v"], keep=False).astype(int)
    assert all(flags[i] == f for i, f in zip(pdf["id"], exp_flags))
    top = {r["k"]: r["v"] for r in mine.top1_per_key(skewed.select("k", "v", "id"), "k", "v",
                                                       [F.col("v"), -F.col("id")]).collect()}
    assert top == pdf.groupby("k")["v"].max().to_dict()
