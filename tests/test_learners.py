"""The count learner, node tables, metric callbacks and early stopping."""

import math
import os
import random
import uuid

import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tessera.ml import models
from tessera.ml.bayes import CategoricalNaiveBayes, CategoricalNaiveBayesModel
from tessera.operators import metrics
from tessera.session import checkpoint_dir


def brute(train, rows, a, width, classes):
    """Probabilities by the formula of the module's docstring, in plain loops."""
    bins = lambda x: "nan" if math.isnan(x) else math.floor(x / width) if width else x
    out = []
    total = sum(w for _, _, w in train)
    for x in rows:
        p = []
        for c in range(classes):
            nc = sum(w for _, y, w in train if y == c)
            q = (nc + a) / (total + a * classes)
            for j, v in enumerate(x):
                seen = {bins(t[j]) for t, _, _ in train}
                n = sum(w for t, y, w in train if y == c and bins(t[j]) == bins(v))
                q *= (n + a) / (nc + a * (len(seen) + 1))
            p.append(q)
        out.append([q / sum(p) for q in p])
    return out


@pytest.mark.parametrize("a,width", [(1.0, 0.0), (0.5, 0.7)])
def test_count_learner_equals_plain_loops(spark, a, width):
    rnd = random.Random(3)
    train = [([float(rnd.randrange(4)), rnd.choice([0.0, -2.5, math.nan])], rnd.choice([0, 1, 3]), rnd.choice([1.0, 2.5]))
             for _ in range(200)]
    rows = [[0.0, -2.5], [3.0, math.nan], [9.0, 7.0], [2.0, 0.0]]  # [9, 7]: both values unseen
    data = [(x, y, w) for x, y, w in train] + [([1.0, 0.0], None, 50.0)]  # without a label: left out
    d = spark.createDataFrame(data, "x array<double>, y int, w double").select(F.col("x")[0].alias("p"), F.col("x")[1].alias("q"), "y", "w")
    asm = models.assemble(["p", "q"])
    m = CategoricalNaiveBayes(labelCol="y", weightCol="w", smoothing=a, binWidth=width).fit(asm.transform(d))
    te = asm.transform(spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "v0 int, p double, q double"))
    got = {r["v0"]: r["probability"] for r in m.transform(te).collect()}
    for i, want in enumerate(brute(train, rows, a, width, 4)):
        assert got[i] == pytest.approx(want, abs=1e-12)
    assert m.transform(te).columns == [*te.columns, "probability"]
    path = os.path.join(checkpoint_dir(spark), f"bayes-{uuid.uuid4().hex}")
    m.write().overwrite().save(path)
    again = CategoricalNaiveBayesModel.load(path)
    assert again.uid == m.uid and again.numClasses == 4
    assert {r["v0"]: r["probability"] for r in again.transform(te).collect()} == got


def test_count_learner_without_labels(spark):
    d = models.assemble(["p"]).transform(spark.createDataFrame([(1.0, None)], "p double, label int"))
    with pytest.raises(ValueError, match="no labelled rows"):
        CategoricalNaiveBayes().fit(d)


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(4)
    data = [(i, i % 3, i % 3 + rnd.random(), rnd.random(), i % 4 if i % 11 else -1) for i in range(400)]
    return spark.createDataFrame(data, "id int, label int, x1 double, x2 double, fold int")


def test_importance_from_nodes_equals_the_models(frame):
    res = models.oof_classify(frame, ["x1", "x2"], "label", "fold", "id", 3, folds=[0, 2],
                              estimator=RandomForestClassifier(numTrees=4, maxDepth=3, seed=1))
    for i, m in zip([0, 2], res.models):
        got = {r["feature"]: r["gain"] for r in res.importance.filter(F.col("fold") == i).collect()}
        assert [got["x1"], got["x2"]] == pytest.approx([100 * x for x in m.stages[-1].featureImportances.toArray()])
    boosted = models.oof_regress(frame, ["x1", "x2"], "label", "fold", "id", folds=[1], estimator=GBTRegressor(maxIter=4, seed=1))
    got = {r["feature"]: r["gain"] for r in boosted.importance.collect()}
    want = 100 * boosted.models[0].stages[-1].featureImportances.toArray()
    assert [got["x1"], got["x2"]] == pytest.approx(list(want))
    nodes = models.tree_nodes(boosted.models)
    assert nodes.count() == sum(t.numNodes for t in boosted.models[0].stages[-1].trees)


def test_importance_of_several_models_a_fold_and_of_none(frame):
    est = OneVsRest(classifier=GBTClassifier(maxIter=2, maxDepth=2, seed=1))
    res = models.oof_classify(frame, ["x1", "x2"], "label", "fold", "id", 3, estimator=est, folds=[0])
    subs = res.models[0].stages[-1].models
    want = sum(100 * t.featureImportances.toArray() for t in subs) / len(subs)
    got = {r["feature"]: r["gain"] for r in res.importance.collect()}
    assert [got["x1"], got["x2"]] == pytest.approx(list(want))
    res = models.oof_classify(frame, ["x1"], "label", "fold", "id", 3, estimator=CategoricalNaiveBayes(binWidth=0.5), folds=[0])
    assert res.importance.count() == 0


def test_boosting_stops_early_and_metric_sees_validation_rows(frame):
    est = GBTRegressor(maxIter=60, maxDepth=2, stepSize=0.9, seed=1)
    score = lambda v: metrics.smape(v.filter("label > 0"), "label", "pred")
    run = lambda early: models.oof_regress(frame, ["x2"], "label", "fold", "id", estimator=est, folds=[0, 1],
                                           metric=score, early_stopping=early)
    full, stopped = run(False), run(True)
    assert [m.stages[-1].getNumTrees for m in full.models] == [60, 60]
    assert all(m.stages[-1].getNumTrees < 60 for m in stopped.models)  # x2 is noise
    for res in (full, stopped):
        rows = {r["fold"]: r["smape"] for r in res.fold_scores.collect()}
        for f in (0, 1):
            v = [(r["label"], r["pred"]) for r in res.oof.filter((F.col("fold") == f) & (F.col("label") > 0)).collect()]
            assert rows[f] == pytest.approx(2 * sum(abs(y - p) / (y + p) for y, p in v) / len(v))
    with pytest.raises(ValueError, match="no early stopping"):
        models.oof_classify(frame, ["x1"], "label", "fold", "id", 3, estimator=RandomForestClassifier(), early_stopping=True)


def test_class_that_a_training_fold_lacks_has_probability_zero(frame):
    d = frame.filter("fold >= 0 AND (label < 2 OR fold = 0)")
    res = models.oof_classify(d, ["x1"], "label", "fold", "id", 3, estimator=CategoricalNaiveBayes(binWidth=0.5), folds=[0, 1])
    rows = res.oof.collect()
    assert all(r["class_2"] == 0.0 for r in rows if r["fold"] == 0) and any(r["class_2"] > 0 for r in rows if r["fold"] == 1)


def test_fits_read_as_many_files_as_rows_need_and_overlap(spark, monkeypatch):
    import threading
    from tessera.ml import models
    rows = [(i, i % 5, i % 2, float(i % 7)) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, fold int, y int, x double").coalesce(1)
    monkeypatch.setattr(models, "FILE_ROWS", 30)
    files, meet, fit = [], threading.Barrier(2, timeout=60), models.Pipeline.fit

    def watched(self, data):
        files.append(len(data.inputFiles()))
        if len(files) <= 4:
            meet.wait()  # two fits run at a time, or this breaks
        return fit(self, data)
    monkeypatch.setattr(models.Pipeline, "fit", watched)
    res = models.oof_classify(d, ["x"], "y", "fold", "id", 2, None, models.RandomForestClassifier(numTrees=2, maxDepth=2, seed=1))
    assert sorted((r["id"], r["fold"]) for r in res.oof.collect()) == [(i, i % 5) for i in range(200)]
    assert files == [7] * 5 and len(res.models) == 5
