"""Out-of-fold scoring with Spark ML (M4, M5, M7–M9).

A k-fold loop is k ``fit`` jobs on ``filter(fold != i)``; each fit is a
distributed Spark ML job.  Out-of-fold predictions are a union of the
per-fold validation predictions (each labelled row is predicted exactly
once, by the model that did not see it); predictions for the rows to score
are the mean over folds (union + ``groupBy``).  Rows with fold -1 are
training-only extras (appended to every training fold, never validated).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, cut_lineage, delete_at_exit

MISSING = -999.0
#: Rows of a file of the tables that the folds' models are fitted on: each fit
#: scans them many times, on as many cores as there are files.
FILE_ROWS = 50_000
#: Models of a learner that are fitted at a time: one's short jobs and last
#: tasks leave cores idle.  Each keeps its binned rows in memory, or on disk.
AT_ONCE = 2
#: A learner callback: validation rows of a fold (key, label, predictions) to
#: a table of one row, e.g. ``lambda v: metrics.smape(v, "fee", "pred")``.
Metric = Callable[[DataFrame], DataFrame]


def assemble(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")


def fill_missing(df: DataFrame, features: Sequence[str], value: float = MISSING) -> DataFrame:
    """Trees in Spark ML do not route missing values: nulls get a constant
    outside the data range (what boosting libraries do implicitly)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(value)) for c in features})


@dataclass
class OofResult:
    oof: DataFrame                 # key, fold, class_0..class_{k-1} (or prediction)
    scored: DataFrame | None       # key, mean over folds
    models: list = field(default_factory=list)
    fold_scores: DataFrame | None = None  # fold, columns of the metric
    explain: Callable[[], DataFrame] | None = None

    @cached_property
    def importance(self) -> DataFrame:
        """feature, fold, split, gain; the models' nodes are written at the
        first use."""
        return self.explain()


def class_probabilities(pred: DataFrame, out: str = "__p") -> DataFrame:
    """Class probabilities as an array column: the model's ``probability``
    (a vector or an array) when it has one, else a softmax of ``rawPrediction`` (one-vs-rest
    ensembles of binary boosted trees expose only per-class margins)."""
    if "probability" in pred.columns:
        is_array = dict(pred.dtypes)["probability"].startswith("array")
        return pred.withColumn(out, F.col("probability") if is_array else vector_to_array("probability"))
    raw = vector_to_array("rawPrediction")
    mx = F.array_max(raw)
    ex = F.transform(raw, lambda x: F.exp(x - mx))
    total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return pred.withColumn(out, F.transform(ex, lambda x: x / total))


def _tree_models(m) -> list:
    """The tree models inside a fitted estimator (one-vs-rest holds one per class)."""
    if hasattr(m, "featureImportances"):
        return [m]
    return [x for sub in getattr(m, "models", []) for x in _tree_models(sub)]


_NODES = ("fold int, part int, parts int, boosted boolean, tree int, node int, feature int, "
          "threshold double, rows long, impurity double, gain double")


def tree_nodes(models: Sequence, folds: Sequence[int] | None = None) -> DataFrame:
    """One row per node of fitted tree models, read from the saved models'
    node tables: ``fold`` (place in the list unless given), ``part`` of
    ``parts`` (one-vs-rest holds a model per class), ``tree``, ``node``,
    ``feature`` (index of the split; null in a leaf), ``threshold`` (null for
    categorical splits), ``rows``, ``impurity``, ``gain`` (null in a leaf).
    Models without trees give no rows."""
    spark = SparkSession.getActiveSession()
    out = [spark.createDataFrame([], _NODES)]
    for i, m in zip(folds if folds is not None else range(len(models)), models):
        trees = _tree_models(m.stages[-1] if isinstance(m, PipelineModel) else m)
        for j, t in enumerate(trees):
            path = os.path.join(checkpoint_dir(spark), f"trees-{uuid.uuid4().hex}")
            t.write().overwrite().save(path)
            delete_at_exit(spark, path)
            n = spark.read.parquet(os.path.join(path, "data"))
            n = n.select("treeID", "nodeData.*") if "nodeData" in n.columns else n.withColumn("treeID", F.lit(0))
            inner = F.col("split.featureIndex") >= 0
            out.append(n.select(
                F.lit(i).alias("fold"), F.lit(j).alias("part"), F.lit(len(trees)).alias("parts"),
                F.lit("GBT" in type(t).__name__).alias("boosted"), F.col("treeID").alias("tree"), F.col("id").alias("node"),
                F.when(inner, F.col("split.featureIndex")).alias("feature"),
                F.when(inner & (F.col("split.numCategories") < 0),
                       F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
                F.col("rawCount").alias("rows"), "impurity", F.when(inner, F.col("gain")).alias("gain")))
    return reduce(DataFrame.unionByName, out)


def tree_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, fold, split, gain)`` from :func:`tree_nodes`: the splits of
    a feature and its share (per cent) of the impurity that splits take away,
    weighted by rows.  A forest's trees count alike, a boosted model's trees by
    what they gain; a fold of several models has their mean."""
    inner = nodes.filter("feature IS NOT NULL")
    per = (inner.groupBy("fold", "part", "parts", F.when(~F.col("boosted"), F.col("tree")).alias("tree"), "feature")
           .agg(F.count(F.lit(1)).alias("split"), F.sum(F.col("gain") * F.col("rows")).alias("gain")))
    share = lambda *by: F.try_divide(F.col("gain"), F.sum("gain").over(Window.partitionBy(*by)))
    per = per.withColumn("gain", share("fold", "part", "tree"))
    part = per.groupBy("fold", "part", "parts", "feature").agg(F.sum("split").alias("split"), F.sum("gain").alias("gain"))
    part = part.withColumn("gain", share("fold", "part") / F.col("parts"))
    got = part.groupBy("fold", "feature").agg(F.sum("split").alias("split"), F.sum("gain").alias("gain"))
    grid = nodes.select("fold").distinct().select("fold", F.posexplode(F.array(*map(F.lit, features))).alias("index", "name"))
    return (grid.join(got.withColumnRenamed("feature", "index"), ["fold", "index"], "left")
            .select(F.col("name").alias("feature"), "fold", F.coalesce("split", F.lit(0)).cast("double").alias("split"),
                    (F.coalesce("gain", F.lit(0.0)) * 100.0).alias("gain")))


def _stopping(est):
    if not est.hasParam("validationIndicatorCol"):
        raise ValueError(f"{type(est).__name__} has no early stopping")
    return est.copy({est.getParam("validationIndicatorCol"): "__valid"})


def _fold_rows(data: DataFrame, fold: str, i: int, early_stopping: bool) -> DataFrame:
    """Rows that fold ``i``'s model is fitted on; with early stopping also the
    fold's own, marked as validation rows."""
    if not early_stopping:
        return data.filter(F.col(fold) != i)
    return data.filter(F.col(fold).isNotNull()).withColumn("__valid", F.col(fold) == i)


def _fit_folds(pipe: Pipeline, data: DataFrame, fold: str, folds: Sequence[int], early_stopping: bool) -> list:
    """The folds' models, AT_ONCE at a time."""
    fit = inheritable_thread_target(data.sparkSession)(lambda i: pipe.fit(_fold_rows(data, fold, i, early_stopping)))
    with ThreadPool(AT_ONCE) as pool:
        return pool.map(fit, folds, chunksize=1)


def _score_fold(metric: Metric, val: DataFrame, fold: str, i: int) -> DataFrame:
    return metric(val).select(F.lit(i).alias(fold), "*")


def oof_classify(df: DataFrame, features: Sequence[str], label: str, fold: str, key: str,
                 n_classes: int, to_score: DataFrame | None = None, estimator=None,
                 folds: Sequence[int] | None = None, weight: str | None = None, prefix: str = "class_",
                 metric: Metric | None = None, early_stopping: bool = False) -> OofResult:
    """k-fold out-of-fold class probabilities.

    ``label`` holds class indexes 0..n_classes-1 (see
    ``aggs.label_index``); ``fold`` holds 0..k-1 or -1 for extra training
    rows.  Returns out-of-fold probabilities for the labelled rows, the
    fold-averaged probabilities for ``to_score`` and per-fold importances.
    A class that no training row of a fold has gets probability 0 there.
    ``metric`` is called on each fold's validation rows (key, label, class
    probabilities); with ``early_stopping`` a boosting learner sees these rows
    as its validation set and stops when they no longer improve.
    """
    folds = list(folds) if folds is not None else list(range(5))
    est = estimator or RandomForestClassifier(numTrees=40, maxDepth=8, seed=66)
    est = est.setLabelCol("__label").setFeaturesCol("__features")
    if weight:
        est = est.setWeightCol(weight)
    # k fits and 2k transforms read these tables: write them once (shared
    # folder, survives executor loss) instead of recomputing the lineage
    data = cut_lineage(fill_missing(df, features).withColumn("__label", F.col(label).cast("double")), "oof-train", FILE_ROWS)
    score = cut_lineage(fill_missing(to_score, features), "oof-score", FILE_ROWS) if to_score is not None else None
    if early_stopping:
        est = _stopping(est)
    pipe = Pipeline(stages=[assemble(features, "__features"), est])
    classes = [F.coalesce(F.get("__p", F.lit(i)), F.lit(0.0)).alias(f"{prefix}{i}") for i in range(n_classes)]
    oof_parts, score_parts, scores = [], [], []
    models = _fit_folds(pipe, data, fold, folds, early_stopping)
    for i, model in zip(folds, models):
        val = class_probabilities(model.transform(data.filter(F.col(fold) == i)))
        oof_parts.append(val.select(key, F.lit(i).alias(fold), *classes))
        if metric:
            scores.append(_score_fold(metric, val.select(key, label, *classes), fold, i))
        if score is not None:
            s = class_probabilities(model.transform(score))
            score_parts.append(s.select(key, *classes))
    oof = reduce(DataFrame.unionByName, oof_parts)
    scored = None
    if score_parts:
        u = reduce(DataFrame.unionByName, score_parts)
        scored = u.groupBy(key).agg(*[F.avg(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(n_classes)])
    return OofResult(oof, scored, models, reduce(DataFrame.unionByName, scores) if scores else None,
                     lambda: tree_importance(tree_nodes(models, folds), features))


def oof_regress(df: DataFrame, features: Sequence[str], target: str, fold: str, key: str,
                to_score: DataFrame | None = None, estimator=None, folds: Sequence[int] | None = None,
                pred: str = "pred", weight: str | None = None, metric: Metric | None = None,
                early_stopping: bool = False) -> OofResult:
    """k-fold out-of-fold regression (``fold_mae`` scores it per fold);
    boosted trees unless another estimator is given.  ``metric`` and
    ``early_stopping`` as in :func:`oof_classify`."""
    folds = list(folds) if folds is not None else list(range(5))
    est = estimator or GBTRegressor(maxIter=20, maxDepth=5, seed=66)
    est = est.setLabelCol("__y").setFeaturesCol("__features").setPredictionCol(pred)
    if weight:
        est = est.setWeightCol(weight)
    data = cut_lineage(fill_missing(df, features).withColumn("__y", F.col(target).cast("double")), "oof-train", FILE_ROWS)
    score = cut_lineage(fill_missing(to_score, features), "oof-score", FILE_ROWS) if to_score is not None else None
    if early_stopping:
        est = _stopping(est)
    pipe = Pipeline(stages=[assemble(features, "__features"), est])
    oof_parts, score_parts, scores = [], [], []
    models = _fit_folds(pipe, data, fold, folds, early_stopping)
    for i, model in zip(folds, models):
        val = model.transform(data.filter(F.col(fold) == i)).select(key, F.lit(i).alias(fold), F.col(target), F.col(pred))
        oof_parts.append(val)
        if metric:
            scores.append(_score_fold(metric, val.drop(fold), fold, i))
        if score is not None:
            score_parts.append(model.transform(score).select(key, F.col(pred)))
    oof = reduce(DataFrame.unionByName, oof_parts)
    scored = None
    if score_parts:
        scored = reduce(DataFrame.unionByName, score_parts).groupBy(key).agg(F.avg(pred).alias(pred))
    return OofResult(oof, scored, models, reduce(DataFrame.unionByName, scores) if scores else None,
                     lambda: tree_importance(tree_nodes(models, folds), features))


def segment_models(df: DataFrame, segment: Column | None, features: Sequence[str], label: str, fold: str,
                   key: str, all_classes: Sequence[int], to_score: DataFrame | None = None,
                   estimator=None, prefix: str = "class_") -> OofResult:
    """Independent models for ``segment`` and its complement (a null segment
    belongs to the complement), each with its own label map (which of
    ``all_classes`` the segment has); outputs unioned on the full class list,
    absent classes filled with 0."""
    from tessera.operators.relate import union_fill
    parts_oof, parts_score, models, results = [], [], [], []
    inside = F.coalesce(segment, F.lit(False))
    for seg in (inside, ~inside):
        d = df.filter(seg)
        n = d.agg(*[F.count(F.when(F.col(label) == F.lit(c), 1)).alias(f"n{i}") for i, c in enumerate(all_classes)]).first()
        present = [c for i, c in enumerate(all_classes) if n[f"n{i}"]]
        idx = F.create_map(*[x for i, c in enumerate(present) for x in (F.lit(c), F.lit(i))])
        d = d.withColumn("__seg_label", F.element_at(idx, F.col(label)))
        s = to_score.filter(seg) if to_score is not None else None
        res = oof_classify(d, features, "__seg_label", fold, key, len(present), s, estimator, prefix="__s")
        ren = {f"__s{i}": f"{prefix}{c}" for i, c in enumerate(present)}
        parts_oof.append(res.oof.withColumnsRenamed(ren))
        if res.scored is not None:
            parts_score.append(res.scored.withColumnsRenamed(ren))
        models += res.models
        results.append(res)
    cols = [f"{prefix}{c}" for c in all_classes]

    def full(frames, lead):
        u = union_fill(frames, 0.0)
        return u.withColumns({c: F.lit(0.0) for c in cols if c not in u.columns}).select(*lead, *cols)
    oof = full(parts_oof, [key, fold])
    scored = full(parts_score, [key]) if parts_score else None
    return OofResult(oof, scored, models, None, lambda: reduce(DataFrame.unionByName, [r.importance for r in results]))


def stacking(base: DataFrame, stage_outputs: Sequence[DataFrame], key: str, features: Sequence[str],
             label: str, fold: str, n_classes: int, to_score_base: DataFrame | None = None,
             stage_scores: Sequence[DataFrame] = (), estimator=None) -> OofResult:
    """Second-level model: out-of-fold outputs of earlier stages joined on
    the row key (each stage's columns prefixed ``s<j>_``) become features."""
    def add(frame, outs):
        extra = []
        for j, o in enumerate(outs):
            cols = [c for c in o.columns if c not in (key, fold)]
            frame = frame.join(o.select(key, *[F.col(c).alias(f"s{j}_{c}") for c in cols]), key, "left")
            extra += [f"s{j}_{c}" for c in cols]
        return frame, extra
    train, extra = add(base, stage_outputs)
    score = None
    if to_score_base is not None:
        score, _ = add(to_score_base, stage_scores)
    return oof_classify(train, list(features) + extra, label, fold, key, n_classes, score, estimator)


__all__ = ["Metric", "OofResult", "oof_classify", "oof_regress", "segment_models", "stacking", "tree_nodes",
           "tree_importance", "fill_missing", "assemble"]
