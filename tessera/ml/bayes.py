"""Categorical naive Bayes as a Spark ML estimator: a learner made of counts.

Every entry of the feature vector is a category (after ``binWidth``, if it is
set: ``floor(x / binWidth)``; NaN is a value of its own).  Fitting is one aggregate, (feature, value,
class) -> weight; scoring joins a feature's values to their counts.  Both are
SQL, so out-of-fold, segment and stacked predictions of this learner can be
stated and checked exactly.

With ``a`` = ``smoothing``, ``n`` the weight of a value in a class, ``n_c`` of
the class, ``N`` of all, ``C`` classes and ``V`` values of the feature::

    p(c)     = (n_c + a) / (N + a C)
    p(v | c) = (n + a) / (n_c + a (V + 1))      # one share for unseen values

Rows without a label are left out of the fit.  Classes are 0 .. the largest
label; one that has no row keeps its smoothed share.
"""

from __future__ import annotations

import math
import os
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keys import tmp_names
from tessera.session import cut_lineage


class _BayesParams(HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasWeightCol):
    smoothing = Param(Params._dummy(), "smoothing", "added to every count", TypeConverters.toFloat)
    binWidth = Param(Params._dummy(), "binWidth", "width of equal bins; 0: values as they are", TypeConverters.toFloat)

    def _value(self, x: Column) -> Column:
        w = self.getOrDefault("binWidth")
        return F.when(F.isnan(x), x).otherwise(F.floor(x / w).cast("double")) if w else x


class CategoricalNaiveBayes(Estimator, _BayesParams):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", probabilityCol="probability",
                 weightCol=None, smoothing=1.0, binWidth=0.0):
        super().__init__()
        self._setDefault(smoothing=1.0, binWidth=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setLabelCol(self, value):
        return self._set(labelCol=value)

    def setFeaturesCol(self, value):
        return self._set(featuresCol=value)

    def setWeightCol(self, value):
        return self._set(weightCol=value)

    def _fit(self, dataset: DataFrame) -> CategoricalNaiveBayesModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined("weightCol") else F.lit(1.0)
        rows = dataset.select(F.col(self.getLabelCol()).cast("int").alias("label"), weight.alias("w"),
                              F.posexplode(vector_to_array(self.getFeaturesCol())).alias("feature", "x"))
        counts = (rows.filter(F.col("label").isNotNull()).withColumn("value", self._value(F.col("x")))
                  .groupBy("feature", "value", "label").agg(F.sum("w").alias("n")))
        return self._copyValues(CategoricalNaiveBayesModel(cut_lineage(counts, "value-counts")))


class CategoricalNaiveBayesModel(Model, _BayesParams):
    """``counts``: (feature, value, label, n), a table as large as the
    features have values.  The driver holds one number per class and one per
    feature."""

    def __init__(self, counts: DataFrame | None = None):
        super().__init__()
        self._setDefault(smoothing=1.0, binWidth=0.0)
        if counts is not None:
            self._hold(counts)

    def _hold(self, counts: DataFrame) -> None:
        self.counts = counts
        per_class = {r["label"]: r["n"] for r in
                     counts.filter("feature = 0").groupBy("label").agg(F.sum("n").alias("n")).collect()}
        if not per_class:
            raise ValueError("no labelled rows or no features")
        self.class_weights = [per_class.get(c, 0.0) for c in range(max(per_class) + 1)]
        wide = [F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n"))), F.lit(0.0))
                for c in range(len(self.class_weights))]
        # read once per feature and scoring: written once
        self.wide = cut_lineage(counts.groupBy("feature", "value").agg(F.array(*wide).alias("n")), "class-counts")
        n_values = self.wide.groupBy("feature").count().collect()
        self.n_values = [r["count"] for r in sorted(n_values)]

    @property
    def numClasses(self) -> int:
        return len(self.class_weights)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        a, classes = self.getOrDefault("smoothing"), range(self.numClasses)
        total = sum(self.class_weights)
        array, *names = tmp_names(dataset, "x", *[f"v{j}" for j in range(len(self.n_values))],
                                  *[f"n{j}" for j in range(len(self.n_values))])
        values, seen = names[:len(self.n_values)], names[len(self.n_values):]
        d = dataset.withColumn(array, vector_to_array(self.getFeaturesCol()))
        d = d.withColumns({v: self._value(F.col(array)[j]) for j, v in enumerate(values)})
        scores = [F.lit(math.log((n + a) / (total + a * len(classes)))) for n in self.class_weights]
        for j, (v, s) in enumerate(zip(values, seen)):
            known = self.wide.filter(F.col("feature") == j).select(F.col("value").alias(v), F.col("n").alias(s))
            d = d.join(known, v, "left")  # two scans: AQE may broadcast, and splits hot values
            scores = [x + F.log((F.coalesce(F.col(s)[c], F.lit(0.0)) + a)
                                / (self.class_weights[c] + a * (self.n_values[j] + 1)))
                      for c, x in zip(classes, scores)]
        (score,) = tmp_names(d, "score")
        d = d.withColumn(score, F.array(*scores))
        shifted = F.transform(score, lambda x: F.exp(x - F.array_max(score)))
        d = d.withColumn(score, shifted)
        whole = reduce(lambda x, y: x + y, [F.col(score)[c] for c in classes])
        return (d.withColumn(self.getProbabilityCol(), F.transform(score, lambda x: x / whole))
                .drop(array, score, *values, *seen))

    def write(self) -> MLWriter:
        return _Writer(self)

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    @classmethod
    def load(cls, path: str) -> CategoricalNaiveBayesModel:
        return cls.read().load(path)


class _Writer(MLWriter):
    def __init__(self, model: CategoricalNaiveBayesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.counts.write.parquet(os.path.join(path, "counts"))


class _Reader(MLReader):
    def load(self, path: str) -> CategoricalNaiveBayesModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        schema = "feature int, value double, label int, n double"
        model = CategoricalNaiveBayesModel(spark.read.schema(schema).parquet(os.path.join(path, "counts")))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
