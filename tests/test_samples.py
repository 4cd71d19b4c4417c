"""Samples of equal size, distinct sketches and sparse one-hot vectors."""

import pytest
from pyspark.sql import functions as F

from tessera.ml import folds
from tessera.operators import aggs, onehot


def test_bounds_have_exactly_that_many_numbers_below(spark):
    # 40 numbers that agree in all digits but the last, and the ends of the range
    numbers = sorted([(7 << 45) + (5 << 30) + (1 << 15) + i for i in range(40)] + [0, 1, (1 << 60) - 1])
    h = spark.createDataFrame([(x,) for x in numbers], "h long")
    ranks = list(range(len(numbers)))
    for r, b in zip(ranks, folds.nth_hashes(h, ranks)):
        assert sum(x < b for x in numbers) == r
    twice = h.union(h)
    assert sum(x < folds.nth_hashes(twice, [20])[0] for x in numbers) == 10
    with pytest.raises(ValueError, match="equal keys"):
        folds.nth_hashes(twice, [21])


@pytest.mark.parametrize("n,n_sub", [(1000, 3), (8, 4), (5, 1), (2, 3), (0, 2)])
def test_samples_are_equal_and_disjoint(spark, n, n_sub):
    d = spark.range(n).withColumnRenamed("id", "key")
    rows = folds.equal_samples(d, "key", n_sub).collect()
    assert len({r["key"] for r in rows}) == len(rows) == n // n_sub * n_sub
    assert all(sum(r["sample"] == i for r in rows) == n // n_sub for i in range(n_sub))


def test_distinct_sketch_error_and_merge(spark):
    d = spark.range(300_000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 90_000).alias("v"))
    d = d.withColumn("k", F.when(F.col("k") == 2, 0).otherwise(F.col("k")))  # a hot key
    exact = {r["k"]: r["n"] for r in d.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    got = {r["k"]: r["e"] for r in aggs.distinct_estimate(d, ["k"], "v", name="e").select("k", "e").distinct().collect()}
    bound = 4 * 1.04 / 2 ** 6
    assert all(abs(got[k] - n) <= bound * n for k, n in exact.items())
    parts = [aggs.distinct_sketch(d.filter(c), ["k"], "v") for c in ("v < 1000", "v >= 500")]
    merged = aggs.merge_sketches(parts[0].union(parts[1]), ["k"]).select("k", F.hll_sketch_estimate("sketch").alias("e"))
    assert all(abs(r["e"] - exact[r["k"]]) <= bound * exact[r["k"]] for r in merged.collect())
    few = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (None, "c"), (2, None)], "k int, v string")
    assert {(r["k"], r["e"]) for r in aggs.distinct_estimate(few, ["k"], "v", name="e").collect()} == {(1, 2), (None, None), (2, None)}


def test_one_hot_vectors(spark):
    d = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "b")], "id int, c string")
    out = onehot.one_hot_vector(d, "c")
    assert out.columns == ["id", "c", "c_vec"]
    assert {r["id"]: r["c_vec"].toArray().tolist() for r in out.collect()} == {0: [0, 1, 0], 1: [1, 0, 0], 2: [0, 0, 1], 3: [0, 1, 0]}
