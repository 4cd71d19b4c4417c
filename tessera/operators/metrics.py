"""Evaluation metrics and decision thresholds.

Each metric is one aggregate over the prediction table (per-class
conditional sums), so it runs where the data is; the k-class tables in
between have k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rows import argmax
from tessera.operators.keys import attach_scalar, tmp_names
from tessera.session import cut_lineage


def smape(df: DataFrame, y: str, p: str) -> DataFrame:
    """``2 * mean(|y - p| / (y + p))`` (rows with y + p = 0 are skipped)."""
    t = F.try_divide(F.abs(F.col(y) - F.col(p)), F.col(y) + F.col(p))
    return df.agg((F.avg(t) * 2).alias("smape"))


def f1_per_class(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Per true class: support, true positives, predicted count and F1."""
    t = (df.filter(F.col(true).isNotNull()).groupBy(F.col(true).alias("cls"))
           .agg(F.count(F.lit(1)).alias("n_true"),
                F.count(F.when(F.col(true) == F.col(pred), 1)).alias("tp")))
    p = df.filter(F.col(pred).isNotNull()).groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    j = t.join(p, "cls", "left").withColumn("n_pred", F.coalesce("n_pred", F.lit(0)))
    return j.withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("n_true") + F.col("n_pred")),
                                         F.lit(0.0)))


def macro_f1(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Unweighted mean over the true classes of the per-class F1."""
    return f1_per_class(df, true, pred).agg(F.avg("f1").alias("macro_f1"),
                                            F.count(F.lit(1)).alias("n_classes"))


def expected_macro_f1(df: DataFrame, probs: Sequence[str], pred: str) -> DataFrame:
    """Expected macro F1 of hard predictions under the probabilities:
    per class ``2r / (m + n)`` with m = predicted count, n = sum of p,
    r = sum of p over rows predicted as that class."""
    aggs = []
    for i, pc in enumerate(probs):
        aggs += [F.sum(pc).alias(f"n{i}"), F.count(F.when(F.col(pred) == i, 1)).alias(f"m{i}"),
                 F.coalesce(F.sum(F.when(F.col(pred) == i, F.col(pc))), F.lit(0.0)).alias(f"r{i}")]
    st = df.agg(*aggs)
    f1s = [F.try_divide(2 * F.col(f"r{i}"), F.col(f"m{i}") + F.col(f"n{i}")) for i in range(len(probs))]
    return st.select((sum(f1s) / F.lit(float(len(probs)))).alias("expected_macro_f1"))


def f1_threshold(df: DataFrame, p: str, name: str = "pred") -> DataFrame:
    """Binary decisions maximising expected F1: walk probabilities in
    descending order accumulating ``sum(p) / (count + sum of all p)`` and
    stop at the first decrease; predict 1 where p exceeds the stopping value.

    The walk rises while p is at least the ratio so far, so it stops at the
    largest p below the ratio's maximum.  The maximum is the fixed point of
    ``r = sum(p >= r) / (count(p >= r) + sum of all p)``, which is reached
    from below in a few rounds: a one-row aggregate each, no sort, over the
    one column, which is written once.
    """
    scores = cut_lineage(df.select(F.col(p).alias("p")), "scores")
    v = F.col("p").cast("double")
    total = scores.agg(F.sum(v)).first()[0] or 0.0
    r, n = 0.0, None
    while True:
        st = scores.agg(F.sum(F.when(v >= r, v)).alias("s"), F.count(F.when(v >= r, 1)).alias("n")).first()
        if not st["n"] or st["n"] == n or st["n"] + total == 0:
            break
        n, r = st["n"], st["s"] / (st["n"] + total)
    th = scores.agg(F.coalesce(F.max(F.when(v < r, F.col("p"))), F.min("p")).alias("threshold"))
    (t,) = tmp_names(df, "t")
    out = attach_scalar(df, th, t)
    return out.withColumn(name, F.coalesce(F.col(p) > F.col(f"{t}.threshold"), F.lit(False)).cast("int")).drop(t)


def multi_f1_threshold(df: DataFrame, probs: Sequence[str], name: str = "pred", passes: int = 3,
                       confident: float = 0.5) -> DataFrame:
    """Re-assign uncertain rows (max p <= ``confident``) to the class with the
    largest expected-F1 gain ``2 (p s - r) / ((s + 1) s)``, s = m + n, with
    the class totals (m = sum p, n = predicted count, r = sum p over rows
    predicted as the class) recomputed before each pass.

    Each pass is one aggregate job whose 3k totals (one row, bounded by the
    class count) enter the next projection as literals, so later passes do
    not re-evaluate earlier ones.
    """
    (flag,) = tmp_names(df, "flag")
    cur = df.withColumn(name, argmax(probs)).withColumn(flag, F.greatest(*[F.col(c) for c in probs]) > confident)
    for _ in range(passes):
        aggs = []
        for i, pc in enumerate(probs):
            aggs += [F.sum(pc).alias(f"m{i}"), F.count(F.when(F.col(name) == i, 1)).cast("double").alias(f"n{i}"),
                     F.coalesce(F.sum(F.when(F.col(name) == i, F.col(pc))), F.lit(0.0)).alias(f"r{i}")]
        st = cur.agg(*aggs).first()
        gains = []
        for i, pc in enumerate(probs):
            s_ = F.lit(st[f"m{i}"]) + F.lit(st[f"n{i}"])
            gains.append(2 * (F.col(pc) * s_ - F.lit(st[f"r{i}"])) / (s_ + 1) / s_)
        arr = F.array(*gains)
        best = (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
        cur = cur.withColumn(name, F.when(F.col(flag), F.col(name)).otherwise(best))
    return cur.drop(flag)


def fold_mae(df: DataFrame, y: str, p: str, fold: str) -> DataFrame:
    """Mean absolute error per validation fold."""
    return df.groupBy(fold).agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"), F.count(F.lit(1)).alias("n"))
