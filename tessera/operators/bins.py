"""Equal-width and equal-frequency binning, per-bin label rates and bin
dummies (A7, A8, A18, A24).

Bin numbers are 1-based and right-closed like ``pd.cut``/``pd.qcut``:
``bin = 1 + #(inner edges < x)``; null stays null.  Equal-frequency edges
are exact linear-interpolated quantiles by multi-selection (a mergeable
sketch brackets every order statistic, a second aggregate counts between the
brackets and keeps the values inside them) or, opt-in, the sketch's own
``percentile_approx``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import attach_scalar, ordinal_within, tmp_names


def _bin_of(x: Column, edges: Column, k: int) -> Column:
    """1 + number of inner edges (edges[1..k-1]) strictly below x."""
    inner = F.slice(edges, 2, k - 1) if k > 1 else F.array().cast("array<double>")
    return F.when(x.isNotNull(), (F.size(F.filter(inner, lambda e: e < x)) + 1).cast("int"))


def equal_width_edges(df: DataFrame, column: str, k: int) -> DataFrame:
    """1-row frame with ``edges`` (k+1 doubles) as ``pd.cut(x, k)`` builds
    them: linspace(min, max), lowest edge lowered by 0.1% of the range; a
    constant column is widened by 0.1% on both sides."""
    x = F.col(column).cast("double")
    st = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    mn, mx = F.col("mn"), F.col("mx")
    same = mn == mx
    lo = F.when(same, F.when(mn == 0, F.lit(-0.001)).otherwise(mn - F.lit(0.001) * F.abs(mn))).otherwise(mn)
    hi = F.when(same, F.when(mx == 0, F.lit(0.001)).otherwise(mx + F.lit(0.001) * F.abs(mx))).otherwise(mx)
    step = (hi - lo) / F.lit(float(k))
    adj = (mx - mn) * F.lit(0.001)
    edges = []
    for j in range(k + 1):
        if j == k:
            e = hi
        else:
            e = F.lit(float(j)) * step + lo
        if j == 0:
            e = F.when(same, e).otherwise(e - adj)
        edges.append(e)
    return st.select(F.array(*edges).alias("edges"))


def quantile_edges(df: DataFrame, column: str, k: int, exact: bool = True,
                   accuracy: int = 10000) -> DataFrame:
    """1-row frame with ``edges``: the quantiles 0, 1/k, …, 1 of the non-null
    values, linear interpolation between order statistics (as ``qcut``); null
    edges without values.

    Exact in two scans.  The first takes the sketch of ``percentile_approx``,
    whose ranks are off by n / accuracy at most; values at three times that
    before and behind a quantile bracket its two order statistics.  The second
    counts the values between the brackets, and the distinct ones inside them
    (some 6 k / accuracy of the rows), whose running counts give the ranks."""
    qs = [j * (1.0 / k) for j in range(k)] + [1.0]
    x = F.col(column).cast("double")
    if not exact:
        return df.agg(F.percentile_approx(x, qs, accuracy).alias("edges"))
    vals = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    at = [min(max(q + d * 3.0 / accuracy, 0.0), 1.0) for q in qs for d in (-1, 1)]
    # one row of 2 (k + 1) numbers
    n, marks = vals.agg(F.count(F.lit(1)), F.percentile_approx("x", at, accuracy)).first()
    if not n:
        return df.sparkSession.range(1).select(F.array(*[F.lit(None).cast("double")] * (k + 1)).alias("edges"))
    if n <= 2 * accuracy:
        inside, slot = F.col("x"), F.lit(0)
    else:
        ends: list[list[float]] = []
        for lo, hi in zip(marks[::2], marks[1::2]):
            if ends and not lo > ends[-1][1]:
                ends[-1][1] = max(ends[-1][1], hi)
            else:
                ends.append([lo, hi])
        # odd inside a bracket, even between them
        passed = [c.cast("int") for lo, hi in ends for c in (F.col("x") >= lo, F.col("x") > hi)]
        slot = sum(passed[1:], passed[0])
        inside = F.when(F.pmod(slot, F.lit(2)) == 1, F.col("x"))
    c = vals.groupBy(slot.alias("slot"), inside.alias("x")).agg(F.count(F.lit(1)).alias("c"), F.lit(0).alias("all"))
    c = ordinal_within(c, ["all"], [F.col("slot"), F.col("x")], "before", weight="c")

    def order_statistic(at):  # the smallest value with more than `at` values up to it
        return F.min(F.when(F.col("before") + F.col("c") > at, F.col("x")))

    stats, edges = [], []
    for j, q in enumerate(qs):
        h = (float(n) - 1) * q
        stats += [order_statistic(math.floor(h)).alias(f"lo{j}"), order_statistic(math.floor(h) + 1).alias(f"hi{j}")]
        lo, hi, frac = F.col(f"lo{j}"), F.col(f"hi{j}"), h - math.floor(h)
        edges.append(lo if frac == 0 else lo + (hi - lo) * frac)
    return c.agg(*stats).select(F.array(*edges).alias("edges"))


def assign_bins(df: DataFrame, column: str, edges: DataFrame, k: int, name: str) -> DataFrame:
    (s,) = tmp_names(df, "edges")
    out = attach_scalar(df, edges, s)
    return out.withColumn(name, _bin_of(F.col(column).cast("double"), F.col(f"{s}.edges"), k)).drop(s)


def equal_width_bins(df: DataFrame, column: str, k: int, name: str | None = None) -> DataFrame:
    return assign_bins(df, column, equal_width_edges(df, column, k), k, name or f"{column}_bin")


def qcut_bins(df: DataFrame, column: str, k: int, name: str | None = None, exact: bool = True) -> DataFrame:
    """``pd.qcut(x, k)`` codes as 1..k (duplicate edges leave empty bins
    instead of raising)."""
    return assign_bins(df, column, quantile_edges(df, column, k, exact), k, name or f"{column}_qbin")


def _bin_rates(df: DataFrame, column: str, label: str, k: int, edges: DataFrame) -> DataFrame:
    binned = assign_bins(df.select(column, label), column, edges, k, "bin")
    per = (binned.filter(F.col("bin").isNotNull()).groupBy("bin")
                 .agg(F.coalesce(F.sum(label), F.lit(0)).alias("sum"), F.count(label).alias("count")))
    all_bins = edges.select(F.posexplode(F.slice("edges", 2, k)).alias("i", "hi"), "edges").select(
        (F.col("i") + 1).cast("int").alias("bin"), F.element_at("edges", F.col("i") + 1).alias("lo"), "hi")
    out = all_bins.join(per, "bin", "left")
    return out.select("bin", "lo", "hi",
                      F.coalesce("sum", F.lit(0)).cast("bigint").alias("sum"),
                      F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
                      F.try_divide(F.col("sum").cast("double"), F.col("count")).alias("rate"))


def rate_equal_width(df: DataFrame, column: str, label: str, k: int = 10) -> DataFrame:
    """Per equal-width bin (all k, empty ones included): label sum, labelled
    count and rate."""
    return _bin_rates(df, column, label, k, equal_width_edges(df, column, k))


def rate_equal_freq(df: DataFrame, column: str, label: str, k: int = 10, exact: bool = True) -> DataFrame:
    """Per equal-frequency bin: label sum, labelled count and rate."""
    return _bin_rates(df, column, label, k, quantile_edges(df, column, k, exact))


def quantile_one_hot(df: DataFrame, column: str, k: int = 10, nan_as_category: bool = True,
                     exact: bool = True) -> DataFrame:
    """qcut bins as 0/1 columns ``<col>_scatter_<bin>`` (+ ``_nan``)."""
    b = f"{column}_scatter"
    out = qcut_bins(df, column, k, b, exact)
    dummies = {f"{b}_{i}": (F.coalesce(F.col(b) == i, F.lit(False))).cast("int") for i in range(1, k + 1)}
    if nan_as_category:
        dummies[f"{b}_nan"] = F.col(b).isNull().cast("int")
    return out.withColumns(dummies).drop(b)
