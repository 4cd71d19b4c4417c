"""Target-rate encodings: per-class rates by category, their out-of-fold
form and Beta-smoothed rates (A10–A12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import attach_scalar, join_back, tmp_names


def _rate_name(category: str, c) -> str:
    return f"{category}_{c}_conversion"


def class_rate_table(df: DataFrame, category: str, label: str, min_support: int = 20) -> DataFrame:
    """P(label = c | category) as a table (category, class, rate) of the
    classes that a category has, for any number of classes; support and
    denominator as in :func:`class_rates`."""
    d = df.filter(F.col(category).isNotNull())
    n = d.groupBy(category).agg(F.count(F.lit(1)).alias("__n"))
    c = d.filter(F.col(label).isNotNull()).groupBy(category, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("__c"))
    return (join_back(c, n, [category]).filter(F.col("__n") >= min_support)
            .select(category, "class", (F.col("__c") / F.col("__n")).alias("rate")))


def class_rates(df: DataFrame, category: str, label: str, classes: Sequence, min_support: int = 20) -> DataFrame:
    """P(label = c | category) for each of the named classes, as columns
    ``<category>_<c>_conversion``.  Denominator: all rows of the category,
    null labels included; categories with fewer than ``min_support`` rows or
    without any labelled row get nulls (in-sample: the row's own label counts).
    """
    lab = F.col(label)
    st = (df.filter(F.col(category).isNotNull()).groupBy(category)
            .agg(F.count(F.lit(1)).alias("__n"), F.count(lab).alias("__m"),
                 *[F.count(F.when(lab == F.lit(c), 1)).alias(f"__c{i}") for i, c in enumerate(classes)]))
    ok = (F.col("__n") >= min_support) & (F.col("__m") > 0)
    st = st.select(category, *[F.when(ok, F.col(f"__c{i}") / F.col("__n")).alias(_rate_name(category, c))
                               for i, c in enumerate(classes)])
    return join_back(df, st, [category])


def oof_class_rates(df: DataFrame, category: str, label: str, fold: str,
                    classes: Sequence) -> DataFrame:
    """Out-of-fold rates of the named classes: for a row in fold f, counts from the other
    folds only, denominator = labelled rows of the category in those folds.

    Totals per (category, fold) and per category are partial aggregates;
    the other-fold count is total minus own fold.  No loop over folds.
    """
    lab = F.col(label)
    per = (df.filter(F.col(category).isNotNull()).groupBy(category, fold)
             .agg(F.count(lab).alias("__m"),
                  *[F.count(F.when(lab == F.lit(c), 1)).alias(f"__c{i}") for i, c in enumerate(classes)]))
    # Spark resolves names case-insensitively: totals get distinct names
    tot = per.groupBy(category).agg(F.sum("__m").alias("__tm"),
                                    *[F.sum(f"__c{i}").alias(f"__t{i}") for i in range(len(classes))])
    rates = per.join(tot, category).select(
        category, fold,
        *[F.try_divide((F.col(f"__t{i}") - F.col(f"__c{i}")).cast("double"), F.col("__tm") - F.col("__m"))
          .alias(_rate_name(category, c)) for i, c in enumerate(classes)])
    return join_back(df, rates, [category, fold])


def beta_smoothed_rate(df: DataFrame, success: str, tries: str, name: str = "bayes_rate") -> DataFrame:
    """``(alpha + C) / (alpha + beta + I)`` with alpha, beta fitted by moments
    of the per-row rates C/I (sample variance), one global aggregate."""
    r = F.col(success).cast("double") / F.col(tries)
    st = df.agg(F.avg(r).alias("mean"), F.var_samp(r).alias("var"))
    m, v = F.col("mean"), F.col("var")
    # fixed values of the moment fit: 1e-6 and 1.000001
    common = (m + 1e-6) * (1.000001 - m) / (v + 1e-6) - 1
    ab = st.select(((m + 1e-6) * common).alias("alpha"), ((1.000001 - m) * common).alias("beta"))
    (s,) = tmp_names(df, "ab")
    out = attach_scalar(df, ab, s)
    a, b = F.col(f"{s}.alpha"), F.col(f"{s}.beta")
    return out.withColumn(name, (a + F.col(success)) / (a + b + F.col(tries))).drop(s)
