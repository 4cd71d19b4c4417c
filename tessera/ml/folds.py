"""Fold assignment.

Folds are a pure function of the row key and a seed (md5 of ``key:seed``),
so they are reproducible across runs and executors and need no driver-side
index lists.  Stratified folds deal rows round-robin inside each class in
hash order; the in-class position comes from the rank index of ``keys``, so a
dominant class is numbered in as many parts as it fills rather than in a
single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import ordinal_within, tmp_names
from tessera.session import cut_lineage


def hash_text(key, seed) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))


def hash_bucket(key, k: int, seed=66) -> Column:
    """``first 32 bits of md5(key:seed) mod k``."""
    h = F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(k)).cast("int")


def kfold(df: DataFrame, key: str, k: int = 5, seed=66, name: str = "fold") -> DataFrame:
    """Shuffled k folds by hashing the row key."""
    return df.withColumn(name, hash_bucket(key, k, seed))


def group_folds(df: DataFrame, group: str, k: int = 5, seed=66, name: str = "fold") -> DataFrame:
    """All rows of a group share one fold (hash of the group key)."""
    return df.withColumn(name, hash_bucket(group, k, seed))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed=66, name: str = "fold") -> DataFrame:
    """Class-balanced folds: inside each class rows are ordered by
    ``md5(key:seed)`` (then key) and dealt to folds round-robin, so fold
    sizes per class differ by at most one."""
    (h,) = tmp_names(df, "h")
    d = df.withColumn(h, hash_text(key, seed))
    o = ordinal_within(d, [label], [F.col(h), F.col(key)], name)
    return o.withColumn(name, F.pmod(F.col(name), F.lit(k)).cast("int")).drop(h)


def random_split(df: DataFrame, key: str, n_sub: int = 2, seed=66, name: str = "sample") -> DataFrame:
    """``n_sub`` disjoint samples of about equal size (hash buckets)."""
    return df.withColumn(name, hash_bucket(key, n_sub, seed))


_BITS, _LEVELS = 15, 4  # of a 60-bit hash: four digits


def nth_hashes(hashes: DataFrame, ranks) -> list[int]:
    """For each 0-based rank a bound with exactly as many of the 60-bit numbers
    ``h`` below it, found digit by digit without a sort: a pass counts the next
    digit of the rows that share a bound's digits so far (at most 32,768 counts
    a bound).  Raises ValueError where equal numbers lie across a bound."""
    found, open_ = {}, {r: (0, r) for r in ranks}  # rank: digits so far, rank among the rows that have them
    for level in range(1, _LEVELS + 1):
        shift = _BITS * (_LEVELS - level)
        digits = F.shiftright("h", shift)
        rows = hashes if level == 1 else hashes.filter(F.shiftright("h", shift + _BITS).isin(sorted({p for p, _ in open_.values()})))
        counts = sorted(map(tuple, rows.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()))
        for rank, (prefix, left) in list(open_.items()):
            for d, n in counts:
                if d >> _BITS != prefix:
                    continue
                if left < n:
                    break
                left -= n
            if left == 0:
                found[rank] = d << shift
                del open_[rank]
            else:
                open_[rank] = (d, left)
        if not open_:
            return [found[r] for r in ranks]
    raise ValueError("rows with equal keys lie across the bound of a sample")


def equal_samples(df: DataFrame, key: str, n_sub: int = 2, seed=66, name: str = "sample") -> DataFrame:
    """``n_sub`` disjoint samples of exactly ``count // n_sub`` rows each, in
    the order of ``md5(key:seed)``; the rows that are left over go.  ``key``
    must be unique."""
    h = F.conv(F.substring(hash_text(key, seed), 1, _BITS * _LEVELS // 4), 16, 10).cast("bigint")
    hashes = cut_lineage(df.select(h.alias("h")), "hashes")
    n = hashes.count()
    size = n // n_sub
    if not size:
        return df.withColumn(name, F.lit(0)).limit(0)
    bounds = nth_hashes(hashes, [i * size for i in range(1, n_sub + 1) if i * size < n])
    sample = sum((F.when(h >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    return df.withColumn(name, sample).filter(F.col(name) < n_sub)


def training_rows_per_fold(df: DataFrame, fold: str, k: int) -> DataFrame:
    """Rows used to train and validate each fold.  Rows with fold -1 (extra
    rows appended to every training fold) are never validated."""
    per = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    folds = per.sparkSession.range(k).select(F.col("id").cast("int").alias(fold))
    j = folds.join(per, fold, "left").withColumn("n_valid", F.coalesce("n", F.lit(0)).cast("bigint"))
    j = j.withColumn("__t", total.select("total").scalar())
    return j.select(fold, (F.col("__t") - F.col("n_valid")).alias("n_train"), "n_valid")
