"""Queries: pair mining family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.rows import row_nunique
from tessera.operators import mine
from tessera.plans.frames import line4
from tessera.plans.oracle_frames import with_frames
from tessera.plans.catalog.sqlutil import r6, spark_r6
from tessera.plans.registry import query
from tessera.sources.store import materialize

V = ["v1", "v2", "v3", "v4"]

_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT {a} AS first, {b} AS second FROM d" for a, b in mine.ordered_pairs(V))

_D = """d AS (SELECT DISTINCT v1, v2, v3, v4 FROM line4
  WHERE len(list_distinct([v1, v2, v3, v4])) > 2)"""


def _mine_sql(columns: str) -> str:
    """The mined lookup over the pair table ``p``."""
    return f"""SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY first ORDER BY pair_count DESC, rate DESC, second ASC) AS rn
  FROM (SELECT *, pair_count / sum(pair_count) OVER (PARTITION BY second) AS rate
        FROM (SELECT first, second, count(*) AS pair_count FROM p
              WHERE first IS NOT NULL AND second IS NOT NULL AND second <> 0
              GROUP BY first, second) c) s
  WHERE pair_count > 10) r
WHERE rn = 1"""


_MINED = _mine_sql(f"first, second, pair_count, {r6('rate')} AS rate")
MINE_SQL = with_frames(_MINED, "line4", extra=f"{_D},\np AS ({_PAIRS_SQL})")


@query("mine_pair_lookup", MINE_SQL)
def mine_pair_lookup(spark, sf_dir):
    """Flagship: per discount value, the value it most often co-occurs with."""
    out = mine.mine_pair_lookup(line4(spark, sf_dir), V, min_count=10)
    return out.withColumn("rate", spark_r6("rate"))


def _mined_rows(spark, sf_dir):
    rows = line4(spark, sf_dir).select(*V).distinct()
    return rows.filter(row_nunique(V) > 2)


def _counts(spark, sf_dir):
    return (mine.pair_stream(_mined_rows(spark, sf_dir), V)
                .groupBy("first", "second").agg(F.count(F.lit(1)).alias("pair_count")))


_C = """c AS (SELECT first, second, count(*) AS pair_count FROM p
  WHERE first IS NOT NULL AND second IS NOT NULL GROUP BY first, second)"""
_TAGGED = " UNION ALL ".join(
    f"SELECT {a} AS first, {b} AS second, '{a}_{b}' AS pair FROM d" for a, b in mine.ordered_pairs(V))
_PAIR_COLS = ", ".join(
    f"CAST(nullif(count(*) FILTER (WHERE pair = '{a}_{b}'), 0) AS BIGINT) AS {a}_{b}"
    for a, b in mine.ordered_pairs(V))


@query("pair_counts", with_frames(f"""
SELECT first, second, {_PAIR_COLS}, count(*) AS pair_count FROM pt
WHERE first IS NOT NULL AND second IS NOT NULL GROUP BY first, second""",
                                  "line4", extra=f"{_D},\npt AS ({_TAGGED})"))
def pair_counts(spark, sf_dir):
    """Count table of every ordered column pair, one column per pair (the
    12-way full outer join chain as one union + group-by)."""
    return mine.pair_counts(_mined_rows(spark, sf_dir), V)


@query("top1_per_key", with_frames("""
SELECT first, second, pair_count FROM (
  SELECT *, row_number() OVER (PARTITION BY first ORDER BY pair_count DESC, second ASC) AS rn FROM c) t
WHERE rn = 1""", "line4", extra=f"{_D},\np AS ({_PAIRS_SQL}),\n{_C}"))
def top1_per_key(spark, sf_dir):
    """Per first value: the most frequent second value (smallest on ties)."""
    return mine.top1_per_key(_counts(spark, sf_dir), "first", "second",
                             [F.col("pair_count"), -F.col("second")])


@query("share_of_group", with_frames(f"""
SELECT first, second, pair_count, {r6('pair_count / sum(pair_count) OVER (PARTITION BY second)')} AS rate
FROM c""", "line4", extra=f"{_D},\np AS ({_PAIRS_SQL}),\n{_C}"))
def share_of_group(spark, sf_dir):
    """Share of each pair count in the total of its second value."""
    out = mine.share_of_group(_counts(spark, sf_dir), "pair_count", "second", "rate")
    return out.withColumn("rate", spark_r6("rate"))


@query("filter_support", with_frames("""
SELECT first, second, pair_count FROM c WHERE pair_count > 10""",
                                     "line4", extra=f"{_D},\np AS ({_PAIRS_SQL}),\n{_C}"))
def filter_support(spark, sf_dir):
    """Pairs whose support exceeds 10 (HAVING on the count table)."""
    return mine.filter_support(_counts(spark, sf_dir), "pair_count", 10)


@query("row_nunique", with_frames("""
SELECT l_orderkey, CAST(len(list_distinct([v1, v2, v3, v4])) AS INTEGER) AS nunique FROM line4""", "line4"))
def row_nunique_q(spark, sf_dir):
    """Distinct non-null values across v1..v4 of each row."""
    return line4(spark, sf_dir).select("l_orderkey", row_nunique(V).alias("nunique"))


_LOOKUP_JOINS = "\n".join(
    f"LEFT JOIN lk AS k{i} ON l.{c} = k{i}.first" for i, c in enumerate(V))
_LOOKUP_COLS = ", ".join(f"k{i}.second AS {c}_most" for i, c in enumerate(V))


_MINE_BODY = _mine_sql("first, second")


@query("lookup_most", with_frames(f"""
SELECT l.l_orderkey, l.v1, l.v2, l.v3, l.v4, {_LOOKUP_COLS}
FROM line4 l
{_LOOKUP_JOINS}""", "line4", extra=f"{_D},\np AS ({_PAIRS_SQL}),\nlk AS ({_MINE_BODY})"))
def lookup_most(spark, sf_dir):
    """Each of v1..v4 looked up in the mined lookup (``<col>_most``)."""
    # line4 feeds both the mining and the joined side, and the lookup is read
    # once per looked-up column: each is written once
    l4 = materialize(line4(spark, sf_dir), "line4")
    lk = materialize(mine.mine_pair_lookup(l4, V, min_count=10), "lookup")
    return mine.lookup_most(l4, lk, V).select("l_orderkey", *V, *[f"{c}_most" for c in V])


def _sources(spark, sf_dir):
    """line4 rows split into three sources by order status (F train, O to
    score, P extra/old rows)."""
    from tessera.session import read_table
    l4 = line4(spark, sf_dir)
    st = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    j = l4.join(st, "l_orderkey")
    return [j.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("F", "O", "P")]


_SRC_SQL = """src AS (
  SELECT l.*, CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS s
  FROM line4 l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus IN ('F', 'O', 'P')),
kept AS (SELECT v1, v2, v3, v4 FROM (
  SELECT *, row_number() OVER (PARTITION BY v1, v2, v3 ORDER BY s, l_orderkey, chunk) AS rn FROM src) t WHERE rn = 1),
d AS (SELECT DISTINCT v1, v2, v3, v4 FROM kept WHERE len(list_distinct([v1, v2, v3, v4])) > 2)"""


@query("magic_lookup_with_old", with_frames(_MINED, "line4", extra=f"{_SRC_SQL},\np AS ({_PAIRS_SQL})"))
def magic_lookup_with_old(spark, sf_dir):
    """Lookup mined after deduplicating train ∪ to-score on (v1, v2, v3)
    (earlier source first) and adding the extra source the same way."""
    from tessera.plans import chains
    train, test, old = _sources(spark, sf_dir)
    _, inc = chains.magic_lookups(train, test, old, ["v1", "v2", "v3"], V, ["l_orderkey", "chunk"], min_count=10)
    return inc.withColumn("rate", spark_r6("rate"))
