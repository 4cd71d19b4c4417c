"""Queries: numeric features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.plans.catalog.sqlutil import cents_sql, multiple, pmod, r6, rint, spark_r6
from tessera.plans.frames import fees4
from tessera.plans.oracle_frames import with_frames
from tessera.plans.registry import query
from tessera.session import read_table

M = {i: f"(f{i} / 100.0)" for i in range(1, 5)}


def _money(spark, sf_dir):
    f = fees4(spark, sf_dir)
    return f.withColumns({f"m{i}": F.col(f"f{i}") / 100.0 for i in range(1, 5)})


def _r(c):
    return spark_r6(c)


@query("ratio_features", with_frames(f"""
SELECT c_custkey,
  {r6(f"{M[1]} / nullif({M[2]} + 0.1, 0)")} AS r12,
  {r6(f"{M[2]} / nullif({M[3]} + 0.1, 0)")} AS r23,
  {r6(f"{M[1]} / nullif({M[2]} + 0.00001, 0)")} AS r12_eps,
  {r6(f"{M[1]} / nullif({M[4]}, 0)")} AS r14,
  {r6(f"c_acctbal / 1000.0 / nullif({M[1]}, 0)")} AS acct_per_thousand
FROM fees4""", "fees4"))
def ratio_features(spark, sf_dir):
    """Ratios with additive epsilons, plain and per-thousand ratios."""
    f = _money(spark, sf_dir)
    return f.select("c_custkey",
                    _r(N.ratio("m1", "m2", 0.1)).alias("r12"), _r(N.ratio("m2", "m3", 0.1)).alias("r23"),
                    _r(N.ratio("m1", "m2", 0.00001)).alias("r12_eps"), _r(N.ratio("m1", "m4")).alias("r14"),
                    _r(N.per_thousand_ratio("c_acctbal", "m1")).alias("acct_per_thousand"))


@query("delta_features", with_frames(f"""
SELECT c_custkey,
  {r6(f"{M[4]} - {M[3]}")} AS d43, {r6(f"{M[1]} + {M[2]}")} AS s12, {r6(f"{M[1]} - 0.15 * {M[2]}")} AS k12,
  CAST(trunc(coalesce({rint(f"({M[4]} - {M[3]}) * 100")}, 999999.9)) AS BIGINT) AS d43_cents
FROM fees4""", "fees4"))
def delta_features(spark, sf_dir):
    """Differences, sums, scaled differences and rounded cent deltas."""
    f = _money(spark, sf_dir)
    cents = F.coalesce(F.rint((F.col("m4") - F.col("m3")) * 100.0), F.lit(999999.9)).cast("bigint")
    return f.select("c_custkey", _r(N.delta("m4", "m3")).alias("d43"), _r(N.total("m1", "m2")).alias("s12"),
                    _r(N.scaled_delta("m1", "m2", 0.15)).alias("k12"), cents.alias("d43_cents"))


@query("log_shift", with_frames(f"""
SELECT c_custkey, {r6(f"CASE WHEN {M[1]} + 2 > 0 THEN ln({M[1]} + 2) END")} AS log_m1,
  {r6("CASE WHEN c_acctbal / 100.0 + 2 > 0 THEN ln(c_acctbal / 100.0 + 2) END")} AS log_bal
FROM fees4""", "fees4"))
def log_shift(spark, sf_dir):
    """``ln(x + 2)``, null where the argument is not positive."""
    f = _money(spark, sf_dir)
    return f.select("c_custkey", _r(N.log_shift("m1")).alias("log_m1"),
                    _r(N.log_shift(F.col("c_acctbal") / 100.0)).alias("log_bal"))


@query("round4", f"""
SELECT c_custkey, round_even(c_acctbal / 7.0 * 10000.0, 0) / 10000.0 AS bal7,
       round_even(c_acctbal / 3.0 * 1000000.0, 0) / 1000000.0 AS bal3
FROM customer""")
def round4(spark, sf_dir):
    """Half-to-even rounding to 4 and 6 decimals."""
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", N.round_half_even(F.col("c_acctbal") / 7.0, 4).alias("bal7"),
                    N.round_half_even(F.col("c_acctbal") / 3.0, 6).alias("bal3"))


@query("int_part", with_frames(f"""
SELECT c_custkey, CAST(trunc(coalesce({M[4]}, -1.0)) AS BIGINT) AS m4_int,
  {pmod(f"CAST(trunc(coalesce({M[4]}, -1.0)) AS BIGINT)", 10)} AS m4_int_last,
  CAST({rint(f"coalesce({M[1]}, 0.0)")} AS BIGINT) AS m1_rounded
FROM fees4""", "fees4"))
def int_part(spark, sf_dir):
    """Truncated integer part (nulls → -1), its last digit, rounded int."""
    f = _money(spark, sf_dir)
    ip = N.int_part("m4", -1)
    return f.select("c_custkey", ip.alias("m4_int"), F.pmod(ip, F.lit(10)).alias("m4_int_last"),
                    N.rounded_int("m1", 0).alias("m1_rounded"))


@query("money_digits", with_frames(f"""
SELECT c_custkey,
  CAST({pmod(cents_sql(M[1]), 10)} AS INTEGER) AS m1_d0,
  CAST({pmod(f"CAST(floor({cents_sql(M[1])} / 10) AS BIGINT)", 10)} AS INTEGER) AS m1_d1,
  CAST({pmod(f"CAST(floor({cents_sql(M[1])} / 100) AS BIGINT)", 10)} AS INTEGER) AS m1_d2,
  CAST({pmod(cents_sql(M[4]), 10)} AS INTEGER) AS m4_d0,
  CAST({pmod(f"CAST(floor({cents_sql(M[4])} / 100) AS BIGINT)", 10)} AS INTEGER) AS m4_d2,
  CAST(floor(coalesce({M[4]}, -1.0) / 10.0) AS BIGINT) AS m4_tens
FROM fees4""", "fees4"))
def money_digits(spark, sf_dir):
    """Digits of the two-decimal text of an amount and its tens."""
    f = _money(spark, sf_dir)
    return f.select("c_custkey", N.money_digit("m1", 0).alias("m1_d0"), N.money_digit("m1", 1).alias("m1_d1"),
                    N.money_digit("m1", 2).alias("m1_d2"), N.money_digit("m4", 0).alias("m4_d0"),
                    N.money_digit("m4", 2).alias("m4_d2"), N.tens("m4").alias("m4_tens"))


_DEC = f"CAST({rint(f'coalesce(({M[4]} - CAST(trunc(coalesce({M[4]}, -1.0)) AS BIGINT)) * 100.0, -1.0)')} AS BIGINT)"
_DEC2 = f"CAST(trunc(coalesce(({rint(f'coalesce({M[3]}, 0.0)')} - {M[3]}) * 100.0, 0.0)) AS BIGINT)"


@query("decimal_digits", with_frames(f"""
SELECT c_custkey, dec, CASE WHEN dec = 0 THEN 1 ELSE 0 END AS dec_is_0,
  CASE WHEN {pmod('dec', 5)} = 0 THEN 1 ELSE 0 END AS dec_is_5,
  {pmod('dec', 10)} AS dec_last, CAST(floor(dec / 5) AS BIGINT) AS dec_div5, dec2
FROM (SELECT c_custkey, {_DEC} AS dec, {_DEC2} AS dec2 FROM fees4) t""", "fees4"))
def decimal_digits(spark, sf_dir):
    """Cents of the fraction and their digit flags."""
    f = _money(spark, sf_dir)
    dec = N.decimal_cents("m4")
    g = f.select("c_custkey", dec.alias("dec"), N.decimal_cents_from_round("m3").alias("dec2"))
    return g.select("c_custkey", "dec", N.is_zero("dec").alias("dec_is_0"),
                    F.when(F.pmod("dec", F.lit(5)) == 0, 1).otherwise(0).alias("dec_is_5"),
                    F.pmod("dec", F.lit(10)).alias("dec_last"), N.floor_band("dec", 5).alias("dec_div5"), "dec2")


_KS = [1, 0.1, 5, 10, 15, 27, 30, 50, 100, 500, 512, 1024, 6000]


def _kname(k):
    return str(k).replace(".", "_")


@query("multiple_flags", f"""
SELECT event_id, {", ".join(f"{multiple('value', float(k))} AS is_{_kname(k)}" for k in _KS)},
  CASE WHEN {pmod(pmod('value', 512.0), 50.0)} = 0 AND value <> 0 THEN 1 ELSE 0 END AS is_512_50
FROM events""")
def multiple_flags(spark, sf_dir):
    """Multiple-of-k flags (floor modulo, zero excluded) and a nested one."""
    e = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select("event_id", *[N.multiple_of(v, float(k)).alias(f"is_{_kname(k)}") for k in _KS],
                    N.nested_multiple(v, 512.0, 50.0).alias("is_512_50"))


_EXTRA = pmod(f"{M[1]} * 100.0 - 600.0", 1000.0)


@query("overage_rate", with_frames(f"""
SELECT c_custkey, {r6('extra')} AS extra, {multiple('extra', 27.0)} AS per27, {multiple('extra', 15.0)} AS per15
FROM (SELECT c_custkey, {_EXTRA} AS extra FROM fees4) t""", "fees4"))
def overage_rate(spark, sf_dir):
    """``(x*100 - 600) % 1000`` and its multiple-of-27/15 flags."""
    f = _money(spark, sf_dir).select("c_custkey", N.overage("m1").alias("extra"))
    return f.select("c_custkey", _r(F.col("extra")).alias("extra"),
                    N.multiple_of("extra", 27.0).alias("per27"), N.multiple_of("extra", 15.0).alias("per15"))


@query("whole_seconds", f"""
SELECT event_id, sec, CASE WHEN sec = 0 AND value <> 0 THEN 1 ELSE 0 END AS sec_is_int
FROM (SELECT event_id, value, CAST({rint(f"({rint('value')} - value) * 60.0")} AS BIGINT) AS sec FROM events) t""")
def whole_seconds(spark, sf_dir):
    """Seconds to the nearest whole minute and a whole-minute flag."""
    e = read_table(spark, sf_dir, "events")
    s = N.whole_seconds("value")
    return e.select("event_id", s.alias("sec"),
                    F.when((s == 0) & (F.col("value") != 0), 1).otherwise(0).alias("sec_is_int"))


@query("floor_bands", """
SELECT p_partkey, CAST(floor(p_size / 3.0) AS BIGINT) AS b3, CAST(floor(p_size / 6.0) AS BIGINT) AS b6,
  CAST(floor((p_size - 25) / 10.0) AS BIGINT) AS b10_floor, CAST(trunc((p_size - 25) / 10.0) AS BIGINT) AS b10_trunc
FROM part""")
def floor_bands(spark, sf_dir):
    """Floor-division bands and truncating bands."""
    p = read_table(spark, sf_dir, "part")
    s = F.col("p_size")
    return p.select("p_partkey", N.floor_band(s, 3).alias("b3"), N.floor_band(s, 6).alias("b6"),
                    N.floor_band(s - 25, 10).alias("b10_floor"), N.trunc_band(s - 25, 10).alias("b10_trunc"))
