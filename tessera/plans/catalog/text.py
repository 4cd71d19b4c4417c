"""Queries: raw-text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.plans.frames import rawtext
from tessera.plans.oracle_frames import with_frames
from tessera.plans.registry import query
from tessera.session import read_table

_INT_RE = T.INT_TEXT


@query("lenient_cast", with_frames(f"""
SELECT o_orderkey, TRY_CAST(trim(fee) AS DOUBLE) AS fee_num,
       CASE WHEN regexp_matches(fee, '{_INT_RE}') THEN TRY_CAST(trim(fee) AS BIGINT) END AS fee_int
FROM rawtext""", "rawtext"))
def lenient_cast(spark, sf_dir):
    """Raw text → double and → whole-number int; junk and ``\\N`` → null."""
    r = rawtext(spark, sf_dir)
    return r.select("o_orderkey", T.lenient_double("fee").alias("fee_num"), T.lenient_int("fee").alias("fee_int"))


@query("have_0", with_frames("""
SELECT o_orderkey, CASE WHEN coalesce(ends_with(split_part(fee, '.', 2), '0'), false) THEN 0 ELSE 1 END AS have_0
FROM rawtext""", "rawtext"))
def have_0(spark, sf_dir):
    """0 when the fraction text ends in 0, else 1."""
    return rawtext(spark, sf_dir).select("o_orderkey", T.have_0("fee").alias("have_0"))


@query("decimal_length", with_frames("""
SELECT o_orderkey, CAST(CASE WHEN contains(fee, '.') THEN length(split_part(fee, '.', 2)) ELSE 0 END AS INTEGER) AS fee_len
FROM rawtext""", "rawtext"))
def decimal_length(spark, sf_dir):
    """Number of characters after the decimal point (0 without one)."""
    return rawtext(spark, sf_dir).select("o_orderkey", T.decimal_length("fee").alias("fee_len"))


@query("text_lengths", with_frames("""
SELECT o_orderkey, CAST(length(split_part(fee, '.', 1)) AS INTEGER) AS len_before,
       CAST(CASE WHEN contains(fee, '.') THEN length(split_part(fee, '.', 2)) END AS INTEGER) AS len_after
FROM rawtext""", "rawtext"))
def text_lengths(spark, sf_dir):
    """Text lengths before and after the decimal point."""
    r = rawtext(spark, sf_dir)
    return r.select("o_orderkey", T.len_before_decimal("fee").alias("len_before"),
                    T.len_after_decimal("fee").alias("len_after"))


@query("suffix_flags", with_frames("""
SELECT o_orderkey, CAST(ends_with(fee, '.00') AS INTEGER) AS ends_00, CAST(ends_with(fee, '.0') AS INTEGER) AS ends_0
FROM rawtext""", "rawtext"))
def suffix_flags(spark, sf_dir):
    """``.00`` / ``.0`` suffix flags of the raw text."""
    r = rawtext(spark, sf_dir)
    return r.select("o_orderkey", T.ends_with_00("fee").alias("ends_00"), T.ends_with_0("fee").alias("ends_0"))


@query("null_token", with_frames("""
SELECT o_orderkey, CASE WHEN fee <> '\\N' THEN fee END AS fee FROM rawtext""", "rawtext"))
def null_token(spark, sf_dir):
    """The raw null token replaced by null."""
    return rawtext(spark, sf_dir).select("o_orderkey", T.null_token("fee").alias("fee"))


_RECODE = {"1-URGENT": "0", "2-HIGH": "1"}


@query("recode", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '0' WHEN o_orderpriority = '2-HIGH' THEN '1'
                        WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS prio
FROM orders""")
def recode(spark, sf_dir):
    """Code table recode: two codes replaced, one nulled, others kept."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", T.recode("o_orderpriority", _RECODE, to_null=("5-LOW",)).alias("prio"))


def _first_match_sql(x: str, test) -> str:
    arms = " ".join(f"WHEN {test(x, t)} THEN {i}" for i, t in enumerate(T.TARIFFS))
    return f"CAST(CASE {arms} END AS INTEGER)"


_PARSE = lambda x: _first_match_sql(x, lambda v, t: f"{v} - {float(t)} >= 15.0")
_PARSE_MIN = lambda x: _first_match_sql(x, lambda v, t: f"abs({v} - {float(t)}) < 0.01")


@query("parse_fee", f"""
SELECT p_partkey, {_PARSE('CAST(p_size AS DOUBLE)')} AS size_parse,
       {_PARSE_MIN('CAST(p_size AS DOUBLE)')} AS size_parse_min,
       {_PARSE('p_retailprice / 50.0')} AS price_parse
FROM part""")
def parse_fee(spark, sf_dir):
    """Tariff index by first match (margin 15) and by exact match."""
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    return p.select("p_partkey", T.parse_fee(size).alias("size_parse"),
                    T.parse_fee_exact(size).alias("size_parse_min"),
                    T.parse_fee(F.col("p_retailprice") / 50.0).alias("price_parse"))
