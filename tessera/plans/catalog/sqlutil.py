"""Small SQL text helpers for the DuckDB twins."""

from __future__ import annotations

R6 = 6


def pmod(x: str, k) -> str:
    """Floor modulo with the same steps as Spark's ``pmod``."""
    return f"(CASE WHEN ({x}) % {k} < 0 THEN (({x}) % {k} + {k}) % {k} ELSE ({x}) % {k} END)"


def multiple(x: str, k) -> str:
    return f"(CASE WHEN {pmod(x, k)} = 0 AND ({x}) <> 0 THEN 1 ELSE 0 END)"


def rint(x: str) -> str:
    return f"round_even({x}, 0)"


def r6(x: str) -> str:
    """Round to 6 decimals with the same IEEE steps as :func:`spark_r6`."""
    return f"(round_even(({x}) * 1000000.0, 0) / 1000000.0)"


def spark_r6(c):
    """``rint(x * 1e6) / 1e6``: identical doubles in Spark and DuckDB (the
    engines' own ``round(x, 6)`` differ for large magnitudes)."""
    from pyspark.sql import functions as F
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * 1000000.0) / 1000000.0


def cents_sql(x):
    """SQL twin of ``numeric.cents`` on ``coalesce(x, -1)``."""
    a = f"abs(coalesce({x}, -1.0))"
    c = f"({a} * 134217729.0)"
    hi = f"({c} - ({c} - {a}))"
    err = f"(({hi} * 100.0 - {a} * 100.0) + ({a} - {hi}) * 100.0)"
    p = f"({a} * 100.0)"
    fl = f"floor({p})"
    up = f"(CASE WHEN {err} > 0 THEN 1 WHEN {err} < 0 THEN 0 WHEN {fl} % 2 = 1 THEN 1 ELSE 0 END)"
    return f"CAST(CASE WHEN {p} - {fl} = 0.5 THEN {fl} + {up} ELSE {rint(p)} END AS BIGINT)"
