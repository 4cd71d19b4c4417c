"""Text-column expressions (cleaning of raw, string-typed numeric columns).

All return a ``Column`` built from JVM-side Spark functions; nothing here
runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import col

# Fixed values that must equal the reference's for equal results:
# the raw-text null token and the plan tariff list used by the fee parser.
NULL_TOKEN = "\\N"
TARIFFS = [16, 26, 36, 46, 56, 66, 76, 106, 136, 166, 196, 296, 396, 596]

INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def null_token(c, token: str = NULL_TOKEN) -> Column:
    """``\\N`` (or another token) → null."""
    c = col(c)
    return F.when(c != F.lit(token), c)


def lenient_double(c) -> Column:
    """Text → double, anything unparsable → null."""
    return _try_cast(F.trim(col(c)), "double")


def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def lenient_int(c) -> Column:
    """Text → bigint only for whole-number text; ``'3.0'`` and junk → null.

    Python's ``int('3.0')`` fails, so the integer parser accepts digits only.
    """
    c = col(c)
    return F.when(c.rlike(INT_TEXT), _try_cast(F.trim(c), "bigint"))


def have_0(c) -> Column:
    """0 when the last character after the first ``.`` is ``0``; else 1.

    No dot, an empty fraction or a null value give 1.
    """
    c = col(c)
    frac = F.split_part(c, F.lit("."), F.lit(2))
    return F.when(F.coalesce(frac.endswith("0"), F.lit(False)), F.lit(0)).otherwise(F.lit(1))


def decimal_length(c) -> Column:
    """Characters after the first ``.`` of the text; no dot or null → 0."""
    c = col(c)
    return F.when(c.contains("."), F.length(F.split_part(c, F.lit("."), F.lit(2)))).otherwise(F.lit(0))


def len_before_decimal(c) -> Column:
    """Length of the text before the first ``.`` (whole text if no dot)."""
    c = col(c)
    return F.length(F.split_part(c, F.lit("."), F.lit(1)))


def len_after_decimal(c) -> Column:
    """Length after the first ``.``; null when there is no dot."""
    c = col(c)
    return F.when(c.contains("."), F.length(F.split_part(c, F.lit("."), F.lit(2))))


def ends_with_00(c) -> Column:
    """1 when the text ends in ``.00``, 0 otherwise, null for null."""
    c = col(c)
    return F.when(c.isNotNull(), c.endswith(".00").cast("int"))


def ends_with_0(c) -> Column:
    """1 when the text ends in ``.0``, 0 otherwise, null for null."""
    c = col(c)
    return F.when(c.isNotNull(), c.endswith(".0").cast("int"))


def recode(c, mapping: dict, to_null=(), passthrough: bool = True) -> Column:
    """Replace listed codes, null out ``to_null`` codes, keep the rest."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    for k in to_null:
        cond = c == F.lit(k)
        out = F.when(cond, F.lit(None)) if out is None else out.when(cond, F.lit(None))
    if out is None:
        return c
    return out.otherwise(c if passthrough else F.lit(None))


# Gender codes of the raw data.
GENDER_CODES = {"01": "0", "02": "1"}
GENDER_NULL = ("00",)


def parse_fee(x, tariffs=TARIFFS, margin: float = 15.0) -> Column:
    """Index of the first tariff ``t`` with ``x - t >= margin``; else null."""
    x = col(x)
    arr = F.array(*[F.lit(float(t)) for t in tariffs])
    hit = F.array_position(F.transform(arr, lambda t: x - t >= F.lit(margin)), True)
    return F.when(hit > 0, (hit - 1).cast("int"))


def parse_fee_exact(x, tariffs=TARIFFS, tol: float = 0.01) -> Column:
    """Index of the first tariff within ``tol`` of ``x``; else null."""
    x = col(x)
    arr = F.array(*[F.lit(float(t)) for t in tariffs])
    hit = F.array_position(F.transform(arr, lambda t: F.abs(x - t) < F.lit(tol)), True)
    return F.when(hit > 0, (hit - 1).cast("int"))
