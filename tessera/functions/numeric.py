"""Numeric feature expressions: ratios, differences, rounding, digit and
multiple-of flags.

Conventions (documented deviations from the pandas source):
* division by zero gives null, never ``inf``/``NaN`` (``try_divide``);
* ``%`` follows Python: floor modulo (``pmod``);
* rounding is half-to-even on ``x * 10^d`` like numpy (``rint``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.util import col


def ratio(a, b, eps: float = 0.0) -> Column:
    """``a / (b + eps)``; null when the divisor is 0 or either side is null."""
    b = col(b)
    den = b + F.lit(eps) if eps else b
    return F.try_divide(col(a), den)


def per_thousand_ratio(a, b) -> Column:
    """``a / 1000 / b``."""
    return F.try_divide(col(a) / F.lit(1000.0), col(b))


def delta(a, b) -> Column:
    return col(a) - col(b)


def total(a, b) -> Column:
    return col(a) + col(b)


def scaled_delta(a, b, k: float) -> Column:
    """``a - k*b``."""
    return col(a) - F.lit(k) * col(b)


def round_half_even(x, digits: int = 4) -> Column:
    """numpy ``round``: ``rint(x * 10^d) / 10^d``."""
    s = float(10 ** digits)
    return F.rint(col(x) * F.lit(s)) / F.lit(s)


def int_part(x, fill: float | None = -1) -> Column:
    """Truncating integer part after filling nulls (``fillna(fill).astype(int)``)."""
    x = col(x)
    if fill is not None:
        x = F.coalesce(x, F.lit(float(fill)))
    return x.cast("bigint")


def rounded_int(x, fill: float | None = 0) -> Column:
    """``round(x.fillna(fill)).astype(int)`` with half-to-even rounding."""
    x = col(x)
    if fill is not None:
        x = F.coalesce(x, F.lit(float(fill)))
    return F.rint(x).cast("bigint")


def cents(x) -> Column:
    """Integer cents of ``|x|`` as ``'%.2f'`` rounds it: the exact binary
    value of x, half-to-even only on exact ties.

    ``|x|*100`` is rounded once by the multiplication; when that lands
    exactly on ``k + 0.5`` the exact product lies on one side of it.  The
    rounding error is recovered exactly (Dekker's two-product with a Veltkamp
    split; 100 needs no split) and decides the side."""
    a = F.abs(col(x))
    p = a * F.lit(100.0)
    c = a * F.lit(134217729.0)          # 2^27 + 1
    hi = c - (c - a)
    lo = a - hi
    err = (hi * F.lit(100.0) - p) + lo * F.lit(100.0)   # p + err == |x| * 100 exactly
    fl = F.floor(p)
    tie = (p - fl) == F.lit(0.5)
    even_up = F.when(F.pmod(fl, F.lit(2)) == 1, F.lit(1)).otherwise(F.lit(0))
    up = F.when(err > 0, F.lit(1)).when(err < 0, F.lit(0)).otherwise(even_up)
    return F.when(tie, fl + up).otherwise(F.rint(p)).cast("bigint")


def money_digit(x, pos: int, fill: float = -1) -> Column:
    """Digit of ``'%.2f' % x``: pos 0 = hundredths (text[-1]), 1 = tenths
    (text[-2]), 2 = units (text[-4]); nulls are filled with ``fill`` first."""
    c = cents(F.coalesce(col(x), F.lit(float(fill))))
    return F.pmod(F.floor(c / F.lit(10 ** pos)), F.lit(10)).cast("int")


def tens(x, fill: float = -1) -> Column:
    """``x.fillna(fill) // 10`` (floor division)."""
    return F.floor(F.coalesce(col(x), F.lit(float(fill))) / F.lit(10.0)).cast("bigint")


def decimal_cents(x, fill: float = -1) -> Column:
    """``round((x - int(x)) * 100)`` with nulls → ``fill`` (truncating int part)."""
    x = col(x)
    ip = F.coalesce(x, F.lit(-1.0)).cast("bigint")
    return F.rint(F.coalesce((x - ip) * F.lit(100.0), F.lit(float(fill)))).cast("bigint")


def decimal_cents_from_round(x) -> Column:
    """``((round(x.fillna(0)) - x) * 100).fillna(0).astype(int)`` (truncating)."""
    x = col(x)
    r = F.rint(F.coalesce(x, F.lit(0.0)))
    return F.coalesce((r - x) * F.lit(100.0), F.lit(0.0)).cast("bigint")


def floor_mod(x, k) -> Column:
    """Python ``x % k`` (sign of the divisor)."""
    return F.pmod(col(x), F.lit(k))


def multiple_of(x, k) -> Column:
    """1 when ``x % k == 0`` and ``x != 0`` (floor modulo), else 0; null → 0."""
    x = col(x)
    return F.when((F.pmod(x, F.lit(k)) == 0) & (x != 0), F.lit(1)).otherwise(F.lit(0))


def nested_multiple(x, k1, k2) -> Column:
    """1 when ``x % k1 % k2 == 0`` and ``x != 0``."""
    x = col(x)
    return F.when((F.pmod(F.pmod(x, F.lit(k1)), F.lit(k2)) == 0) & (x != 0), F.lit(1)).otherwise(F.lit(0))


def overage(x, base: float = 600.0, period: float = 1000.0) -> Column:
    """``(x*100 - base) % period`` (floor modulo)."""
    return F.pmod(col(x) * F.lit(100.0) - F.lit(base), F.lit(period))


def is_zero(x) -> Column:
    return F.when(col(x) == 0, F.lit(1)).otherwise(F.lit(0))


def whole_seconds(m) -> Column:
    """Seconds between minutes ``m`` and the nearest whole minute:
    ``round((round(m) - m) * 60)`` (half-to-even)."""
    m = col(m)
    return F.rint((F.rint(m) - m) * F.lit(60.0)).cast("bigint")


def log_shift(x, shift: float = 2.0) -> Column:
    """``ln(x + shift)``; null where the argument is not positive."""
    a = col(x) + F.lit(float(shift))
    return F.when(a > 0, F.log(a))


def floor_band(x, k: float) -> Column:
    """``x // k`` (floor)."""
    return F.floor(col(x) / F.lit(float(k))).cast("bigint")


def trunc_band(x, k: float) -> Column:
    """``int(x / k)`` (truncation toward zero)."""
    return (col(x) / F.lit(float(k))).cast("bigint")
