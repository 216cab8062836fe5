"""Exact numeric helpers.

PostgreSQL rounds ``numeric`` half away from zero on the exact value.  Binary
doubles cannot do that reliably (``round(1.005, 2)``), so averages and ratios
are computed on integers: the numerator is an exact unscaled sum and the result
is the exactly rounded rational ``num / den``.  All of it stays in JVM
expressions (whole-stage codegen), no Python on the row path.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def ratio_units(num: Column, den: Column, dp: int) -> Column:
    """``round(num / den * 10**dp)`` half away from zero as a LONG; NULL if den <= 0.

    Computed on DECIMAL(38,0) so ``num * 10**dp`` cannot overflow a long.
    """
    a = num.cast("decimal(38,0)") * F.lit(10 ** dp).cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    x = F.abs(a) * 2 + d
    q = ((x - x % (d * 2)) / (d * 2)).cast("decimal(38,0)")
    return F.when(d > 0, F.when(a < 0, -q).otherwise(q).cast("long"))


def fixed(units: Column, scale: int, precision: int = 18) -> Column:
    """DECIMAL(precision, scale) from an integer count of ``10**-scale`` units (exact)."""
    step = Decimal(1).scaleb(-scale)
    return (units.cast("decimal(38,0)") * F.lit(step)).cast(f"decimal({precision},{scale})")


def round_ratio(num: Column, den: Column, dp: int) -> Column:
    """``round(num / den, dp)`` exactly, as DOUBLE (NULL when den <= 0)."""
    return ratio_units(num, den, dp) / F.lit(float(10 ** dp))


def unscaled(c: Column, scale: int) -> Column:
    """Exact integer ``c * 10**scale`` for a column holding at most ``scale`` digits."""
    return F.round(c.cast("decimal(38,10)") * F.lit(10 ** scale), 0).cast("long")


def avg_units(c: Column, in_scale: int, dp: int) -> Column:
    """Aggregate: ``ROUND(AVG(c), dp) * 10**dp`` as LONG, exact."""
    return ratio_units(F.sum(unscaled(c, in_scale)), F.count(c) * F.lit(10 ** in_scale), dp)


def avg_dec(c: Column, in_scale: int, dp: int, precision: int = 18) -> Column:
    """Aggregate: ``ROUND(AVG(c)::numeric, dp)`` as DECIMAL(precision, dp)."""
    return fixed(avg_units(c, in_scale, dp), dp, precision)


def round_dec(c: Column, dp: int, precision: int = 18) -> Column:
    """``ROUND(c::numeric, dp)`` for a decimal column (HALF_UP, exact)."""
    return F.round(c.cast("decimal(38,10)"), dp).cast(f"decimal({precision},{dp})")


def round_binary(d: Column, dp: int = 2) -> Column:
    """A non-negative double rounded to ``dp`` places by its exact binary value, ties to the even digit.

    The fraction is taken apart into 60 bits (exact: multiplying by powers of two loses nothing, and bits beyond are
    below any tie), and the rounding is done on integers.
    """
    big = "decimal(38,0)"
    whole = F.floor(d).cast(big)
    scaled = (d - F.floor(d)) * F.lit(2.0 ** 30)
    bits = F.floor(scaled).cast(big) * F.lit(2 ** 30).cast(big) + F.floor((scaled - F.floor(scaled)) * F.lit(2.0 ** 30)).cast(big)
    one = F.lit(2 ** 60).cast(big)
    n = bits.cast(big) * F.lit(10 ** dp).cast(big)
    rest = n % one
    units = (whole * F.lit(10 ** dp).cast(big) + ((n - rest) / one).cast(big)).cast(big)
    up = (rest * 2 > one) | ((rest * 2 == one) & (units % 2 == 1))
    return (units + F.when(up, 1).otherwise(0)).cast("double") / F.lit(float(10 ** dp))


def pct(x: Column, y: Column, dp: int = 2) -> Column:
    """Percentage ``x / y * 100`` in doubles, rounded to ``dp`` places half-even on the binary value; 0 for no rows."""
    return F.when(y.cast("long") > 0, round_binary(x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0)) * 100.0, dp)).otherwise(F.lit(0.0))


def epoch_micros(later: Column, earlier: Column) -> Column:
    """``EXTRACT(EPOCH FROM later - earlier)`` in whole microseconds (D13), exact.

    NTZ wall-clock values are read as UTC instants (the session zone is UTC).
    """
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def epoch_seconds(later: Column, earlier: Column) -> Column:
    """``EXTRACT(EPOCH FROM later - earlier)`` as fractional seconds (DOUBLE)."""
    return epoch_micros(later, earlier) / F.lit(1e6)
