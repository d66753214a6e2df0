"""Column expressions for guarded arithmetic and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_change_pct(now: Column, base: Column) -> Column:
    """``(now / base - 1) * 100``; null on a zero base."""
    return (F.try_divide(now, base) - F.lit(1)) * F.lit(100)


def diff_change_pct(now: Column, base: Column) -> Column:
    """``(now - base) / base * 100``; null on a zero base.

    Equal to ``ratio_change_pct`` on paper, but not in the last bits, so each
    operator keeps to one of the two.
    """
    return F.try_divide(now - base, base) * F.lit(100)


def share_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null on an empty whole."""
    return F.try_divide(part, whole) * F.lit(100)


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def valid_price(value: Column) -> Column:
    """Non-null, positive and not NaN (in Spark NaN counts as greater than 0)."""
    return is_number(value) & (value > 0)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over the pairs where both sides are present.

    ``corr`` raises on a flat series in ANSI mode; this gives null there, and
    null instead of NaN.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    result = F.try_divide(F.covar_pop(x, y), spread)
    return F.when(~F.isnan(result), result)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Standard score; centring only where the spread is zero."""
    return F.when(std == 0, value - mean).otherwise(F.try_divide(value - mean, std))


def round_even(value: Column, digits: int) -> Column:
    """Nearest decimal with ``digits`` places; a tie goes to the even digit.

    What counts is the exact binary value, as in Python's ``round``. ``bround``
    looks at the shortest decimal text instead and sees a tie in 2.675, which is
    below it. The scaled value is rounded, and its own rounding error, which two
    half-width products give exactly, decides where it shows a tie.
    """
    scale = float(10**digits)
    scaled = value * scale
    split = value * float(2**27 + 1)
    high = split - (split - value)
    error = (high * scale - scaled) + (value - high) * scale
    whole = F.rint(scaled)
    rest = scaled - whole
    step = (
        F.when((rest == 0.5) & (error > 0), F.lit(1.0))
        .when((rest == -0.5) & (error < 0), F.lit(-1.0))
        .otherwise(F.lit(0.0))
    )
    exact = F.abs(value) < 2.0**52 / scale
    return F.when(exact, (whole + step) / scale).otherwise(F.bround(value, digits))


def fixed_text(value: Column, digits: int) -> Column:
    """Decimal text with ``digits`` places, rounded half to even."""
    text = F.format_string(f"%.{digits}f", round_even(value, digits))
    return F.when(value.isNotNull(), text)


def signed_whole_text(value: Column) -> Column:
    """Whole number with its sign; a negative value that rounds to 0 is ``-0``."""
    rounded = round_even(value, 0)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when((value < 0) & (rounded == 0), F.lit("-0"))
        .otherwise(F.format_string("%+.0f", rounded))
    )


def to_33_bits(value: Column) -> Column:
    """Round a double to 33 significant bits, about 1e-10 of its size.

    Multiplying by 2**20 + 1 and subtracting cuts the low 20 bits. Results that
    are equal on paper but were summed in different orders become equal.
    """
    scaled = value * F.lit(float(2**20 + 1))
    return scaled - (scaled - value)
