"""Rounding and fixed-point text with the conventions the results are defined in.

Three conventions occur and they differ on ties:

* ``truncate2``        toward zero, two decimals;
* ``round_scaled``     scale, round to even, unscale (array-library rounding);
* ``round_exact``      decides on the exact binary value, ties to even (the rule of
                       a scripting language's ``round`` and of C's ``%.nf``). Spark's
                       ``round``/``bround``/``format_string`` decide on the shortest
                       decimal text instead, so 2.45 would be a tie for them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIGH_BITS, _LOW_BITS = 30, 31
_WHOLE_FROM = 2.0**53
#: Noise below this many decimals must not decide a tie or a truncation.
SNAP_DIGITS = 9


def snap(x: Column) -> Column:
    """Drop the summation-order noise in the last bits of an aggregate."""
    return F.round(x, SNAP_DIGITS)


def truncate2(x: Column) -> Column:
    """Keep two decimals, cutting toward zero."""
    return (x * 100).try_cast("long") / 100


def round_scaled(x: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def _units(magnitude: Column, digits: int) -> Column:
    """``magnitude * 10**digits`` as a bigint, exact ties going to the even unit.

    The fraction is scaled by 2**61, which keeps every bit of any fraction near a tie,
    and the decimal shift is done in integers (in two halves, to stay within 64 bits):
    nothing is rounded before the tie is decided.
    """
    if not 0 <= digits <= 2:
        raise ValueError("digits must be 0, 1 or 2")
    scale = F.lit(10**digits).cast("long")
    whole = F.floor(magnitude)
    fraction = F.floor((magnitude - whole) * float(2 ** (_HIGH_BITS + _LOW_BITS)))
    low = _last_bits(fraction, _LOW_BITS) * scale
    high = F.shiftright(fraction, _LOW_BITS) * scale + F.shiftright(low, _LOW_BITS)
    units = whole * scale + F.shiftright(high, _HIGH_BITS)
    rest = _last_bits(high, _HIGH_BITS) * 2**_LOW_BITS + _last_bits(low, _LOW_BITS)
    half = 2 ** (_HIGH_BITS + _LOW_BITS - 1)
    above = (rest > half) | ((rest == half) & (units % 2 == 1))
    return units + above.cast("long")


def _last_bits(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit(2**bits - 1).cast("long"))


def _fractional(x: Column) -> Column:
    """The magnitude where it can have a fraction, null where it cannot."""
    return F.when(F.abs(x) < _WHOLE_FROM, F.abs(x))


def round_exact(x: Column, digits: int) -> Column:
    rounded = F.signum(x) * _units(_fractional(x), digits) / float(10**digits)
    return F.coalesce(rounded, x)


def fixed_text(x: Column, digits: int) -> Column:
    """Text with exactly ``digits`` decimals, e.g. ``1.12`` for 1.125; null for null.

    Never fails: a number from 2**53 on has no fraction and is written as a whole number
    (exact up to 2**63, beyond in its shortest digits and zeros), others as inf and nan.
    """
    units = _units(_fractional(x), digits)
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    zeros = F.lit("." + "0" * digits if digits else "")
    exact = F.when(F.abs(x) < 2.0**63, F.abs(x)).try_cast("long").cast("string")
    shortest = F.regexp_replace(F.format_string("%.0f", F.abs(x)), r"\..*", "")
    large = F.concat(F.coalesce(exact, shortest), zeros)
    large = F.when(F.isnan(x), "nan").when(F.abs(x) == math.inf, "inf").otherwise(large)
    if digits == 0:
        small = units.cast("string")
    else:
        scale = F.lit(10**digits).cast("long")
        whole = F.floor(units / scale)
        decimals = F.lpad((units % scale).cast("string"), digits, "0")
        small = F.concat(whole.cast("string"), F.lit("."), decimals)
    return F.when(x.isNotNull(), F.concat(sign, F.coalesce(small, large)))
