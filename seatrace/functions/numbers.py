"""Numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this, x * 10**digits is split exactly; from WHOLE on, a double has no fraction.
SPLIT_BELOW = 1e9
WHOLE = float(1 << 52)


def round_exact(x: Column, digits: int) -> Column:
    """Round a double by its exact binary value, exact ties to even.

    Spark's ``round`` and ``bround`` look at the shortest decimal text of the double, so
    2.675 (stored just below) goes up. Good for up to 6 digits. From SPLIT_BELOW on only the
    fraction is rounded; whole doubles, infinities and NaN stay as they are.
    """
    size = F.abs(x)
    whole = F.floor(x).cast("double")
    return (
        F.when(size < SPLIT_BELOW, _rounded(x, digits))
        .when(size < WHOLE, whole + _rounded(x - whole, digits))
        .otherwise(x)
    )


def _rounded(x: Column, digits: int) -> Column:
    """The product ``x * 10**digits`` is split into its double part and the exact rest; the
    rest decides what the double part shows as a tie."""
    scale = float(10**digits)
    product = x * scale
    spread = x * 134217729.0  # 2**27 + 1 cuts the 53-bit mantissa into two halves
    high = spread - (spread - x)
    rest = (high * scale - product) + (x - high) * scale
    below = F.floor(product).cast("double")
    part = product - below
    odd = F.pmod(below, F.lit(2.0)) == 1.0
    # rest > 0, or rest = 0 and odd, in one comparison: this expression is often inlined
    tie_goes_up = rest >= F.when(odd, 0.0).otherwise(1e-300)
    up = (part > 0.5) | ((part == 0.5) & tie_goes_up)
    return (below + F.when(up, 1.0).otherwise(0.0)) / scale
