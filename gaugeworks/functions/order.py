"""Whole numbers that order like the values they stand for."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeworks.functions.values import INF

# Fixed values of the double format: bits of the fraction, and the exponents of normal numbers.
FRACTION, LEAST_EXPONENT, BIAS = 52, -1022, 1023


def order_image(v: Column) -> Column:
    """A 64-bit whole number per double that keeps order; different doubles differ, zeros of both signs are one.

    Exponent and fraction come from exact multiplications by powers of two. Infinities lie outside all
    numbers and NaN above them, as Spark orders them. Null gives null.
    """
    v = v.cast("double")
    size = F.abs(v)
    guess = F.greatest(F.coalesce(F.floor(F.log2(F.when(size < F.lit(INF), size))), F.lit(LEAST_EXPONENT)), F.lit(LEAST_EXPONENT))
    scaled = size * F.pow(F.lit(2.0), -guess)  # the logarithm may be off by one next to a power of two
    exponent = guess + F.when(scaled >= 2, 1).when((scaled < 1) & (guess > LEAST_EXPONENT), -1).otherwise(0)
    fraction = (size * F.pow(F.lit(2.0), -exponent) * F.lit(float(1 << FRACTION))).cast("long")
    unit = F.lit(1 << FRACTION)
    bits = (F.when(F.isnan(v), F.lit(BIAS * 2 + 1) * unit + 1).when(size == F.lit(INF), F.lit(BIAS * 2 + 1) * unit)
            .otherwise((exponent + (BIAS - 1)) * unit + fraction))
    return F.when(v < 0, -bits).otherwise(bits)
