"""Scores of a result, and what is read off predictions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the exponent of the second formula.
EXPONENT = 1.25


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b with infinity and NaN where the divisor is 0, as floating-point division has them."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(b != 0, F.try_divide(a, b)).when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).when(a == 0, F.lit(float("nan")))


def live_score(s1: Column, s2: Column) -> Column:
    """1 / (1 + e^(1 - s1/s2)), mirrored below a half; 0 to 0 is null. The two sides' scores sum to 1."""
    one = 1 / (1 + F.exp(1 - safe_ratio(s1, s2)))
    other = 1 - 1 / (1 + F.exp(1 - safe_ratio(s2, s1)))
    return F.nanvl(F.when(one < 0.5, other).otherwise(one), F.lit(None))


def notebook_score(s1: Column, s2: Column) -> Column:
    """With the exponent on the exponential above a half and on the ratio below; 0 to 0 is null."""
    one = 1 / (1 + F.pow(F.exp(1 - safe_ratio(s1, s2)), F.lit(EXPONENT)))
    other = 1 - 1 / (1 + F.exp(1 - F.pow(safe_ratio(s2, s1), F.lit(EXPONENT))))
    return F.nanvl(F.when(one < 0.5, other).otherwise(one), F.lit(None))


def stated_score(s1: Column, s2: Column) -> Column:
    """(1 / (1 + e^(-s1/s2))) to the power 1.25: the formula as it is stated, which neither of the others is; 0 to 0 is null."""
    return F.nanvl(F.pow(1 / (1 + F.exp(-safe_ratio(s1, s2))), F.lit(EXPONENT)), F.lit(None))


def binary(x: Column) -> Column:
    """1 above a half, else 0."""
    return (x > 0.5).cast("int")


def in_band(p: Column, margin: Column) -> Column:
    """Whether a prediction is further than the margin from a half; with no margin, always."""
    return (margin == 0) | (p > 0.5 + margin) | (p < 0.5 - margin)


def huber(error: Column, delta: float = 1.0) -> Column:
    return F.when(F.abs(error) <= delta, 0.5 * error * error).otherwise(delta * (F.abs(error) - 0.5 * delta))


def percent(p: Column) -> Column:
    """Of a chance, to two decimals, ties to even."""
    return F.bround(p * 100, 2)


def three(p: Column) -> Column:
    return F.bround(p, 3)
