"""Mathematical functions. A result that is not a finite number becomes NULL."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def _real(x: Column) -> Column:
    return x.cast("double")


def _checked(f):
    return lambda x: _finite(f(_real(x)))


acos, asin, atan = _checked(F.acos), _checked(F.asin), _checked(F.atan)
sin, cos, tan = _checked(F.sin), _checked(F.cos), _checked(F.tan)
sinh, cosh, tanh = _checked(F.sinh), _checked(F.cosh), _checked(F.tanh)
asinh, acosh, atanh = _checked(F.asinh), _checked(F.acosh), _checked(F.atanh)
exp, log, log10, sqrt = _checked(F.exp), _checked(F.ln), _checked(F.log10), _checked(F.sqrt)
degrees, radians = _checked(F.degrees), _checked(F.radians)


def atan2(y: Column, x: Column) -> Column:
    return _finite(F.atan2(_real(y), _real(x)))


def cot(x: Column) -> Column:
    """1 / tan(x); infinite at 0."""
    return F.when(_real(x) == 0, F.lit(float("inf"))).otherwise(_finite(F.try_divide(F.lit(1.0), F.tan(_real(x)))))


def coth(x: Column) -> Column:
    """1 / tanh(x); infinite at 0."""
    return F.when(_real(x) == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), F.tanh(_real(x))))


def power(x: Column, y: Column) -> Column:
    return _finite(F.pow(_real(x), _real(y)))


def sign(x: Column) -> Column:
    return F.signum(x)


def sign_whole(x: Column) -> Column:
    """Sign of a whole number, as a whole number."""
    return F.signum(x).cast("bigint")


def round_even(x: Column, digits: int) -> Column:
    """Rounds the scaled value to the even neighbour, as array libraries do."""
    scale = float(10**digits)
    return F.rint(_real(x) * scale) / scale


def square(x: Column) -> Column:
    """Whole numbers are squared in 64 bits; NULL beyond them."""
    return F.try_multiply(x * F.lit(1).cast("bigint"), x)


def ceil(x: Column) -> Column:
    return F.ceil(x).cast("bigint")


def floor(x: Column) -> Column:
    return F.floor(x).cast("bigint")


def pi() -> Column:
    return F.lit(math.pi)


def logit(t: Column) -> Column:
    """ln(t / (1 - t)), with 0 and 1 moved to 0.0001 and 0.9999 first (fixed values)."""
    inner = F.when(t == 0, 0.0001).when(t == 1, 0.9999).otherwise(t)
    return F.ln(inner / (1 - inner))


def inverse_logit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def clamp_cover(p: Column) -> Column:
    """Predicted cover limited to [0, 0.95]; NaN stays."""
    return F.when(F.isnan(p), p).when(p > 0.95, 0.95).when(p < 0, 0.0).otherwise(p)
