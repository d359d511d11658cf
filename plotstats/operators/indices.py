"""Spectral indices of band columns. A zero denominator gives NULL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def ndvi_b5(b5: Column, b8: Column) -> Column:
    """Seasonal form of the vegetation index, with B5 in the place of red."""
    return F.try_divide(b8 - b5, b8 + b5)


def ndvi(b4: Column, b8: Column) -> Column:
    return F.try_divide(b8 - b4, b8 + b4)


def endvi(b2: Column, b3: Column, b8: Column) -> Column:
    return F.try_divide(b8 + b3 - 2 * b2, b8 + b3 + 2 * b2)


def gdvi(b3: Column, b8: Column) -> Column:
    return b8 - b3


def msavi2(b4: Column, b8: Column) -> Column:
    b4, b8 = b4.cast("double"), b8.cast("double")
    base = 2 * b8 + 1
    return (base - F.sqrt(base * base - 8 * (b8 - b4))) * 0.5


def savi(b4: Column, b8: Column) -> Column:
    """Soil-adjusted index with L = 0.5."""
    return F.try_divide((b8 - b4) * 1.5, b8 + b4 + 0.5)


# Index name -> (function, bands it reads, in argument order).
SEASONAL_INDICES: Mapping[str, tuple[Callable[..., Column], tuple[str, ...]]] = {
    "NDVI": (ndvi_b5, ("B5", "B8")),
}
MONTHLY_INDICES: Mapping[str, tuple[Callable[..., Column], tuple[str, ...]]] = {
    "ENDVI": (endvi, ("B2", "B3", "B8")),
    "NDVI": (ndvi, ("B4", "B8")),
    "GDVI": (gdvi, ("B3", "B8")),
    "MSAVI2": (msavi2, ("B4", "B8")),
    "SAVI": (savi, ("B4", "B8")),
}
