"""Preparing a feature table for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.operators.orderstats import number_rows
from plotstats.operators.skew import lookup_join
from plotstats.schemas import PLOT_COLUMNS

# More distinct values than this are numbered range by range, not in one sort.
MANY_LEVELS = 1_000_000


def feature_columns(columns: Sequence[str], key: str = "plot_id") -> list[str]:
    """All columns but the key, the plot columns (the aridity zone stays) and the vegetation share."""
    outside = (set(PLOT_COLUMNS) - {"Aridity_zone"}) | {key}
    return [c for c in columns if c not in outside and not c.startswith("veg_pc")]


def load_training(df: DataFrame, target: str = "tree_cover", cols: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """Complete, distinct rows; target and features only, and the row `key` that sampling, splitting and the rest need, if named."""
    cols = list(cols) if cols is not None else feature_columns(df.columns, key or "plot_id")
    kept = [c for c in (key, target) if c]
    return df.na.drop().dropDuplicates().select(*kept, *[c for c in cols if c not in kept])


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid="keep").transform(df)


def category_levels(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of `column` numbered from 0 in sorted order."""
    levels = df.where(F.col(column).isNotNull()).select(column).distinct()
    if levels.count() > MANY_LEVELS:
        return number_rows(levels, [column], name)
    return levels.withColumn(name, (F.row_number().over(Window.orderBy(column)) - 1).cast("bigint"))


def category_index(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Adds the code of the value among the sorted distinct values; NULL stays NULL."""
    name = name or f"{column}_index"
    return lookup_join(df, category_levels(df, column, name), [column], "left")


def one_hot_drop_first(df: DataFrame, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column per level except the alphabetically first, named `{column}_{level}`.

    Each level becomes a column, so this is for few levels, which are looked up unless given; `category_stages` takes any number.
    """
    if levels is None:
        levels = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect()]
    flags = [
        F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in sorted(levels)[1:]
    ]
    return df.select(*[c for c in df.columns if c != column], *flags)


def category_stages(columns: Sequence[str]) -> list:
    """Stages that turn each column into a sparse vector `{column}_vector`, one place per level in sorted order.

    Any number of levels; they are kept in the fitted stages, so a saved pipeline codes new rows alike. A level that
    was not seen when fitting, and NULL, is the vector of zeros.
    """
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep", stringOrderType="alphabetAsc") for c in columns]
    # the place that is dropped is the last, of unseen levels
    hot = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vector" for c in columns], dropLast=True)
    return [*index, hot] if columns else []


def min_max_scale(df: DataFrame, cols: Sequence[str], low: float = -1.0, high: float = 1.0) -> DataFrame:
    """Columns scaled to [low, high] over the whole table; a constant column becomes `low`."""
    ends = df.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    ends = ends.select(F.struct(*ends.columns).alias("ends")).scalar()

    def scaled(c: str) -> Column:
        lo, hi = ends[f"{c}_lo"], ends[f"{c}_hi"]
        width = F.when(hi == lo, 1.0).otherwise(hi - lo)
        return (F.col(c) - lo) / width * (high - low) + low

    return df.withColumns({c: scaled(c) for c in cols})


def to_byte_scale(x: Column) -> Column:
    """[-1, 1] to [0, 255]."""
    return x * (255.0 / 2) + 255.0 / 2


def from_byte_scale(x: Column) -> Column:
    """[0, 255] to [-1, 1]."""
    return (x - 255.0 / 2) / (255.0 / 2)
