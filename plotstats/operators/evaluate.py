"""Error measures of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.functions.math import clamp_cover, inverse_logit
from plotstats.operators.orderstats import global_ranks, tally
from plotstats.operators.sampling import uniform


def back_transform(df: DataFrame, target: str, prediction: str, transformed: bool = True) -> DataFrame:
    """Adds `y` and `p` (clamped) on the cover scale and `diff`, the error before clamping."""
    y, p = F.col(target).cast("double"), F.col(prediction).cast("double")
    if transformed:
        y, p = inverse_logit(y), inverse_logit(p)
    return df.withColumns({"y": y, "p": clamp_cover(p), "diff": p - y})


def _weight(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1.0)


def rmse(df: DataFrame, weight: str | None = None) -> DataFrame:
    w = _weight(weight)
    error = F.col("y") - F.col("p")
    return df.agg(F.sqrt(F.sum(w * error * error) / F.sum(w)).alias("rmse"))


def r2(df: DataFrame, weight: str | None = None) -> DataFrame:
    w = _weight(weight)
    mean = df.agg(F.sum(w * F.col("y")) / F.sum(w)).scalar()
    error, spread = F.col("y") - F.col("p"), F.col("y") - mean
    return df.select(w.alias("w"), error.alias("e"), spread.alias("s")).agg(
        (1 - F.try_divide(F.sum(F.col("w") * F.col("e") * F.col("e")), F.sum(F.col("w") * F.col("s") * F.col("s")))).alias("r2")
    )


def mae(df: DataFrame) -> DataFrame:
    """Mean absolute error of the unclamped predictions."""
    return df.agg(F.avg(F.abs("diff")).alias("mae"))


def error_deciles(df: DataFrame) -> DataFrame:
    """Exact order statistics of the absolute error: percent 0, 10, ..., 90 (50 is the median)."""
    counts = tally(df, [], F.abs(F.col("diff")))
    picked = global_ranks(counts, lambda n: {str(i): F.floor(n * i / 100) + 1 for i in range(0, 100, 10)})
    return picked.select(F.col("name").cast("int").alias("percent"), F.col("value").alias("abs_error"))


def bucket_mae(df: DataFrame) -> DataFrame:
    """Mean absolute error per tenth of the target, both bounds excluded; empty tenths are absent.

    The bounds are i / 10 and i / 10 + 0.1 in floating point, so they may overlap slightly.
    """
    y = F.col("y")
    near = F.floor(y * 10).cast("int")
    tenths = F.filter(
        F.array(near - 1, near, near + 1),
        lambda i: (i >= 0) & (i <= 9) & (i / 10 < y) & (y < i / 10 + 0.1),
    )
    rows = df.where(y.isNotNull()).select(F.explode(tenths).alias("bucket"), F.abs("diff").alias("e"))
    return rows.groupBy("bucket").agg(F.avg("e").alias("mae"), F.count(F.lit(1)).alias("n"))


def report(df: DataFrame, weight: str | None = None) -> DataFrame:
    """RMSE, R2 and mean absolute error in one row, in one pass besides the mean of the target."""
    w = _weight(weight)
    mean = df.agg(F.sum(w * F.col("y")) / F.sum(w)).scalar()
    rows = df.select(w.alias("w"), (F.col("y") - F.col("p")).alias("e"), (F.col("y") - mean).alias("s"), "diff")
    squares = F.sum(F.col("w") * F.col("e") * F.col("e"))
    return rows.agg(
        F.sqrt(squares / F.sum("w")).alias("rmse"),
        (1 - F.try_divide(squares, F.sum(F.col("w") * F.col("s") * F.col("s")))).alias("r2"),
        F.avg(F.abs("diff")).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def predict_baseline(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Uniform random predictions in [0, 1), repeatable by key."""
    return df.withColumn("prediction", uniform(F.col(key), seed))
