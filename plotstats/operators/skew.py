"""Finding and splitting groups that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotstats.session import materialize

# A group is hot when it holds more rows than both limits. The share also bounds the
# number of hot groups (at most 1 / share), so their keys can always be broadcast.
GROUP_SHARE = 1e-6
JOIN_SHARE = 1e-4
HOT_ROWS = 500_000
HOT_ROWS_CONF = "plotstats.hot.rows"

# A task sorts about so many values of ordinary groups.
TASK_VALUES = 1_000_000
TASK_VALUES_CONF = "plotstats.task.values"

# Largest table handed to broadcast() on the strength of a computed bound.
BROADCAST_BYTES = 64 * 1024 * 1024


def hot_groups(df: DataFrame, keys: Sequence[str], share: float = GROUP_SHARE) -> DataFrame | None:
    """Keys of the hot groups of `df`, or None when there is none.

    One pass over the key columns with map-side counts; the driver sees a single row.
    """
    return group_census(df, keys, share)[1]


def group_census(df: DataFrame, keys: Sequence[str], share: float = GROUP_SHARE) -> tuple[int, DataFrame | None]:
    """Number of rows of `df`, and its `hot_groups`, by the same pass."""
    floor = int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    census = counts.agg(F.sum("_n").alias("rows"), F.max("_n").alias("top")).first()
    rows = census["rows"] or 0
    limit = max(floor, share * rows)
    if (census["top"] or 0) <= limit:
        return rows, None
    return rows, materialize(counts.where(F.col("_n") > limit).select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))


def tasks_for(spark: SparkSession, values: int) -> int | None:
    """Number of tasks for `values` values that are sorted, None if the session's number of partitions is enough."""
    most = int(spark.conf.get(TASK_VALUES_CONF, str(TASK_VALUES)))
    tasks = -(-values // most)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def placed_by(df: DataFrame, keys: Sequence[str], values: int) -> DataFrame:
    """Rows partitioned by `keys`. The number of partitions grows with the number of `values` in the rows, so that no task
    is given more as the table grows."""
    tasks = tasks_for(df.sparkSession, values)
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the hot groups and all other rows; NULL keys form a group like any other."""
    small, on = F.broadcast(hot), _same(keys, "_hot_")
    return df.join(small, on, "left_semi"), df.join(small, on, "left_anti")


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys in which NULL equals NULL, as it does in GROUP BY."""
    rest = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"_grp_{k}") for k in keys], *rest)
    return left.join(renamed, _same(keys, "_grp_"), how).drop(*[f"_grp_{k}" for k in keys])


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    per_key: int = 1,
    hot: DataFrame | None | bool = True,
) -> DataFrame:
    """Join where `right` holds at most `per_key` rows per key and `left` may be skewed.

    Rows of hot left keys meet the few right rows of those keys by broadcast (at most
    per_key / JOIN_SHARE rows) and never travel; all others use an ordinary join.
    `hot` passes on the result of an earlier `hot_groups` for the same keys.
    """
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
        per_key = 1
    if hot is True:
        hot = hot_groups(left, keys, JOIN_SHARE)
    if hot is None:
        return left.join(right, keys, how)
    hot_left, cold_left = split_hot(left, keys, hot)
    hot_right = split_hot(right, keys, hot)[0]
    if per_key <= 100:
        hot_right = F.broadcast(hot_right)
    return cold_left.join(right, keys, how).unionByName(hot_left.join(hot_right, keys, how))
