"""Robust statistics of groups: expression builders and a skew-safe grouped form."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.operators.orderstats import group_ranks, tally
from plotstats.operators.skew import group_census, join_groups, placed_by, split_hot
from plotstats.schemas import VEGETATION_CLASS


def stdev(x: str) -> Column:
    """Sample standard deviation, 0.0 for fewer than two values."""
    return F.coalesce(F.stddev_samp(x), F.lit(0.0))


def variance(x: str) -> Column:
    """Sample variance, 0.0 for fewer than two values."""
    return F.coalesce(F.var_samp(x), F.lit(0.0))


def mode(x: str) -> Column:
    """Most frequent value; NULL when several values are equally frequent."""
    first, last = f"mode() within group (order by `{x}`)", f"mode() within group (order by `{x}` desc)"
    return F.expr(f"case when {first} = {last} then {first} end")


def median(x: str) -> Column:
    return F.median(x)


def _quartile(x: str, p: float) -> Column:
    """Inverse distribution function, averaged where it jumps (no interpolation)."""
    return F.expr(
        f"(percentile_disc({p}) within group (order by `{x}`)"
        f" + percentile_disc({1 - p}) within group (order by `{x}` desc)) / 2"
    )


def lower_quartile(x: str) -> Column:
    return _quartile(x, 0.25)


def upper_quartile(x: str) -> Column:
    return _quartile(x, 0.75)


def veg_share(x: str) -> Column:
    """Share of the vegetation class among the non-null scene classes."""
    return F.try_divide(F.count_if(F.col(x) == VEGETATION_CLASS), F.count(x))


def veg_share_compat(x: str) -> Column:
    """The share divided as integers: 1 when all pixels are vegetation, 0 otherwise."""
    return F.expr(f"count_if(`{x}` = {VEGETATION_CLASS}) div nullif(count(`{x}`), 0)").cast("double")


STATS: Mapping[str, Callable[[str], Column]] = {
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "stdev": stdev,
    "variance": variance,
    "stddev_samp": F.stddev_samp,
    "mode": mode,
    "median": median,
    "lower_quartile": lower_quartile,
    "upper_quartile": upper_quartile,
    "veg_share": veg_share,
    "veg_share_compat": veg_share_compat,
}

# Quarters of the distribution below each order statistic.
QUARTERS = {"median": 2, "lower_quartile": 1, "upper_quartile": 3}


def _ranks(quarters: int) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """The two 1-based ranks to average among `n` values; equal unless n * quarters / 4 is whole."""
    return (
        lambda n: F.floor((n * quarters + 3) / 4),
        lambda n: F.floor(n * quarters / 4) + 1,
    )


# Column types whose values a DOUBLE holds exactly.
_NARROW = {"tinyint", "smallint", "int", "float", "double"}


def _kind(column_type: str) -> str:
    return "double" if column_type in _NARROW else column_type


def measured(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per input row and measure: keys, `_measure` (its number) and the value in `_x0`, `_x1`, ...

    There is one value column for each kind of type: numbers that a DOUBLE holds exactly share one, other types keep their own.
    """
    types = {c: _kind(df.schema[c].dataType.simpleString()) for c in columns}
    kinds = value_kinds(df, columns)

    def value(c: str, kind: str) -> Column:
        if types[c] != kind:
            return F.lit(None).cast(kind)
        # both zeros are one value
        return F.col(c).cast(kind) + 0.0 if kind == "double" else F.col(c)

    entries = [F.struct(F.lit(i).alias("_measure"), *[value(c, k).alias(f"_x{j}") for j, k in enumerate(kinds)]) for i, c in enumerate(columns)]
    return df.select(*keys, F.inline(F.array(*entries)))


def value_kinds(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return sorted({_kind(df.schema[c].dataType.simpleString()) for c in columns})


def _middle(low: Column, high: Column) -> Column:
    """Halves are taken as DOUBLE: the sum of two values may leave their own type."""
    return (low.cast("double") + high.cast("double")) / 2


def grouped_stats(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, str]], check_skew: bool = True
) -> DataFrame:
    """One row per group; `wanted` maps an output column to (statistic, input column).

    Order statistics and modes need all values of a group together. Ordinary groups
    are brought together once and sorted, which spills; nothing holds a group in memory. Groups too large for one task
    are tallied by value instead, so that no task ever holds a whole group. `check_skew=False` is for rows
    that are already placed by (a part of) the keys and known to have no large group.
    """
    keys = list(keys)
    whole = any(f in QUARTERS or f == "mode" for f, _ in wanted.values())
    if not whole:
        return df.groupBy(*keys).agg(*[STATS[f](x).alias(k) for k, (f, x) in wanted.items()])
    if not check_skew:
        return _cold_stats(df, keys, wanted)
    rows, hot = group_census(df, keys)
    values = rows * len({x for _, x in wanted.values()})
    if hot is None:
        return _cold_stats(placed_by(df, keys, values), keys, wanted)
    hot_rows, cold_rows = split_hot(df, keys, hot)
    cold = _cold_stats(placed_by(cold_rows, keys, values), keys, wanted)
    return cold.unionByName(_hot_stats(hot_rows, keys, wanted, cold))


def _cold_stats(rows: DataFrame, keys: list[str], wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Groups of bounded size: one sort by measure and value, the rank of each row in it, and plain aggregates."""
    columns = sorted({x for _, x in wanted.values()})
    kinds = value_kinds(rows, columns)
    long = measured(rows, keys, columns)
    values = [F.col(f"_x{j}") for j in range(len(kinds))]
    known = reduce(lambda a, b: a | b, [v.isNotNull() for v in values])
    return _from_runs(long.withColumn("_one", known.cast("int")), keys, wanted, rows, "_one", False)


def tallied_stats(counts: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, str]], like: DataFrame) -> DataFrame:
    """Order statistics and modes of groups given as run lengths: rows of `measured` with the number `n` of equal ones.

    `like` has the measured columns; only its types are read. Rows of one group must lie in one partition.
    """
    if any(f not in QUARTERS and f != "mode" for f, _ in wanted.values()):
        raise ValueError("only order statistics and modes can be taken from run lengths")
    return _from_runs(counts, list(keys), wanted, like, "n", True)


def _from_runs(
    long: DataFrame, keys: list[str], wanted: Mapping[str, tuple[str, str]], like: DataFrame, n: str, runs: bool
) -> DataFrame:
    columns = sorted({x for _, x in wanted.values()})
    kinds = value_kinds(like, columns)
    kind_of = {c: kinds.index(_kind(like.schema[c].dataType.simpleString())) for c in columns}
    group = Window.partitionBy(*keys, "_measure")
    ordered = group.orderBy(*[F.col(f"_x{j}").asc_nulls_last() for j in range(len(kinds))])
    used = {f for f, _ in wanted.values()}
    # of the rows without a value, which come last, none counts
    ranked = long.withColumns(
        {
            "_last": F.sum(n).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_total": F.sum(n).over(group),
        }
    )
    if "mode" in used:
        run = F.col(n) if runs else F.sum(n).over(ordered.rangeBetween(Window.currentRow, Window.currentRow))
        ranked = ranked.withColumn("_run", run).withColumn("_top", F.max("_run").over(group))

    def stat(f: str, x: str) -> Column:
        value = F.col(x)
        if f in QUARTERS:
            sides = [rank(F.col("_total")) for rank in _ranks(QUARTERS[f])]
            first, last = F.col("_last") - F.col(n), F.col("_last")
            return _middle(*[F.max(F.when((first < r) & (r <= last), value)) for r in sides])
        if f == "mode":
            top = (F.col("_run") == F.col("_top")) & (F.col(n) > 0)
            least, most = F.min(F.when(top, value)), F.max(F.when(top, value))
            return F.when(least == most, least)
        return STATS[f](x)

    pairs = sorted({(f, kind_of[x]) for f, x in wanted.values()})
    stats = ranked.groupBy(*keys, "_measure").agg(*[stat(f, f"_x{j}").alias(f"{f}_{j}") for f, j in pairs])
    wide = stats.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_measure") == columns.index(x), F.col(f"{f}_{kind_of[x]}"))).alias(k) for k, (f, x) in wanted.items()]
    )
    own = {k: like.schema[x].dataType for k, (f, x) in wanted.items() if f in ("min", "max", "mode")}
    return wide.select(*keys, *[F.col(k).cast(own[k]).alias(k) if k in own else F.col(k) for k in wanted])


def _hot_stats(
    rows: DataFrame, keys: list[str], wanted: Mapping[str, tuple[str, str]], like: DataFrame
) -> DataFrame:
    simple = {k: v for k, v in wanted.items() if v[0] not in QUARTERS and v[0] != "mode"}
    result = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[STATS[f](x).alias(k) for k, (f, x) in simple.items()])

    def tallies(stats: set[str]) -> list[tuple[dict[int, str], DataFrame]]:
        """The measures of each kind of type, by number, and their tally."""
        columns = sorted({x for f, x in wanted.values() if f in stats})
        out = []
        for kind in value_kinds(rows, columns) if columns else []:
            own = [c for c in columns if _kind(rows.schema[c].dataType.simpleString()) == kind]
            out.append((dict(enumerate(own)), tally(measured(rows, keys, own), [*keys, "_measure"], F.col("_x0"))))
        return out

    def side_by_side(long: DataFrame, stats: set[str], numbers: dict[int, str], value: Callable[[str], Column]) -> DataFrame:
        own = {x: i for i, x in numbers.items()}
        chosen = {k: (f, x) for k, (f, x) in wanted.items() if f in stats and x in own}
        wide = long.groupBy(*keys).agg(*[F.max(F.when(F.col("_measure") == own[x], value(f))).alias(k) for k, (f, x) in chosen.items()])
        # A group without any value of any measure is absent from `long`.
        return join_groups(result, wide, keys, "left")

    for numbers, counts in tallies(set(QUARTERS)):
        used = {f for f, x in wanted.values() if f in QUARTERS and x in numbers.values()}
        ranks = {f"{f}_{side}": _ranks(QUARTERS[f])[side] for f in used for side in (0, 1)}
        picked = group_ranks(counts, [*keys, "_measure"], ranks)
        result = side_by_side(picked, set(QUARTERS), numbers, lambda f: _middle(F.col(f"{f}_0"), F.col(f"{f}_1")))
    for numbers, counts in tallies({"mode"}):
        tops = (
            counts.groupBy(*keys, "_measure", "n")
            .agg(F.count(F.lit(1)).alias("ties"), F.min("value").alias("value"))
            .groupBy(*keys, "_measure")
            .agg(F.max_by(F.struct("ties", "value"), "n").alias("top"))
        )
        result = side_by_side(tops, {"mode"}, numbers, lambda _: F.when(F.col("top.ties") == 1, F.col("top.value")))
    return result.select(*[F.col(c).cast(like.schema[c].dataType) for c in like.columns])
