"""Exact values at given ranks, without sorting a whole group in one task.

Rows are first tallied per distinct value (copies collapse on the map side). The interval that holds a wanted rank is
then narrowed: a sketch of the values inside it (approximate percentiles, merged from partial sketches of the map side) cuts it,
the pieces are counted exactly, and the piece with the rank takes its place, until no interval holds more values than
fit in a task. Only these last ones are sorted. The number of rounds grows with the logarithm of the largest group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.operators.skew import BROADCAST_BYTES, join_groups
from plotstats.session import materialize

# Cuts of an interval in one round.
CUTS = 64
# Distinct values that one task sorts.
SORT_ROWS = 1_000_000
SORT_ROWS_CONF = "plotstats.sort.rows"


def sort_rows(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get(SORT_ROWS_CONF, str(SORT_ROWS))))


def tally(df: DataFrame, groups: Sequence[str], value: Column) -> DataFrame:
    """One row per group and distinct non-null value, with its number of rows `n`."""
    return (
        df.select(*groups, value.alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*groups, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _small(df: DataFrame, rows: int, width: int) -> DataFrame:
    """A table of `rows` rows of about `width` bytes, sent to all tasks if that is little."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def _inside(counts: DataFrame, intervals: DataFrame, groups: list[str]) -> DataFrame:
    """The tallied rows of each interval: above `low`, not above `high`, NULL for an open end."""
    value = F.col("value")
    near = join_groups(counts, intervals, groups)
    return near.where((F.col("low").isNull() | (value > F.col("low"))) & (F.col("high").isNull() | (value <= F.col("high"))))


# Halving steps of a binary search among the cuts.
_STEPS = [CUTS >> i for i in range(1, CUTS.bit_length())]


def _cut(counts: DataFrame, wide: DataFrame, groups: list[str], rows: int) -> DataFrame:
    """Each interval replaced by those of its pieces that hold a wanted rank."""
    # NaN is above every number; it stays in the last piece
    plain = F.col("value") if counts.schema["value"].dataType.typeName() not in ("double", "float") else F.when(~F.isnan("value"), F.col("value"))
    points = [i / CUTS for i in range(1, CUTS)]
    interval = [*groups, "before"]
    inside = _inside(counts, _small(wide.drop("ranks", "held"), rows, 100), groups)
    # approximate, so written once: every later step must see the same cuts, also when a lost task is run again
    cuts = materialize(inside.groupBy(*interval).agg(F.array_distinct(F.percentile_approx(plain, points, 10_000)).alias("cuts")))
    at = F.reduce(
        F.array(*[F.lit(s) for s in _STEPS]),
        F.lit(0),
        lambda at, step: at + F.when(F.get("cuts", at + step - 1) < F.col("value"), step).otherwise(0),
    )
    placed = join_groups(inside, _small(cuts, rows, 8 * CUTS), interval, "left")
    pieces = placed.groupBy(*interval, at.alias("at")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("held"))
    # at most CUTS pieces of each interval from here on
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*interval).orderBy("at"))
    known = join_groups(join_groups(pieces.withColumn("upto", upto), wide.drop("held"), interval), cuts, interval)
    start = F.col("upto") - F.col("n")
    own = F.filter("ranks", lambda r: (r["rank"] > start) & (r["rank"] <= F.col("upto")))
    low = F.when(F.col("at") > 0, F.get("cuts", F.col("at") - 1)).otherwise(F.col("low"))
    high = F.coalesce(F.get("cuts", F.col("at")), F.col("high"))
    return known.select(*groups, low.alias("low"), high.alias("high"), start.alias("before"), "held", own.alias("ranks")).where(F.size("ranks") > 0)


def group_ranks(
    counts: DataFrame, groups: Sequence[str], ranks: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """One row per group with a column per entry of `ranks`: the value at that 1-based rank, NULL outside the group.

    `counts` comes from `tally`; each rank is a function of the group's number of rows. The result does not depend on the cuts.
    """
    groups = list(groups)
    limit = sort_rows(counts)
    # Read again in each round.
    counts = materialize(counts)
    kind = counts.schema["value"].dataType
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), f(F.col("total")).cast("bigint").alias("rank")) for k, f in ranks.items()])
    totals = counts.groupBy(*groups).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    open_ = F.lit(None).cast(kind)
    now = materialize(
        totals.select(*groups, open_.alias("low"), open_.alias("high"), F.lit(0).cast("bigint").alias("before"), "held", wanted.alias("ranks"))
    )
    narrow, most = [], None
    while True:
        size = now.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("held") > limit).alias("wide"), F.max("held").alias("most")).first()
        if most is not None and size["wide"] and size["most"] >= most:
            # values too close to each other for the sketch, which sees them as DOUBLE: they are sorted as they are
            limit = size["most"]
            size = {"all": size["all"], "wide": 0}
        narrow.append((now.where(F.col("held") <= limit), size["all"] - size["wide"]))
        if not size["wide"]:
            break
        most = size["most"]
        now = materialize(_cut(counts, now.where(F.col("held") > limit), groups, size["wide"]))
    last = reduce(DataFrame.unionByName, [t for t, _ in narrow])
    inside = _inside(counts, _small(last, sum(n for _, n in narrow), 200 + 16 * len(ranks)), groups)
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*groups, "before").orderBy("value"))
    return (
        inside.withColumn("last", upto)
        .select(*groups, "value", F.explode(F.filter("ranks", lambda r: (r["rank"] > F.col("last") - F.col("n")) & (r["rank"] <= F.col("last")))).alias("rank"))
        .groupBy(*groups)
        .agg(*[F.max(F.when(F.col("rank.name") == k, F.col("value"))).alias(k) for k in ranks])
    )


def global_ranks(counts: DataFrame, ranks: Callable[[Column], Mapping[str, Column]]) -> DataFrame:
    """Rows (name, value) for 1-based ranks over the whole table; ranks outside it give no row.

    `ranks` maps the column of the number of rows to the wanted ranks.
    """
    names = list(ranks(F.lit(0)))
    whole = counts.withColumn("_all", F.lit(0))
    found = group_ranks(whole, ["_all"], {k: (lambda n, k=k: ranks(n)[k]) for k in names})
    rows = F.array(*[F.struct(F.lit(k).alias("name"), F.col(f"`{k}`").alias("value")) for k in names])
    return found.select(F.inline(rows)).where("value is not null")


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Number all rows from 0 in the order of `order`, whose columns must identify a row.

    The rows are cut into ranges and written once; numbering then needs only the
    range sizes and a sort inside each range.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_held"))
    # One row per shuffle partition.
    starts = sizes.select(
        "_range", (F.sum("_held").over(Window.orderBy("_range")) - F.col("_held")).alias("_start")
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .select(F.col(name).cast("bigint"), *df.columns)
    )
