"""Joins of points: by tolerance, by coordinates, to the nearest pixel, by chunk."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.operators.aggregates import grouped_stats
from plotstats.operators.skew import JOIN_SHARE, hot_groups, lookup_join
from plotstats.operators.tables import missing, point_coordinates

# Two coordinates agree when abs(a - b) <= ATOL + RTOL * abs(b) (fixed values).
ATOL = 1e-8
RTOL = 1e-5
# Side of the small cells; the tolerance is 1 in the scaled coordinate.
FINE = 0.25
# Slightly above 1: the scaled distance of two agreeing values is at most 1 / (1 - RTOL).
COARSE = 1.001


def tolerance(b: Column) -> Column:
    return ATOL + RTOL * F.abs(b)


def _scaled(x: Column) -> Column:
    """A coordinate in which the tolerance is about 1 everywhere (integral of 1 / tolerance)."""
    return F.signum(x) * F.log1p(F.abs(x) * (RTOL / ATOL)) / RTOL


def _agrees(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= tolerance(b)


# Deepest cells have side FINE / 8^DEPTH; a cell with more distinct points than LEAF is looked at through its 64 parts.
DEPTH = 6
LEAF = 64


def _cell(level: int) -> list[Column]:
    """Cell of a right point at `level`, as columns named alike at every level."""
    return [F.shiftright(c, 3 * (DEPTH - level)).alias(f"{c}{level}") for c in ("qx", "qy")]


def _depth(points: DataFrame, keys: list[str]) -> int:
    """Levels below the first until no cell holds more than LEAF points. One small count of the right side per level."""
    for level in range(DEPTH):
        most = points.groupBy(*keys, "bx", "by", *_cell(level)).count().agg(F.max("count")).first()[0]
        if (most or 0) <= LEAF:
            return level
    return DEPTH


def _relation(near: DataFrame) -> DataFrame:
    """Pairs of a left point and a cell that may agree, with `inside`: all points of the cell agree."""
    tests = []
    for x in ("lon", "lat"):
        lo, hi, v = F.col(f"b_{x}_lo"), F.col(f"b_{x}_hi"), F.col(f"a_{x}")
        least = ATOL + RTOL * F.when((lo <= 0) & (hi >= 0), 0.0).otherwise(F.least(F.abs(lo), F.abs(hi)))
        most = ATOL + RTOL * F.greatest(F.abs(lo), F.abs(hi))
        single = lo == hi
        inside = F.when(single, _agrees(v, lo)).otherwise(F.greatest(F.abs(v - lo), F.abs(v - hi)) <= least)
        apart = F.when(single, ~_agrees(v, lo)).otherwise((v < lo - most * 1.0000001) | (v > hi + most * 1.0000001))
        tests.append((inside, apart))
    (in_x, out_x), (in_y, out_y) = tests
    return near.where(~(out_x | out_y)).withColumn("inside", in_x & in_y)


def tolerance_matches(
    left: DataFrame,
    right: DataFrame,
    right_key: str,
    coords: tuple[str, str] = ("longitude", "latitude"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Per distinct left coordinate pair (and `by` columns, which must be equal): `matches`, the number of agreeing right rows, and, if
    it is one, its key. `right` holds one row per `right_key`.

    Equal coordinates are collapsed on both sides. Right points are counted per
    small cell; a cell entirely inside or outside the tolerance needs no look at its
    points, so a dense spot does not produce all pairs. On the border of the tolerance, a cell with many points is replaced by
    its 64 parts, again and again; only the points of border cells with few of them are compared one by one.
    """
    lon, lat = coords
    keys = list(by)
    a = (
        left.select(*keys, F.col(lon).alias("a_lon"), F.col(lat).alias("a_lat"))
        .where("a_lon is not null and a_lat is not null")
        .distinct()
        .withColumn("cx", F.floor(_scaled(F.col("a_lon")) / COARSE))
        .withColumn("cy", F.floor(_scaled(F.col("a_lat")) / COARSE))
    )
    one = [*keys, "a_lon", "a_lat"]
    finest = FINE / 8**DEPTH
    points = (
        right.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
        .groupBy(*keys, F.col(lon).alias("b_lon"), F.col(lat).alias("b_lat"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(right_key).alias("key"))
        .withColumns(
            {
                "bx": F.floor(_scaled(F.col("b_lon")) / COARSE),
                "by": F.floor(_scaled(F.col("b_lat")) / COARSE),
                "qx": F.floor(_scaled(F.col("b_lon")) / finest),
                "qy": F.floor(_scaled(F.col("b_lat")) / finest),
            }
        )
    )
    depth = _depth(points, keys)

    def cells(level: int) -> DataFrame:
        parent = _cell(level - 1) if level else []
        return points.groupBy(*keys, "bx", "by", *parent, *_cell(level)).agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("held"),
            F.min("key").alias("key"),
            *[f(c).alias(f"{c}_{s}") for c in ("b_lon", "b_lat") for s, f in (("lo", F.min), ("hi", F.max))],
        )

    neighbours = F.expr("inline(flatten(transform(array(-1L, 0L, 1L), i -> transform(array(-1L, 0L, 1L), j -> "
                        "struct(bx + i as cx, by + j as cy)))))")
    near = _relation(a.join(cells(0).select("*", neighbours), [*keys, "cx", "cy"]))
    found = []
    for level in range(depth + 1):
        names = ["bx", "by", f"qx{level}", f"qy{level}"]
        found.append(near.where("inside").select(*one, "n", "key"))
        border = near.where("not inside")
        leaves = border.where(F.col("held") <= LEAF) if level < depth else border
        compared = leaves.select(*one, *names).join(points.select(*keys, "bx", "by", *_cell(level), "b_lon", "b_lat", "n", "key"), [*keys, *names])
        agreeing = _agrees(F.col("a_lon"), F.col("b_lon")) & _agrees(F.col("a_lat"), F.col("b_lat"))
        found.append(compared.where(agreeing).select(*one, "n", "key"))
        if level < depth:
            near = _relation(border.where(F.col("held") > LEAF).select(*one, *names).join(cells(level + 1), [*keys, *names]))
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy(*one)
        .agg(F.sum("n").alias("matches"), F.min("key").alias("key"))
        .select(
            *keys,
            F.col("a_lon").alias(lon),
            F.col("a_lat").alias(lat),
            "matches",
            F.when(F.col("matches") == 1, F.col("key")).alias(right_key),
        )
    )


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    right_key: str,
    coords: tuple[str, str] = ("longitude", "latitude"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Left rows that agree with exactly one right row, with its columns; shared names get `_x`, `_y`.

    The joins are by distinct coordinates and by the right key; many left rows on one spot are split by adaptive skew handling.
    """
    matched = tolerance_matches(left, right, right_key, coords, by).where("matches = 1").drop("matches")
    matched = matched.withColumnRenamed(right_key, "_match")
    keyed = left.join(matched, [*by, *coords])
    return inner_join_suffix(keyed, right, "_match", right_key, hot=None).drop("_match")


def join_exports(exports: DataFrame, plots: DataFrame, plot_key: str = "plot_id", region: str | None = None) -> DataFrame:
    """Exported samples, placed by their geometry text `.geo`, with the one plot they agree with.

    With `region`, a column of both tables, samples only meet plots of their own region: exports and plots of all
    regions are joined in one job.
    """
    lon, lat = point_coordinates(F.col("`.geo`"))
    placed = exports.drop("system:index").withColumns({"longitude": lon, "latitude": lat})
    return tolerance_join(placed, plots, plot_key, by=[region] if region else [])


def tolerance_join_report(
    left: DataFrame,
    right: DataFrame,
    right_key: str,
    coords: tuple[str, str] = ("longitude", "latitude"),
    by: Sequence[str] = (),
) -> DataFrame:
    """All left rows with `matches`, the number of right rows they agree with, and `match_status` none, one or many."""
    counted = tolerance_matches(left, right, right_key, coords, by).drop(right_key)
    status = F.when(F.col("matches") == 1, "one").when(F.col("matches") > 1, "many").otherwise("none")
    joined = left.join(counted, [*by, *coords], "left")
    return joined.select(*left.columns, F.coalesce("matches", F.lit(0)).alias("matches"), status.alias("match_status"))


def inner_join_suffix(left: DataFrame, right: DataFrame, left_on: str, right_on: str, hot: DataFrame | None | bool = None) -> DataFrame:
    """Inner join of each left row with its one right row; columns of both sides get `_x` and `_y`.

    Rows of a frequent key are split by adaptive skew handling; `hot=True` looks for such keys first and sends their partners by broadcast.
    """
    shared = set(left.columns) & set(right.columns)
    a = left.select(*[F.col(f"`{c}`").alias(f"{c}_x" if c in shared else c) for c in left.columns])
    b = right.select(*[F.col(f"`{c}`").alias(f"{c}_y" if c in shared else c) for c in right.columns])
    a_key = f"{left_on}_x" if left_on in shared else left_on
    b_key = f"{right_on}_y" if right_on in shared else right_on
    joined = lookup_join(a.withColumn("_on", F.col(a_key)), b.withColumn("_on", F.col(b_key)), ["_on"], "inner", hot=hot)
    return joined.drop("_on")


def known_points(df: DataFrame, db: DataFrame, coords: Sequence[str] = ("longitude", "latitude")) -> DataFrame:
    return lookup_join(df, db, list(coords), "left_semi")


def new_points(df: DataFrame, db: DataFrame, coords: Sequence[str] = ("longitude", "latitude")) -> DataFrame:
    return lookup_join(df, db, list(coords), "left_anti")


def rest_split(full: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Rows of `full` that are not in `train`; `key` identifies a row."""
    return full.join(train.select(key), key, "left_anti")


def squared_distance(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """Squared distance in degrees."""
    return (lon - lon0) * (lon - lon0) + (lat - lat0) * (lat - lat0)


def with_distance(pixels: DataFrame, plots: DataFrame, key: str, hot: DataFrame | None | bool = True) -> DataFrame:
    """Pixels of a plot with `dist2` to its centre. `plots` has one row per `key`."""
    centres = plots.select(key, F.col("longitude").alias("_lon0"), F.col("latitude").alias("_lat0"))
    dist2 = squared_distance(F.col("longitude"), F.col("latitude"), F.col("_lon0"), F.col("_lat0"))
    return lookup_join(pixels, centres, [key], "inner", hot=hot).withColumn("dist2", dist2).drop("_lon0", "_lat0")


def nearest_pixels(pixels: DataFrame, plots: DataFrame, key: str) -> DataFrame:
    """All pixel rows at the smallest distance to their plot, ties included.

    The smallest distance is a plain aggregate, so a plot of any size needs no sort.
    """
    hot = hot_groups(pixels, [key], JOIN_SHARE)
    rows = with_distance(pixels, plots, key, hot)
    least = rows.groupBy(key).agg(F.min("dist2").alias("_least"))
    return lookup_join(rows, least, [key], "inner", hot=hot).where("dist2 = _least").select(*rows.columns)


def nearest_median_sd(pixels: DataFrame, plots: DataFrame, key: str, bands: Sequence[str]) -> DataFrame:
    """Median and sample deviation (NULL for one value) of the nearest pixels of each plot."""
    wanted = {b: ("median", b) for b in bands} | {f"{b}_sd": ("stddev_samp", b) for b in bands}
    return grouped_stats(nearest_pixels(pixels, plots, key), [key], wanted)


def chunk_key(index: Column, last: int, size: int = 10) -> Column:
    """Number of the file that holds row `index`: files are named by their last row."""
    return F.least(F.floor(index / size) * size + (size - 1), F.lit(last)).cast("bigint")


def chunk_key_join(df: DataFrame, index: str, chunks: DataFrame, chunk: str, size: int = 10) -> DataFrame:
    """Rows with the records of their chunk file.

    The last key is the largest index of `df`, so a chunk never serves more than
    `size` rows and the join grows with the records only.
    """
    last = df.agg(F.max(index)).first()[0]
    keyed = df.withColumn(chunk, chunk_key(F.col(index), last if last is not None else 0, size))
    return lookup_join(chunks, keyed, [chunk], "inner", per_key=size)


def nearest_run(
    points: DataFrame, index: str, chunks: DataFrame, chunk: str, line: str, run: int = 12, size: int = 10
) -> DataFrame:
    """The first record nearest to each point and its `run - 1` successors in the same file.

    `line` is the position of a record in its file.
    """
    named = points.select(index, F.col("longitude").alias("_lon0"), F.col("latitude").alias("_lat0"))
    pairs = chunk_key_join(named, index, chunks.select(chunk, line, "longitude", "latitude"), chunk, size)
    dist2 = squared_distance(F.col("longitude"), F.col("latitude"), F.col("_lon0"), F.col("_lat0"))
    # a record without coordinates is near to nothing
    pairs = pairs.where(dist2.isNotNull() & ~F.isnan(dist2))
    starts = pairs.groupBy(index, chunk).agg(F.min(F.struct(dist2.alias("d"), F.col(line).alias("at"))).alias("best"))
    lines = starts.select(index, chunk, F.explode(F.sequence(F.col("best.at"), F.col("best.at") + (run - 1))).alias(line))
    return lines.join(chunks, [chunk, line])


def null_run_count(runs: DataFrame, index: str, value: str, name: str = "no_burn") -> DataFrame:
    return runs.groupBy(index).agg(F.count_if(missing(runs, value)).alias(name))


def update_by_key(df: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Writes the non-null values of `updates` over those of the matching rows.

    Of several updates of one key, the row whose values sort last holds; rows never multiply.
    """
    values = [c for c in updates.columns if c not in keys]
    last = updates.groupBy(*keys).agg(F.max(F.struct(*[F.col(c).alias(f"_new_{c}") for c in values])).alias("_last"))
    renamed = last.select(*keys, "_last.*")
    joined = lookup_join(df, renamed, list(keys), "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"`_new_{c}`"), F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def zonal_reduce(pixels: DataFrame, plots: DataFrame, key: str, bands: Sequence[str]) -> DataFrame:
    """First (nearest to the centre, then smallest coordinates) and median value per plot."""
    rows = with_distance(pixels, plots, key)
    place = F.struct("dist2", "longitude", "latitude", *[F.coalesce(F.col(b).cast("double"), F.lit(0.0)) for b in bands])
    # a pixel without coordinates is never the first: an order that is null does not count
    place = F.when(F.col("dist2").isNotNull() & ~F.isnan("dist2"), place)
    first = rows.groupBy(key).agg(*[F.min_by(b, place).alias(f"{b}_first") for b in bands])
    med = grouped_stats(rows, [key], {f"{b}_median": ("median", b) for b in bands})
    return first.join(med, key)


def landsat_prepare(points: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Points with empty target columns for the median and the deviation of every band."""
    targets = [*bands, *[f"{b}_sd" for b in bands]]
    kept = [c for c in points.columns if c not in targets]
    return points.select(*kept, *[F.lit(None).cast("double").alias(c) for c in targets])


def populate_points(
    points: DataFrame,
    db: DataFrame,
    pixels: DataFrame,
    key: str,
    prepare: Callable[[DataFrame], DataFrame],
    aggregate: Callable[[DataFrame, DataFrame], DataFrame],
    coords: Sequence[str] = ("longitude", "latitude"),
) -> DataFrame:
    """Rows to append to `db`: new points, their target columns filled from the pixels around them.

    `aggregate` maps (pixels, points) to one row per `key`. All points run as one job.
    """
    fresh = prepare(new_points(points, db, coords))
    values = aggregate(pixels, fresh)
    targets = [c for c in values.columns if c != key]
    by_coords = (
        fresh.select(key, *coords)
        .join(values, key)
        .groupBy(*coords)
        .agg(F.max_by(F.struct(*targets), key).alias("last"))
        .select(*coords, "last.*")
    )
    return update_by_key(fresh, by_coords, list(coords))
