"""Two-level statistics: observations -> per-pixel medians -> per-plot statistics."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.functions.math import round_even
from plotstats.operators.aggregates import grouped_stats, measured, tallied_stats
from plotstats.operators.indices import MONTHLY_INDICES, SEASONAL_INDICES
from plotstats.operators.observations import Season, clear_sky, in_days, with_season, year_month
from plotstats.operators.skew import group_census, placed_by, split_hot
from plotstats.schemas import BANDS, DIFF_STATS, MONTHLY_BANDS, MONTHLY_STATS, SEASONAL_STATS, TRAINING_BANDS
from plotstats.session import materialize

PIXEL = ["id", "longitude", "latitude"]
DIGITS = 5

Indices = Mapping[str, tuple[Callable[..., Column], tuple[str, ...]]]


def level_columns(bands: Sequence[str], indices: Indices, scene_class: bool) -> tuple[list[str], list[str]]:
    """Bands that the medians of a pixel need, and the scene class if it is wanted."""
    return list(dict.fromkeys([*bands, *[b for _, read in indices.values() for b in read]])), ["SCL"] if scene_class else []


def _with_indices(medians: DataFrame, bands: Sequence[str], indices: Indices, extra: Sequence[str], scl: Sequence[str]) -> DataFrame:
    derived = {f"{name}_m": f(*[F.col(f"{b}_m") for b in read]) for name, (f, read) in indices.items()}
    return medians.withColumns(derived).select(*PIXEL, *extra, *[f"{c}_m" for c in [*bands, *indices, *scl]])


def _pixel_stats(needed: Sequence[str], scl: Sequence[str]) -> dict[str, tuple[str, str]]:
    return {f"{b}_m": ("median", b) for b in needed} | {f"{c}_m": ("mode", c) for c in scl}


def pixel_medians(
    obs: DataFrame,
    bands: Sequence[str],
    indices: Indices,
    extra: Sequence[str] = (),
    scene_class: bool = False,
    check_skew: bool = True,
) -> DataFrame:
    """Median of each band per pixel (and `extra` keys), and the indices of these medians."""
    needed, scl = level_columns(bands, indices, scene_class)
    rows = obs.select(*PIXEL, *extra, *needed, *scl)
    medians = grouped_stats(rows, [*PIXEL, *extra], _pixel_stats(needed, scl), check_skew)
    return _with_indices(medians, bands, indices, extra, scl)


def _plot_level(
    pixels: DataFrame, bands: Sequence[str], indices: Indices, funs: Sequence[str], extra: Sequence[str], share: str | None, check_skew: bool
) -> DataFrame:
    wanted = {f"{m.lower()}_{f}": (f, f"{m}_m") for m in [*bands, *indices] for f in funs}
    if share:
        wanted["veg_pc"] = (share, "SCL_m")
    if check_skew:
        # Read again by every step for the large plots.
        pixels = materialize(pixels)
    stats = grouped_stats(pixels, ["id", *extra], wanted, check_skew)
    values = [round_even(F.col(c), DIGITS).alias(c) for c in wanted]
    return stats.select("id", *extra, *values)


def two_level_stats(
    obs: DataFrame,
    bands: Sequence[str],
    indices: Indices,
    funs: Sequence[str],
    extra: Sequence[str] = (),
    share: str | None = None,
    census: DataFrame | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """One row per plot (and `extra` keys) with `funs` of every band and index.

    Rows of an ordinary plot travel once: partitioned by plot they satisfy both
    groupings. A plot with too many rows for one task is grouped by pixel first, and
    each of its two levels is checked for skew on its own. `census` is a cheaper table
    that holds at least as many rows of every plot, to look for large plots in. `bucketed`
    rows come from a table in buckets by plot and need not travel at all.
    """

    needed, scl = level_columns(bands, indices, share is not None)

    def placed(rows: DataFrame) -> DataFrame:
        return rows if bucketed else placed_by(rows, ["id"], total * len([*needed, *scl]))

    def levels(rows: DataFrame, check_skew: bool) -> DataFrame:
        pixels = pixel_medians(rows, bands, indices, extra, share is not None, check_skew)
        return _plot_level(pixels, bands, indices, funs, extra, share, check_skew)

    total, hot = group_census(obs if census is None else census, ["id"])
    if hot is None:
        return levels(placed(obs), False)
    hot_rows, cold_rows = split_hot(obs, ["id"], hot)
    return levels(placed(cold_rows), False).unionByName(levels(hot_rows, True))


# --- mergeable state -------------------------------------------------------------------


def pixel_runs(obs: DataFrame, bands: Sequence[str], indices: Indices, scene_class: bool = False) -> DataFrame:
    """Run lengths: one row per pixel, measure and value with its number `n` of observations.

    Two such tables are merged by adding up `n` (`merged_runs`); the statistics of the first level
    need nothing else.
    """
    needed, scl = level_columns(bands, indices, scene_class)
    return merged_runs(measured(obs, PIXEL, sorted([*needed, *scl])).withColumn("n", F.lit(1).cast("bigint")))


def merged_runs(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*[c for c in runs.columns if c != "n"]).agg(F.sum("n").alias("n"))


def stats_of_runs(
    runs: DataFrame, like: DataFrame, bands: Sequence[str], indices: Indices, funs: Sequence[str], share: str | None = None
) -> DataFrame:
    """The statistics of `two_level_stats` from run lengths; `like` has the types of the observations."""
    needed, scl = level_columns(bands, indices, share is not None)

    def levels(rows: DataFrame, check_skew: bool) -> DataFrame:
        medians = tallied_stats(rows, PIXEL, _pixel_stats(needed, scl), like)
        return _plot_level(_with_indices(medians, bands, indices, (), scl), bands, indices, funs, (), share, check_skew)

    total, hot = group_census(runs, ["id"])
    if hot is None:
        return levels(placed_by(runs, ["id"], total), False)
    hot_rows, cold_rows = split_hot(runs, ["id"], hot)
    # a pixel's runs are sorted, which spills
    return levels(placed_by(cold_rows, ["id"], total), False).unionByName(levels(placed_by(hot_rows, PIXEL, total), True))


def _share(compat: bool) -> str:
    return "veg_share_compat" if compat else "veg_share"


def plot_stats(
    obs: DataFrame, start: str, end: str, bands: Sequence[str] = BANDS, compat: bool = False, bucketed: bool = False
) -> DataFrame:
    """Seven statistics of every band and of NDVI, and the vegetation share, for one period.

    `bucketed`: `obs` is a table in buckets by id (`sinks.write_bucketed`), whose rows need no exchange.
    """
    period = obs.where(in_days(start, end))
    clear = period.where(clear_sky())
    return two_level_stats(clear, bands, SEASONAL_INDICES, SEASONAL_STATS, share=_share(compat), census=period, bucketed=bucketed)


def left_join_features(plots: DataFrame, features: DataFrame) -> DataFrame:
    """All plots; those without usable observations keep NULL features."""
    return plots.join(features.withColumnRenamed("id", "plot_id"), "plot_id", "left")


def season_stats(
    obs: DataFrame, seasons: Sequence[Season], bands: Sequence[str] = BANDS, compat: bool = False
) -> DataFrame:
    """The statistics of `plot_stats` for every season side by side, suffixed `_s0`, `_s1`, ...

    One pass over the observations; a season without data stays NULL.
    """
    period = obs.where(in_days(min(a for a, _ in seasons), max(b for _, b in seasons)))
    clear = with_season(period.where(clear_sky()), seasons)
    long = two_level_stats(clear, bands, SEASONAL_INDICES, SEASONAL_STATS, ["season"], _share(compat), period)
    values = [c for c in long.columns if c not in ("id", "season")]
    numbers = list(range(len(seasons)))
    wide = long.groupBy("id").pivot("season", numbers).agg(F.first(F.struct(*values), ignorenulls=True))
    return wide.select("id", *[F.col(f"`{i}`.{c}").alias(f"{c}_s{i}") for i in numbers for c in values])


def season_diff(features: DataFrame, bands: Sequence[str] = tuple(DIFF_STATS), seasons: int = 3) -> DataFrame:
    """Adds the spread over the seasons of the statistics that `DIFF_STATS` lists for each band."""

    def spread(name: str) -> Column:
        values = [F.col(f"{name}_s{i}") for i in range(seasons)]
        return F.abs(F.greatest(*values) - F.least(*values))

    return features.withColumns(
        {
            f"diff_{f}_{b.lower()}": spread(f"{b.lower()}_{f}")
            for b in bands
            for f in DIFF_STATS.get(b, SEASONAL_STATS)
        }
    )


def improved_columns(columns: Sequence[str]) -> list[str]:
    """Columns kept for training: those of no band, and those that `TRAINING_BANDS` allows their band."""

    def allowed(parts: set[str]) -> bool:
        level = bool(parts & {"AVG", "QUARTILE"})
        for band in (*BANDS, "NDVI"):
            if band in parts:
                return band in TRAINING_BANDS and (TRAINING_BANDS[band] or not level)
        return not level and not {"VEG", "PC"} <= parts

    return [c for c in columns if allowed(set(re.findall("[A-Z0-9]+", c.upper())))]


def wide_names(df: DataFrame) -> DataFrame:
    """Canonical feature names to the form `fun(BAND_m)_season`."""
    funs = "|".join(sorted(SEASONAL_STATS, key=len, reverse=True))

    def rename(c: str) -> str:
        found = re.fullmatch(rf"(\w+?)_({funs})_s(\d+)", c)
        if found:
            band, fun, season = found.groups()
            return f"{fun}({band.upper()}_m)_{season}"
        return re.sub(r"^veg_pc_s(\d+)$", r"veg_pc_\1", c)

    return df.toDF(*[rename(c) for c in df.columns])


def monthly_stats(obs: DataFrame, use_all: bool = True, bands: Sequence[str] | None = None) -> DataFrame:
    """Six statistics of bands and five indices per plot and month (`yyyy-MM`)."""
    bands = bands or (BANDS if use_all else MONTHLY_BANDS)
    clear = obs.where(clear_sky()).withColumn("year_month", year_month(F.col("time")))
    return two_level_stats(clear, bands, MONTHLY_INDICES, MONTHLY_STATS, ["year_month"], census=obs)


def monthly_min_max_med(monthly: DataFrame) -> DataFrame:
    """Least, largest and median month of every monthly statistic, per plot.

    A plot has one row per month, so its group is small whatever its number of pixels.
    """
    values = [c for c in monthly.columns if c not in ("id", "year_month")]
    aggs = [f(c).alias(f"{c}_{name}") for name, f in (("min", F.min), ("max", F.max), ("med", F.median)) for c in values]
    return monthly.groupBy("id").agg(*aggs)


def median_composite(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Median over time of every band per location."""
    return grouped_stats(df, keys, {b: ("median", b) for b in bands})


def daily_median_series(df: DataFrame, group: str, day: Column, bands: Sequence[str]) -> DataFrame:
    """Median of every band per group and day."""
    return grouped_stats(df.withColumn("day", day), [group, "day"], {b: ("median", b) for b in bands})
