"""Cleaning and filtering of pixel observations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.functions.math import round_even
from plotstats.operators.skew import lookup_join
from plotstats.schemas import QA_BANDS

DAY = 86_400
COORDINATE_DIGITS = 7
# Mean earth radius in metres (fixed value).
EARTH_RADIUS = 6371008.7714150598

Season = tuple[str, str]


def epoch(day: str) -> int:
    """Epoch seconds at the start of a UTC day given as yyyy-mm-dd."""
    d = date.fromisoformat(day)
    return int(datetime(d.year, d.month, d.day, tzinfo=timezone.utc).timestamp())


def cast_bands(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Raw records to typed columns; columns without an entry stay as they are."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def cloud_flag(qa60: Column) -> Column:
    """True for exactly one of the two cloud bits; both together are not flagged."""
    return F.coalesce(qa60.isin(1024, 2048), F.lit(False))


def clean_observations(df: DataFrame) -> DataFrame:
    """Cloud flag, coordinates to 7 digits, milliseconds to seconds, quality bands dropped."""
    return df.withColumns(
        {
            "HAS_CLOUDFLAG": cloud_flag(F.col("QA60")),
            "longitude": round_even(F.col("longitude"), COORDINATE_DIGITS),
            "latitude": round_even(F.col("latitude"), COORDINATE_DIGITS),
            "time": F.floor(F.col("time") / 1000).cast("bigint"),
        }
    ).drop(*QA_BANDS)


def clear_sky() -> Column:
    """Unflagged without a cloud probability, or little cloud and little snow."""
    return F.expr(
        "(not HAS_CLOUDFLAG and MSK_CLDPRB is null) or (MSK_CLDPRB < 0.1D and MSK_SNWPRB < 0.1D)"
    )


def in_days(start: str, end: str, time: str = "time") -> Column:
    """Whole UTC days, both included. Compares the stored seconds, so the scan can skip row groups."""
    return (F.col(time) >= epoch(start)) & (F.col(time) < epoch(end) + DAY)


def in_period(start: str, end: str, time: str = "time") -> Column:
    """From the start of day `start` up to, but not including, day `end`."""
    return (F.col(time) >= epoch(start)) & (F.col(time) < epoch(end))


def with_season(df: DataFrame, seasons: Sequence[Season], time: str = "time") -> DataFrame:
    """One row per observation and season it falls into, in column `season` (0, 1, ...)."""
    table = F.array(
        *[
            F.struct(F.lit(i).alias("season"), F.lit(epoch(a)).alias("from"), F.lit(epoch(b) + DAY).alias("to"))
            for i, (a, b) in enumerate(seasons)
        ]
    )
    hits = F.filter(table, lambda s: (F.col(time) >= s["from"]) & (F.col(time) < s["to"]))
    return df.withColumn("season", F.explode(F.transform(hits, lambda s: s["season"])))


def select_ids(df: DataFrame, ids: range | Iterable[int] | DataFrame, key: str = "id") -> DataFrame:
    """Rows of the given ids: a contiguous range as a comparison, a table or list of ids as a semi join."""
    if isinstance(ids, DataFrame):
        return lookup_join(df, ids, [key], "left_semi")
    if isinstance(ids, range) and ids.step == 1:
        return df.where((F.col(key) >= ids.start) & (F.col(key) < ids.stop))
    kind = df.schema[key].dataType.simpleString()
    named = df.sparkSession.createDataFrame([(i,) for i in set(ids)], f"`{key}` {kind}")
    return df.join(named, key, "left_semi")


def metadata_filter(df: DataFrame, min_quality: int = 7, max_cloud: float = 0.25) -> DataFrame:
    return df.where((F.col("IMAGE_QUALITY_TIRS") >= min_quality) & (F.col("CLOUD_COVER") <= max_cloud))


def in_box(lon: Column, lat: Column, lon0: Column, lat0: Column, metres: float = 35.0) -> Column:
    """Inside the bounding box of a circle of `metres` around (lon0, lat0)."""
    d = F.degrees(F.lit(metres / EARTH_RADIUS))
    return (F.abs(lat - lat0) <= d) & (F.abs(lon - lon0) <= d / F.cos(F.radians(lat0)))


def bbox_filter(obs: DataFrame, plots: DataFrame, metres: float = 35.0) -> DataFrame:
    """Observations inside the box around their own plot."""
    centres = plots.select(F.col("plot_id").alias("id"), F.col("longitude").alias("_lon0"), F.col("latitude").alias("_lat0"))
    joined = lookup_join(obs, centres, ["id"], "inner")
    near = in_box(F.col("longitude"), F.col("latitude"), F.col("_lon0"), F.col("_lat0"), metres)
    return joined.where(near).select(*obs.columns)


def year_month(time: Column) -> Column:
    return F.date_format(F.timestamp_seconds(time), "yyyy-MM")


def utc_date(time: Column) -> Column:
    return F.to_date(F.timestamp_seconds(time))


def around_midnight(time: Column) -> Column:
    """True in the last minute of a UTC day and in its first."""
    return F.date_format(F.timestamp_seconds(time), "HH:mm").isin("23:59", "00:00")
