"""Shaping of plot tables: rows, columns, keys, geometry text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators.observations import EARTH_RADIUS
from plotstats.operators.orderstats import global_ranks, number_rows, tally
from plotstats.schemas import CANONICAL_COLUMNS, GEOMETRY


def region_filter(df: DataFrame, region: str, column: str = "dryland_assessment_region") -> DataFrame:
    return df.where(F.col(column) == region)


def row_slice(df: DataFrame, key: str, index: int, n: int) -> DataFrame:
    """Rows index*n to (index+1)*n of the table in the order of its unique `key`.

    Looks up the first and the last key of the slice instead of numbering all rows.
    """
    def bounds(total: Column) -> Mapping[str, Column]:
        return {"first": F.lit(index * n + 1), "last": F.least(total, F.lit((index + 1) * n))}

    ends = {r["name"]: r["value"] for r in global_ranks(tally(df, [], F.col(key)), bounds).collect()}
    if "first" not in ends:
        return df.where(F.lit(False))
    return df.where(F.col(key).between(ends["first"], ends["last"]))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def null_census(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs and NaNs of every column."""
    return df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])


def missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a column of floating-point numbers."""
    value = F.col(f"`{column}`")
    return value.isNull() | F.isnan(value) if dict(df.dtypes)[column] in ("float", "double") else value.isNull()


def canonical_schema(df: DataFrame) -> DataFrame:
    """Joined table to the fixed column order; the coordinates are those of the plot side (`_y`)."""
    named = {"longitude": "longitude_y", "latitude": "latitude_y"}
    return df.select(*[F.col(named[c]).alias(c) if named.get(c) in df.columns else F.col(c) for c in CANONICAL_COLUMNS])


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`; absent ones are NULL, others are dropped."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def select_by_pattern(
    df: DataFrame,
    contains: Sequence[str] = (),
    starts_with: Sequence[str] = (),
    without: Sequence[str] = (),
) -> DataFrame:
    """Columns whose name contains or starts with one of the texts, and contains none of `without`."""
    def chosen(c: str) -> bool:
        wanted = any(p in c for p in contains) or any(c.startswith(p) for p in starts_with)
        return (wanted or not (contains or starts_with)) and not any(p in c for p in without)

    return df.select(*[F.col(f"`{c}`") for c in df.columns if chosen(c)])


def rectangle_polygon(
    df: DataFrame, metres: float = 30.0, drop_cols: bool = True, compat: bool = False
) -> DataFrame:
    """Adds `geometry`: a closed polygon text reaching `metres` to each side of the point.

    A degree of longitude shrinks with the cosine of the latitude. `compat` instead
    widens the latitude side by the cosine of the longitude.
    """
    d = F.degrees(F.lit(metres / EARTH_RADIUS))
    if compat:
        dx, dy = d, d / F.cos(F.radians(F.col("longitude")))
    else:
        dx, dy = d / F.cos(F.radians(F.col("latitude"))), d
    boxed = df.withColumns(
        {
            "xMin": F.col("longitude") - dx,
            "xMax": F.col("longitude") + dx,
            "yMin": F.col("latitude") - dy,
            "yMax": F.col("latitude") + dy,
        }
    )
    corners = [("xMin", "yMin"), ("xMax", "yMin"), ("xMax", "yMax"), ("xMin", "yMax"), ("xMin", "yMin")]
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in corners])
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    boxed = boxed.withColumn("geometry", shape)
    return boxed.drop("xMin", "xMax", "yMin", "yMax") if drop_cols else boxed


def point_coordinates(geo: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a point geometry text."""
    place = F.from_json(geo, GEOMETRY)["coordinates"]
    return F.get(place, 0), F.get(place, 1)


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def row_key(df: DataFrame, order: Sequence[str], name: str = "plot_id") -> DataFrame:
    """A stable row number in the order of `order`, written once with the table.

    A table that already has the key keeps it.
    """
    return df if name in df.columns else number_rows(df, order, name)


def class_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def region_bounds(df: DataFrame, region: str, key: str) -> DataFrame:
    """Half-open range of ids per region."""
    return df.groupBy(region).agg(F.min(key).alias("first_id"), (F.max(key) + 1).alias("end_id"))


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, matched by column name; a column absent from a table is NULL there."""
    result = tables[0]
    for t in tables[1:]:
        result = result.unionByName(t, allowMissingColumns=True)
    return result


def sym_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that occur in exactly one of the two tables, in one aggregation."""
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("_side")).unionByName(b.select(*columns, F.lit(2).alias("_side")))
    return both.groupBy(*columns).agg(F.bit_or("_side").alias("_sides")).where("_sides <> 3").drop("_sides")


def top_k(df: DataFrame, by: str, k: int = 25, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(by), *tie).limit(k)
