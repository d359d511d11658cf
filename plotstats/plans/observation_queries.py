"""Queries: cleaning, filters, projections and table shaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators import observations as obs
from plotstats.operators import tables
from plotstats.plans.views import (
    CLEAR_SQL,
    OBS_SQL,
    PLOTS_SQL,
    POINTS_SQL,
    RAW_SQL,
    observations,
    plots,
    points,
    raw_observations,
    table,
)
from plotstats.schemas import CANONICAL_COLUMNS, LANDSAT_COLUMNS, POLYGON

ROW = ["id", "longitude", "latitude", "time", "B4", "B8"]
ROW_SQL = ", ".join(ROW)
# Days of the filter queries.
FROM, TO = "1996-01-01", "1998-12-31"
_SECONDS = {d: obs.epoch(d) for d in (FROM, TO)}
METADATA = {
    "image_id": "l_orderkey",
    "IMAGE_QUALITY_TIRS": "l_linenumber + 2",
    "CLOUD_COVER": "l_tax * 5",
    "B1": "l_extendedprice",
}
META_SQL = ", ".join(f"{e} as {c}" for c, e in METADATA.items())


def cloud_flag(spark, sf_dir):
    df = raw_observations(spark, sf_dir)
    return df.groupBy("QA60", obs.cloud_flag(F.col("QA60")).alias("flagged")).agg(F.count(F.lit(1)).alias("n"))


def round_coords(spark, sf_dir):
    df = raw_observations(spark, sf_dir)
    return df.select("id", obs.round_even(F.col("longitude"), 7).alias("longitude"), obs.round_even(F.col("latitude"), 7).alias("latitude"))


def clean_observations(spark, sf_dir):
    return obs.clean_observations(raw_observations(spark, sf_dir)).select(*ROW, "HAS_CLOUDFLAG")


def clear_sky_filter(spark, sf_dir):
    return observations(spark, sf_dir).where(obs.clear_sky()).select(*ROW)


def date_range_filter(spark, sf_dir):
    return observations(spark, sf_dir).where(obs.in_days(FROM, TO)).select(*ROW)


def date_half_open(spark, sf_dir):
    return observations(spark, sf_dir).where(obs.in_period(FROM, TO)).select(*ROW)


def id_set_filter(spark, sf_dir):
    """Observations of the plots with forest, by a table of ids."""
    ids = plots(spark, sf_dir).where("land_use_category = 'forest'").select(F.col("plot_id").alias("id"))
    return obs.select_ids(observations(spark, sf_dir), ids).select(*ROW)


def metadata_filter(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in METADATA.items()])
    return obs.metadata_filter(df)


def bbox_filter(spark, sf_dir):
    return obs.bbox_filter(observations(spark, sf_dir), plots(spark, sf_dir)).select(*ROW)


def region_filter(spark, sf_dir):
    return tables.region_filter(plots(spark, sf_dir), "Region3").select("plot_id", "longitude", "latitude")


def row_slice(spark, sf_dir):
    df = tables.region_filter(table(spark, sf_dir, "customer"), "MACHINERY", "c_mktsegment")
    return tables.row_slice(df.select("c_custkey", "c_acctbal"), "c_custkey", 1, 10)


def _with_gaps(spark, sf_dir):
    return points(spark, sf_dir).selectExpr(
        "point_id",
        "case when point_id % 11 = 0 then null else longitude end as longitude",
        "case when point_id % 13 = 0 then null else latitude end as latitude",
        "case when acctbal < 0 then null else acctbal end as acctbal",
    )


GAPS_SQL = (
    "(select point_id, case when point_id % 11 = 0 then null else longitude end as longitude,"
    " case when point_id % 13 = 0 then null else latitude end as latitude,"
    f" case when acctbal < 0 then null else acctbal end as acctbal from {POINTS_SQL})"
)


def drop_nulls(spark, sf_dir):
    return tables.drop_nulls(_with_gaps(spark, sf_dir), ["longitude", "latitude"])


def null_census(spark, sf_dir):
    return tables.null_census(_with_gaps(spark, sf_dir))


_JOINED = {
    **{c: f"plot_id * {i + 1} + 5e-1" for i, c in enumerate(LANDSAT_COLUMNS)},
    "longitude_x": "longitude + 1e-6",
    "latitude_x": "latitude + 1e-6",
    "longitude_y": "longitude",
    "latitude_y": "latitude",
    "dryland_assessment_region": "dryland_assessment_region",
    "Aridity_zone": "Aridity_zone",
    "land_use_category": "land_use_category",
    "tree_cover": "tree_cover",
}


def canonical_schema(spark, sf_dir):
    return tables.canonical_schema(plots(spark, sf_dir).selectExpr(*[f"{e} as {c}" for c, e in _JOINED.items()]))


CANONICAL_SQL = (
    "select "
    + ", ".join(f"{_JOINED[c]} as {c}" if c in LANDSAT_COLUMNS else c for c in CANONICAL_COLUMNS)
    + f" from {PLOTS_SQL}"
)


def conform_schema(spark, sf_dir):
    wanted = T.StructType(
        [
            T.StructField("plot_id", T.LongType()),
            T.StructField("tree_cover", T.DoubleType()),
            T.StructField("canopy", T.DoubleType()),
            T.StructField("no_burn", T.LongType()),
        ]
    )
    return tables.conform_schema(plots(spark, sf_dir), wanted)


def select_by_pattern(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return tables.select_by_pattern(df, contains=["price", "tax"], starts_with=["l_s", "l_ord"], without=["date"])


def rectangle_polygon(spark, sf_dir):
    """Corners read back from the polygon text."""
    df = tables.rectangle_polygon(plots(spark, sf_dir))
    ring = F.from_json("geometry", POLYGON)["coordinates"][0]
    corner = {"x_min": (0, 0), "y_min": (0, 1), "x_max": (2, 0), "y_max": (2, 1)}
    return df.select(
        "plot_id",
        F.size(ring).cast("bigint").alias("points"),
        (ring[0] == ring[4]).alias("closed"),
        *[F.round(ring[i][j], 7).alias(c) for c, (i, j) in corner.items()],
    )


_D30 = "degrees(30 / 6371008.7714150598e0)"
RECTANGLE_SQL = f"""select plot_id, cast(5 as bigint) as points, true as closed,
 round(longitude - {_D30} / cos(radians(latitude)), 7) as x_min, round(latitude - {_D30}, 7) as y_min,
 round(longitude + {_D30} / cos(radians(latitude)), 7) as x_max, round(latitude + {_D30}, 7) as y_max
 from {PLOTS_SQL}"""

_D35 = "degrees(35 / 6371008.7714150598e0)"
BBOX_SQL = f"""select {', '.join('o.' + c for c in ROW)} from {OBS_SQL} o join {PLOTS_SQL} p on o.id = p.plot_id
 where abs(o.latitude - p.latitude) <= {_D35}
 and abs(o.longitude - p.longitude) <= {_D35} / cos(radians(p.latitude))"""


def row_key(spark, sf_dir):
    df = points(spark, sf_dir).select("longitude", "latitude", "point_id")
    return tables.row_key(df, ["longitude", "latitude", "point_id"], "plot_id")


def year_month(spark, sf_dir):
    df = observations(spark, sf_dir).select(obs.year_month(F.col("time")).alias("year_month"))
    return df.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))


def midnight_check(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    df = table(spark, sf_dir, "events").select("event_id", seconds.alias("time"))
    return df.where(obs.around_midnight(F.col("time")))


def json_extract(spark, sf_dir):
    """The number in the event properties, and the coordinates of a point text built from each customer."""
    geo = "concat('{\"type\":\"Point\",\"coordinates\":[', c_custkey, ',', c_nationkey, ']}')"
    lon, lat = tables.point_coordinates(F.expr(geo))
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), lon.alias("a"), lat.alias("b"), F.lit("point").alias("kind")
    )
    k = F.from_json("props", "k double")["k"]
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"), k.alias("a"), F.lit(None).cast("double").alias("b"), F.lit("props").alias("kind")
    )
    return tables.union_all(people, events)


def class_histogram(spark, sf_dir):
    return tables.class_histogram(plots(spark, sf_dir), "tree_cover")


def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag").dropDuplicates()


def distinct_values(spark, sf_dir):
    return plots(spark, sf_dir).select("dryland_assessment_region").distinct()


def region_bounds(spark, sf_dir):
    return tables.region_bounds(plots(spark, sf_dir), "dryland_assessment_region", "plot_id")


def union_all(spark, sf_dir):
    a = plots(spark, sf_dir).select("plot_id", "longitude", "tree_cover")
    b = points(spark, sf_dir).select(F.col("point_id").alias("plot_id"), "longitude", "acctbal")
    return tables.union_all(a, b)


def sym_difference(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    a = df.where("l_returnflag = 'R'").select("l_suppkey", "l_linenumber", "l_quantity")
    b = df.where("l_returnflag <> 'R'").select("l_suppkey", "l_linenumber", "l_quantity")
    return tables.sym_difference(a, b)


def top_k(spark, sf_dir):
    return tables.top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, ["o_orderkey"])


_SYM = "select l_suppkey, l_linenumber, l_quantity from lineitem where l_returnflag {} 'R'"

QUERIES = {
    "cloud_flag": (
        cloud_flag,
        f"select QA60, QA60 in (1024, 2048) as flagged, count(*) as n from {RAW_SQL} group by all",
    ),
    "round_coords": (
        round_coords,
        f"select id, round_even(longitude * 1e7, 0) / 1e7 as longitude, round_even(latitude * 1e7, 0) / 1e7 as latitude from {RAW_SQL}",
    ),
    "clean_observations": (
        clean_observations,
        "select id, round_even(longitude * 1e7, 0) / 1e7 as longitude, round_even(latitude * 1e7, 0) / 1e7 as latitude,"
        f" time // 1000 as time, B4, B8, QA60 in (1024, 2048) as HAS_CLOUDFLAG from {RAW_SQL}",
    ),
    "clear_sky_filter": (clear_sky_filter, f"select {ROW_SQL} from {OBS_SQL} where {CLEAR_SQL}"),
    "date_range_filter": (
        date_range_filter,
        f"select {ROW_SQL} from {OBS_SQL} where cast(make_timestamp(time * 1000000) as date)"
        f" between date '{FROM}' and date '{TO}'",
    ),
    "date_half_open": (
        date_half_open,
        f"select {ROW_SQL} from {OBS_SQL} where time >= {_SECONDS[FROM]} and time < {_SECONDS[TO]}",
    ),
    "id_set_filter": (
        id_set_filter,
        f"select {ROW_SQL} from {OBS_SQL} where id in"
        f" (select plot_id from {PLOTS_SQL} where land_use_category = 'forest')",
    ),
    "metadata_filter": (
        metadata_filter,
        f"select * from (select {META_SQL} from lineitem) where IMAGE_QUALITY_TIRS >= 7 and CLOUD_COVER <= 25e-2",
    ),
    "bbox_filter": (bbox_filter, BBOX_SQL),
    "region_filter": (
        region_filter,
        f"select plot_id, longitude, latitude from {PLOTS_SQL} where dryland_assessment_region = 'Region3'",
    ),
    "row_slice": (
        row_slice,
        "select c_custkey, c_acctbal from customer where c_mktsegment = 'MACHINERY' order by c_custkey limit 10 offset 10",
    ),
    "drop_nulls": (drop_nulls, f"select * from {GAPS_SQL} where longitude is not null and latitude is not null"),
    "null_census": (
        null_census,
        "select "
        + ", ".join(
            f"count(*) filter (where {c} is null) as {c}" for c in ("point_id", "longitude", "latitude", "acctbal")
        )
        + f" from {GAPS_SQL}",
    ),
    "canonical_schema": (canonical_schema, CANONICAL_SQL),
    "conform_schema": (
        conform_schema,
        "select plot_id, tree_cover, cast(null as double) as canopy, cast(null as bigint) as no_burn"
        f" from {PLOTS_SQL}",
    ),
    "select_by_pattern": (select_by_pattern, "select l_orderkey, l_suppkey, l_extendedprice, l_tax from lineitem"),
    "rectangle_polygon": (rectangle_polygon, RECTANGLE_SQL),
    "row_key": (
        row_key,
        "select row_number() over (order by longitude, latitude, point_id) - 1 as plot_id, longitude, latitude,"
        f" point_id from {POINTS_SQL}",
    ),
    "year_month": (
        year_month,
        f"select strftime(make_timestamp(time * 1000000), '%Y-%m') as year_month, count(*) as n from {OBS_SQL} group by all",
    ),
    "midnight_check": (
        midnight_check,
        "select event_id, cast(floor(epoch(ts)) as bigint) as time from events"
        " where strftime(ts, '%H:%M') in ('23:59', '00:00')",
    ),
    "json_extract": (
        json_extract,
        "select c_custkey as key, cast(c_custkey as double) as a, cast(c_nationkey as double) as b, 'point' as kind"
        " from customer union all select event_id, cast(json_extract(props, '$.k') as double), null, 'props' from events",
    ),
    "class_histogram": (class_histogram, f"select tree_cover, count(*) as n from {PLOTS_SQL} group by all"),
    "distinct_rows": (distinct_rows, "select distinct l_suppkey, l_linenumber, l_returnflag from lineitem"),
    "distinct_values": (distinct_values, f"select distinct dryland_assessment_region from {PLOTS_SQL}"),
    "region_bounds": (
        region_bounds,
        "select dryland_assessment_region, min(plot_id) as first_id, max(plot_id) + 1 as end_id"
        f" from {PLOTS_SQL} group by all",
    ),
    "union_all": (
        union_all,
        f"select plot_id, longitude, tree_cover, cast(null as double) as acctbal from {PLOTS_SQL} union all"
        f" select point_id, longitude, null, acctbal from {POINTS_SQL}",
    ),
    "sym_difference": (
        sym_difference,
        f"({_SYM.format('=')} except {_SYM.format('<>')}) union all ({_SYM.format('<>')} except {_SYM.format('=')})",
    ),
    "top_k": (
        top_k,
        "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25",
    ),
}
