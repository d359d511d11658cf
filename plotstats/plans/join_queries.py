"""Queries: joins of points, pixels and chunk files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plotstats.operators import joins
from plotstats.plans.views import (
    PIXEL_VIEW,
    PIXELS_SQL,
    PLOTS_SQL,
    POINTS_SQL,
    SAMPLES_SQL,
    SITES_SQL,
    pixels,
    plots,
    points,
    samples,
    sites,
    table,
)

_CLOSE = " and ".join(f"abs(a.{c} - b.{c}) <= 1e-8 + 1e-5 * abs(b.{c})" for c in ("longitude", "latitude"))


def tolerance_join(spark, sf_dir):
    return joins.tolerance_join(samples(spark, sf_dir), sites(spark, sf_dir), "plot_id")


def tolerance_join_report(spark, sf_dir):
    report = joins.tolerance_join_report(samples(spark, sf_dir), sites(spark, sf_dir), "plot_id")
    return report.select("sample_id", "match_status")


def tolerance_join_counts(spark, sf_dir):
    """Number of sites that each sample agrees with, within its half of the ids."""
    left = samples(spark, sf_dir).withColumn("half", F.col("sample_id") % 2)
    right = sites(spark, sf_dir).withColumn("half", F.col("plot_id") % 2)
    return joins.tolerance_join_report(left, right, "plot_id", by=["half"]).select("sample_id", "half", "matches", "match_status")


def inner_join_suffix(spark, sf_dir):
    people = table(spark, sf_dir, "customer").selectExpr("c_custkey as key", "c_name as name", "c_nationkey as at")
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey as key", "n_name as name")
    return joins.inner_join_suffix(people, nations, "at", "key")


def semi_join(spark, sf_dir):
    return joins.known_points(points(spark, sf_dir), plots(spark, sf_dir)).select("point_id", "longitude", "latitude")


def anti_join(spark, sf_dir):
    return joins.new_points(points(spark, sf_dir), plots(spark, sf_dir)).select("point_id", "longitude", "latitude")


def nearest_pixels(spark, sf_dir):
    near = joins.nearest_pixels(pixels(spark, sf_dir), points(spark, sf_dir), "point_id")
    return near.select("point_id", "B1", "B2", F.round("dist2", 12).alias("dist2"))


def nearest_median_sd(spark, sf_dir):
    stats = joins.nearest_median_sd(pixels(spark, sf_dir), points(spark, sf_dir), "point_id", ["B1", "B2"])
    return stats.select("point_id", *[F.round(c, 6).alias(c) for c in stats.columns[1:]])


def zonal_reduce(spark, sf_dir):
    stats = joins.zonal_reduce(pixels(spark, sf_dir), points(spark, sf_dir), "point_id", ["B1", "B2"])
    return stats.select("point_id", *[F.round(c, 6).alias(c) for c in stats.columns[1:]])


def populate_points(spark, sf_dir):
    bands = ["B1", "B2"]
    filled = joins.populate_points(
        points(spark, sf_dir).drop("acctbal"),
        plots(spark, sf_dir),
        pixels(spark, sf_dir),
        "point_id",
        lambda df: joins.landsat_prepare(df, bands),
        lambda px, pts: joins.nearest_median_sd(px, pts, "point_id", bands),
    )
    return filled.select("point_id", *[F.round(c, 6).alias(c) for c in ("B1", "B2", "B1_sd", "B2_sd")])


def _records(spark, sf_dir):
    """Records of chunk files of ten points each, in file order."""
    last = points(spark, sf_dir).agg(F.max("point_id")).first()[0]
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", *[f"{e} as {c}" for c, e in PIXEL_VIEW.items()], f"{_BURN} as burn"
    )
    df = df.withColumn("chunk", joins.chunk_key(F.col("point_id"), last))
    line = F.row_number().over(Window.partitionBy("chunk").orderBy("o_orderkey")) - 1
    return df.select("chunk", line.cast("bigint").alias("line"), "longitude", "latitude", "burn")


def chunk_key_join(spark, sf_dir):
    pts = points(spark, sf_dir).select("point_id")
    records = _records(spark, sf_dir).select("chunk", "line", "burn")
    joined = joins.chunk_key_join(pts, "point_id", records, "chunk")
    return joined.groupBy("point_id", "chunk").agg(F.count(F.lit(1)).alias("records"), F.sum("burn").alias("burn_sum"))


def nearest_12_months(spark, sf_dir):
    runs = joins.nearest_run(points(spark, sf_dir), "point_id", _records(spark, sf_dir), "chunk", "line")
    return runs.select("point_id", "chunk", "line", "burn")


def null_run_count(spark, sf_dir):
    runs = joins.nearest_run(points(spark, sf_dir), "point_id", _records(spark, sf_dir), "chunk", "line")
    return joins.null_run_count(runs, "point_id", "burn")


def update_by_key(spark, sf_dir):
    """Account balances of points overwritten by the largest one of the plots at the same place."""
    new = (
        plots(spark, sf_dir)
        .where("tree_cover > 0.3D")
        .groupBy("longitude", "latitude")
        .agg(F.max("tree_cover").alias("acctbal"))
    )
    return joins.update_by_key(points(spark, sf_dir), new, ["longitude", "latitude"])


_BURN = "case when o_orderkey % 3 = 0 then null else o_orderkey % 365 end"
_DIST = (
    "(x.longitude - p.longitude) * (x.longitude - p.longitude) + (x.latitude - p.latitude) * (x.latitude - p.latitude)"
)
_NEAR_ALL = f"(select x.*, {_DIST} as dist2 from {PIXELS_SQL} x join {POINTS_SQL} p using (point_id))"
_NEAREST = f"(select * from (select *, min(dist2) over (partition by point_id) as least from {_NEAR_ALL}) where dist2 = least)"
_MEDIAN_SD = ", ".join(
    [f"round(median({b}), 6) as {b}" for b in ("B1", "B2")]
    + [f"round(stddev_samp({b}), 6) as {b}_sd" for b in ("B1", "B2")]
)
_LAST = "(select max(c_custkey) from customer)"
_CHUNK = f"least(10 * cast(floor({{}} / 10) as bigint) + 9, {_LAST})"
_RECORDS = (
    "(select chunk, row_number() over (partition by chunk order by o_orderkey) - 1 as line, longitude, latitude, burn from"
    f" (select o_orderkey, {', '.join(f'{e} as {c}' for c, e in PIXEL_VIEW.items())}, {_BURN} as burn,"
    f" {_CHUNK.format('o_custkey')} as chunk from orders))"
)
_POINT_CHUNKS = f"(select *, {_CHUNK.format('point_id')} as chunk from {POINTS_SQL})"
_STARTS = (
    "(select point_id, chunk, line as first_line from (select p.point_id, p.chunk, x.line, row_number() over"
    f" (partition by p.point_id order by {_DIST}, x.line) as rn from {_POINT_CHUNKS} p join {_RECORDS} x on p.chunk = x.chunk)"
    " where rn = 1)"
)
_RUNS = (
    f"select s.point_id, s.chunk, r.line, r.burn from {_STARTS} s join {_RECORDS} r on r.chunk = s.chunk"
    " and r.line between s.first_line and s.first_line + 11"
)
_IN_PLOTS = f"(longitude, latitude) in (select (longitude, latitude) from {PLOTS_SQL})"
_MATCHES = (
    f"(select a.sample_id, count(b.plot_id) as n, min(b.plot_id) as plot_id from {SAMPLES_SQL} a"
    f" left join {SITES_SQL} b on {_CLOSE} group by a.sample_id)"
)
_FRESH = f"(select point_id, longitude, latitude from {POINTS_SQL} where not {_IN_PLOTS})"
_VALUES = f"(select point_id, {_MEDIAN_SD} from {_NEAREST} group by point_id)"

QUERIES = {
    "tolerance_join": (
        tolerance_join,
        "select a.sample_id, a.longitude as longitude_x, a.latitude as latitude_x, a.B1, b.plot_id,"
        f" b.longitude as longitude_y, b.latitude as latitude_y, b.tree_cover from {_MATCHES} m"
        f" join {SAMPLES_SQL} a on a.sample_id = m.sample_id join {SITES_SQL} b on b.plot_id = m.plot_id where m.n = 1",
    ),
    "tolerance_join_report": (
        tolerance_join_report,
        "select sample_id, case n when 0 then 'none' when 1 then 'one' else 'many' end as match_status"
        f" from {_MATCHES}",
    ),
    "tolerance_join_counts": (
        tolerance_join_counts,
        "select a.sample_id, a.sample_id % 2 as half, count(b.plot_id) as matches, case count(b.plot_id) when 0 then 'none' when 1 then 'one' else 'many' end as match_status"
        f" from {SAMPLES_SQL} a left join {SITES_SQL} b on {_CLOSE} and a.sample_id % 2 = b.plot_id % 2 group by a.sample_id",
    ),
    "inner_join_suffix": (
        inner_join_suffix,
        "select c_custkey as key_x, c_name as name_x, c_nationkey as at, n_nationkey as key_y, n_name as name_y"
        " from customer join nation on c_nationkey = n_nationkey",
    ),
    "semi_join": (semi_join, f"select point_id, longitude, latitude from {POINTS_SQL} where {_IN_PLOTS}"),
    "anti_join": (anti_join, f"select point_id, longitude, latitude from {POINTS_SQL} where not {_IN_PLOTS}"),
    "nearest_pixels": (
        nearest_pixels,
        f"select point_id, B1, B2, round(dist2, 12) as dist2 from {_NEAREST}",
    ),
    "nearest_median_sd": (nearest_median_sd, f"select point_id, {_MEDIAN_SD} from {_NEAREST} group by point_id"),
    "zonal_reduce": (
        zonal_reduce,
        "select point_id, round(max(case when rn = 1 then B1 end), 6) as B1_first,"
        " round(max(case when rn = 1 then B2 end), 6) as B2_first, round(median(B1), 6) as B1_median,"
        " round(median(B2), 6) as B2_median from (select *, row_number() over (partition by point_id"
        f" order by dist2, longitude, latitude, B1, B2) as rn from {_NEAR_ALL}) group by point_id",
    ),
    "populate_points": (
        populate_points,
        "select f.point_id, v.B1, v.B2, v.B1_sd, v.B2_sd from "
        f"{_FRESH} f left join (select * from (select f.longitude, f.latitude, v.*, row_number() over"
        f" (partition by f.longitude, f.latitude order by v.point_id desc) as rn from {_FRESH} f join {_VALUES} v"
        " using (point_id)) where rn = 1) v on f.longitude = v.longitude and f.latitude = v.latitude",
    ),
    "chunk_key_join": (
        chunk_key_join,
        "select p.point_id, p.chunk, count(*) as records, cast(sum(x.burn) as bigint) as burn_sum"
        f" from {_POINT_CHUNKS} p join {_RECORDS} x on p.chunk = x.chunk group by p.point_id, p.chunk",
    ),
    "nearest_12_months": (nearest_12_months, _RUNS),
    "null_run_count": (
        null_run_count,
        f"select point_id, count(*) filter (where burn is null) as no_burn from ({_RUNS}) group by point_id",
    ),
    "update_by_key": (
        update_by_key,
        "select p.point_id, p.longitude, p.latitude, coalesce(n.v, p.acctbal) as acctbal from "
        f"{POINTS_SQL} p left join (select longitude, latitude, max(tree_cover) as v from {PLOTS_SQL}"
        " where tree_cover > 3e-1 group by longitude, latitude) n"
        " on p.longitude = n.longitude and p.latitude = n.latitude",
    ),
}
