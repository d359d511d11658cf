"""Queries: indices, grouped statistics and the two-level plot statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotstats.operators import indices as ix
from plotstats.operators import plot_stats as ps
from plotstats.operators.aggregates import grouped_stats
from plotstats.operators.observations import utc_date
from plotstats.operators.raster import RASTER_BANDS, plot_raster as raster_query
from plotstats.plans.views import CLEAR_SQL, END, OBS_SQL, PLOTS_SQL, SEASONS, START, observations, plots, table
from plotstats.schemas import BANDS, DIFF_STATS, MONTHLY_STATS, SEASONAL_STATS
from plotstats.session import scratch_path
from plotstats.sources.sinks import write_bucketed

# Buckets of the stored tables; a task takes one.
BUCKETS = 64


# --- the same statistics as SQL text ---------------------------------------------------

def _quartile_sql(x: str, p: float) -> str:
    return (
        f"(percentile_disc({p}) within group (order by {x}) + percentile_disc({1 - p}) within group (order by {x} desc)) / 2e0"
    )


def stat_sql(fun: str, x: str) -> str:
    return {
        "min": f"min({x})",
        "max": f"max({x})",
        "avg": f"avg({x})",
        "stdev": f"coalesce(stddev_samp({x}), 0)",
        "variance": f"coalesce(var_samp({x}), 0)",
        "median": f"median({x})",
        "lower_quartile": _quartile_sql(x, 0.25),
        "upper_quartile": _quartile_sql(x, 0.75),
    }[fun]


INDEX_SQL = {
    "ndvi_b5": "({B8} - {B5}) / nullif({B8} + {B5}, 0)",
    "ndvi": "({B8} - {B4}) / nullif({B8} + {B4}, 0)",
    "endvi": "({B8} + {B3} - 2 * {B2}) / nullif({B8} + {B3} + 2 * {B2}, 0)",
    "gdvi": "{B8} - {B3}",
    "msavi2": "((2 * {B8} + 1) - sqrt((2 * {B8} + 1) * (2 * {B8} + 1) - 8 * ({B8} - {B4}))) * 5e-1",
    "savi": "(({B8} - {B4}) * 15e-1) / nullif({B8} + {B4} + 5e-1, 0)",
}


def index_sql(name: str, pattern: str = "{}_m") -> str:
    return INDEX_SQL[name].format(**{b: pattern.format(b) for b in BANDS})


SEASONAL_SQL = {"NDVI": "ndvi_b5"}
MONTHLY_SQL = {"ENDVI": "endvi", "NDVI": "ndvi", "GDVI": "gdvi", "MSAVI2": "msavi2", "SAVI": "savi"}
# Scene class of a pixel: the most frequent one, none on a tie.
MODE_SQL = "case when mode_n = 1 then mode_v end"


def pixel_sql(bands, indices: dict[str, str], extra: str = "", where: str = "true", scl: bool = False) -> str:
    """Per-pixel medians (all bands, so that every index can be formed) with indices."""
    keys = f"id, longitude, latitude{', ' + extra if extra else ''}"
    medians = ", ".join(f"median({b}) as {b}_m" for b in BANDS)
    derived = "".join(f", {index_sql(k)} as {name}_m" for name, k in indices.items())
    base = f"(select * from {OBS_SQL} where {CLEAR_SQL} and {where})"
    if extra == "year_month":
        base = f"(select *, strftime(make_timestamp(time * 1000000), '%Y-%m') as year_month from {base})"
    if extra == "season":
        ranges = " union all ".join(
            f"select {i} as season, date '{a}' as a, date '{b}' as b" for i, (a, b) in enumerate(SEASONS)
        )
        base = (
            f"(select o.*, s.season from {base} o join ({ranges}) s"
            " on cast(make_timestamp(o.time * 1000000) as date) between s.a and s.b)"
        )
    medians_sql = f"select {keys}, {medians} from {base} group by {keys}"
    if scl:
        on = " and ".join(f"m.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
        counted = f"select {keys}, SCL, count(*) as n from {base} group by {keys}, SCL"
        ranked = f"select *, max(n) over (partition by {keys}) as top from ({counted})"
        modes = (
            f"select {keys}, case when count(*) = 1 then min(SCL) end as SCL_m from ({ranked})"
            f" where n = top group by {keys}"
        )
        medians_sql = f"select m.*, s.SCL_m from ({medians_sql}) m join ({modes}) s on {on}"
    return f"(select *{derived} from ({medians_sql}))"


VEG_SQL = "count(*) filter (where SCL_m = 4) / nullif(cast(count(SCL_m) as double), 0)"


def level_sql(bands, indices, funs, extra="", scl=False, where="true") -> str:
    keys = f"id{', ' + extra if extra else ''}"
    stats = ", ".join(
        f"round_even(cast({stat_sql(f, m + '_m')} as double) * 1e5, 0) / 1e5 as {m.lower()}_{f}" for m in [*bands, *indices] for f in funs
    )
    veg = f", round_even({VEG_SQL} * 1e5, 0) / 1e5 as veg_pc" if scl else ""
    return f"select {keys}, {stats}{veg} from {pixel_sql(bands, indices, extra, where, scl)} group by {keys}"


SEASON_COLUMNS = [f"{m.lower()}_{f}" for m in [*BANDS, "NDVI"] for f in SEASONAL_STATS] + ["veg_pc"]
SEASON_SQL = (
    "select id, "
    + ", ".join(
        f"max(case when season = {i} then {c} end) as {c}_s{i}" for i in range(len(SEASONS)) for c in SEASON_COLUMNS
    )
    + f" from ({level_sql(BANDS, SEASONAL_SQL, SEASONAL_STATS, 'season', True)}) group by id"
)
DIFF = [(b.lower(), f) for b, stats in DIFF_STATS.items() for f in stats]
MONTHLY_SQL_TEXT = level_sql(BANDS, MONTHLY_SQL, MONTHLY_STATS, "year_month")
MONTHLY_COLUMNS = [f"{m.lower()}_{f}" for m in [*BANDS, *MONTHLY_SQL] for f in MONTHLY_STATS]
PLOT_STATS_SQL = level_sql(
    BANDS,
    SEASONAL_SQL,
    SEASONAL_STATS,
    scl=True,
    where=f"cast(make_timestamp(time * 1000000) as date) between date '{START}' and date '{END}'",
)


# --- queries ---------------------------------------------------------------------------

def plot_stats(spark, sf_dir):
    return ps.plot_stats(observations(spark, sf_dir), START, END)


def veg_share(spark, sf_dir):
    stats = ps.plot_stats(observations(spark, sf_dir), START, END, bands=["B4"])
    whole = ps.plot_stats(observations(spark, sf_dir), START, END, bands=["B4"], compat=True)
    return stats.select("id", "veg_pc").join(whole.select("id", F.col("veg_pc").alias("veg_pc_compat")), "id")


def left_join_features(spark, sf_dir):
    stats = ps.plot_stats(observations(spark, sf_dir), START, END, bands=["B4", "B8"])
    return ps.left_join_features(plots(spark, sf_dir).select("plot_id", "tree_cover"), stats.drop("veg_pc"))


def bucketed_features(spark, sf_dir):
    """Plots and observations stored in buckets by plot: neither the statistics nor the join moves a stored row."""
    bands = ["B4", "B8"]
    seen = observations(spark, sf_dir).select("id", "longitude", "latitude", "time", "B4", "B5", "B8", "SCL", "MSK_CLDPRB", "MSK_SNWPRB", "HAS_CLOUDFLAG")
    tables = []
    for df, key in ((seen, "id"), (plots(spark, sf_dir).select("plot_id", "tree_cover"), "plot_id")):
        path = scratch_path(spark, "buckets")
        tables.append(write_bucketed(df, f"plotstats_{path[-32:]}", path, key, BUCKETS))
    stats = ps.plot_stats(tables[0], START, END, bands, bucketed=True)
    return ps.left_join_features(tables[1], stats.drop("veg_pc"))


def season_stats(spark, sf_dir):
    return ps.season_stats(observations(spark, sf_dir), SEASONS)


def season_diff(spark, sf_dir):
    wide = ps.season_stats(observations(spark, sf_dir), SEASONS, bands=["B1", "B2", "B3", "B4", "B12"])
    return ps.season_diff(wide).select("id", *[F.round(f"diff_{f}_{b}", 5).alias(f"diff_{f}_{b}") for b, f in DIFF])


def monthly_stats(spark, sf_dir):
    return ps.monthly_stats(observations(spark, sf_dir))


def monthly_min_max_med(spark, sf_dir):
    wide = ps.monthly_min_max_med(ps.monthly_stats(observations(spark, sf_dir)))
    return wide.select("id", *[F.round(c, 9).alias(c) if c.endswith("_med") else F.col(c) for c in wide.columns[1:]])


def _index(name, function, bands):
    def query(spark, sf_dir):
        df = observations(spark, sf_dir)
        value = function(*[F.col(b).cast("double") for b in bands])
        return df.select("id", "time", *bands, F.round(value, 9).alias(name))

    columns = ", ".join(bands)
    sql = (
        f"select id, time, {columns}, round({index_sql(name, 'cast({} as double)')}, 9) as {name} from {OBS_SQL}"
    )
    return query, sql


# Digits that both engines agree on, whatever the order of the additions.
DIGITS = {"variance": 3, "stdev": 6, "mode": 6, "median": 6, "lower_quartile": 6, "upper_quartile": 6}


def _aggregate(fun):
    """One statistic of two columns per supplier and per return flag."""
    measures = {"q": "l_quantity", "p": "l_extendedprice"}

    def query(spark, sf_dir):
        df = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", *measures.values())
        wanted = {f"{k}_{fun}": (fun, c) for k, c in measures.items()}
        parts = []
        for kind, key in (("supplier", "l_suppkey"), ("flag", "l_returnflag")):
            stats = grouped_stats(df, [key], wanted)
            values = [F.round(F.col(c).cast("double"), DIGITS[fun]).alias(c) for c in wanted]
            parts.append(stats.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("grp"), *values))
        return parts[0].unionByName(parts[1])

    def part(kind, key):
        if fun == "mode":
            one = [
                f"(select grp, case when count(*) = 1 then min(v) end as {k}_mode from (select *, max(n) over"
                f" (partition by grp) as top from (select {key} as grp, {c} as v, count(*) as n from lineitem group by all))"
                f" where n = top group by grp) {k}"
                for k, c in measures.items()
            ]
            return (
                f"select '{kind}' as kind, cast(grp as varchar) as grp, q_mode, p_mode from {one[0]} join {one[1]} using (grp)"
            )
        stats = ", ".join(f"round({stat_sql(fun, c)}, {DIGITS[fun]}) as {k}_{fun}" for k, c in measures.items())
        return f"select '{kind}' as kind, cast({key} as varchar) as grp, {stats} from lineitem group by {key}"

    return query, part("supplier", "l_suppkey") + " union all " + part("flag", "l_returnflag")


def median_composite(spark, sf_dir):
    df = observations(spark, sf_dir)
    return ps.median_composite(df, ["longitude", "latitude"], ["B2", "B3", "B4"])


def daily_median_series(spark, sf_dir):
    """Median price bands per discount class and day."""
    df = table(spark, sf_dir, "lineitem").select(
        F.round(F.col("l_discount") * 100).cast("bigint").alias("class"),
        F.expr("unix_seconds(cast(l_shipdate as timestamp))").alias("time"),
        F.col("l_extendedprice").alias("B2"),
        F.col("l_quantity").alias("B3"),
    )
    series = ps.daily_median_series(df, "class", utc_date(F.col("time")), ["B2", "B3"])
    return series.select("class", F.col("day").cast("string").alias("day"), F.round("B2", 3).alias("B2"), "B3")


def plot_raster(spark, sf_dir):
    df = raster_query(observations(spark, sf_dir), START, END)
    return df.select("id", *[F.round(c, 6).alias(c) for c in df.columns[1:]])


def _plot_raster_sql() -> str:
    where = f"cast(make_timestamp(time * 1000000) as date) between date '{START}' and date '{END}'"
    base = f"(select * from {OBS_SQL} where {CLEAR_SQL} and {where})"
    medians = (
        "select id, longitude, latitude, floor(median(TCI_R)) as R, floor(median(TCI_G)) as G, floor(median(TCI_B)) as B,"
        " round_even((median(B8) - median(B5)) / nullif(median(B8) + median(B5), 0) * 1275e-1 + 1275e-1, 0) as ndvi"
        f" from {base} group by id, longitude, latitude"
    )
    placed = (
        "select *, dense_rank() over (partition by id order by longitude) - 1 as ri,"
        f" dense_rank() over (partition by id order by latitude) - 1 as ci from ({medians})"
    )
    grid = (
        "select *, max(ri) over (partition by id) + 1 as h, max(ci) over (partition by id) + 1 as w,"
        f" count(ndvi) over (partition by id) as n from ({placed})"
    )
    cells = ", ".join(
        f"round(max(case when ri = floor(({x} + 5e-1) * h / 8) and ci = floor(({y} + 5e-1) * w / 7)"
        f" then ({b} - 1275e-1) / 1275e-1 end), 6) as {b}_{x}_{y}"
        for x in range(8)
        for y in range(7)
        for b in RASTER_BANDS
    )
    return f"select id, {cells} from ({grid}) where n = h * w group by id"


QUERIES = {
    "plot_stats": (plot_stats, PLOT_STATS_SQL),
    "veg_share": (
        veg_share,
        f"select id, round_even({VEG_SQL} * 1e5, 0) / 1e5 as veg_pc, cast(count(*) filter (where SCL_m = 4) //"
        f" nullif(count(SCL_m), 0) as double) as veg_pc_compat from {pixel_sql(['B4'], SEASONAL_SQL, scl=True)} group by id",
    ),
    "left_join_features": (
        left_join_features,
        f"select p.plot_id, p.tree_cover, f.* exclude (id) from {PLOTS_SQL} p left join"
        f" ({level_sql(['B4', 'B8'], SEASONAL_SQL, SEASONAL_STATS)}) f on p.plot_id = f.id",
    ),
    "bucketed_features": (
        bucketed_features,
        f"select p.plot_id, p.tree_cover, f.* exclude (id) from {PLOTS_SQL} p left join"
        f" ({level_sql(['B4', 'B8'], SEASONAL_SQL, SEASONAL_STATS)}) f on p.plot_id = f.id",
    ),
    "season_stats": (season_stats, SEASON_SQL),
    "season_diff": (
        season_diff,
        "select id, "
        + ", ".join(
            f"round(greatest({b}_{f}_s0, {b}_{f}_s1, {b}_{f}_s2) - least({b}_{f}_s0, {b}_{f}_s1, {b}_{f}_s2), 5)"
            f" as diff_{f}_{b}"
            for b, f in DIFF
        )
        + f" from ({SEASON_SQL})",
    ),
    "monthly_stats": (monthly_stats, MONTHLY_SQL_TEXT),
    "monthly_min_max_med": (
        monthly_min_max_med,
        "select id, "
        + ", ".join(
            [f"min({c}) as {c}_min, max({c}) as {c}_max, round(median({c}), 9) as {c}_med" for c in MONTHLY_COLUMNS]
        )
        + f" from ({MONTHLY_SQL_TEXT}) group by id",
    ),
    "idx_ndvi_b5": _index("ndvi_b5", ix.ndvi_b5, ("B5", "B8")),
    "idx_ndvi": _index("ndvi", ix.ndvi, ("B4", "B8")),
    "idx_endvi": _index("endvi", ix.endvi, ("B2", "B3", "B8")),
    "idx_gdvi": _index("gdvi", ix.gdvi, ("B3", "B8")),
    "idx_msavi2": _index("msavi2", ix.msavi2, ("B4", "B8")),
    "idx_savi": _index("savi", ix.savi, ("B4", "B8")),
    **{f"agg_{f}": _aggregate(f) for f in ("stdev", "variance", "mode", "median", "lower_quartile", "upper_quartile")},
    "median_composite": (
        median_composite,
        "select longitude, latitude, median(B2) as B2, median(B3) as B3, median(B4) as B4"
        f" from {OBS_SQL} group by longitude, latitude",
    ),
    "daily_median_series": (
        daily_median_series,
        "select cast(round(l_discount * 100) as bigint) as class, cast(cast(l_shipdate as date) as varchar) as day,"
        " round(median(l_extendedprice), 3) as B2, median(l_quantity) as B3 from lineitem group by 1, 2",
    ),
    "plot_raster": (plot_raster, _plot_raster_sql()),
}
