"""Plots, observations, samples and rasters derived from the stored tables.

Each view is a list of SQL expressions over one table, so the same text defines it
for Spark and for the SQL that checks the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The observed period, and three seasons that cover it.
START, END = "1995-01-01", "2001-12-31"
SEASONS = (("1995-01-01", "1997-03-31"), ("1997-04-01", "1999-06-30"), ("1999-07-01", "2001-12-31"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lon(key: str) -> str:
    return f"(cast({key} % 340 as double) - 170 + 123e-3 + floor({key} / 340) * 1e-2)"


def _lat(key: str) -> str:
    return f"(cast(({key} * 7) % 140 as double) - 70 + 321e-3)"


def sql_view(columns: dict[str, str], source: str) -> str:
    return "(select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {source})"


def spark_view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


PLOT_VIEW = {
    "plot_id": "s_suppkey",
    "longitude": _lon("s_suppkey"),
    "latitude": _lat("s_suppkey"),
    "dryland_assessment_region": "concat('Region', cast(s_nationkey % 12 as varchar(9)))",
    "Aridity_zone": "case s_nationkey % 4 when 0 then 'Arid' when 1 then 'Semiarid' when 2 then 'Hyperarid'"
    " else 'Dry subhumid' end",
    "land_use_category": "case s_suppkey % 3 when 0 then 'forest' when 1 then 'grassland' else 'barren' end",
    "tree_cover": "floor(abs(s_acctbal)) % 20 / 2e1",
}

_Q, _E, _D, _T = (
    "floor(l_quantity)",
    "floor(l_extendedprice / 100)",
    "round(l_discount * 100)",
    "round(l_tax * 100)",
)
_BAND_EXPRS = {
    "B1": f"{_Q} * 20 + {_D}",
    "B2": f"{_Q} * 15 + {_T} * 3",
    "B3": f"{_E} + {_D}",
    "B4": f"{_Q} * 30 + {_T}",
    "B5": f"{_E} + {_Q}",
    "B6": f"{_Q} * 10 + {_E}",
    "B7": f"{_E} * 2 + {_T}",
    "B8": f"{_E} * 2 + {_Q} * 7",
    "B8A": f"{_E} + {_D} * 50",
    "B9": f"{_Q} * 3 + {_T}",
    "B11": f"{_E} * 3 + {_D} * 5",
    "B12": f"{_Q} * 25 + {_D} * 2",
    "AOT": _Q,
    "WVP": f"{_D} * 10 + {_T}",
    "SCL": f"{_Q} % 3 + 3",
    "TCI_R": f"{_Q} * 5",
    "TCI_G": f"{_E} % 256",
    "TCI_B": f"{_D} * 20",
}
_OBS_COMMON = {
    "id": "l_suppkey",
    "longitude": f"{_lon('l_suppkey')} + (l_linenumber % 4) * 2e-4",
    "latitude": f"{_lat('l_suppkey')} + (l_partkey % 3) * 3e-4",
}
_OBS_VALUES = {
    **{b: f"cast({e} as int)" for b, e in _BAND_EXPRS.items()},
    "MSK_CLDPRB": "case when l_returnflag = 'R' then null else l_tax * 2 end",
    "MSK_SNWPRB": "l_discount",
}
SPARK_SECONDS = "unix_seconds(cast(l_shipdate as timestamp))"
DUCK_SECONDS = "cast(epoch(l_shipdate) as bigint)"


def _observation_columns(seconds: str) -> dict[str, str]:
    return {**_OBS_COMMON, "time": seconds, **_OBS_VALUES, "HAS_CLOUDFLAG": "(l_linestatus = 'F')"}


def _raw_columns(seconds: str) -> dict[str, str]:
    """Observations as fetched: milliseconds, unrounded coordinates, quality bands."""
    return {
        "id": "l_suppkey",
        "longitude": f"{_OBS_COMMON['longitude']} + l_linenumber * 1e-9",
        "latitude": f"{_OBS_COMMON['latitude']} - l_linenumber * 1e-9",
        "time": f"{seconds} * 1000 + 499",
        **_OBS_VALUES,
        "QA10": "cast(0 as bigint)",
        "QA20": "cast(0 as bigint)",
        "QA60": "cast(case when l_linestatus = 'O' then 0 when l_linenumber % 3 = 0 then 1024"
        " when l_linenumber % 3 = 1 then 2048 else 3072 end as bigint)",
    }


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "supplier"), PLOT_VIEW)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "lineitem"), _observation_columns(SPARK_SECONDS))


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "lineitem"), _raw_columns(SPARK_SECONDS))


PLOTS_SQL = sql_view(PLOT_VIEW, "supplier")
OBS_SQL = sql_view(_observation_columns(DUCK_SECONDS), "lineitem")
RAW_SQL = sql_view(_raw_columns(DUCK_SECONDS), "lineitem")
CLEAR_SQL = "((not HAS_CLOUDFLAG and MSK_CLDPRB is null) or (MSK_CLDPRB < 1e-1 and MSK_SNWPRB < 1e-1))"

def _place(key: str) -> str:
    """Three customers share a place."""
    return f"({key} - {key} % 3)"


# Points around the plots, with the records fetched for them.
POINT_VIEW = {
    "point_id": "c_custkey",
    "longitude": _lon(_place('c_custkey')),
    "latitude": _lat(_place('c_custkey')),
    "acctbal": "c_acctbal",
}
PIXEL_VIEW = {
    "point_id": "o_custkey",
    "longitude": f"{_lon(_place('o_custkey'))} + (o_orderkey % 5 - 2) * 1e-4",
    "latitude": f"{_lat(_place('o_custkey'))} + (o_orderkey % 3 - 1) * 1e-4",
    "B1": "floor(o_totalprice / 100) + 0e0",
    "B2": "o_totalprice % 1000",
}
# Exported samples whose coordinates differ slightly from those of the plots; every
# tenth plot stands on its neighbour.
SAMPLE_VIEW = {
    "sample_id": "c_custkey",
    "longitude": f"{_lon(_place('c_custkey'))} + (c_custkey % 7 - 3) * 4e-4",
    "latitude": f"{_lat(_place('c_custkey'))} + (c_custkey % 5 - 2) * 2e-4",
    "B1": "c_acctbal",
}
_DOUBLED = "(s_suppkey - case when s_suppkey % 10 = 9 then 1 else 0 end)"
SITE_VIEW = {
    "plot_id": "s_suppkey",
    "longitude": _lon(_DOUBLED),
    "latitude": _lat(_DOUBLED),
    "tree_cover": PLOT_VIEW["tree_cover"],
}


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "customer"), POINT_VIEW)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "orders"), PIXEL_VIEW)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "customer"), SAMPLE_VIEW)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "supplier"), SITE_VIEW)


POINTS_SQL = sql_view(POINT_VIEW, "customer")
PIXELS_SQL = sql_view(PIXEL_VIEW, "orders")
SAMPLES_SQL = sql_view(SAMPLE_VIEW, "customer")
SITES_SQL = sql_view(SITE_VIEW, "supplier")

# Labelled rows for sampling and evaluation.
EVAL_VIEW = {
    "row_id": "o_orderkey",
    "label": "cast(floor(o_totalprice / 1e5) as int)",
    "cover": "least(floor(o_totalprice / 25000) / 2e1, 1e0)",
    "guess": "least(floor(o_totalprice / 25000) / 2e1, 1e0) * 8e-1 + (o_custkey % 100) / 5e2",
    "w": "o_custkey % 7 + 1e0",
}
EVAL_SQL = sql_view(EVAL_VIEW, "orders")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(table(spark, sf_dir, "orders"), EVAL_VIEW)


# 64 numbers per vector as a 4 x 16, 16 x 4 or 8 x 8 image.
_WIDTH = "case vec_id % 3 when 0 then 16 when 1 then 4 else 8 end"
IMAGE_SQL = (
    f"(select vec_id as image_id, cast(floor(pos / ({_WIDTH})) as bigint) as row, cast(pos % ({_WIDTH}) as bigint) as col, cast(v as double) as val,"
    f" cast(64 / ({_WIDTH}) as bigint) as height, cast({_WIDTH} as bigint) as width from "
    "(select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as pos from embeddings))"
)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return cells.selectExpr(
        "vec_id as image_id",
        f"cast(floor(pos / ({_WIDTH})) as bigint) as row",
        f"cast(pos % ({_WIDTH}) as bigint) as col",
        "cast(v as double) as val",
    )
