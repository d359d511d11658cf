"""Queries: sources and sinks, as round trips of whole tables through files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators.observations import cast_bands
from plotstats.operators.joins import chunk_key
from plotstats.plans.views import PLOTS_SQL, RAW_SQL, plots, raw_observations, table
from plotstats.schemas import PLOTS
from plotstats.session import scratch_path
from plotstats.sources import readers, sinks

ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "plots")
    plots(spark, sf_dir).write.option("header", True).option("sep", ";").csv(path)
    return readers.read_csv(spark, path, PLOTS, ";", ["plot_id", "longitude", "latitude", "Aridity_zone", "tree_cover"])


def scan_csv_skip(spark, sf_dir):
    """Chunk files of ten points each, with a title line above the header."""
    path = scratch_path(spark, "chunks")
    points = plots(spark, sf_dir)
    line = F.concat_ws(",", "plot_id", "longitude", "latitude")
    files = points.groupBy(chunk_key(F.col("plot_id"), 2**62).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("plot_id", line.alias("t")))), lambda s: s["t"]), "\n").alias("body")
    )
    text = F.concat(F.lit("exported points\nplot_id,longitude,latitude\n"), "body")
    files.select("chunk", text.alias("value")).write.partitionBy("chunk").text(path, lineSep="\n")
    schema = T.StructType([f for f in PLOTS.fields if f.name in ("plot_id", "longitude", "latitude")])
    return readers.read_csv_below_title(spark, f"{path}/*/*.txt", schema).drop("file")


def scan_parquet(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"])


def scan_keyed_files(spark, sf_dir):
    path = scratch_path(spark, "regions")
    df = plots(spark, sf_dir).select("plot_id", "longitude", "dryland_assessment_region")
    sinks.write_partitioned(df, path, "dryland_assessment_region", "csv")
    schema = T.StructType([f for f in PLOTS.fields if f.name in ("plot_id", "longitude")])
    return readers.read_keyed_files(spark, f"{path}/*/*.csv", schema, r"dryland_assessment_region=(\w+)/", ["region"])


def cast_bands_query(spark, sf_dir):
    raw = raw_observations(spark, sf_dir).select("id", "time", "B1", "B2", "SCL", "QA60")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return cast_bands(text, {"id": "bigint", "time": "bigint", "B1": "int", "B2": "int", "SCL": "int", "QA60": "bigint"})


def sink_append(spark, sf_dir):
    path = scratch_path(spark, "orders")
    df = _orders(spark, sf_dir)
    early = F.col("o_totalprice") < 100_000
    sinks.append(df.where(early), path, "o_orderstatus")
    sinks.append(df.where(~early), path, "o_orderstatus")
    return spark.read.parquet(path)


def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "orders")
    df = _orders(spark, sf_dir)
    sinks.write_csv(df, path)
    return readers.read_csv(spark, path, df.schema)


def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "orders")
    sinks.write_parquet(_orders(spark, sf_dir), path)
    return spark.read.parquet(path)


def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "orders")
    sinks.write_partitioned(_orders(spark, sf_dir), path, "o_orderstatus")
    return spark.read.parquet(path)


def sink_bounded(spark, sf_dir):
    """Rows per file of the split table, never above the bound."""
    path = scratch_path(spark, "orders")
    df = _orders(spark, sf_dir)
    sinks.write_bounded(df, path, 5300)
    back = readers.read_csv(spark, path, df.schema)
    files = back.groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("s"))
    return files.agg(
        F.sum("n").alias("rows"), F.sum("s").alias("key_sum"), (F.max("n") <= 5300).alias("within_bound")
    )


def wkt_points(spark, sf_dir):
    df = sinks.with_wkt(plots(spark, sf_dir), F.round("longitude", 7), F.round("latitude", 7))
    return df.select("plot_id", "geometry")


QUERIES = {
    "scan_csv": (scan_csv, f"select plot_id, longitude, latitude, Aridity_zone, tree_cover from {PLOTS_SQL}"),
    "scan_csv_skip": (scan_csv_skip, f"select plot_id, longitude, latitude, plot_id % 10 as line from {PLOTS_SQL}"),
    "scan_parquet": (scan_parquet, "select o_orderkey, o_totalprice from orders"),
    "scan_keyed_files": (
        scan_keyed_files,
        f"select plot_id, longitude, dryland_assessment_region as region from {PLOTS_SQL}",
    ),
    "cast_bands": (cast_bands_query, f"select id, time, B1, B2, SCL, QA60 from {RAW_SQL}"),
    "sink_append": (sink_append, ORDERS_SQL),
    "sink_csv": (sink_csv, ORDERS_SQL),
    "sink_parquet": (sink_parquet, ORDERS_SQL),
    "sink_partitioned": (sink_partitioned, ORDERS_SQL),
    "sink_bounded": (
        sink_bounded,
        "select count(*) as rows, cast(sum(o_orderkey) as bigint) as key_sum, true as within_bound from orders",
    ),
    "wkt_points": (
        wkt_points,
        "select plot_id, 'POINT (' || cast(round(longitude, 7) as varchar) || ' ' || cast(round(latitude, 7) as varchar)"
        f" || ')' as geometry from {PLOTS_SQL}",
    ),
}
