"""Queries: incremental ingest of the raw observations and the features derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotstats.operators.observations import clean_observations
from plotstats.operators.tables import row_key
from plotstats.plans.statistics import SEASONAL_SQL, SEASONAL_STATS, level_sql
from plotstats.plans.views import END, PLOTS_SQL, RAW_SQL, START, plots, raw_observations
from plotstats.session import scratch_path
from plotstats.streaming import ingest as stream
from plotstats.streaming.fetch import fetch_points, folder_fetch

ROW = ["id", "longitude", "latitude", "time", "B4", "B8", "HAS_CLOUDFLAG"]
BANDS = ["B4", "B8"]
NEEDED = ["id", "longitude", "latitude", "time", "B4", "B5", "B8", "SCL", "MSK_CLDPRB", "MSK_SNWPRB", "QA10", "QA20", "QA60"]


# Rows of a raw file, about; a task reads one.
FILE_ROWS = 500_000
BATCHES = 2


def _raw_files(spark, sf_dir, files):
    """Raw files, at least so many, their schema, and the files of each of BATCHES batches."""
    path = scratch_path(spark, "raw")
    df = raw_observations(spark, sf_dir).select(*NEEDED)
    files = max(files, -(-df.count() // FILE_ROWS))
    df.repartition(files).write.parquet(path)
    return path, df.schema, -(-files // BATCHES)


def incremental_ingest(spark, sf_dir):
    source, schema, per_batch = _raw_files(spark, sf_dir, 4)
    target, state = scratch_path(spark, "observations"), scratch_path(spark, "state")
    stream.ingest(spark, source, target, state, schema, files_per_batch=per_batch)
    # A second run finds nothing new.
    stream.ingest(spark, source, target, state, schema, files_per_batch=per_batch)
    return spark.read.parquet(target).select(*ROW)


def resumable_fetch(spark, sf_dir):
    """Observations asked for point by point, in two runs: the second goes on where the first one stopped."""
    remote = scratch_path(spark, "remote")
    raw = raw_observations(spark, sf_dir).select(*[c for c in ROW if c != "HAS_CLOUDFLAG"], "QA10", "QA20", "QA60")
    # a folder per point: each task moves its own into place, not the driver all of them
    stored = raw.repartition("id").write.partitionBy("id").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    stored.json(remote)
    known = scratch_path(spark, "points")
    row_key(plots(spark, sf_dir).select(F.col("plot_id").alias("id"), "longitude", "latitude"), ["id"], "point").write.parquet(known)
    points = spark.read.parquet(known)
    target, log, state = (scratch_path(spark, n) for n in ("observations", "log", "state"))
    half = points.count() // 2
    for until in (half, None):
        fetch_points(spark, points, folder_fetch(remote), raw.schema, target, log, state, until)
    return spark.read.parquet(target).select(*ROW)


def ingest_new_ids(spark, sf_dir):
    """Of all fetched rows, those of plots that the stored table does not hold yet."""
    fetched = clean_observations(raw_observations(spark, sf_dir).select(*NEEDED))
    stored = scratch_path(spark, "observations")
    known = plots(spark, sf_dir).where("land_use_category != 'forest'").select("plot_id")
    fetched.join(known, fetched["id"] == known["plot_id"], "left_semi").write.parquet(stored)
    return stream.ingest_new_ids(fetched, spark.read.parquet(stored)).select(*ROW)


def incremental_features(spark, sf_dir):
    source, schema, per_batch = _raw_files(spark, sf_dir, 2)
    observations, features, state = (scratch_path(spark, n) for n in ("observations", "features", "state"))
    stream.refresh_plot_stats(spark, source, observations, features, state, START, END, BANDS, schema, files_per_batch=per_batch)
    return stream.latest_features(spark, features)


_CLEANED = (
    "(select * exclude (longitude, latitude, time), round_even(longitude * 1e7, 0) / 1e7 as longitude, round_even(latitude * 1e7, 0) / 1e7 as latitude,"
    f" time // 1000 as time, QA60 in (1024, 2048) as HAS_CLOUDFLAG from {RAW_SQL})"
)


def _features_sql() -> str:
    from plotstats.plans.views import OBS_SQL

    return level_sql(BANDS, SEASONAL_SQL, SEASONAL_STATS, scl=True).replace(OBS_SQL, _CLEANED)


QUERIES = {
    "incremental_ingest": (incremental_ingest, f"select {', '.join(ROW)} from {_CLEANED}"),
    "resumable_fetch": (resumable_fetch, f"select {', '.join(ROW)} from {_CLEANED} where id in (select plot_id from {PLOTS_SQL})"),
    "ingest_new_ids": (
        ingest_new_ids,
        f"select {', '.join(ROW)} from {_CLEANED} where id not in (select plot_id from {PLOTS_SQL} where land_use_category <> 'forest')",
    ),
    "incremental_features": (incremental_features, _features_sql()),
}
