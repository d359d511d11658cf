"""Incremental ingest of raw observations and refresh of the features they touch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators.indices import SEASONAL_INDICES
from plotstats.operators.observations import clean_observations, clear_sky, in_days
from plotstats.operators.plot_stats import level_columns, merged_runs, pixel_runs, stats_of_runs
from plotstats.operators.skew import lookup_join, tasks_for
from plotstats.schemas import RAW_OBSERVATIONS, SEASONAL_STATS
from plotstats.session import folders, remove

# Directories per batch of the observation table.
BUCKETS = 256


def _new_files(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    schema: T.StructType = RAW_OBSERVATIONS,
    files_per_batch: int | None = None,
) -> None:
    """Cleans every raw file not seen before and appends it to the observation table.

    The checkpoint in `state` remembers what was read; an interrupted run continues
    where it stopped, and the file sink lists each batch exactly once.
    """
    cleaned = clean_observations(_new_files(spark, source, schema, files_per_batch))
    query = (
        cleaned.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_new_ids(fetched: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Batch form: rows of ids that the stored table does not hold yet."""
    return lookup_join(fetched, stored, [key], "left_anti")


def refresh_features(
    spark: SparkSession,
    source: str,
    observations: str,
    features: str,
    state: str,
    compute: Callable[[DataFrame], DataFrame],
    schema: T.StructType = RAW_OBSERVATIONS,
    files_per_batch: int | None = None,
) -> None:
    """Ingests like `ingest` and recomputes the features of the plots each batch touches.

    For any `compute`: it runs over all stored
    observations of the touched plots (`refresh_plot_stats` needs only a mergeable state). These are stored by bucket of the plot id, so
    only the buckets with a touched plot are read. Both tables are written per batch
    number: a batch that is run again replaces its own output, and a reader takes the
    latest row per plot.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        cleaned = clean_observations(batch).withColumns(
            {"bucket": F.pmod(F.hash("id"), F.lit(BUCKETS)), "batch": F.lit(number)}
        )
        (
            cleaned.hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch", "bucket")
            .parquet(observations)
        )
        # Every batch so far, whatever later files an earlier attempt may have left.
        stored = session.read.parquet(observations).where(F.col("batch") <= number)
        touched = stored.where(F.col("batch") == number).select("id", "bucket").distinct()
        # At most BUCKETS numbers.
        buckets = [r[0] for r in touched.select("bucket").distinct().collect()]
        pruned = stored.where(F.col("bucket").isin(buckets)).drop("batch", "bucket")
        affected = lookup_join(pruned, touched.select("id"), ["id"], "left_semi")
        (
            compute(affected)
            .withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(features)
        )

    query = (
        _new_files(spark, source, schema, files_per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def state_versions(spark: SparkSession, state: str, buckets: list[int], before: int) -> dict[int, list[tuple[int, str]]]:
    """Of each bucket, the versions of its state older than batch `before`, newest first, with their paths."""
    found: dict[int, list[tuple[int, str]]] = {}
    for bucket in buckets:
        paths = folders(spark, f"{state}/bucket={bucket}/version=*")
        versions = [(int(p.rsplit("=", 1)[1]), p) for p in paths]
        found[bucket] = sorted((v for v in versions if v[0] < before), reverse=True)
    return found


def refresh_plot_stats(
    spark: SparkSession,
    source: str,
    observations: str,
    features: str,
    state: str,
    start: str,
    end: str,
    bands: Sequence[str],
    schema: T.StructType = RAW_OBSERVATIONS,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Ingests like `ingest` and brings the `plot_stats` of the plots each batch touches up to date.

    The state holds, by bucket of the plot, the run lengths of every pixel and measure: they are exact and merge by addition, so a
    batch reads its own rows and the state of the buckets it touches, never earlier observations. A
    bucket's state is written as a new version, numbered like the batch: a batch that is run again starts from
    the same older version and replaces its own output. Versions that no batch can need any more are deleted.
    """
    runs_state = f"{state}/runs"
    needed, scl = level_columns(bands, SEASONAL_INDICES, True)
    measures = [*needed, *scl]

    def on_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        cleaned = clean_observations(batch).withColumn("bucket", F.pmod(F.hash("id"), F.lit(buckets)))
        own_rows = f"{observations}/batch={number}"
        cleaned.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(own_rows)
        own = session.read.schema(cleaned.schema).parquet(own_rows)
        clear = own.where(in_days(start, end) & clear_sky())
        # this session is the query's own
        tasks = tasks_for(session, own.count() * len(measures))
        if tasks:
            session.conf.set("spark.sql.shuffle.partitions", tasks)
        delta = pixel_runs(clear, bands, SEASONAL_INDICES, scene_class=True)
        # At most `buckets` numbers.
        touched = sorted(r[0] for r in clear.select("bucket").distinct().collect())
        if not touched:
            return
        older = state_versions(session, runs_state, touched, number)
        paths = [versions[0][1] for versions in older.values() if versions]
        if paths:
            delta = merged_runs(delta.unionByName(session.read.schema(delta.schema).parquet(*paths)))
        placed = delta.withColumns({"bucket": F.pmod(F.hash("id"), F.lit(buckets)), "version": F.lit(number)})
        (
            placed.hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "version")
            .parquet(runs_state)
        )
        now = session.read.schema(delta.schema).parquet(*[f"{runs_state}/bucket={b}/version={number}" for b in touched])
        ids = clear.select("id").distinct()
        affected = lookup_join(now, ids, ["id"], "left_semi")
        (
            stats_of_runs(affected, clear, bands, SEASONAL_INDICES, SEASONAL_STATS, "veg_share")
            .withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(features)
        )
        for versions in older.values():
            for _, path in versions[1:]:
                remove(session, path)

    query = (
        _new_files(spark, source, schema, files_per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{state}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_features(spark: SparkSession, features: str) -> DataFrame:
    """The current feature row of every plot: the one of the last batch that touched it."""
    stored = spark.read.parquet(features)
    values = [c for c in stored.columns if c not in ("id", "batch")]
    newest = stored.groupBy("id").agg(F.max_by(F.struct(*values), "batch").alias("row"))
    return newest.select("id", "row.*")


