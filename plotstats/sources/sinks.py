"""Writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from plotstats.operators.tables import wkt_point


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Adds the rows to a parquet table, optionally with one directory per value of a column."""
    if partition_by:
        write_partitioned(df, path, partition_by, mode="append")
    else:
        df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One directory per value of `column`.

    Rows are brought together by value, so a directory gets few files; the rebalance
    splits a value that holds much more than the others.
    """
    df.hint("rebalance", column).write.mode(mode).partitionBy(column).format(fmt).option("header", True).save(path)


def write_bounded(df: DataFrame, path: str, rows: int = 5300, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Files of at most `rows` rows."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).option("header", True).format(fmt).save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, partition_by: str | None = None) -> DataFrame:
    """Stores the rows as a table of the catalogue in `buckets` files by hash of `key`, sorted by it, and reads it from there.

    Joins and groupings by `key` of such tables with equal numbers of buckets need no exchange. Give tables that are joined the same
    number, large enough that a bucket suits a task.
    """
    # one file per bucket, written by the task that holds it; with `partition_by`, one per bucket and value
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def with_wkt(df: DataFrame, lon: Column, lat: Column) -> DataFrame:
    """Adds the point geometry as well-known text, for CSV and parquet sinks."""
    return df.withColumn("geometry", wkt_point(lon, lat))
