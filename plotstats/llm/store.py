"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.session import remove, scratch_path

#: A table that is sent to every executor has at most so many bytes of values, by `bytes_of`.
BROADCAST_BYTES = 24 << 20
#: Texts are handed to Python workers so many at a time.
BATCH_ROWS = "500"
#: Removes the shuffle files of a statement as soon as it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def saved(df: DataFrame) -> DataFrame:
    """Writes the table below spark.checkpoint.dir and reads it from there: the lineage ends, any executor can read on.

    The shuffles of the write are its own, so their files go when it ends.
    """
    path = scratch_path(df.sparkSession, "llm")
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by `saved` that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, table._scratch)


def bytes_of(column: str, kind: T.DataType) -> Column:
    """About the memory of a value: arrays by their elements, texts by their length."""
    if isinstance(kind, T.ArrayType):
        width = 8 * len(kind.elementType.fields) + 16 if isinstance(kind.elementType, T.StructType) else 8
        return F.coalesce(F.size(column), F.lit(0)) * width + 24
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    return F.lit(8 * len(kind.fields) + 16 if isinstance(kind, T.StructType) else 8)


def handy(table: DataFrame, most: int | None = None) -> DataFrame:
    """A written table, sent to every executor if its values take at most `most` bytes, else joined by shuffling."""
    row = sum((bytes_of(f.name, f.dataType) for f in table.schema.fields), F.lit(16))
    size = table.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(table) if size <= (BROADCAST_BYTES if most is None else most) else table
