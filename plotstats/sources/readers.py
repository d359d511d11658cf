"""Reading tables and files with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header line; only `columns` are parsed when given."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv_below_title(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files whose header is on the second line.

    Adds `line` (0 for the first record) and `file`. Lines are numbered per block of a file and
    the blocks are lined up by their sizes, so a large file is read by many tasks.
    """
    block = ["file", "block"]
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_order"),
    )
    # blank lines do not count, unless one stands in the place of the title
    in_order = Window.partitionBy(*block).orderBy("_order")
    lines = lines.withColumn("_first", (F.col("block") == 0) & (F.row_number().over(in_order) == 1))
    lines = lines.where("_first or trim(value) <> ''").drop("_first")
    sizes = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_held"))
    upto = F.sum("_held").over(Window.partitionBy("file").orderBy("block"))
    starts = sizes.select(*block, (upto - F.col("_held")).alias("_start"))
    in_block = F.row_number().over(in_order) - 1
    numbered = lines.withColumn("_in_block", in_block).join(starts, block)
    records = numbered.withColumn("line", F.col("_start") + F.col("_in_block") - 2).where("line >= 0")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = records.withColumn("r", F.from_csv("value", fields))
    return parsed.select("r.*", F.col("line").cast("bigint").alias("line"), "file")


def read_keyed_files(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str, keys: Sequence[str]
) -> DataFrame:
    """All CSV files of a glob as one table; the groups of `pattern` in the file path become columns."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    # the path is that of a URI; a plus sign in it is one
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select("*", *[F.regexp_extract(name, pattern, i + 1).alias(k) for i, k in enumerate(keys)])
