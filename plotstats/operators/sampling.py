"""Repeatable sampling and splitting by hash of the row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.operators.orderstats import sort_rows
from plotstats.operators.skew import lookup_join
from plotstats.session import materialize

HASH_BITS = 60
# Each round of `stratify` looks at so many more bits of the hash.
SLICE_BITS = 12


def key_hash(key: Column, seed: int = 42, digits: int = HASH_BITS // 4) -> Column:
    """First hexadecimal digits of the md5 of key and seed, as a number."""
    text = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def uniform(key: Column, seed: int = 42) -> Column:
    """Repeatable number in [0, 1) per row."""
    return key_hash(key, seed, 8) / float(2**32)


def train_test_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the share holds on average, a row's side depends on its key alone."""
    # the last digits of the hash are the thousandths, the others what lies between them
    code = key_hash(F.col(key), seed, 8)
    thousandths = F.pmod(code, F.lit(1000)) + F.floor(code / 1000) / (2**32 // 1000 + 1)
    in_test = F.coalesce(thousandths < test_share * 1000, F.lit(False))
    return df.where(~in_test), df.where(in_test)


def stratify(df: DataFrame, label: str, key: str, scale: int = 4, seed: int = 42) -> DataFrame:
    """At most `scale` times the size of the smallest class from each class, without replacement.

    Rows are taken in hash order. The part of the hash in which the limit of a class falls is narrowed bit by bit, by
    counting its slices, until it holds no more rows than a task sorts; rows below it are taken whole, rows above it
    are left, and only the rows in it are numbered. So neither the size of a class nor that of the table matters.
    """
    rows = df.where(F.col(label).isNotNull()).withColumn("_hash", key_hash(F.col(key), seed))
    most = sort_rows(df)
    counts = materialize(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_held")))
    limit = (counts.agg(F.min("_held")).first()[0] or 0) * scale
    # the part of each class's hashes with the limit: those whose upper `bits` bits are `_part`, of which `_room` are taken
    cut = counts.where(F.col("_held") > limit).select(label, F.lit(0).cast("bigint").alias("_part"), F.lit(limit).cast("bigint").alias("_room"), "_held")
    bits = 0
    while bits < HASH_BITS and (cut.agg(F.max("_held")).first()[0] or 0) > most:
        part = F.shiftright("_hash", HASH_BITS - bits) if bits else F.lit(0)
        inside = lookup_join(rows.select(label, "_hash"), cut.select(label, "_part", "_room"), [label], "inner").where(part == F.col("_part"))
        bits += SLICE_BITS
        held = inside.groupBy(label, F.shiftright("_hash", HASH_BITS - bits).alias("_part")).agg(F.count(F.lit(1)).alias("_held"), F.first("_room").alias("_room"))
        upto = F.sum("_held").over(Window.partitionBy(label).orderBy("_part"))
        # 4,096 slices of each class at most
        cut = materialize(
            held.withColumn("_before", upto - F.col("_held"))
            .where("_before < _room and _room <= _before + _held")
            .select(label, "_part", (F.col("_room") - F.col("_before")).alias("_room"), "_held")
        )
    placed = lookup_join(rows, cut.select(label, "_part", "_room"), [label], "left")
    own = F.shiftright("_hash", HASH_BITS - bits) if bits else F.lit(0).cast("bigint")
    whole = placed.where(F.col("_part").isNull() | (own < F.col("_part"))).select(*df.columns)
    order = Window.partitionBy(label).orderBy("_hash", key)
    part = placed.where(own == F.col("_part")).withColumn("_nth", F.row_number().over(order)).where("_nth <= _room")
    return whole.unionByName(part.select(*df.columns))


def class_weights(df: DataFrame, label: str, name: str = "weight", balanced: bool = False) -> DataFrame:
    """Adds the share of the row's class, or with `balanced` the weight that evens out the classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    weight = total / (classes * F.col("_n")) if balanced else F.col("_n") / total
    weights = counts.select(label, weight.alias(name))
    return lookup_join(df, weights, [label], "left")
