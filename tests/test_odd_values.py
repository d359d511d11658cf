"""NULL, NaN, repeated keys and whole numbers that the checking SQL does not feed."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.functions import math as fm
from plotstats.operators import indices, joins, raster, tables
from plotstats.sources import readers

NAN = float("nan")


def test_records_without_coordinates_are_never_nearest(spark):
    points = spark.createDataFrame([(0, 1.0, 1.0)], "i long, longitude double, latitude double")
    chunks = spark.createDataFrame(
        [(0, 0, None, 1.0), (0, 1, NAN, 1.0), (0, 2, 1.5, 1.0)], "chunk long, line long, longitude double, latitude double"
    )
    assert [r["line"] for r in joins.nearest_run(points, "i", chunks, "chunk", "line", run=1).collect()] == [2]
    plots = spark.createDataFrame([(1, 0.0, 0.0)], "id int, longitude double, latitude double")
    pixels = spark.createDataFrame(
        [(1, None, 0.0, 5.0), (1, NAN, 0.0, 6.0), (1, 2.0, 0.0, 9.0)], "id int, longitude double, latitude double, B1 double"
    )
    assert joins.zonal_reduce(pixels, plots, "id", ["B1"]).first()["B1_first"] == 9.0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, NAN, "a"), (1, None, None), (1, 1.0, "b")], "i int, x double, s string")
    assert tables.null_census(df).first().asDict() == {"i": 0, "x": 2, "s": 1}
    assert joins.null_run_count(df, "i", "x").first()["no_burn"] == 2


def test_updates_of_one_key_never_multiply_rows(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 2)], "k int, v int")
    updates = spark.createDataFrame([(1, 5), (1, 7), (3, 9)], "k int, v int")
    assert sorted(map(tuple, joins.update_by_key(df, updates, ["k"]).collect())) == [(1, 7), (1, 7), (2, 2)]


def test_whole_numbers_and_nan(spark):
    row = spark.range(1).select(
        fm.square(F.lit(50000)).alias("s"), fm.square(F.lit(1.5)).alias("d"), fm.square(F.lit(1 << 40)).alias("big"),
        fm.clamp_cover(F.lit(NAN)).alias("n"), fm.clamp_cover(F.lit(2.0)).alias("c"), indices.msavi2(F.lit(9), F.lit(30000)).alias("m"),
    ).first()
    assert (row["s"], row["d"], row["big"], row["c"]) == (2500000000, 2.25, None, 0.95) and math.isnan(row["n"]) and row["m"] > 0


def test_image_with_a_copy_and_a_hole_is_incomplete(spark):
    cells = [(1, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (2, 0, 0)]
    pixels = spark.createDataFrame([(*c, 1.0) for c in cells], "image_id int, row int, col int, value double")
    assert [r[0] for r in raster.incomplete_images(pixels).collect()] == [1]


def test_readers_decode_paths_and_skip_blank_lines(spark, tmp_path):
    (tmp_path / "New South").mkdir()
    (tmp_path / "New South" / "a+b 1.csv").write_text("x\n1\n")
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    row = readers.read_keyed_files(spark, str(tmp_path / "*" / "*.csv"), schema, r"([^/]+)/([^/]+)\.csv$", ["region", "name"]).first()
    assert (row["region"], row["name"]) == ("New South", "a+b 1")
    (tmp_path / "t.txt").write_text("title\nx\n\n5\n\n6\n")
    rows = readers.read_csv_below_title(spark, str(tmp_path / "t.txt"), schema).collect()
    assert sorted((r["line"], r["x"]) for r in rows) == [(0, 5), (1, 6)]
