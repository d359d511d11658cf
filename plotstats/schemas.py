"""Column lists and explicit schemas of the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import types as T

# Band and column names of the observation and feature tables.
BANDS = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12"]
MONTHLY_BANDS = ["B1", "B5", "B9", "B12"]
EXTRA_BANDS = ["AOT", "WVP", "SCL", "TCI_R", "TCI_G", "TCI_B"]
MASKS = ["MSK_CLDPRB", "MSK_SNWPRB"]
QA_BANDS = ["QA10", "QA20", "QA60"]
SEASONAL_STATS = ["min", "max", "avg", "stdev", "median", "lower_quartile", "upper_quartile"]
MONTHLY_STATS = ["min", "max", "avg", "lower_quartile", "upper_quartile", "stdev"]
# The statistics whose spread over the seasons is a feature, by band.
_SPREAD = ["min", "max", "stdev", "median"]
DIFF_STATS = {
    "B1": _SPREAD,
    "B2": _SPREAD,
    "B12": SEASONAL_STATS,
    "B4": SEASONAL_STATS,
    "NDVI": SEASONAL_STATS,
    "B3": _SPREAD,
}
# Bands of the features kept for training, and whether their means and quartiles are kept.
TRAINING_BANDS = {
    "B1": False,
    "B2": False,
    "B3": False,
    "B4": True,
    "B5": False,
    "B9": False,
    "B12": True,
    "NDVI": True,
}
LANDSAT_BANDS = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B10", "B11"]
LANDSAT_COLUMNS = [*LANDSAT_BANDS, "sr_aerosol", "pixel_qa", "radsat_qa"]
PLOT_COLUMNS = [
    "longitude",
    "latitude",
    "dryland_assessment_region",
    "Aridity_zone",
    "land_use_category",
    "tree_cover",
]
CANONICAL_COLUMNS = [*PLOT_COLUMNS, *LANDSAT_BANDS, "pixel_qa", "radsat_qa", "sr_aerosol"]
# Scene class "vegetation".
VEGETATION_CLASS = 4

PLOTS = T.StructType(
    [
        T.StructField("plot_id", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("dryland_assessment_region", T.StringType()),
        T.StructField("Aridity_zone", T.StringType()),
        T.StructField("land_use_category", T.StringType()),
        T.StructField("tree_cover", T.DoubleType()),
    ]
)

OBSERVATIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("time", T.LongType()),
        *[T.StructField(b, T.IntegerType()) for b in [*BANDS, *EXTRA_BANDS]],
        *[T.StructField(m, T.DoubleType()) for m in MASKS],
        T.StructField("HAS_CLOUDFLAG", T.BooleanType()),
    ]
)

# Records as fetched: time in milliseconds and the quality bands still present.
RAW_OBSERVATIONS = T.StructType(
    [f for f in OBSERVATIONS.fields if f.name != "HAS_CLOUDFLAG"]
    + [T.StructField(b, T.LongType()) for b in QA_BANDS]
)

GEOMETRY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ]
)
POLYGON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
    ]
)
