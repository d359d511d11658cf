"""Reshaping rasters held as pixel tables (image_id, row, col, value columns).

Every mode is an index map from source to target cells. A pixel computes the target
cells it fills, so no target grid is generated and nothing is joined back, except
for padding cells that copy a pixel of the same image. Results carry the height and
width of their image, so a further step (or a stored table with these columns) needs
no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.operators.indices import SEASONAL_INDICES
from plotstats.operators.observations import clear_sky, in_days
from plotstats.operators.plot_stats import pixel_medians
from plotstats.operators.prep import from_byte_scale, to_byte_scale
from plotstats.operators.sampling import key_hash
from plotstats.operators.skew import hot_groups, lookup_join, split_hot
from plotstats.session import materialize

CELL = ["image_id", "row", "col"]
SHAPE = ["height", "width"]


def image_shapes(pixels: DataFrame) -> DataFrame:
    """Height, width and whether the grid is complete, per image."""
    return pixels.groupBy("image_id").agg(
        (F.max("row") + 1).cast("bigint").alias("height"),
        (F.max("col") + 1).cast("bigint").alias("width"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row", "col").alias("cells"),
        F.min("row").alias("first_row"),
        F.min("col").alias("first_col"),
    ).select("image_id", "height", "width", (
        (F.col("n") == F.col("height") * F.col("width")) & (F.col("n") == F.col("cells")) & (F.col("first_row") >= 0) & (F.col("first_col") >= 0)
    ).alias("complete"))


def incomplete_images(pixels: DataFrame) -> DataFrame:
    """Images that the reshaping operators leave out."""
    return image_shapes(pixels).where(~F.col("complete")).select("image_id")


def with_shape(pixels: DataFrame) -> DataFrame:
    """Pixels of complete images with the height and width of their image, unless already known."""
    if set(SHAPE) <= set(pixels.columns):
        return pixels
    shapes = image_shapes(pixels).where("complete").select("image_id", "height", "width")
    return lookup_join(pixels, shapes, ["image_id"], "inner")


def _steps(first: Column, last: Column, step: Column) -> Column:
    """first, first + step, ... up to last; empty when first > last."""
    return F.when(first <= last, F.sequence(first, last, step)).otherwise(F.array().cast("array<bigint>"))


def _start(position: str, seed: int) -> Column:
    spare = F.abs(F.col("height") - F.col("width"))
    if position == "topleft":
        return F.lit(0).cast("bigint")
    if position == "center":
        return F.floor(spare / 2)
    if position == "random":
        return F.when(spare == 0, F.lit(0)).otherwise(F.pmod(key_hash(F.col("image_id"), seed), spare)).cast("bigint")
    raise ValueError(f"unknown position {position}")


def _landscape() -> Column:
    return F.col("height") < F.col("width")


def _along_short(df: DataFrame, targets: Column, values: Sequence[str]) -> DataFrame:
    """Replaces the index along the short axis by each of `targets`."""
    spread = df.withColumn("_t", F.explode(targets))
    return spread.select(
        "image_id",
        F.when(_landscape(), F.col("_t")).otherwise(F.col("row")).cast("bigint").alias("row"),
        F.when(_landscape(), F.col("col")).otherwise(F.col("_t")).cast("bigint").alias("col"),
        *_square("_long"),
        *values,
    )


def _square(side: str) -> list[Column]:
    return [F.col(side).cast("bigint").alias(c) for c in SHAPE]


def _short_axis(df: DataFrame, position: str, seed: int) -> DataFrame:
    """Adds index `_r` and size `_a` of the short axis, size `_long` of the other, start `_s`."""
    return df.withColumns(
        {
            "_r": F.when(_landscape(), F.col("row")).otherwise(F.col("col")).cast("bigint"),
            "_a": F.least("height", "width"),
            "_long": F.greatest("height", "width"),
            "_s": _start(position, seed),
        }
    )


def nearest(pixels: DataFrame, height: int, width: int, values: Sequence[str]) -> DataFrame:
    """Nearest-neighbour resize: target i reads source floor((i + 0.5) * size / target size)."""
    def targets(r: Column, size: Column, target: int) -> Column:
        def first(k: Column) -> Column:
            # Smallest i with (2 i + 1) * size >= 2 * target * k.
            return F.greatest(F.ceil((2 * target * k - size) / (2 * size)), F.lit(0)).cast("bigint")

        return _steps(first(r), F.least(first(r + 1), F.lit(target)) - 1, F.lit(1).cast("bigint"))

    rows = targets(F.col("row").cast("bigint"), F.col("height"), height)
    cols = targets(F.col("col").cast("bigint"), F.col("width"), width)
    return (
        with_shape(pixels)
        .withColumn("_row", F.explode(rows))
        .withColumn("_col", F.explode(cols))
        .select(
            "image_id",
            F.col("_row").alias("row"),
            F.col("_col").alias("col"),
            F.lit(height).cast("bigint").alias("height"),
            F.lit(width).cast("bigint").alias("width"),
            *values,
        )
    )


def tile(pixels: DataFrame, values: Sequence[str], position: str = "topleft", seed: int = 42) -> DataFrame:
    """Repeats the image along its short axis to a square."""
    df = _short_axis(with_shape(pixels), position, seed)
    targets = _steps(F.pmod(F.col("_s") + F.col("_r"), F.col("_a")), F.col("_long") - 1, F.col("_a"))
    return _along_short(df, targets, values)


def mirror(pixels: DataFrame, values: Sequence[str], position: str = "topleft", seed: int = 42) -> DataFrame:
    """Reflects the image along its short axis to a square; both directions start with row 0."""
    df = _short_axis(with_shape(pixels), position, seed)
    r, a, s, long = F.col("_r"), F.col("_a"), F.col("_s"), F.col("_long")
    period = F.greatest(2 * (a - 1), F.lit(1))
    back = F.pmod(period - r, period)

    def steps(last: Column) -> Column:
        """Distances from the start at which source row r is shown."""
        return F.array_union(_steps(r, last, period), _steps(back, last, period))

    forward = F.transform(steps(long - 1 - s), lambda k: s + k)
    backward = F.transform(steps(s - 1), lambda k: s - 1 - k)
    return _along_short(df, F.concat(forward, backward), values)


def crop(pixels: DataFrame, values: Sequence[str], position: str = "topleft", seed: int = 42) -> DataFrame:
    """Cuts a square of the short side out of the long axis."""
    df = _short_axis(with_shape(pixels), position, seed)
    along = F.when(_landscape(), F.col("col")).otherwise(F.col("row")) - F.col("_s")
    kept = df.withColumn("_t", along).where((F.col("_t") >= 0) & (F.col("_t") < F.col("_a")))
    return kept.select(
        "image_id",
        F.when(_landscape(), F.col("row")).otherwise(F.col("_t")).cast("bigint").alias("row"),
        F.when(_landscape(), F.col("_t")).otherwise(F.col("col")).cast("bigint").alias("col"),
        *_square("_a"),
        *values,
    )


def contain(
    pixels: DataFrame,
    values: Sequence[str],
    position: str = "topleft",
    padding: str = "black",
    seed: int = 42,
) -> DataFrame:
    """Places the image in a square of its long side and fills the rest.

    `padding` is black (0), white (255), random (0 to 255) or clone (a random pixel of the image).
    """
    shaped = with_shape(pixels)
    df = _short_axis(shaped, position, seed)
    inside = _along_short(df, F.array(F.col("_r") + F.col("_s")), values)
    corners = shaped.where("row = 0 and col = 0").select(*CELL, *SHAPE)
    shapes = _short_axis(corners, position, seed)
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    empty = F.concat(
        _steps(zero, F.col("_s") - 1, one), _steps(F.col("_s") + F.col("_a"), F.col("_long") - 1, one)
    )
    pads = (
        shapes.withColumn("_t", F.explode(empty))
        .withColumn("_u", F.explode(_steps(zero, F.col("_long") - 1, one)))
        .withColumn("row", F.when(_landscape(), F.col("_t")).otherwise(F.col("_u")))
        .withColumn("col", F.when(_landscape(), F.col("_u")).otherwise(F.col("_t")))
    )
    cell = F.concat_ws("-", "image_id", "row", "col")
    if padding == "clone":
        source = pixels.select(
            "image_id", F.col("row").cast("bigint").alias("_row"), F.col("col").cast("bigint").alias("_col"), *values
        )
        chosen = pads.withColumns(
            {
                "_row": F.pmod(key_hash(F.concat(cell, F.lit("-r")), seed), F.col("height")),
                "_col": F.pmod(key_hash(F.concat(cell, F.lit("-c")), seed), F.col("width")),
            }
        ).select(*CELL, "_long", "_row", "_col")
        filled = chosen.join(source, ["image_id", "_row", "_col"]).select(*CELL, *_square("_long"), *values)
    else:
        fill = {"black": lambda c: F.lit(0), "white": lambda c: F.lit(255)}.get(
            padding, lambda c: F.pmod(key_hash(F.concat(cell, F.lit(f"-{c}")), seed), F.lit(256))
        )
        if padding not in ("black", "white", "random"):
            raise ValueError(f"unknown padding {padding}")
        kinds = {f.name: f.dataType for f in pixels.schema.fields}
        filled = pads.select(*CELL, *_square("_long"), *[fill(c).cast(kinds[c]).alias(c) for c in values])
    return inside.unionByName(filled)


def reshape(
    pixels: DataFrame,
    mode: str,
    values: Sequence[str],
    size: tuple[int, int] | None = None,
    position: str = "topleft",
    padding: str = "black",
    seed: int = 42,
) -> DataFrame:
    """One of interp, tile, mirror, crop, contain for all images, then a resize to (height, width)."""
    if mode == "interp":
        result = pixels
    elif mode == "contain":
        result = contain(pixels, values, position, padding, seed)
    else:
        result = {"tile": tile, "mirror": mirror, "crop": crop}[mode](pixels, values, position, seed)
    return nearest(result, *size, values) if size else result


RASTER_BANDS = ["R", "G", "B", "ndvi"]
RASTER_SIZE = (8, 7)


def _raster_pixels(clear: DataFrame, check_skew: bool) -> DataFrame:
    """Median colours and index of every pixel, on the byte scale."""
    medians = pixel_medians(clear, ["TCI_R", "TCI_G", "TCI_B"], SEASONAL_INDICES, check_skew=check_skew)
    channels = {"R": "TCI_R_m", "G": "TCI_G_m", "B": "TCI_B_m"}
    return medians.select(
        F.col("id").alias("image_id"),
        "longitude",
        "latitude",
        # Colours are stored as bytes; the index is moved to the byte scale and rounded.
        *[F.floor(c).cast("double").alias(b) for b, c in channels.items()],
        F.rint(to_byte_scale(F.col("NDVI_m"))).alias("ndvi"),
    )


def _placed(pixels: DataFrame) -> DataFrame:
    """Pixels of complete plots with their cell. Rows of a plot lie in one partition, so nothing moves."""
    plot = Window.partitionBy("image_id")
    ranked = pixels.where("longitude is not null and latitude is not null").withColumns(
        {
            "row": (F.dense_rank().over(plot.orderBy("longitude")) - 1).cast("bigint"),
            "col": (F.dense_rank().over(plot.orderBy("latitude")) - 1).cast("bigint"),
        }
    )
    whole = ranked.withColumns({"height": F.max("row").over(plot) + 1, "width": F.max("col").over(plot) + 1, "_n": F.count("ndvi").over(plot)})
    return whole.where("ndvi is not null and _n = height * width").select(*CELL, *RASTER_BANDS, *SHAPE)


def _placed_large(pixels: DataFrame) -> DataFrame:
    """The same for plots with too many pixels for one task: positions are ranked among the distinct coordinates."""

    def positions(axis: str, name: str) -> DataFrame:
        distinct = pixels.where(F.col(axis).isNotNull()).select("image_id", axis).distinct()
        order = Window.partitionBy("image_id").orderBy(axis)
        return distinct.withColumn(name, (F.row_number().over(order) - 1).cast("bigint"))

    grid = (
        pixels.where(F.col("ndvi").isNotNull())
        .join(positions("longitude", "row"), ["image_id", "longitude"])
        .join(positions("latitude", "col"), ["image_id", "latitude"])
        .select(*CELL, *RASTER_BANDS)
    )
    shapes = pixels.groupBy("image_id").agg(
        F.count_distinct("longitude").alias("height"),
        F.count_distinct("latitude").alias("width"),
    )
    complete = (
        grid.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).join(shapes, "image_id")
        .where("n = height * width").drop("n")
    )
    return grid.join(complete, "image_id").select(*CELL, *RASTER_BANDS, *SHAPE)


def plot_raster(obs: DataFrame, start: str, end: str, size: tuple[int, int] = RASTER_SIZE) -> DataFrame:
    """One row per plot with `{band}_{x}_{y}`, scaled to [-1, 1]: medians of the pixels as an image.

    Pixels are placed by the rank of their longitude and latitude in the plot; plots with
    missing pixels are left out. Ordinary plots travel once, for the medians, the places and the image; the ids are read once more before,
    to find the plots that are too large for that.
    """
    clear = obs.where(in_days(start, end)).where(clear_sky())
    hot = hot_groups(clear, ["id"])
    if hot is None:
        return _image(_placed(_raster_pixels(clear.repartition("id"), False)), size)
    hot_rows, cold_rows = split_hot(clear, ["id"], hot)
    large = _placed_large(materialize(_raster_pixels(hot_rows, True)))
    return _image(_placed(_raster_pixels(cold_rows.repartition("id"), False)), size).unionByName(_image(large, size))


def _image(grid: DataFrame, size: tuple[int, int]) -> DataFrame:
    small = nearest(grid, *size, RASTER_BANDS)
    scaled = small.select(
        "image_id",
        F.concat_ws("_", "row", "col").alias("at"),
        F.struct(*[from_byte_scale(F.col(b)).alias(b) for b in RASTER_BANDS]).alias("v"),
    )
    # A fixed number of cells per plot.
    cells = scaled.groupBy("image_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("cells"))
    return cells.select(
        F.col("image_id").alias("id"),
        *[
            F.try_element_at("cells", F.lit(f"{x}_{y}"))[b].alias(f"{b}_{x}_{y}")
            for x in range(size[0])
            for y in range(size[1])
            for b in RASTER_BANDS
        ],
    )
