"""A low-discrepancy schedule of sources: which block of which source comes at which place of the mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotstats.llm.store import handy, saved

WORDS = r"[^\x20\x09-\x0D]+"
#: Words in a block, slots that are ranked together, documents that are put in order together.
BLOCK = 1_024
RUN = 65_536
SHELF = 50_000
#: Golden-ratio points on a circle of 2^31 places: multiples of an odd number near 2^31 / phi reach each place once.
CIRCLE = 1 << 31
GOLDEN = 1_327_217_885
CELLS = 4_096


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size) of every row, size in words; written once."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    return saved(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source_no, source, source_size, target): `epochs` times all words shared by weight, at most `limit` times a source.

    Sources rank by code point, null last, and take the weights in turn. What a source can't take is shared by the others.
    A table of one row per source; what is left over is spread at one level, found by running sums in the order in which
    sources fill up.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the tables of sources have one row each: their windows need no partition
    no = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    each = each.withColumn("source_no", no - 1).withColumn("weight", F.element_at(turn, F.pmod(F.col("source_no"), F.lit(len(weights))) + 1))
    each = each.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    each = each.withColumn("left", F.sum("source_size").over(everything) * F.lit(float(epochs)) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
    each = each.withColumn("rest", F.sum("weight").over(later)).withColumn("place", F.row_number().over(order))
    open_ = F.col("left") * F.col("weight") < F.col("most") * F.col("rest")
    level = F.min(F.when(open_, F.struct("place", "left", "rest"))).over(everything)
    each = each.withColumn("level", level)
    full = F.col("level").isNull() | (F.col("place") < F.col("level.place"))
    return each.select("source_no", "source", "source_size", F.when(full, F.col("most")).otherwise(F.col("level.left") * F.col("weight") / F.col("level.rest")).alias("target"))


def schedule(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, rank): the block `rank` of a source comes at place `slot`; `table` as `targets` gives it.

    Slot i takes the source in whose share of the circle the i-th golden-ratio point falls, and the slots of a source are
    ranked in order. A source leaves its slots empty once it has reached its target; the few blocks that the points
    leave out (no more than their discrepancy) come at the end. So every source gets exactly the blocks of its target.
    """
    spark = table.sparkSession
    need = table.withColumn("blocks", F.ceil(F.round("target") / block).cast("long")).where("blocks > 0")
    n = need.agg(F.sum("blocks")).first()[0] or 0
    order = Window.orderBy("source_no")
    high = F.round(F.sum("blocks").over(order.rowsBetween(Window.unboundedPreceding, 0)) * F.lit(CIRCLE / max(n, 1))).cast("long")
    arcs = need.withColumn("high", high).withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0)))
    step = CIRCLE // CELLS
    arcs = arcs.where("high > low").withColumn("cell", F.explode(F.expr(f"sequence(low div {step}, (high - 1) div {step})")))
    arcs = handy(saved(arcs.select("source_no", "blocks", "low", "high", "cell")))
    point = F.pmod((F.col("slot") % CIRCLE) * F.lit(GOLDEN), F.lit(CIRCLE))
    slots = spark.range(n).select(F.col("id").alias("slot")).withColumn("point", point).withColumn("cell", F.expr(f"point div {step}"))
    slots = slots.join(arcs, "cell").where("low <= point and point < high").select("slot", "source_no", "blocks", F.expr(f"slot div {RUN}").alias("run"))
    runs = slots.groupBy("source_no", "run").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = saved(runs.withColumn("before", F.coalesce(before, F.lit(0))))
    inside = F.row_number().over(Window.partitionBy("source_no", "run").orderBy("slot")) - 1
    ranked = slots.withColumn("inside", inside).join(handy(runs), ["source_no", "run"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside")).where("rank < blocks").select("slot", "source_no", "rank")
    got = runs.groupBy("source_no").agg(F.sum("rows").alias("got"))
    missing = need.join(got, "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < blocks")
    missing = missing.select("source_no", F.explode(F.expr("sequence(got, blocks - 1)")).alias("rank"))
    return ranked.union(missing.select((F.col("rank") + n).alias("slot"), "source_no", "rank"))


def placed(sizes: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with the columns of their source and `start`: the words before the row in its source, in an order drawn by hash.

    The order is found on shelves of about SHELF rows, so no task sorts a whole source. Rows that agree in identifier and size
    can change places without a change in the result.
    """
    shelves = max(1, sizes.count() // SHELF)
    draw = F.pmod(F.xxhash64("id", F.lit("mix")), F.lit(CIRCLE))
    table = handy(table)
    rows = sizes.join(table, sizes["source"].eqNullSafe(table["source"])).select(
        "id", "size", "source_no", "source_size", "target", draw.alias("draw"), F.expr("1").alias("one")
    ).withColumn("shelf", F.floor(F.col("draw") * F.lit(shelves) / F.lit(CIRCLE)))
    full = rows.groupBy("source_no", "shelf").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source_no").orderBy("shelf").rowsBetween(Window.unboundedPreceding, -1))
    full = saved(full.select("source_no", "shelf", F.coalesce(before, F.lit(0)).alias("before")))
    inside = F.sum("size").over(Window.partitionBy("source_no", "shelf").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(handy(full), ["source_no", "shelf"]).select(
        "id", "size", "source_no", "source_size", "target", (F.col("before") + F.col("inside")).alias("start")
    )


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source_no, rank, id, size, start, begin, words): what the blocks of a source hold of each row.

    A source repeats without end as far as its target goes; `begin` is the first word of the row that is meant.
    """
    goal = F.round("target").cast("long")
    spans = rows.where("size > 0").withColumn("goal", goal).withColumn("pass", F.explode(F.expr("sequence(0L, greatest(0L, (goal - 1) div source_size))")))
    spans = spans.withColumn("low", F.col("pass") * F.col("source_size") + F.col("start"))
    spans = spans.withColumn("high", F.least(F.col("low") + F.col("size"), F.col("goal"))).where("low < high")
    spans = spans.withColumn("rank", F.explode(F.expr(f"sequence(low div {block}, (high - 1) div {block})")))
    begin = F.greatest(F.col("low"), F.col("rank") * block)
    words = F.least(F.col("high"), (F.col("rank") + 1) * block) - begin
    return spans.select("source_no", "rank", "id", "size", "start", (begin - F.col("low")).alias("begin"), words.alias("words"))


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int = BLOCK, **shares) -> DataFrame:
    """(slot, id, begin, words): the mix in order; each row says which words of which document come next in a slot.

    Null and empty texts have no words and never appear; a null source is a source. An empty table gives an empty mix.
    """
    sizes = measured(docs, id_col, text_col, source_col)
    table = saved(targets(sizes, **shares))
    return schedule(table, block).join(pieces(placed(sizes, table), block), ["source_no", "rank"]).select("slot", F.col("id").alias(id_col), "begin", "words")


def taken(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int = BLOCK, **shares) -> DataFrame:
    """(id_col, size, source_size, target, taken) for every row of `docs`: how many of its words the mix takes.

    The words of a source sum to its rounded target, and no row gives more than the limit allows. Rows without words
    give 0. Repeated rows stand in the mix one by one.
    """
    sizes = measured(docs, id_col, text_col, source_col)
    table = saved(targets(sizes, **shares))
    rows = placed(sizes, table)
    used = schedule(table, block).join(pieces(rows, block), ["source_no", "rank"])
    used = used.groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    kept = rows.join(used.withColumn("filled", F.lit(True)), (rows["source_no"] == used["source_no"]) & (rows["start"] == used["start"]) & (rows["size"] > 0), "left")
    return kept.select(rows["id"].alias(id_col), rows["size"], rows["source_size"], rows["target"], F.coalesce("taken", F.lit(0)).alias("taken"))
