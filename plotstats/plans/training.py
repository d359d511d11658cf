"""Queries: sampling, preparation, evaluation and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.functions.math import logit
from plotstats.operators import evaluate as ev
from plotstats.operators import boosting, joins, models, prep, sampling
from plotstats.operators.tables import drop_nulls
from plotstats.plans.views import EVAL_SQL, PLOTS_SQL, labelled, plots, table
from plotstats.session import materialize, scratch_path

_HASH = "cast('0x' || substr(md5(concat({}, '-42')), 1, {}) as bigint)"
_IN_TEST = f"{_HASH.format('row_id', 8)} % 1000 < 200"


# --- sampling and preparation ----------------------------------------------------------

def stratify(spark, sf_dir):
    return sampling.stratify(labelled(spark, sf_dir), "label", "row_id").select("row_id", "label")


STRATIFIED = (
    f"(select * from (select *, row_number() over (partition by label order by {_HASH.format('row_id', 15)}, row_id) as rn,"
    f" (select 4 * min(n) from (select count(*) as n from {EVAL_SQL} group by label)) as cap from {EVAL_SQL}) where rn <= cap)"
)


def train_test_split(spark, sf_dir):
    train, test = sampling.train_test_split(labelled(spark, sf_dir), "row_id")
    columns = ["row_id", "cover"]
    return train.select(*columns, F.lit("train").alias("side")).unionByName(
        test.select(*columns, F.lit("test").alias("side"))
    )


def rest_split(spark, sf_dir):
    full = labelled(spark, sf_dir).select("row_id", "label")
    train, _ = sampling.train_test_split(full, "row_id")
    return joins.rest_split(full, train, "row_id")


def load_training(spark, sf_dir):
    """Complete, distinct rows of a table with gaps and copies."""
    df = plots(spark, sf_dir).selectExpr(
        "longitude", "latitude", "dryland_assessment_region", "land_use_category", "Aridity_zone", "tree_cover",
        "nullif(plot_id % 17, 3) as B1", "plot_id % 5 as B2", "plot_id % 2 as veg_pc_s0",
    )
    return prep.load_training(df.unionByName(df))


def category_index(spark, sf_dir):
    return prep.category_index(plots(spark, sf_dir).select("plot_id", "Aridity_zone"), "Aridity_zone")


def one_hot_drop_first(spark, sf_dir):
    return prep.one_hot_drop_first(plots(spark, sf_dir).select("plot_id", "land_use_category"), "land_use_category")


def min_max_scale(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    scaled = prep.min_max_scale(df, ["c_acctbal", "nation"])
    return scaled.select("c_custkey", *[F.round(c, 9).alias(c) for c in ("c_acctbal", "nation")])


def fixed_scale(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 10_000).alias("x"))
    bytes_ = F.round(prep.to_byte_scale(F.col("x")), 8)
    return df.select(
        "c_custkey", bytes_.alias("on_bytes"), F.round(prep.from_byte_scale(prep.to_byte_scale(F.col("x"))), 9).alias("back")
    )


def class_weights(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "label")
    one = sampling.class_weights(df, "label")
    both = sampling.class_weights(one, "label", "balanced_weight", balanced=True)
    return both.select("row_id", "label", *[F.round(c, 9).alias(c) for c in ("weight", "balanced_weight")])


# --- evaluation ------------------------------------------------------------------------

def _predicted(spark, sf_dir) -> DataFrame:
    """Target and prediction on the logit scale, transformed back as after training."""
    df = labelled(spark, sf_dir).withColumns({"t": logit(F.col("cover")), "pred": logit(F.least(F.col("guess"), F.lit(0.999)))})
    return ev.back_transform(df, "t", "pred")


_U = "case cover when 0 then 1e-4 when 1 then 9999e-4 else cover end"
_G = "least(guess, 999e-3)"
_GU = f"case {_G} when 0 then 1e-4 else {_G} end"
PREDICTED = (
    "(select *, greatest(0, least(95e-2, raw)) as p, raw - y as diff from (select *,"
    f" 1 / (1 + exp(-ln(({_U}) / (1 - ({_U}))))) as y, 1 / (1 + exp(-ln(({_GU}) / (1 - ({_GU}))))) as raw from {{}}))"
)


def _r2_sql(source: str, w: str) -> str:
    return (
        f"1 - sum({w} * (y - p) * (y - p)) / sum({w} * (y - m) * (y - m)) from (select *, (select sum({w} * y) / sum({w}) from"
        f" {source}) as m from {source})"
    )


def eval_rmse(spark, sf_dir):
    df = _predicted(spark, sf_dir)
    parts = [ev.rmse(df, w).select(F.lit(n).alias("weighting"), F.round("rmse", 9).alias("rmse")) for n, w in (("none", None), ("w", "w"))]
    return parts[0].unionByName(parts[1])


def eval_r2(spark, sf_dir):
    df = _predicted(spark, sf_dir)
    parts = [ev.r2(df, w).select(F.lit(n).alias("weighting"), F.round("r2", 9).alias("r2")) for n, w in (("none", None), ("w", "w"))]
    return parts[0].unionByName(parts[1])


def eval_mae(spark, sf_dir):
    return ev.mae(_predicted(spark, sf_dir)).select(F.round("mae", 9).alias("mae"))


def eval_bucket_mae(spark, sf_dir):
    """Tenths of the untransformed cover, whose values lie on the bounds."""
    df = ev.back_transform(labelled(spark, sf_dir), "cover", "guess", transformed=False)
    return ev.bucket_mae(df).select("bucket", F.round("mae", 9).alias("mae"), "n")


def error_deciles(spark, sf_dir):
    return ev.error_deciles(_predicted(spark, sf_dir)).select("percent", F.round("abs_error", 9).alias("abs_error"))


def predict_baseline(spark, sf_dir):
    df = ev.predict_baseline(labelled(spark, sf_dir).select("row_id", "cover"), "row_id")
    return df.select("row_id", F.round("prediction", 9).alias("prediction"))


def eval_rest(spark, sf_dir):
    """Report on the rows that neither stratification nor the split left in the training set."""
    full = labelled(spark, sf_dir)
    train, _ = sampling.train_test_split(sampling.stratify(full, "label", "row_id"), "row_id")
    rest = joins.rest_split(_predicted(spark, sf_dir), train, "row_id")
    report = ev.report(rest)
    return report.select(*[F.round(c, 9).alias(c) for c in ("rmse", "r2", "mae")], "n")


def train_report(spark, sf_dir):
    """One chain: complete rows with their key, stratified, split, trained with a category, evaluated on each part and on the rest.

    `beats_mean` says whether the model explains more than the mean of the part does.
    """
    full = labelled(spark, sf_dir).withColumn("zone", F.concat(F.lit("z"), (F.col("label") % 4).cast("string")))
    rows = prep.load_training(full, "cover", ["label", "zone", "guess", "w"], key="row_id").withColumn("t", logit(F.col("cover")))
    train, test = sampling.train_test_split(sampling.stratify(rows, "label", "row_id"), "row_id")
    model = models.train_boost(train, "t", ["guess"], weight="w", categories=["zone"], maxIter=5, maxDepth=4)
    parts = {"train": train, "test": test, "rest": joins.rest_split(rows, train, "row_id")}
    out = []
    for name, part in parts.items():
        scored = ev.back_transform(model.transform(part), "t", "prediction")
        out.append(ev.report(scored, "w").select(F.lit(name).alias("part"), "n", (F.col("r2") > 0).alias("beats_mean")))
    return reduce(DataFrame.unionByName, out)


_REST = PREDICTED.format(
    f"(select * from {EVAL_SQL} where row_id not in (select row_id from {STRATIFIED} where not ({_IN_TEST})))"
)
_ALL = PREDICTED.format(EVAL_SQL)


# --- models ----------------------------------------------------------------------------

# Rows of a partition of the training rows, about.
MODEL_ROWS = 500_000
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _model_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    df = drop_nulls(
        lines.selectExpr(
            "concat(l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber) as row_id",
            "least((l_quantity + l_discount * 100 + l_extendedprice / 10000) / 70, 0.95D) as tree_cover",
            "case when l_quantity < 18 then 'barren' when l_quantity < 35 then 'grassland' else 'forest' end as land_use",
            "cast(l_linenumber as double) as l_linenumber",
            "l_quantity",
            "l_discount",
            "l_tax",
        )
    ).withColumn("t", logit(F.col("tree_cover")))
    # Trees pass over the rows many times; few input files must not leave cores idle, and no task takes more as the table grows.
    tasks = max(spark.sparkContext.defaultParallelism, -(-lines.count() // MODEL_ROWS))
    spread = df.repartition(tasks, "row_id")
    return sampling.train_test_split(spread, "row_id")


def _report(model, test: DataFrame, label: str, transformed: bool) -> DataFrame:
    # the report reads the scores twice
    scored = materialize(ev.back_transform(model.transform(test).select(label, "prediction"), label, "prediction", transformed))
    return ev.report(scored).select("n", *[F.round(c, 4).alias(c) for c in ("rmse", "r2", "mae")])


def ml_gbt(spark, sf_dir):
    """Trained, saved, loaded again and evaluated on the held-out rows."""
    train, test = _model_rows(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save_model(models.train_boost(train, "t", FEATURES, by_cell=True), path)
    return _report(models.load_model(path), test, "t", True)


def ml_huber(spark, sf_dir):
    """Trees with Huber loss, dropout and best-leaf-first growth; saved, loaded and evaluated on the held-out rows."""
    train, test = _model_rows(spark, sf_dir)
    path = scratch_path(spark, "model")
    boosting.train_huber(train, "t", FEATURES, trees=5, rate=0.4, leaves=16).save(spark, path)
    return _report(boosting.Model.load(spark, path), test, "t", True)


def ml_huber_split(spark, sf_dir):
    """The best first split by each feature."""
    train, _ = _model_rows(spark, sf_dir)
    found = boosting.first_split(train, "tree_cover", FEATURES, delta=0.2)
    return found.select("feature", "value", F.round("gain", 4).alias("gain"))


_MODEL_SQL = (
    "(select *, cast('0x' || substr(md5(concat(row_id, '-42')), 1, 8) as bigint) % 1000 < 200 as in_test from (select"
    " concat(l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber) as row_id,"
    " least((l_quantity + l_discount * 100 + l_extendedprice / 10000) / 70, 95e-2) as tree_cover,"
    " cast(l_linenumber as double) as l_linenumber, l_quantity, l_discount, l_tax from lineitem))"
)
_HUBER_SPLIT_SQL = f"""
with rows as (
  select *, greatest(least((select avg(tree_cover) from {_MODEL_SQL} where not in_test) - tree_cover, 2e-1), -2e-1) as g
  from {_MODEL_SQL} where not in_test
), long as (
  {" union all ".join(f"select '{c}' as feature, {c}::double as x, g from rows" for c in FEATURES)}
), tally as (
  select feature, x, sum(g) as g, count(*) as n from long group by all
), ends as (
  select feature, x, sum(g) over up as lg, sum(n) over up as ln, sum(g) over whole as tg, sum(n) over whole as tn from tally
  window up as (partition by feature order by x), whole as (partition by feature)
), gains as (
  select feature, x, lg * lg / ln + (tg - lg) * (tg - lg) / (tn - ln) - tg * tg / tn as gain from ends where ln >= 50 and tn - ln >= 50
)
select feature, arg_max(x, gain) as value, round(max(gain), 4) as gain from gains where gain > 0 group by feature
"""


def ml_forest(spark, sf_dir):
    train, test = _model_rows(spark, sf_dir)
    model = models.train_forest(train, "tree_cover", FEATURES)
    return _report(model, test, "tree_cover", False)


def ml_classifier(spark, sf_dir):
    train, test = _model_rows(spark, sf_dir)
    model = models.train_classifier(train, "land_use", FEATURES)
    return model.transform(test).groupBy("land_use", "prediction").agg(F.count(F.lit(1)).alias("n"))


def ml_grid_search(spark, sf_dir):
    train, _ = _model_rows(spark, sf_dir)
    found = models.grid_search(train, "t", FEATURES, {"maxDepth": [2, 4]})
    rows = [(int(r["maxDepth"]), round(float(r["mae"]), 6)) for r in models.search_results(found)]
    return spark.createDataFrame(rows, "max_depth int, mae double")


def ml_importances(spark, sf_dir):
    train, _ = _model_rows(spark, sf_dir)
    model = models.train_boost(train, "t", FEATURES, maxIter=5, maxDepth=4)
    return models.importances(model, FEATURES, train)


QUERIES = {
    "stratify": (stratify, f"select row_id, label from {STRATIFIED}"),
    "train_test_split": (
        train_test_split,
        f"select row_id, cover, case when {_IN_TEST} then 'test' else 'train' end as side from {EVAL_SQL}",
    ),
    "rest_split": (rest_split, f"select row_id, label from {EVAL_SQL} where {_IN_TEST}"),
    "load_training": (
        load_training,
        "select tree_cover, Aridity_zone, B1, B2 from (select distinct longitude, latitude, dryland_assessment_region,"
        " land_use_category, Aridity_zone, tree_cover, nullif(plot_id % 17, 3) as B1, plot_id % 5 as B2, plot_id % 2 as v"
        f" from {PLOTS_SQL}) where B1 is not null",
    ),
    "category_index": (
        category_index,
        "select plot_id, Aridity_zone, dense_rank() over (order by Aridity_zone) - 1 as Aridity_zone_index"
        f" from {PLOTS_SQL}",
    ),
    "one_hot_drop_first": (
        one_hot_drop_first,
        "select plot_id, cast(land_use_category = 'forest' as int) as land_use_category_forest,"
        f" cast(land_use_category = 'grassland' as int) as land_use_category_grassland from {PLOTS_SQL}",
    ),
    "min_max_scale": (
        min_max_scale,
        "select c_custkey, round((c_acctbal - lo) / (hi - lo) * 2 - 1, 9) as c_acctbal,"
        " round((c_nationkey - nlo) / (nhi - nlo) * 2 - 1, 9) as nation from customer, (select min(c_acctbal) as lo,"
        " max(c_acctbal) as hi, cast(min(c_nationkey) as double) as nlo, cast(max(c_nationkey) as double) as nhi from customer)",
    ),
    "fixed_scale": (
        fixed_scale,
        "select c_custkey, round(c_acctbal / 10000 * 1275e-1 + 1275e-1, 8) as on_bytes,"
        " round((c_acctbal / 10000 * 1275e-1 + 1275e-1 - 1275e-1) / 1275e-1, 9) as back from customer",
    ),
    "class_weights": (
        class_weights,
        "select row_id, label, round(n / t, 9) as weight, round(t / (k * n), 9) as balanced_weight from (select row_id, label,"
        f" cast(count(*) over (partition by label) as double) as n, (select count(*) from {EVAL_SQL}) as t,"
        f" (select count(distinct label) from {EVAL_SQL}) as k from {EVAL_SQL})",
    ),
    "eval_rmse": (
        eval_rmse,
        f"select 'none' as weighting, round(sqrt(avg((y - p) * (y - p))), 9) as rmse from {_ALL} union all"
        f" select 'w', round(sqrt(sum(w * (y - p) * (y - p)) / sum(w)), 9) from {_ALL}",
    ),
    "eval_r2": (
        eval_r2,
        f"select 'none' as weighting, round(r, 9) as r2 from (select {_r2_sql(_ALL, '1e0').replace(' from (select', ' as r from (select', 1)})"
        f" union all select 'w', round(r, 9) from (select {_r2_sql(_ALL, 'w').replace(' from (select', ' as r from (select', 1)})",
    ),
    "eval_mae": (eval_mae, f"select round(avg(abs(diff)), 9) as mae from {_ALL}"),
    "eval_bucket_mae": (
        eval_bucket_mae,
        "select cast(i as int) as bucket, round(avg(abs(guess - cover)), 9) as mae, count(*) as n from"
        f" {EVAL_SQL} join range(10) b(i) on i / 10 < cover and cover < i / 10 + 1e-1 group by i",
    ),
    "error_deciles": (
        error_deciles,
        "select cast(i as int) as percent, round(e, 9) as abs_error from (select abs(diff) as e, row_number() over"
        f" (order by abs(diff)) - 1 as rn, count(*) over () as n from {_ALL}) join range(0, 100, 10) b(i) on rn = (n * i) // 100",
    ),
    "predict_baseline": (
        predict_baseline,
        f"select row_id, round({_HASH.format('row_id', 8)} / 4294967296e0, 9) as prediction from {EVAL_SQL}",
    ),
    "eval_rest": (
        eval_rest,
        "select round(sqrt(avg((y - p) * (y - p))), 9) as rmse, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 9)"
        " as r2, round(avg(abs(diff)), 9) as mae, count(*) as n from (select *, avg(y) over () as m"
        f" from {_REST})",
    ),
    "train_report": (
        train_report,
        f"select 'train' as part, count(*) as n, true as beats_mean from {STRATIFIED} where not ({_IN_TEST})"
        f" union all select 'test', count(*), true from {STRATIFIED} where {_IN_TEST}"
        f" union all select 'rest', count(*), true from {EVAL_SQL} where row_id not in (select row_id from {STRATIFIED} where not ({_IN_TEST}))",
    ),
    "ml_gbt": (ml_gbt, None),
    "ml_huber": (ml_huber, None),
    "ml_huber_split": (ml_huber_split, _HUBER_SPLIT_SQL),
    "ml_forest": (ml_forest, None),
    "ml_classifier": (ml_classifier, None),
    "ml_grid_search": (ml_grid_search, None),
    "ml_importances": (ml_importances, None),
}
