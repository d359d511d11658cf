"""Shape of the physical plans, and files that sinks write."""

import glob

import pyarrow.csv
import pyarrow.parquet
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotstats.operators import joins, observations, plot_stats
from plotstats.plans import catalogue
from plotstats.plans.incremental import NEEDED
from plotstats.plans.views import END, SEASONS, START, raw_observations, samples, sites
from plotstats.plans.views import observations as stored
from plotstats.session import scratch_path
from plotstats.sources import readers, sinks
from plotstats.streaming import ingest as stream

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join(spark):
    for name, (function, _) in catalogue().items():
        if name.startswith(("ml_", "sink_", "scan_", "incremental_", "resumable_")):
            continue
        text = plan(function(spark, SF))
        assert "Python" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_time_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "observations")
    stored(spark, SF).write.parquet(path)
    df = spark.read.parquet(path).where(observations.in_days("1996-01-01", "1996-12-31")).select("id", "B4")
    text = plan(df)
    assert "GreaterThanOrEqual(time," in text and "LessThan(time," in text
    assert "ReadSchema: struct<id:bigint,time:bigint,B4:int>" in text


def test_two_levels_share_one_exchange(spark):
    assert plan(plot_stats.plot_stats(stored(spark, SF), START, END, ["B4"])).count("Exchange") == 1
    assert plan(plot_stats.season_stats(stored(spark, SF), SEASONS, ["B4"])).count("Exchange") == 1


def test_tolerance_join_is_an_equi_join(spark):
    text = plan(joins.tolerance_matches(samples(spark, SF), sites(spark, SF), "plot_id"))
    assert "NestedLoop" not in text and ("SortMergeJoin" in text or "HashJoin" in text)


def test_bounded_files(spark):
    path = scratch_path(spark, "bounded")
    sinks.write_bounded(spark.range(1000).coalesce(1), path, 300, "parquet")
    files = [pyarrow.parquet.read_metadata(f).num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sorted(files) == [100, 300, 300, 300]


def test_csv_header_only_when_asked(spark):
    path = scratch_path(spark, "plain")
    sinks.write_csv(spark.range(3).coalesce(1), path, header=False)
    (file,) = glob.glob(f"{path}/*.csv")
    assert open(file).read().split() == ["0", "1", "2"]


def test_ingest_skips_known_ids(spark):
    fetched = spark.range(10)
    known = spark.range(6)
    assert sorted(r[0] for r in stream.ingest_new_ids(fetched, known).collect()) == [6, 7, 8, 9]
    assert stream.ingest_new_ids(fetched, known.where(F.lit(False))).count() == 10


def test_large_groups_are_split_by_hash_joins(spark, every_group_hot):
    df = plot_stats.plot_stats(stored(spark, SF), START, END, ["B4"])
    text = plan(df)
    assert "Python" not in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_lines_are_numbered_across_blocks(spark):
    """A file cut into several blocks keeps its line numbers."""
    path = scratch_path(spark, "titled")
    body = "title\nk,v\n" + "\n".join(f"{i},{i * 2}" for i in range(5000)) + "\n"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path, lineSep="\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_csv_below_title(spark, f"{path}/*.txt", T.StructType().add("k", "long").add("v", "long"))
        rows = df.collect()
        assert spark.read.text(path).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["line"], r["k"], r["v"]) for r in rows) == [(i, i, 2 * i) for i in range(5000)]


def test_rerun_batches_replace_their_output(spark):
    """A second ingest run over the same state and one more file gives each plot its latest row."""
    source, observed, features, state = (scratch_path(spark, n) for n in ("raw", "obs", "features", "state"))
    raw = raw_observations(spark, SF).select(*NEEDED)

    def run():
        stream.refresh_features(
            spark, source, observed, features, state,
            lambda df: df.groupBy("id").agg(F.count(F.lit(1)).alias("n")), raw.schema, files_per_batch=1,
        )

    raw.where("id < 6").coalesce(1).write.mode("append").parquet(source)
    run()
    raw.where("id >= 4").coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    got = {r["id"]: r["n"] for r in stream.latest_features(spark, features).collect()}
    every = raw.where("id < 6").union(raw.where("id >= 4"))
    assert got == {r["id"]: r["count"] for r in every.groupBy("id").count().collect()}


def test_bucketed_tables_need_no_exchange(spark):
    from plotstats.plans.statistics import BUCKETS

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalogue()["bucketed_features"][0](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text
    assert f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text


def test_buckets_within_partitions(spark):
    df = spark.createDataFrame([(i, f"r{i % 3}") for i in range(50)], "plot_id int, region string")
    path = scratch_path(spark, "buckets")
    back = sinks.write_bucketed(df, "regions_" + path[-32:], path, "plot_id", 4, "region")
    assert sorted(map(tuple, back.select("plot_id", "region").collect())) == sorted(map(tuple, df.collect()))
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{path}/region=*")) == ["r0", "r1", "r2"]
    assert "Exchange" not in plan(back.groupBy("plot_id").count())
