"""Incremental statistics from a mergeable state: equal to a recomputation, and nothing else is read."""

import glob
import os

from pyspark.sql import functions as F

from plotstats.operators.observations import clean_observations
from plotstats.operators.plot_stats import plot_stats
from plotstats.plans.incremental import BANDS, NEEDED
from plotstats.plans.views import END, START, raw_observations
from plotstats.session import scratch_path
from plotstats.streaming import ingest as stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_batch_reads_its_own_rows_and_the_touched_state(spark):
    source, observed, features, state = (scratch_path(spark, n) for n in ("raw", "obs", "features", "state"))
    raw = raw_observations(spark, SF).select(*NEEDED)

    def run():
        stream.refresh_plot_stats(spark, source, observed, features, state, START, END, BANDS, raw.schema, files_per_batch=1, buckets=4)

    bucket = F.pmod(F.hash("id"), F.lit(4))
    halves = raw.randomSplit([0.5, 0.5], 1)
    halves[0].coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(stream.latest_features(spark, features)) == rows(plot_stats(clean_observations(halves[0]), START, END, BANDS))
    # whatever lies outside the touched bucket, and all earlier observations, can no longer be read
    spoiled = [p for p in glob.glob(f"{state}/runs/bucket=*/**/*.parquet", recursive=True) if "/bucket=1/" not in p]
    spoiled += glob.glob(f"{observed}/**/*.parquet", recursive=True)
    assert len(spoiled) > 3
    for path in spoiled:
        with open(path, "wb") as f:
            f.write(b"spoiled")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.unlink(crc)
    more = halves[1].where(bucket == 1)
    more.coalesce(1).write.mode("append").parquet(source)
    run()
    both = clean_observations(halves[0].union(more))
    assert rows(stream.latest_features(spark, features)) == rows(plot_stats(both, START, END, BANDS))


def test_versions_are_kept_for_a_second_attempt_only(spark):
    source, observed, features, state = (scratch_path(spark, n) for n in ("raw", "obs", "features", "state"))
    raw = raw_observations(spark, SF).select(*NEEDED)
    parts = raw.randomSplit([0.25] * 4, 2)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        stream.refresh_plot_stats(spark, source, observed, features, state, START, END, BANDS, raw.schema, files_per_batch=1, buckets=2)
    assert rows(stream.latest_features(spark, features)) == rows(plot_stats(clean_observations(raw), START, END, BANDS))
    kept = sorted(p.rsplit("version=", 1)[1] for p in glob.glob(f"{state}/runs/bucket=0/version=*"))
    assert kept == ["2", "3"]
    # the last batch once more, as after a crash before its end was noted
    os.unlink(f"{state}/progress/commits/3")
    crc = f"{state}/progress/commits/.3.crc"
    if os.path.exists(crc):
        os.unlink(crc)
    stream.refresh_plot_stats(spark, source, observed, features, state, START, END, BANDS, raw.schema, files_per_batch=1, buckets=2)
    assert rows(stream.latest_features(spark, features)) == rows(plot_stats(clean_observations(raw), START, END, BANDS))


def test_large_plots_and_a_batch_without_clear_rows(spark, every_group_hot):
    source, observed, features, state = (scratch_path(spark, n) for n in ("raw", "obs", "features", "state"))
    raw = raw_observations(spark, SF).select(*NEEDED)
    raw.where("id < 4").coalesce(1).write.mode("append").parquet(source)
    raw.where("id < 4").withColumn("time", F.lit(0).cast("bigint")).coalesce(1).write.mode("append").parquet(source)
    stream.refresh_plot_stats(spark, source, observed, features, state, START, END, BANDS, raw.schema, files_per_batch=1)
    assert rows(stream.latest_features(spark, features)) == rows(plot_stats(clean_observations(raw.where("id < 4")), START, END, BANDS))
