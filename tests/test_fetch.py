"""Resumable fetches: every point once, whatever ends a run."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plotstats.session import scratch_path
from plotstats.streaming.fetch import TooLarge, fetch_points, next_point

SCHEMA = "id bigint, longitude double, latitude double, time bigint, B4 int, QA10 bigint, QA20 bigint, QA60 bigint"


def remote(folder, broken=(), flaky=(), large=()):
    """Two rows per point, none for every tenth; notes each request in `folder`."""

    def fetch(point):
        i = point["id"]
        with open(f"{folder}/{i}", "a") as f:
            f.write("x")
        if i in large:
            raise TooLarge("Too many values")
        if i in broken or (i in flaky and os.path.getsize(f"{folder}/{i}") < 3):
            raise OSError("no answer")
        for k in range(0 if i % 10 == 0 else 2):
            yield {"id": i, "longitude": 0.5, "latitude": 1.25, "time": 1000 * k, "B4": None if k else i, "QA10": 0, "QA20": 0, "QA60": 1024 * k}

    return fetch


class Runs:
    def __init__(self, spark, tmp_path, n=25):
        self.spark, self.folder = spark, str(tmp_path)
        self.points = spark.range(n).select(F.col("id").alias("point"), (F.col("id") + 100).alias("id"))
        self.schema = spark.createDataFrame([], SCHEMA).schema
        self.target, self.log, self.state = (scratch_path(spark, x) for x in ("obs", "log", "state"))

    def go(self, **kw):
        options = {"chunk": 10, "attempts": 3, "wait": 0.0, "tasks": 2}
        until = kw.pop("until", None)
        fetch_points(self.spark, self.points, remote(self.folder, **kw), self.schema, self.target, self.log, self.state, until, **options)

    def requests(self):
        return {int(f): os.path.getsize(f"{self.folder}/{f}") for f in os.listdir(self.folder)}

    def stored(self):
        return sorted(map(tuple, self.spark.read.parquet(self.target).select("id", "time", "B4", "HAS_CLOUDFLAG").collect()))

    def states(self):
        rows = self.spark.read.parquet(self.log).select("id", "state", "attempts", "rows").collect()
        assert len({r["id"] for r in rows}) == len(rows)
        return {r["id"]: (r["state"], r["attempts"], r["rows"]) for r in rows}


def expected(ids):
    return sorted((i, k, None if k else i, bool(k)) for i in ids for k in range(0 if i % 10 == 0 else 2))


def test_runs_go_on_where_the_last_one_stopped(spark, tmp_path):
    runs = Runs(spark, tmp_path)
    runs.go(until=7)
    assert runs.stored() == expected(range(100, 107)) and next_point(spark, runs.log) == 7
    runs.go(until=3)
    runs.go()
    runs.go()
    assert runs.stored() == expected(range(100, 125))
    assert runs.requests() == dict.fromkeys(range(100, 125), 1)


def test_retries_and_answers_that_are_too_large(spark, tmp_path):
    runs = Runs(spark, tmp_path)
    runs.go(flaky={103, 111}, large={105})
    assert runs.stored() == expected(set(range(100, 125)) - {105})
    states = runs.states()
    assert states[103] == ("fetched", 3, 2) and states[105] == ("too large", 1, 0) and states[110] == ("fetched", 1, 0)
    assert runs.requests()[105] == 1 and runs.requests()[111] == 3


def test_a_failed_point_ends_the_run_and_only_it_is_asked_for_again(spark, tmp_path):
    runs = Runs(spark, tmp_path)
    with pytest.raises(StreamingQueryException, match="1 points could not be fetched"):
        runs.go(broken={113})
    assert runs.stored() == expected(set(range(100, 120)) - {113})
    assert runs.states()[113] == ("failed", 3, 0)
    runs.go()
    assert runs.stored() == expected(range(100, 125))
    assert runs.states()[113] == ("fetched", 1, 2)
    assert runs.requests() == dict.fromkeys(range(100, 125), 1) | {113: 4}


def test_a_batch_whose_end_was_not_noted_is_not_asked_for_again(spark, tmp_path):
    runs = Runs(spark, tmp_path)
    runs.go(until=20)
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{runs.state}/progress/commits/{name}"):
            os.unlink(f"{runs.state}/progress/commits/{name}")
    runs.go()
    assert runs.stored() == expected(range(100, 125))
    assert runs.requests() == dict.fromkeys(range(100, 125), 1)


def test_no_points(spark, tmp_path):
    runs = Runs(spark, tmp_path, 0)
    runs.go()
    assert runs.requests() == {} and next_point(spark, runs.log) == 0
