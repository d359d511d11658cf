"""Resumable fetches from a remote source: a stream of point numbers, each of which is asked for once."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from plotstats.operators.observations import clean_observations
from plotstats.session import folders, remove

#: Points of a batch, unless the points would take more than MOST_BATCHES of them: a batch has its cost whatever it holds.
CHUNK = 1000
MOST_BATCHES = 32
#: Requests for one point before it counts as failed.
ATTEMPTS = 10
FETCHED, TOO_LARGE, FAILED = "fetched", "too large", "failed"

Fetch = Callable[[dict], Iterable[dict]]


class TooLarge(Exception):
    """The answer for a point has more values than the remote source gives out; asking again is no use."""


class FetchFailed(RuntimeError):
    """Some points of a batch could not be fetched; the next run asks for these again."""


class PointOffsets(DataSource):
    """Numbers of points, from 0 up to the option `total`, at most `chunk` in a batch. The offset is the next number.

    Spark's checkpoint holds the offsets of every batch. A new run tells by the option `position` how
    far the earlier ones came, since a reader is asked for its latest offset before it hears of a first one.
    """

    @classmethod
    def name(cls) -> str:
        return "point_offsets"

    def schema(self) -> str:
        return "point bigint"

    def streamReader(self, schema: T.StructType) -> PointReader:
        return PointReader(int(self.options["total"]), int(self.options["chunk"]), int(self.options.get("position", 0)))


class Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class PointReader(DataSourceStreamReader):
    def __init__(self, total: int, chunk: int, position: int):
        self.total, self.chunk, self.position = total, chunk, position

    def initialOffset(self) -> dict:
        return {"point": 0}

    def latestOffset(self) -> dict:
        # a run may be told to stop before the place that an earlier one has reached
        return {"point": max(self.position, min(self.position + self.chunk, self.total))}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.position = max(self.position, end["point"])
        return [Range(start["point"], end["point"])]

    def read(self, partition: Range) -> Iterator[tuple[int]]:
        for point in range(partition.start, partition.end):
            yield (point,)


def folder_fetch(folder: str) -> Fetch:
    """Answers of a remote source kept in a folder: JSON lines below `id=<id>`; a point without a folder has no rows."""

    def fetch(point: dict) -> Iterator[dict]:
        from pyarrow import fs

        if "://" in folder or folder.startswith("file:"):
            store, root = fs.FileSystem.from_uri(folder)
        else:
            store, root = fs.LocalFileSystem(), folder
        files = store.get_file_info(fs.FileSelector(f"{root}/id={point['id']}", allow_not_found=True))
        for file in sorted(f.path for f in files if f.base_name.endswith(".json")):
            with store.open_input_stream(file) as stream:
                for line in stream.read().splitlines():
                    yield json.loads(line)

    return fetch


def _asked(fetch: Fetch, columns: list[str], answer: T.StructType, attempts: int, wait: float):
    """Asks for each point, again after `wait` seconds and twice as long each time, and gives rows of `columns` and one row of its state."""

    def ask(point: dict) -> list[dict]:
        tried, rows, state, fault = 0, [], FAILED, None
        while state == FAILED and tried < attempts:
            if tried:
                time.sleep(wait * 2**tried)
            tried += 1
            try:
                rows, state, fault = list(fetch(point)), FETCHED, None
            except TooLarge as no:
                state, fault = TOO_LARGE, str(no)
            except Exception as no:  # whatever the remote source may raise
                fault = f"{type(no).__name__}: {no}"
        return [*rows, {"state": state, "attempts": tried, "rows": len(rows), "fault": fault}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(answer)
        for batch in batches:
            # the rows of one point at a time
            for point in batch.to_pylist():
                rows, state = (part := ask(point))[:-1], part[-1]
                values = {c: [*[row.get(c) for row in rows], None] for c in columns}
                values |= {c: [*[None] * len(rows), state[c]] for c in state}
                values |= {c: [point[c]] * len(part) for c in ("point", "id")}
                yield pa.RecordBatch.from_arrays([pa.array(values[k.name], k.type, from_pandas=True) for k in kinds], schema=kinds)

    return run


def _answer_schema(schema: T.StructType) -> T.StructType:
    own = [T.StructField("point", T.LongType()), T.StructField("id", schema["id"].dataType)]
    state = [T.StructField("state", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("fault", T.StringType())]
    # rows of a point's state have no values
    return T.StructType(own + [T.StructField(f.name, f.dataType) for f in schema.fields if f.name != "id"] + state)


def fetch_points(
    spark: SparkSession,
    points: DataFrame,
    fetch: Fetch,
    schema: T.StructType,
    observations: str,
    log: str,
    state: str,
    until: int | None = None,
    chunk: int | None = None,
    attempts: int = ATTEMPTS,
    wait: float = 1.0,
    tasks: int = 8,
) -> None:
    """Fetches the observations of every point and stores them cleaned, going on where an earlier run stopped.

    `points` has the columns `point` (0, 1, 2, ... without gaps) and `id`, and what `fetch` needs; `fetch` gives the
    raw rows of one point as dictionaries. The run ends before the point `until`. Points are taken `chunk` at a time, by default CHUNK or, of very many points, a share of
    all, by `tasks` tasks, each of which holds the answer for one point. The answers of a batch are stored before anything is derived from them, so a batch that is run again asks
    only for the points that are missing, and its observations replace what the earlier attempt stored: no point is stored
    twice. A point whose answer is too large is noted in `log` and left out. If a point fails
    `attempts` times, the others of its batch are stored, and the run ends with `FetchFailed`; the next
    run asks for it again. `log` has one row per point: point, id, state, attempts, rows, fault, batch.
    """
    spark.dataSource.register(PointOffsets)
    answer = _answer_schema(schema)
    columns = [f.name for f in schema.fields if f.name != "id"]
    known = points.select(*dict.fromkeys(["point", "id", *points.columns]))
    total = points.agg(F.max("point")).first()[0]
    total = 0 if total is None else total + 1
    chunk = chunk or max(CHUNK, -(-total // MOST_BATCHES))
    total = total if until is None else min(until, total)

    def stored(number: int) -> list[str]:
        # an attempt that was killed while it wrote has no mark of success
        return [p.rsplit("/", 1)[0] for p in folders(spark, f"{state}/answers/batch={number}/try=*/_SUCCESS")]

    def on_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        first, last = batch.agg(F.min("point"), F.max("point")).first()
        if first is None:
            return
        wanted = known.where(F.col("point").between(first, last))
        before = stored(number)
        if before:
            done = session.read.schema(answer).parquet(*before).where(F.col("state").isin(FETCHED, TOO_LARGE))
            wanted = wanted.join(done.select("point"), "point", "left_anti")
        path = f"{state}/answers/batch={number}/try={1 + max([int(p.rsplit('=', 1)[1]) for p in before], default=0)}"
        asked = wanted.repartition(tasks, "point").mapInArrow(_asked(fetch, columns, answer, attempts, wait), answer)
        asked.write.mode("overwrite").parquet(path)

        answers = session.read.schema(answer).parquet(*stored(number))
        clean_observations(answers.where("state is null").select(*schema.names)).write.mode("overwrite").parquet(f"{observations}/batch={number}")
        # of a point that failed first and was fetched later, the last state
        newest = answers.where("state is not null").withColumn("round", F.regexp_extract(F.input_file_name(), r"try=(\d+)", 1).cast("int"))
        newest = newest.groupBy("point", "id").agg(F.max_by(F.struct("state", "attempts", "rows", "fault"), "round").alias("s")).select("point", "id", "s.*")
        newest.write.mode("overwrite").parquet(f"{log}/batch={number}")
        failed = session.read.parquet(f"{log}/batch={number}").where(F.col("state") == FAILED).agg(F.count("*"), F.min("point"), F.min("fault")).first()
        if failed[0]:
            raise FetchFailed(f"{failed[0]} points could not be fetched, the first of them {failed[1]}: {failed[2]}")
        # the batch before this one can not be run again
        for path in folders(session, f"{state}/answers/batch={number - 1}"):
            remove(session, path)

    query = (
        spark.readStream.format("point_offsets")
        .option("total", total)
        .option("chunk", chunk)
        .option("position", next_point(spark, log))
        .load()
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{state}/progress")
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def next_point(spark: SparkSession, log: str) -> int:
    """One more than the largest point that a run has dealt with."""
    if not folders(spark, f"{log}/batch=*"):
        return 0
    last = spark.read.parquet(log).agg(F.max("point")).first()[0]
    return 0 if last is None else last + 1
