"""Clustering of whole-number vectors around centroids, with an exact progressive search.

A vector of 64 components and its Walsh-Hadamard transform carry the same distances: with H the matrix of signs,
|Hx - Hc|^2 = 64 |x - c|^2, and all numbers stay whole. The first coefficients describe a vector coarsely (sums over
halves, quarters and so on in sequency order), so a sum over a few of them is a lower bound that already tells most
centroids apart. The search adds coefficients coarse to fine, drops every centroid whose sum so far is
strictly above the whole distance of one that is known, and finishes all 64 coefficients for what is left: the
result is the nearest centroid, of equally near ones the smallest number.

Defined results: only vectors of exactly 64 components, none null or non-finite, take part, all others give no row; repeated rows are
vectors of their own; a null identifier is clustered like any other but hashes after all others; fewer vectors than centroids
give as many centroids as vectors; an empty table gives no rows. Components up to 1e30 in size are exact; a distance beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
#: Whole numbers up to this size have all sums of the search within 64 bits; larger ones are computed with Python's integers.
NARROW = 1 << 24
#: Coefficients after which centroids are dropped; the first come in one step.
STEPS = (4, 8, 16, 32, 64)
#: Vectors are compared in blocks of so many, which bounds the memory of a task.
BLOCK = 4096


def signs() -> np.ndarray:
    """The rows of the Hadamard matrix in order of their number of sign changes: coarse first."""
    h = np.ones((1, 1), np.int64)
    while len(h) < DIMENSIONS:
        h = np.block([[h, h], [h, -h]])
    changes = (np.diff(h, axis=1) != 0).sum(axis=1)
    return h[np.argsort(changes, kind="stable")]


SIGNS = signs()


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of doubles, as 64-bit numbers if they are small enough."""
    scaled = np.floor(256.0 * vectors)
    if scaled.size and np.abs(scaled).max() > NARROW:
        return np.array([[int(x) for x in row] for row in scaled], dtype=object)
    return scaled.astype(np.int64)


def transform(numbers: np.ndarray) -> np.ndarray:
    """All 64 coefficients of each row, exact."""
    return numbers @ SIGNS.T if numbers.dtype != object else numbers.dot(SIGNS.T.astype(object))


def nearest(numbers: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance of each row."""
    if object in (numbers.dtype, centroids.dtype):
        numbers, centroids = numbers.astype(object), centroids.astype(object)
    x, c = transform(numbers), transform(centroids)
    rows = np.arange(len(x))
    # coarse sums of all centroids; the best of them is finished and bounds the rest
    first = STEPS[0]
    sums = ((x[:, None, :first] - c[None, :, :first]) ** 2).sum(axis=2)
    guess = sums.argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    at, which = np.nonzero(sums <= bound[:, None])
    left = sums[at, which]
    for begin, end in zip(STEPS, STEPS[1:], strict=False):
        left = left + ((x[at, begin:end] - c[which, begin:end]) ** 2).sum(axis=1)
        keep = left <= bound[at]
        at, which, left = at[keep], which[keep], left[keep]
    # whole distances now; rows come in order, and within a row centroids by number
    order = np.lexsort((which, left, at)) if left.dtype != object else sorted(range(len(at)), key=lambda i: (at[i], left[i], which[i]))
    at, which, left = at[order], which[order], left[order]
    head = np.searchsorted(at, rows)
    return which[head], left[head] // DIMENSIONS


def usable(vector: Column) -> Column:
    """Exactly 64 components, none null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == DIMENSIONS) & fine, F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, whole_numbers(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS))


def starts(vectors: DataFrame, seed: str, k: int) -> np.ndarray:
    """The `k` vectors with the smallest sha256 of seed, colon and identifier; at most `k` rows reach the driver."""
    hashed = vectors.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256))
    rows = hashed.orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).collect()
    return whole_numbers(np.array([r["vector"] for r in rows], np.float64).reshape(-1, DIMENSIONS))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of their vectors. A task hands on one row of sums for each centroid."""
    names = [f"s{i}" for i in range(DIMENSIONS)]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), DIMENSIONS), object)
        count = np.zeros(len(centroids), np.int64)
        for _, numbers in _blocks(batches):
            own, _ = nearest(numbers, centroids)
            count += np.bincount(own, minlength=len(centroids))
            for k in np.unique(own):
                total[k] += numbers[own == k].sum(axis=0)
        full = np.flatnonzero(count)
        columns = [pa.array(full), pa.array(count[full])]
        columns += [pa.array([Decimal(int(total[k][i])) for k in full], pa.decimal128(38, 0)) for i in range(DIMENSIONS)]
        yield pa.RecordBatch.from_arrays(columns, ["k", "n", *names])

    sums = vectors.select("vector").mapInArrow(tally, "k long, n long, " + ", ".join(f"{s} decimal(38,0)" for s in names))
    moved_ = centroids.astype(object)
    for row in sums.groupBy("k").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect():
        moved_[row["k"]] = [int(row[s]) // row["n"] for s in names]
    return moved_ if len(moved_) and max(map(abs, moved_.ravel())) > NARROW else moved_.astype(np.int64)


def fit(vectors: DataFrame, seed: str = "2", k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after `rounds` rounds. `vectors`: id, vector. Only k x 64 numbers are sent to and from the tasks."""
    centroids = starts(vectors, seed, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance (squared) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers in _blocks(batches):
            own, distance = nearest(numbers, centroids)
            known = [int(d) if d < 1 << 63 else None for d in distance] if distance.dtype == object else distance
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(own.astype(np.int32)), pa.array(known, pa.int64())], ["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "vector").mapInArrow(run, f"id {kind}, cluster int, distance long")


def clusters(table: DataFrame, id_column: str, vector_column: str, seed: str = "2", k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """(id_column, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector of the table."""
    vectors = table.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")).where(usable(F.col("vector")))
    vectors = vectors.select("id", F.col("vector").cast("array<double>").alias("vector"))
    centroids = fit(vectors, seed, k, rounds)
    own = assign(vectors, centroids)
    # one row for each of the k centroids
    sums = {r["cluster"]: r["inertia"] for r in own.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    whole = sum(v for v in sums.values() if v is not None)
    facts = [
        (i, _long(sums.get(i)), _long(whole), hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()) for i, c in enumerate(centroids)
    ]
    named = table.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = own.join(F.broadcast(named), "cluster")
    return out.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(number: Decimal | None) -> int | None:
    return int(number) if number is not None and number < 1 << 63 else None
