"""Ranked search over an index of documents grouped by length.

score(item, document) = sum over the item's terms, repeats included, of w * impact(tf, m), where w is the term's weight
floor(1000 ln((2N + 2) / (2 df + 1))), impact(tf, m) = 10^9 tf div (1000 tf + 8 m), and m = 25 + 75 n N div L depends on the
document's length n alone. So documents of equal m form a stratum in which an impact is a function of tf: it is computed once for each
(stratum, tf), and the postings of a term within a stratum are kept by tf. The largest tf of each of its terms bounds
what a stratum can give an item. Strata are visited from the largest bound down, and a stratum whose bound is below the
tenth score found is left out; one whose bound equals it is visited, as a smaller identifier would win the tie.

Two passes over the rows: the first counts each document's terms and keeps those that an item asks for (the other terms only count for n,
N and L); the second deals documents out by ranges of (m, hash of the identifier), so that a stratum lies together unless it is
too large for one task, and hands on at most `k` rows an item and task. Items are taken in blocks of bounded size.

Defined results: a null or empty text has no terms, takes no part and finds nothing; repeated rows of documents are documents of
their own, repeated rows of items get the same documents each; equal scores go by ascending identifier, null last; without documents or items
there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotstats.llm.store import saved, tune
from plotstats.llm.text import raw

#: Bytes of items' texts that are searched at once; their words and weights are sent to every executor.
ITEM_BYTES = 32 << 20
#: Postings of a task, roughly; the number of tasks follows from it and the input.
TASK_POSTINGS = 2_000_000
#: Postings that a task holds at a time.
BLOCK_POSTINGS = 250_000
#: Strata visited before the first threshold is known, and the factor by which later visits grow.
FIRST_VISIT, GROWTH = 16, 4

# A-Z become a-z; all other signs, blanks and control characters of ASCII separate terms
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """id, n (all terms), terms (numbers of the vocabulary, ascending), tfs of every document with a term."""
    known = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            ids, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                words = terms_of(text.as_py())
                if words:
                    found = sorted((number[w], c) for w, c in Counter(words).items() if w in number)
                    ids.append(i)
                    sizes.append(len(words))
                    terms.append([t for t, _ in found])
                    tfs.append([c for _, c in found])
            columns = [batch.column("id").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<int>")


def normaliser(documents: int, length: int) -> Column:
    """m = 100 - 75 + 75 n N div L of a column n; the product is taken in decimals."""
    return F.expr(f"25 + (cast(n as decimal(18,0)) * cast({75 * documents} as decimal(20,0))) div cast({length} as decimal(20,0))")


class Block:
    """The index of some documents: postings by term, stratum and tf."""

    def __init__(self, ids: pa.Array, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        rank = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        self.ids, place = ids.take(pa.array(rank)), np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))  # documents are numbered in order of their identifiers
        normalisers, stratum = np.unique(m, return_inverse=True)
        doc, of = np.repeat(place, sizes), np.repeat(stratum, sizes)
        order = np.lexsort((tfs, of, terms))
        self.doc, of, term, tf = doc[order], of[order], terms[order], tfs[order].astype(np.int64)
        new = np.ones(len(tf), bool)
        new[1:] = (term[1:] != term[:-1]) | (of[1:] != of[:-1])
        step = new.copy()
        step[1:] |= tf[1:] != tf[:-1]
        # one impact for each (term, stratum, tf)
        at = np.flatnonzero(step)
        impact = (1_000_000_000 * tf[at]) // (1000 * tf[at] + 8 * normalisers[of[at]])
        self.impact = np.repeat(impact, np.diff(np.append(at, len(tf))))
        self.start = np.flatnonzero(new)
        self.length = np.diff(np.append(self.start, len(tf)))
        self.stratum, self.strata = of[self.start], len(normalisers)
        self.most = self.impact[self.start + self.length - 1] if len(self.start) else self.impact
        self.first = term[self.start]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, scores) of the up to `k` best documents with a score above 0 and not below `threshold`."""
        low, high = np.searchsorted(self.first, terms, "left"), np.searchsorted(self.first, terms, "right")
        entries = _ranges(low, high - low)
        value = np.repeat(weights, high - low)
        bound = _sums(self.stratum[entries], value * self.most[entries], self.strata)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, visit = 0, FIRST_VISIT
        while at < len(order) and bound[order[at]] >= threshold:
            batch = order[at : at + visit]
            batch = batch[bound[batch] >= threshold]
            wanted = np.zeros(self.strata, bool)
            wanted[batch] = True
            use = wanted[self.stratum[entries]]
            own, times = entries[use], value[use]
            index = _ranges(self.start[own], self.length[own])
            total = _sums(self.doc[index], np.repeat(times, self.length[own]) * self.impact[index], len(self.ids))
            found = np.flatnonzero(total >= max(threshold, 1))
            docs, scores = _best(np.append(docs, found), np.append(scores, total[found]), k)
            if len(docs) == k:
                threshold = max(threshold, int(scores[-1]))
            at, visit = at + visit, visit * GROWTH
        return docs, scores


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths) if total else np.zeros(0, np.int64)


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums by place: in doubles while all of them together stay below 2^53."""
    if values.sum(dtype=np.float64) < 2**52:
        return np.bincount(at, values, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(docs) > k:
        least = np.partition(scores, -k)[-k]
        near = scores >= least
        docs, scores = docs[near], scores[near]
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _search(rows: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """query, id, score: the best `k` of each task for each query. `rows`: id, m, terms, tfs, sorted by m within a task."""
    sent = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}

        def merge(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts).combine_chunks()
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
            ids = table.column("id").combine_chunks()
            block = Block(ids, table.column("m").to_numpy(), sizes, terms.flatten().to_numpy(), tfs.flatten().to_numpy())
            for q, (own, weights) in enumerate(sent.value):
                kept = best.get(q, [])
                docs, scores = block.search(own, weights, k, -kept[-1][0] if len(kept) == k else 0)
                if len(docs):
                    new = [(-s, i is None, i) for s, i in zip(scores.tolist(), block.ids.take(pa.array(docs)).to_pylist(), strict=True)]
                    best[q] = sorted(kept + new, key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))[:k]

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= BLOCK_POSTINGS:
                merge(held)
                held, size = [], 0
        if held:
            merge(held)
        flat = [(q, -s, i) for q, kept in best.items() for s, _, i in kept]
        columns = [pa.array([x[0] for x in flat], pa.int32()), pa.array([x[2] for x in flat], id_type), pa.array([x[1] for x in flat], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["id"].dataType
    id_type = to_arrow_type(kind)
    return rows.select("id", "m", "terms", "tfs").mapInArrow(run, f"query int, id {kind.simpleString()}, score long")


def _block(docs: DataFrame, texts: list[bytes], k: int) -> DataFrame:
    """text, rank, id, score for a bounded list of distinct texts."""
    spark = docs.sparkSession
    asked = [Counter(terms_of(t)) for t in texts]
    vocabulary = sorted(set().union(*asked)) if asked else []
    number = {w: i for i, w in enumerate(vocabulary)}
    rows = saved(postings(docs, vocabulary))
    total = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("length"), F.sum(F.size("terms")).alias("postings")).first()
    found = {r["term"]: r["df"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    queries = []
    for counts in asked:
        own = sorted((number[w], c) for w, c in counts.items() if number[w] in found)
        terms = np.array([t for t, _ in own], np.int64)
        queries.append((terms, np.array([c * weight(total["documents"], found[t]) for t, c in own], np.int64)))
    if not total["documents"]:
        indexed = rows.withColumn("m", F.col("n"))
    else:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total["postings"]) // TASK_POSTINGS))
        indexed = rows.where(F.size("terms") > 0).withColumn("m", normaliser(total["documents"], total["length"]))
        indexed = indexed.repartitionByRange(tasks, "m", F.xxhash64("id")).sortWithinPartitions("m")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = _search(indexed, queries, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "query int, text binary")
    return ranked.join(F.broadcast(named), "query").select("text", "rank", "id", "score")


def search(docs: DataFrame, items: DataFrame, id_column: str, text_column: str, item_column: str, item_text: str, k: int = 10) -> DataFrame:
    """(item_column, rank, id_column, score): the `k` documents with the highest scores above 0 for each row of items."""
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(F.col(id_column).alias("id"), raw(F.col(text_column)).alias("text"))
    asked = items.select(F.col(item_column).alias("item"), raw(F.col(item_text)).alias("text"))
    texts = saved(asked.select("text").distinct())
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    part = F.pmod(F.xxhash64("text"), F.lit(blocks))
    found = []
    for b in range(blocks):
        own = [bytes(r["text"]) for r in texts.where(part == b).collect()]
        # with many blocks each one's finds are written before the next is begun
        one = _block(rows, own, k)
        found.append(saved(one) if blocks > 1 else one)
    finds = reduce(DataFrame.union, found)
    out = asked.join(finds, "text")
    return out.select(F.col("item").alias(item_column), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
