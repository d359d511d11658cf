"""Quality of a text: random-indexing word vectors, pooled, through a two-layer network with calibrated output."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.llm.store import saved, tune

#: A word or a run of signs.
TOKEN = re.compile(r"\w+|[^\w\s]+")
CAPITALS = "<capitals>"
SIZE = 64
#: Non-zero entries of an index vector, half of them 1, half -1.
ENTRIES = 8
#: Neighbours on each side that a word's vector collects.
WINDOW = 2
#: Tokens rarer than this in the sample share the vectors of unseen ones.
LEAST_COUNT = 3
UNSEEN = 256
HIDDEN = 32
#: Passes over the sample, and steps of 64 rows at least, so that a small sample is learned too.
EPOCHS = 60
LEAST_STEPS = 2_000
SEED = 7


@dataclass
class QualityModel:
    """`rows` maps a token to its row of `vectors`; the last UNSEEN rows serve all other tokens by their hash."""

    rows: dict[str, int]
    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float


def index_vector(token: str) -> np.ndarray:
    """The fixed sparse random vector of a token."""
    draw = np.random.default_rng(zlib.crc32(token.encode("utf-8", "replace")))
    vector = np.zeros(SIZE, np.float32)
    at = draw.choice(SIZE, ENTRIES, replace=False)
    vector[at[: ENTRIES // 2]] = 1
    vector[at[ENTRIES // 2 :]] = -1
    return vector


def tokens(text: str) -> list[str]:
    """Lower-cased words and runs of signs; a mark follows each word in capitals."""
    out = []
    for token in TOKEN.findall(text):
        out.append(token.lower())
        if len(token) > 1 and token.isupper():
            out.append(CAPITALS)
    return out


def _row(rows: dict[str, int], token: str) -> int:
    at = rows.get(token)
    return at if at is not None else len(rows) + zlib.crc32(token.encode("utf-8", "replace")) % UNSEEN


def _count_tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = Counter(t for text in frame["text"] for t in tokens(text))
        yield pd.DataFrame({"token": list(counts), "n": list(counts.values())})


def _index_rows(rows: dict[str, int]) -> np.ndarray:
    return np.stack([index_vector(t) for t in rows] + [index_vector(f"<{i}>") for i in range(UNSEEN)])


def _collect_contexts(shared):
    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: dict[str, int] = shared.value
        count = len(rows) + UNSEEN
        index = _index_rows(rows)
        total = np.zeros((count, SIZE), np.float32)
        for frame in frames:
            for text in frame["text"]:
                at = np.array([_row(rows, t) for t in tokens(text)], np.int64)
                for begin in range(0, len(at), 50_000):
                    own = at[begin : begin + 50_000]
                    drawn, near = index[own], np.zeros((len(own), SIZE), np.float32)
                    for step in range(1, WINDOW + 1):
                        near[step:] += drawn[:-step]
                        near[:-step] += drawn[step:]
                    order = np.argsort(own, kind="stable")
                    first = np.flatnonzero(np.diff(own[order], prepend=-1))
                    total[own[order][first]] += np.add.reduceat(near[order], first, axis=0)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        if len(used):
            yield pd.DataFrame({"row": used, "part": used % 16, "vector": list(total[used])})

    return collect


def _add_vectors(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("row", kind="stable")
    values = np.stack(frame["vector"].to_list()).astype(np.float64)
    row = frame["row"].to_numpy()
    first = np.flatnonzero(np.diff(row, prepend=-1))
    # whole numbers: their sum does not depend on the order of the parts
    return pd.DataFrame({"row": row[first], "vector": list(np.add.reduceat(values, first, axis=0))})


def pooled(text: str, rows: dict[str, int], vectors: np.ndarray, memory: dict[str, tuple[int, int]]) -> np.ndarray:
    """Mean vector over tokens, mean over distinct tokens, and the logarithms of both counts."""
    counts: Counter = Counter()
    for token, n in Counter(TOKEN.findall(text)).items():
        known = memory.get(token)
        if known is None:
            extra = _row(rows, CAPITALS) if len(token) > 1 and token.isupper() else -1
            known = memory[token] = (_row(rows, token.lower()), extra)
        counts[known[0]] += n
        if known[1] >= 0:
            counts[known[1]] += n
    if not counts:
        return np.zeros(2 * SIZE + 2, np.float32)
    at = np.fromiter(counts, np.int64, len(counts))
    n = np.fromiter(counts.values(), np.float32, len(counts))
    drawn = vectors[at]
    return np.concatenate([n @ drawn / n.sum(), drawn.mean(axis=0), [np.log1p(n.sum()), np.log1p(len(n))]]).astype(np.float32)


def _pool_all(shared):
    def pool(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, vectors = shared.value
        memory: dict = {}
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"].astype(str), "label": frame["label"], "features": [pooled(t, rows, vectors, memory) for t in frame["text"]]})

    return pool


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = 6000) -> QualityModel:
    """Learns word vectors and network from about `rows` labelled rows (all, if fewer), drawn by a hash of the identifier.

    `labels` has one row per identifier. Rows without identifier or label teach nothing; a null text is an empty one. The
    vocabulary is that of the sample.
    """
    spark = docs.sparkSession
    tune(spark)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    count = known.count()
    ratio = F.pmod(F.xxhash64("_id", F.lit("quality sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # `rows` identifiers on average: a bounded number
    drawn = F.broadcast(saved(known.where(ratio * count < rows)))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = saved(texts.join(drawn, F.col("id") == F.col("_id")).select("id", "text", "label"))
    texts = texts.repartition(16, "id")
    frequent = texts.mapInPandas(_count_tokens, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    words = {r["token"]: i for i, r in enumerate(frequent.where(F.col("n") >= LEAST_COUNT).orderBy("token").select("token").collect())}
    shared = spark.sparkContext.broadcast(words)
    sums = (
        texts.mapInPandas(_collect_contexts(shared), "row long, part int, vector array<float>")
        .groupBy("part").applyInPandas(_add_vectors, "row long, vector array<double>").toPandas()
    )
    vectors = np.zeros((len(words) + UNSEEN, SIZE))
    if len(sums):
        vectors[sums["row"].to_numpy()] = np.stack(sums["vector"].to_list())
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    # frequent neighbours make contexts alike: a token's own index vector tells it from its neighbours
    vectors = (vectors + _index_rows(words) / ENTRIES**0.5).astype(np.float32)
    features = texts.mapInPandas(_pool_all(spark.sparkContext.broadcast((words, vectors))), "id string, label int, features array<float>")
    table = features.toPandas().sort_values(["id", "label"], kind="stable")
    if not len(table):
        return QualityModel(words, vectors, np.zeros(2 * SIZE + 2), np.ones(2 * SIZE + 2), [], 1.0)
    x, y = np.stack(table["features"].to_list()).astype(np.float64), table["label"].to_numpy(float)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - shift) / scale
    fold = np.array([zlib.crc32(b"fold" + str(i).encode()) % 5 for i in table["id"]])
    layers = train(x[fold > 0], y[fold > 0])
    return QualityModel(words, vectors, shift, scale, layers, calibrate(forward(x[fold == 0], layers)[0], y[fold == 0]))


def forward(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits and hidden activations."""
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden @ w2 + b2[0], hidden


def train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Adam on the logistic loss with weight decay; the same data give the same weights."""
    draw = np.random.default_rng(SEED)
    layers = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(max(EPOCHS, LEAST_STEPS * 64 // len(x)) if len(x) else 0):
        order = draw.permutation(len(x))
        for at in np.array_split(order, max(1, len(x) // 64)):
            logit, hidden = forward(x[at], layers)
            error = (1 / (1 + np.exp(-logit)) - y[at]) / len(at)
            back = np.outer(error, layers[2]) * (1 - hidden**2)
            slopes = [x[at].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope + (1e-3 * layers[i] if i in (0, 2) else 0)
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                layers[i] = layers[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return layers


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest logistic loss on rows that training did not see."""
    if not len(y) or len(np.unique(y)) < 2:
        return 1.0
    choices = np.exp(np.linspace(np.log(0.2), np.log(5), 81))
    losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in choices]
    return float(choices[int(np.argmin(losses))])


def probability(features: np.ndarray, model: QualityModel) -> np.ndarray:
    if not model.layers:
        return np.full(len(features), 0.5)
    logits, _ = forward((features - model.shift) / model.scale, model.layers)
    return 1 / (1 + np.exp(-np.clip(logits / model.temperature, -500, 500)))


def _scorer(shared):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: QualityModel = shared.value
        memory: dict = {}
        for frame in frames:
            features = np.stack([pooled(t, model.rows, model.vectors, memory) for t in frame["text"]]) if len(frame) else np.zeros((0, 2 * SIZE + 2))
            yield pd.DataFrame({"id": frame["id"], "score": probability(features.astype(np.float64), model)})
            if len(memory) > 300_000:
                memory.clear()

    return score


def score(docs: DataFrame, model: QualityModel, id_col: str, text_col: str) -> DataFrame:
    """(id_col, score) for every row: the calibrated probability of label 1. Null and empty texts get the network's
    answer to a text without words; without training rows every score is 0.5. Rows are judged one by one."""
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInPandas(
        _scorer(spark.sparkContext.broadcast(model)), f"id {kind}, score double"
    ).withColumnRenamed("id", id_col)
