"""Benchmark decontamination: training passages as queries on a BM25 index of the test items, with block-max pruning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.llm.store import saved, tune
from plotstats.llm.text import mix, raw, texts_of, word_hashes

K1, B = 1.2, 0.75
#: A passage is retrieved for an item at this share of the score that the item's own text would get.
RETRIEVE = 0.6
#: The question and the answer of an item must each have this share of their words in runs of RUN words that the passage has;
#: of an item that has no answer column, the item as a whole is enough.
OVERLAP = 0.8
RUN = 5
#: The answer: the last so many words of an item that has no answer column, in hundredths of its words.
ANSWER_PERCENT = 25
#: Items of a block share one upper bound per word; items of an index, in bytes of text; words of the shortest passages.
BLOCK = 32
INDEX_BYTES = 32 << 20
LEAST_STEP = 32
#: Steps of a long text that are searched at once.
STEPS = 4_096
#: Letters, digits and all bytes beyond ASCII count; A-Z as a-z, all else as a blank.
PLAIN = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else 32 for c in range(256))


@dataclass
class Index:
    """Items of a similar length: passages are two steps long, so each item lies whole in one of them."""

    step: int
    items: np.ndarray
    need: np.ndarray
    block_need: np.ndarray
    terms: np.ndarray
    best: np.ndarray
    block_best: np.ndarray
    impact: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray, bool]]


def words_of(texts: list[bytes]) -> list[np.ndarray]:
    return [h for _, h in word_hashes([t.translate(PLAIN) for t in texts])]


def item_words(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """Question and answer of each item as word hashes, and whether it has an answer. Without one, the last words are the answer."""
    questions = words_of(texts_of(frame["question"]))
    answers = words_of(texts_of(frame["answer"]))
    out = []
    for question, answer in zip(questions, answers):
        given = len(answer) > 0
        if not given:
            cut = len(question) - len(question) * ANSWER_PERCENT // 100
            question, answer = question[:cut], question[cut:]
        out.append((question, answer, given))
    return out


def _count_items(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for question, answer, _ in item_words(frame):
            own = np.concatenate([question, answer])
            terms = np.unique(own)
            yield pd.DataFrame({"term": terms.view(np.int64), "size": len(own) * (np.arange(len(terms)) == 0)})


def build(frame: pd.DataFrame, frequency: dict[int, int], count: int, mean: float) -> list[Index]:
    """Indexes of the items by length: up to LEAST_STEP words, up to twice that, and so on. Items without words are left out."""
    words = item_words(frame)
    sizes = np.array([len(q) + len(a) for q, a, _ in words])
    out, step = [], LEAST_STEP
    while (sizes > step // 2 if step > LEAST_STEP else sizes > 0).any():
        low = step // 2 if step > LEAST_STEP else 0
        chosen = np.flatnonzero((sizes > low) & (sizes <= step))
        if len(chosen):
            out.append(_index(step, frame["item"].to_numpy()[chosen], [words[i] for i in chosen], frequency, count, mean))
        step *= 2
    return out


def _index(step: int, items, parts, frequency: dict[int, int], count: int, mean: float) -> Index:
    whole = [np.concatenate(p[:2]) for p in parts]
    terms = np.unique(np.concatenate(whole))
    found = np.array([frequency[int(t)] for t in terms.view(np.int64)], float)
    weight = np.log(1 + (count - found + 0.5) / (found + 0.5))
    impact = np.zeros((len(terms), len(items)), np.float32)
    for i, own in enumerate(whole):
        distinct, n = np.unique(own, return_counts=True)
        at = np.searchsorted(terms, distinct)
        impact[at, i] = weight[at] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(own) / mean))
    need = RETRIEVE * impact.sum(axis=0) * (1 - 1e-6)
    # items with like needs share a block, so that the bound of a block is a useful one
    order = np.argsort(need, kind="stable")
    items, need, impact, parts = items[order], need[order], impact[:, order], [parts[i] for i in order]
    edges = np.arange(0, len(items), BLOCK)
    return Index(step, items, need, np.minimum.reduceat(need, edges), terms, impact.max(axis=1), np.maximum.reduceat(impact, edges, axis=1), impact, parts)


def search(index: Index, at: np.ndarray) -> list[tuple[int, int, float]]:
    """(first step of the passage, item, score) of every passage that an item's need allows.

    `at` holds, for each word of a text, its row in the index or -1. A passage counts a word once. Passages whose words'
    best impacts stay below every need are skipped, then blocks of items whose bounds stay below their need; what is left is scored.
    """
    steps = max(1, -(-len(at) // index.step))
    hit = np.flatnonzero(at >= 0)
    if not len(hit):
        return []
    own, column = np.unique(at[hit], return_inverse=True)
    bound = np.bincount(hit // index.step, weights=index.best[at[hit]], minlength=steps)
    bound = bound + np.append(bound[1:], 0)
    live = np.flatnonzero(bound >= index.block_need[0])
    if not len(live):
        return []
    has = np.zeros((steps + 1, len(own)), np.float32)
    has[hit // index.step, column] = 1
    passages = np.maximum(has[live], has[live + 1])
    out = []
    bounds = passages @ index.block_best[own]
    rows, blocks = np.nonzero(bounds * (1 + 1e-5) >= index.block_need)
    for block in np.unique(blocks):
        mine, low = rows[blocks == block], block * BLOCK
        scores = passages[mine] @ index.impact[own, low : low + BLOCK]
        row, item = np.nonzero(scores >= index.need[low : low + BLOCK])
        out += [(int(live[mine[r]]), int(low + i), float(scores[r, i])) for r, i in zip(row, item)]
    return out


def covered(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the words of `part` in runs of RUN words (of all its words, if fewer) that the passage has too; 1 for an empty part."""
    width = min(RUN, len(part))
    if not width:
        return 1.0
    if len(passage) < width:
        return 0.0
    runs = [_runs(x, width) for x in (part, passage)]
    found = np.isin(runs[0], runs[1])
    inside = np.zeros(len(part), bool)
    for step in range(width):
        inside[step : step + len(found)] |= found
    return float(inside.mean())


def held(item: tuple[np.ndarray, np.ndarray, bool], passage: np.ndarray) -> tuple[float, float, bool]:
    """Overlaps of question and answer, and whether the passage holds the item: both of them, or all of an item without an answer."""
    *parts, given = item
    question, answer = (covered(p, passage) for p in parts)
    found = min(question, answer) >= OVERLAP or not given and covered(np.concatenate(parts), passage) >= OVERLAP
    return question, answer, found


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - width + 1 + i]
    return mix(total)


def _matcher(shared):
    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes: list[Index] = shared.value
        for frame in frames:
            rows, ids = [], frame["id"].array
            for number, own in word_hashes([t.translate(PLAIN) for t in texts_of(frame["text"])]):
                for index in indexes:
                    at = np.minimum(np.searchsorted(index.terms, own), len(index.terms) - 1)
                    at = np.where(index.terms[at] == own, at, -1)
                    for begin in range(0, len(own), STEPS * index.step):
                        for step, item, score in search(index, at[begin : begin + (STEPS + 1) * index.step]):
                            passage = own[begin + step * index.step : begin + (step + 2) * index.step]
                            question, answer, found = held(index.parts[item], passage)
                            if found:
                                rows.append((ids[number], index.items[item], score, question, answer))
            yield pd.DataFrame(rows, columns=["id", "item", "score", "question_overlap", "answer_overlap"])

    return match


def leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, question_col: str, answer_col: str | None = None) -> DataFrame:
    """(id_col, item_col, score, question_overlap, answer_overlap): each item that a passage of a document holds, with its best passage.

    Every passage of every document is searched; passages overlap by half. Items are indexed in parts of about INDEX_BYTES of
    text with the word frequencies of all items, each part in a pass of its own, so any number fits. Null and empty
    texts hold nothing, items without words are never found. An item without an answer is also held by a passage with OVERLAP of
    all its words, so `answer_overlap` of its last words may be less. Rows without an identifier are searched but can't be named
    and are left out; repeated rows give one result.
    """
    spark = docs.sparkSession
    tune(spark)
    answer = raw(F.col(answer_col)) if answer_col else F.lit(b"")
    table = saved(items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), raw(F.col(question_col)).alias("question"), answer.alias("answer")).distinct())
    counted = saved(table.mapInPandas(_count_items, "term long, size long").groupBy("term").agg(F.count("*").alias("items"), F.sum("size").alias("words")))
    count, size = table.agg(F.count("*"), F.sum(F.length("question") + F.length("answer"))).first()
    kinds = [docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]
    schema = f"id {kinds[0]}, item {kinds[1]}, score double, question_overlap double, answer_overlap double"
    words = counted.agg(F.sum("words")).first()[0] or 0
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), raw(F.col(text_col)).alias("text"))
    found = spark.createDataFrame([], schema)
    parts = -(-(size or 0) // INDEX_BYTES)
    for part in range(parts):
        own = table.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        terms = own.mapInPandas(_count_items, "term long, size long").select("term").distinct()
        frequency = counted.join(terms, "term", "left_semi").select("term", "items").toPandas()
        indexes = build(own.toPandas(), dict(zip(frequency["term"], frequency["items"])), count, words / count)
        found = found.union(texts.mapInPandas(_matcher(spark.sparkContext.broadcast(indexes)), schema))
    best = found.groupBy("id", "item").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.*")
