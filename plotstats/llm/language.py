"""Language of a text: known words first, then ever shorter character n-grams of unseen words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.llm.store import saved, tune

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Longest character n-gram; a word is framed by one mark at each end.
LONGEST = 4
FRAME = "_"
#: Added to every count of a word or n-gram in a language.
SMOOTHING = 0.1
#: Words of the sample that occur less often than this count as unseen.
LEAST_COUNT = 2
#: Scores of words are kept by each worker for so many words at a time.
REMEMBERED = 400_000


@dataclass
class LanguageModel:
    """Per-language log frequencies; bounded by the sample that `fit` draws."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]

    def of_word(self, word: str) -> np.ndarray | None:
        """Log frequencies per language: of the word, else the mean over its longest known n-grams, else None."""
        known = self.words.get(word)
        if known is not None:
            return known
        framed = FRAME + word + FRAME
        for n in range(min(LONGEST, len(framed)), 0, -1):
            found = [g for i in range(len(framed) - n + 1) if (g := self.grams.get(framed[i : i + n])) is not None]
            if found:
                return np.mean(found, axis=0)
        return None


def _ratio(column: str) -> F.Column:
    """A number in [0, 1) drawn from the identifier."""
    return F.pmod(F.xxhash64(F.col(column), F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """About `per_language` rows of each language (all, if it has fewer), drawn by a hash of the identifier: (lang, text)."""
    keys = labelled.select(id_col, lang_col).where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = keys.groupBy(lang_col).agg(F.count("*").alias("_rows"))
    drawn = keys.join(F.broadcast(sizes), lang_col).where(_ratio(id_col) * F.col("_rows") < per_language)
    # per_language rows of each language at most, on average: a bounded number of identifiers
    drawn = saved(drawn.select(F.col(id_col).alias("_id")).distinct())
    return labelled.join(F.broadcast(drawn), F.col(id_col) == F.col("_id"), "left_semi").select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: Counter = Counter()
        for lang, text in zip(frame["lang"], frame["text"]):
            counts.update((lang, w) for w in WORD.findall(text.lower()))
        if counts:
            yield pd.DataFrame({"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": list(counts.values())})


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = 2000) -> LanguageModel:
    """Learns from a sample of labelled rows whose size per language is `per_language`; whole texts of it are counted.

    Rows without identifier, text or language teach nothing. Without any row the model knows no language.
    """
    tune(labelled.sparkSession)
    words = saved(
        sample(labelled, id_col, text_col, lang_col, per_language)
        .where("text is not null").mapInPandas(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    framed = words.select("lang", "n", F.concat(F.lit(FRAME), "word", F.lit(FRAME)).alias("f"))
    spelt = [f"transform(sequence(1, char_length(f) - {n - 1}), i -> substring(f, i, {n}))" for n in range(1, LONGEST + 1)]
    # a framed word has three signs or more
    spelt = [s if n <= 3 else f"if(char_length(f) < {n}, array(), {s})" for n, s in enumerate(spelt, 1)]
    grams = framed.select("lang", "n", F.explode(F.expr(f"concat({', '.join(spelt)})")).alias("gram"))
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    return LanguageModel(
        languages,
        _table(words.toPandas(), "word", languages, LEAST_COUNT, lambda w: 0),
        _table(grams.toPandas(), "gram", languages, 1, len),
    )


def _table(counts: pd.DataFrame, key: str, languages: list[str], least: int, kind) -> dict[str, np.ndarray]:
    """Log frequency of each key in each language, among keys of the same kind."""
    total = counts.groupby(key)["n"].sum()
    counts = counts[counts[key].isin(total[total >= least].index)]
    wide = counts.pivot_table(index=key, columns="lang", values="n", fill_value=0).reindex(columns=languages, fill_value=0)
    out: dict[str, np.ndarray] = {}
    if not len(wide):
        return out
    values = wide.to_numpy(float) + SMOOTHING
    kinds = np.array([kind(k) for k in wide.index])
    for k in np.unique(kinds):
        values[kinds == k] = np.log(values[kinds == k] / values[kinds == k].sum(axis=0))
    out.update(zip(wide.index, values.astype(np.float32)))
    return out


def has_letter(words) -> bool:
    return any(c.isalpha() for w in words for c in w)


class Judge:
    """Judges text after text, keeping the scores of words met before."""

    def __init__(self, model: LanguageModel):
        self.model, self.memory = model, {}
        self.nothing = np.zeros(len(model.languages))

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = Counter(WORD.findall(text.lower())) if text else Counter()
        if not self.model.languages or not has_letter(counts):
            return UNKNOWN, 0.0
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory, rows = self.memory, []
        for word in counts:
            value = memory.get(word)
            if value is None:
                value = self.model.of_word(word)
                value = memory[word] = self.nothing if value is None else value
            rows.append(value)
        total = np.fromiter(counts.values(), float, len(rows)) @ np.stack(rows)
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _classifier(shared):
    def classify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(shared.value)
        for frame in frames:
            answers = [judge(text) for text in frame.pop("text")]
            yield frame.assign(lang_pred=[a[0] for a in answers], score=[a[1] for a in answers])

    return classify


def identify(docs: DataFrame, model: LanguageModel, id_col: str, text_col: str) -> DataFrame:
    """(id_col, lang_pred, score) for every row; score is the share of the likelihood that the best language has.

    A text that is null or has no letter gets `und` and 0, and so does every text when the model knows no language.
    Ties go to the language first by name. Every row is judged alone: repeated rows give repeated results.
    """
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        _classifier(shared), f"id {kind}, lang_pred string, score double"
    ).withColumnRenamed("id", id_col)


def recognised(docs: DataFrame, model: LanguageModel, text_col: str, least: float = 0.5) -> DataFrame:
    """The rows, unchanged, whose text gets a language with a score of `least` or more."""
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            answers = [judge(text) for text in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in answers], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
