"""Quality rules: compression bands over whole texts and chunks, beside counts of words, signs and repetitions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotstats.llm.store import tune
from plotstats.llm.text import raw

SIGNS = re.compile(rb"[#*$%&|<>]")
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]")


@dataclass(frozen=True)
class Bands:
    """Limits on length / compressed length. `whole` has (bytes from, least, most) rows, in rising order; texts below the
    first are not judged. A text also falls when more than `chunk_share` of its whole chunks of `chunk` bytes leave
    `chunk_limits`. The whole-text limits widen with the length, because a longer text finds more to copy."""

    level: int = 3
    whole: tuple = ((200, 0.95, 2.6), (500, 1.15, 3.2), (1_000, 1.3, 3.8), (2_000, 1.4, 4.5), (4_000, 1.5, 5.0), (16_000, 1.5, 6.0), (64_000, 1.5, 7.0))
    chunk: int = 2_048
    chunk_limits: tuple = field(default=(1.3, 5.0))
    chunk_share: float = 0.3


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a run of three words found twice or more in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # pairs get numbers of their own, so that a third word fits beside them for any vocabulary
    _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, at, count = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[at] > 1
    inside = np.zeros(len(words), bool)
    for step in range(3):
        inside[step : step + len(twice)] |= twice
    return int(inside.sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, signs, repeated lines, words in repeated runs of three)."""
    words = text.split()
    joined = np.frombuffer(b"".join(words), np.uint8)
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return (
        len(words), int(np.count_nonzero((joined & 0xC0) != 0x80)), len(SIGNS.findall(text)), len(lines) - len(set(lines)), repeated_words(words),
    )


def ratios(text: bytes, bands: Bands, press: zstandard.ZstdCompressor) -> tuple[float, float]:
    """(ratio of the whole text, share of its whole chunks outside the chunk limits)."""
    whole = len(text) / max(1, len(press.compress(text)))
    low, high = bands.chunk_limits
    chunks = [len(press.compress(text[i : i + bands.chunk])) for i in range(0, len(text) - bands.chunk + 1, bands.chunk)]
    bad = sum(not low <= bands.chunk / n <= high for n in chunks)
    return whole, bad / len(chunks) if chunks else 0.0


def within(size: int, whole: float, bad_chunks: float, bands: Bands) -> bool:
    limits = [(least, most) for begin, least, most in bands.whole if size >= begin]
    return (not limits or limits[-1][0] <= whole <= limits[-1][1]) and bad_chunks <= bands.chunk_share


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _judge(bands: Bands):
    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=bands.level)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                text = bytes(text)
                counts = measures(text)
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                whole, bad = ratios(text, bands, press)
                rows.append((*counts, failed, not failed and within(len(text), whole, bad, bands), whole, bad))
            out = pd.DataFrame(rows, columns=[*COLUMNS, "base_failed", "kept", "ratio", "bad_chunk_share"])
            out.insert(0, "id", frame["id"].array)
            yield out

    return judge


def judge(docs: DataFrame, id_col: str, text_col: str, bands: Bands = Bands()) -> DataFrame:
    """(id_col, the five counts, base_failed, kept, ratio, bad_chunk_share) for every row.

    A null text has no words and fails the base rule, as does an empty one. Texts are taken whole; rows are judged one by
    one, so repeated rows give repeated results. Words and lines are compared byte by byte.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS) + ", base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
    return docs.select(F.col(id_col).alias("id"), raw(F.col(text_col)).alias("text")).mapInPandas(_judge(bands), schema).withColumnRenamed("id", id_col)
