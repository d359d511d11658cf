"""Words and shingles of whole texts as 64-bit numbers, a batch of texts at a time.

Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage
return, which is what `bytes.split()` separates; A-Z are lower-cased byte by byte, so text in
other scripts is left alone. Texts travel as UTF-8 bytes and null counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts are hashed in pieces of about so many bytes, so that one long text needs little more memory than itself.
PIECE = 1 << 22
ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64; kept and grown as needed."""
    kept = _powers.__dict__.setdefault("kept", [np.ones(1, np.uint64)] * 2)
    if len(kept[0]) < n:
        size = max(n, 2 * len(kept[0]))
        for i, base in enumerate((ODD, pow(ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept[i] = np.cumprod(steps, dtype=np.uint64)
    return kept[0], kept[1]


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))
_CODES[65:91] = _CODES[97:123]  # A-Z count as a-z


def pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    at = 0
    while len(raw) - at > PIECE:
        cut = at + PIECE
        while cut < len(raw) and not _SPACE[raw[cut]]:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def hash_words(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of a buffer that ends with a blank."""
    data = np.frombuffer(buffer, np.uint8)
    space = _SPACE[data]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & before)
    stops = np.flatnonzero(space & ~before)
    power, inverse = _powers(len(data))
    total = np.cumsum(_CODES[data] * power[: len(data)], dtype=np.uint64)
    upto = np.where(starts > 0, total[np.maximum(starts, 1) - 1], np.uint64(0))
    value = (total[stops - 1] - upto) * inverse[starts] if len(starts) else np.zeros(0, np.uint64)
    return mix(value + (stops - starts).astype(np.uint64) * np.uint64(ODD)), starts, stops


def groups(texts: list[bytes], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of `most` bytes together, or of one text that is longer."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < most):
            size += len(texts[end]) + 1
            end += 1
        yield at, end
        at = end


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, hashes of its words in order), texts in order."""
    for at, end in groups(texts):
        if len(texts[at]) > PIECE:
            yield at, np.concatenate([hash_words(p + b" ")[0] for p in pieces(texts[at])])
            continue
        hashes, starts, _ = hash_words(b" ".join(texts[at:end]) + b" ")
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts[at:end]]))
        for i in range(end - at):
            yield at + i, hashes[bounds[i] : bounds[i + 1]]


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `n` words; of all words together when there are fewer."""
    if not len(words):
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - width + 1 + i]
    return np.unique(mix(total))


def raw(column: Column) -> Column:
    """A text column as bytes for Python workers; null as empty."""
    return F.coalesce(column.cast("binary"), F.lit(b""))


def texts_of(column: pd.Series) -> list[bytes]:
    return [bytes(x) for x in column]


def remainder(identifier: Column, n: int) -> Column:
    """crc32 of the identifier as text, modulo `n`; null for a null identifier."""
    return F.crc32(identifier.cast("string").cast("binary")) % n
