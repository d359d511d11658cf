"""Main text of web pages: what repeats across the pages of a host is removed, what is unique is kept.

The token streams of all pages of a host are taken together, and the suffixes that start at chosen positions are put in order by what
follows up to the next chosen position: a suffix array of the host at sparse positions, dealt out by host and value, so that no
task needs a whole host. Positions are chosen by content, the smallest of the hashes around them, and at the ends of blocks, so
a passage is cut alike wherever it stands. Entries that are equal are counted by page; neighbouring positions of a page whose entries recur
make up the long repeated substrings, of LEAST_WORDS words and more.

A substring is boilerplate if it stands on enough pages of its host: in a page that names its article itself (an article or main
element) on more than half of them and on five, as a passage that some articles share is part of them; in any other page on three tenths of
them and on two. So many pages must also differ in content: pages are told apart by 64 classes of the hash of their whole text, and a
group of copies of one page is one class. A page of which mostly copies would be left over is a copy itself and keeps its text.

Before this, `markup` drops what the markup itself names as menu, header, footer, sidebar, notice, advert, form, script,
style or comments.

Pages are read twice and never shuffled. Per host at most four times the mean number of positions of a page can be boilerplate; these are
sent to all executors up to BROADCAST_BYTES, else joined by host.

Defined results: a null or empty page has the empty text; a page without url or host is only judged by its markup; repeated
rows are pages of their own with the same text each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.llm.markup import article
from plotstats.llm.store import saved, tune
from plotstats.llm.text import mix, word_hashes

#: Words of a repeated substring at least.
LEAST_WORDS = 8
#: A position is chosen if the hash of its two words is the smallest of so many on either side.
REACH = 4
#: Pages that name their article: on more than this share of the host's pages, and on so many.
NAMED_SHARE, NAMED_PAGES = 0.5, 5
#: Other pages.
OTHER_SHARE, OTHER_PAGES = 0.3, 2
#: A page that names its article keeps its text if more than this share of its words would go; another if this share would.
NAMED_MOST, OTHER_MOST = 0.5, 0.9
#: Boilerplate positions are sent to every executor up to so many bytes.
BROADCAST_BYTES = 16 << 20

_STEP = np.uint64(0x9FB21C651E98DF25)


def host_of(url: Column) -> Column:
    """Lower-cased host of a url, null without one."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.when(host != "", host)


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the positions of a page's blocks: first word, end, hash of the words between; and the first word of each block."""
    sizes = np.array([t.count(" ") + 1 for t in texts], np.int64)
    words = next(word_hashes(["\n".join(texts).encode("utf-8", "replace")]))[1]
    first = np.cumsum(sizes) - sizes
    n = len(words)
    following = np.roll(words, -1)
    following[np.append(first[1:], n) - 1] = 0
    pairs = mix(words + following * _STEP)
    # blocks are set apart, so that none has a say in another's positions
    at = np.arange(n) + REACH * np.repeat(np.arange(len(sizes)), sizes)
    apart = np.full(n + REACH * len(sizes), np.iinfo(np.uint64).max, np.uint64)
    apart[at] = pairs
    smallest = apart.copy()
    for shift in range(1, REACH + 1):
        smallest[shift:] = np.minimum(smallest[shift:], apart[:-shift])
        smallest[:-shift] = np.minimum(smallest[:-shift], apart[shift:])
    chosen = pairs == smallest[at]
    chosen[first] = True
    start = np.flatnonzero(chosen)
    end = np.append(start[1:], n)
    place = np.arange(n) - np.repeat(start, end - start)
    return start, end, mix(np.add.reduceat(mix(words + place.astype(np.uint64) * _STEP), start) + (end - start).astype(np.uint64)), first


def _text(value: pa.Scalar) -> str:
    return value.as_py() or ""


def entries(pages: DataFrame) -> DataFrame:
    """host, key, n (pages of the task's batch that have it), classes (bits of their contents); key null stands for the page itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, contents = [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                texts, _ = article(_text(page))
                if not texts:
                    continue
                own = np.unique(cut(texts)[2])
                hosts.append(np.full(len(own), host, np.int64))
                keys.append(own)
                contents.append(np.full(len(own), int(mix(own).sum(dtype=np.uint64)) % 64, np.uint64))
            if not keys:
                continue
            rows = [len(k) for k in keys]
            host, key, content = np.concatenate(hosts), np.concatenate(keys).view(np.int64), np.concatenate(contents)
            order = np.lexsort((key, host))
            host, key, bits = host[order], key[order], np.uint64(1) << content[order]
            new = np.append(True, (host[1:] != host[:-1]) | (key[1:] != key[:-1]))
            at = np.flatnonzero(new)
            yield _entries(host[at], pa.array(key[at]), np.diff(np.append(at, len(key))), np.bitwise_or.reduceat(bits, at))
            # one entry for each page
            page_bits = np.uint64(1) << np.array([c[0] for c in contents], np.uint64)
            yield _entries(np.array([h[0] for h in hosts]), pa.nulls(len(rows), pa.int64()), np.ones(len(rows), np.int64), page_bits)

    return pages.mapInArrow(run, "host long, key long, n long, classes long")


def _entries(host: np.ndarray, key: pa.Array, n: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(host), key, pa.array(n), pa.array(bits.view(np.int64))], ["host", "key", "n", "classes"])


def repeated(pages: DataFrame) -> DataFrame:
    """host, common, frequent: keys on most pages of the host, and those on some. `pages`: host (hash), html."""
    counted = saved(
        entries(pages).groupBy("host", "key").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("classes")).alias("classes")).where("n > 1 or key is null")
    )
    whole = counted.where("key is null").select("host", F.col("n").alias("pages"), F.col("classes").alias("contents"))
    both = counted.where("key is not null").join(whole, "host")

    def on(share: float, pages_: int) -> Column:
        return (F.col("n") >= pages_) & (F.col("classes") >= F.least(F.lit(pages_), F.lit(32))) & (F.col("n") >= F.col("pages") * share) & (F.col("classes") >= F.col("contents") * share)

    common = on(NAMED_SHARE, NAMED_PAGES) & (F.col("n") > F.col("pages") * NAMED_SHARE)
    found = both.where(on(OTHER_SHARE, OTHER_PAGES)).select("host", "key", common.alias("common"))
    # bounded by the mean number of positions of a page of the host, four times
    return found.groupBy("host").agg(F.collect_list(F.when(F.col("common"), F.col("key"))).alias("common"), F.collect_list("key").alias("frequent"))


def kept(texts: list[str], named: bool, common: np.ndarray, frequent: np.ndarray) -> str:
    """The blocks without what repeats, one a line."""
    if not len(frequent) or not texts:
        return "\n".join(texts)
    start, end, key, first = cut(texts)
    total = int(end[-1])
    for own, most in ((common, NAMED_MOST),) if named else ((frequent, OTHER_MOST), (common, OTHER_MOST)):
        hit = np.isin(key.view(np.int64), own)
        # neighbouring positions that recur are one substring
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
        runs = [(int(start[a]), int(end[b - 1])) for a, b in zip(edges[::2], edges[1::2], strict=True) if end[b - 1] - start[a] >= LEAST_WORDS]
        gone = sum(b - a for a, b in runs)
        if not gone:
            continue
        if gone >= most * total:
            continue
        covered = np.zeros(total, bool)
        for a, b in runs:
            covered[a:b] = True
        out = []
        for at, text in zip(first, texts, strict=True):
            words = text.split(" ")
            own_covered = covered[at : at + len(words)]
            if not own_covered.any():
                out.append(text)
            elif not own_covered.all():
                out.append(" ".join(w for w, c in zip(words, own_covered, strict=True) if not c))
        return "\n".join(out)
    return "\n".join(texts)


def main_text(table: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """(id_column, url_column, text, n_chars) of every row."""
    spark = table.sparkSession
    tune(spark)
    host = host_of(F.col(url_column))
    pages = table.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.when(host.isNotNull(), F.xxhash64(host)).alias("host"), F.col(html_column).alias("html"))
    keys = saved(repeated(pages.where("host is not null").select("host", "html")))
    size = keys.agg(F.sum(F.size("common") + F.size("frequent") + 4)).first()[0] or 0
    joined = pages.join(F.broadcast(keys) if 8 * size <= BROADCAST_BYTES else keys, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, common, frequent in zip(*(batch.column(c) for c in ("html", "common", "frequent")), strict=True):
                out.append(kept(*article(_text(page)), *(np.array(x.as_py() or [], np.int64) for x in (common, frequent))))
            text = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), text, pa.array([len(t) for t in out], pa.int64())], ["id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("id", "url"))
    done = joined.select("id", "url", "html", "common", "frequent").mapInArrow(run, f"{kinds}, text string, n_chars long")
    return done.select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text", "n_chars")
