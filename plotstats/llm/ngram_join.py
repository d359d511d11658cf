"""Documents linked by the Jaccard similarity of their word n-grams: a blocked sparse product of the incidence matrix.

The matrix has a row per document and a column per n-gram hash. Its columns are dealt to blocks, and the number of blocks
comes from the sizes of the rows: two rows similar enough differ in at most D = (n1 + n2) * (100 - t) / (100 + t) columns,
so of B blocks they agree on B - D. Each row leaves out its most frequent blocks, one less than it must share, and rows
that agree on one of the others enter the product; their overlap is accumulated over all columns, and pairs below the
bound that follows from their sizes are discarded. Passages that many documents share, and copies edited too much, do not
bring rows together: their common blocks are the ones left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotstats.llm.graph import components
from plotstats.llm.store import handy, saved, tune
from plotstats.llm.text import mix, raw, shingle_set, texts_of, word_hashes

#: Upper ends of the size bands, each about half as large again as the one before.
FIRST_BAND = 8
#: Blocks beyond the least number, in hundredths of it. Rows agree on more blocks the more there are, and may leave out more.
SPARE_PERCENT = 40
#: The lowest bit of a key tells those of single columns from those of blocks.
SINGLE = np.uint64(1)
#: Blocks of a row, the smallest, by which pairs that met before are known.
LOW = 16
#: Parts of the sketch of a row, of 64 bits each.
SKETCH = [f"s{i}" for i in range(4)]


def bands(size: int) -> int:
    """The least upper end of a band that is `size` or more."""
    top = FIRST_BAND
    while top < size:
        top += top // 2
    return top


def differing(x: int, y: int, percent: int) -> int:
    """Columns in which similar rows of these sizes differ at most."""
    return (x + y) * (100 - percent) // (100 + percent)


def blocks_of(top: int, percent: int) -> int:
    """Blocks of the band of sizes up to `top`."""
    least = differing(top, top, percent) + 1
    return least + least * SPARE_PERCENT // 100


def block_keys(columns: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a row, and for each how many of the keys of its kind the row may leave out, times two and plus the kind.

    A row takes part in its own band and, if a larger similar row can be in the next one, in that too; these are the kinds.
    The columns of a block are a range of hashes. Of the blocks with columns at most D differ, so similar rows agree on the
    rest, `agree` or more. If all rows order keys alike, each can leave out its last `agree - 1` keys of a kind: the first
    common key is followed by so many others in both. Rows with too many empty blocks for that get the keys of their first
    n - ceil(n * percent / 100) + 1 columns, which similar rows share, and leave out nothing.
    """
    n = len(columns)
    if not n:
        return columns, np.zeros(0, np.int64)
    top = bands(n)
    tops = [top] + ([top + top // 2] if n * 100 // percent > top else [])
    keys, spared = [], []
    mixed = mix(columns)
    for kind, top in enumerate(tops):
        block = ((columns >> np.uint64(32)) * np.uint64(blocks_of(top, percent))) >> np.uint64(32)
        first = np.flatnonzero(np.diff(block, prepend=np.uint64(1 << 63)) != 0)
        salt = mix(block[first] + np.uint64(top << 24))
        keys.append(mix(np.add.reduceat(mixed, first) + salt) & ~SINGLE)
        agree = len(first) - differing(n, min(top, n * 100 // percent), percent)
        if agree < 1:
            keys.append(mix(mixed[: n - -(-n * percent // 100) + 1] ^ np.uint64(top)) | SINGLE)
        spared.append(np.full(sum(map(len, keys)) - sum(map(len, spared)), 2 * max(agree - 1, 0) + kind))
    return np.concatenate(keys), np.concatenate(spared)


def node_of(columns: np.ndarray) -> int:
    """A number for a set; equal sets have equal numbers."""
    total = mix(columns).sum(dtype=np.uint64) + np.uint64(len(columns))
    return int(mix(np.array([total]))[0].view(np.int64))


def sketch_of(columns: np.ndarray) -> np.ndarray:
    """Bits that say whether the number of columns dealt to them is odd; rows differ in as many columns as bits at least."""
    odd = np.bincount((columns % np.uint64(64 * len(SKETCH))).astype(np.int64), minlength=64 * len(SKETCH)) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _profiles(n: int):
    def profile(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(w, n) for _, w in word_hashes(texts_of(frame["text"]))]
            sketches = np.array([sketch_of(s) for s in sets]).reshape(len(sets), len(SKETCH))
            yield pd.DataFrame({"id": frame["id"], "n": [len(s) for s in sets], "node": [node_of(s) for s in sets]} | dict(zip(SKETCH, sketches.T)))

    return profile


def _keys(n: int, percent: int):
    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen, own, spared, node = set(), [], [], []
            for _, words in word_hashes(texts_of(frame["text"])):
                columns = shingle_set(words, n)
                # rows too small to differ can only be equal
                if len(columns) * (100 - percent) >= percent and (number := node_of(columns)) not in seen:
                    seen.add(number)
                    own.append((found := block_keys(columns, percent))[0])
                    spared.append(found[1])
                    node.append(np.full(len(own[-1]), number))
            if own:
                yield pd.DataFrame({"key": np.concatenate(own).view(np.int64), "node": np.concatenate(node), "spared": np.concatenate(spared)})

    return keys


def _rows(n: int):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(w, n) for _, w in word_hashes(texts_of(frame["text"]))]
            yield pd.DataFrame({"node": [node_of(s) for s in sets], "columns": [s.tobytes() for s in sets]})

    return rows


def _product(percent: int):
    """Overlap of each pair of rows, and the pairs that reach the bound."""

    def product(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = np.zeros(len(frame), bool)
            for i, (x, y) in enumerate(zip(frame["x"], frame["y"])):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                overlap = int(np.count_nonzero(y[at] == x))
                keep[i] = (100 + percent) * overlap >= percent * (len(x) + len(y))
            yield frame.loc[keep, ["a", "b"]]

    return product


class NgramJoin:
    """The join over one table of documents; `percent` is the similarity in hundredths, `n` the words of an n-gram."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int):
        tune(docs.sparkSession)
        self.n, self.percent = n, percent
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.docs = docs.select(F.col(id_col).alias("id"), raw(F.col(text_col)).alias("text"))
        self.profile = saved(self.docs.mapInPandas(_profiles(n), ", ".join([f"id {self.kind}", *(f"{c} long" for c in ["n", "node", *SKETCH])])))
        named = self.profile.where("n > 0 and id is not null")
        #: One row of the matrix per distinct set, named by its smallest document.
        self.sets = saved(named.groupBy("node").agg(F.min("id").alias("name"), *(F.max(c).alias(c) for c in ["n", *SKETCH])))

    def links(self) -> DataFrame:
        """(a, b) between sets, enough of them to connect all that are connected, each of them verified.

        Each set is first compared with one set only: of the heads of its blocks, the one it shares most blocks with. What
        this leaves in different components of a block is then compared pair by pair, so no link between different
        components is lost and the pairs within a group of copies are never listed.
        """
        members = self._members()
        stars = members.where("node != top").groupBy(F.col("top").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("blocks"), F.max("n").alias("nb"))
        stars = stars.groupBy("b").agg(F.max(F.struct("blocks", "a", "nb")).alias("best")).select("b", "best.*")
        stars = self._verified(stars.join(self.sets.select(F.col("node").alias("a"), F.col("n").alias("na")), "a"))
        return stars.union(self._verified(self._across(members, saved(components(stars)))))

    def _members(self) -> DataFrame:
        """(key, node, n, top): the blocks that sets keep, of those that several have, and the head of each block.

        Sets leave out their most frequent blocks, as many as they may: similar sets still have one in common, and parts that
        many documents share bring only those together that consist of them. The head of a block is the set whose blocks are the most
        frequent in all. In a group of edited copies it is one near the original, from which the others are half as
        far as from each other.
        """
        keys = self.docs.mapInPandas(_keys(self.n, self.percent), "key long, node long, spared long")
        shared = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
        several = saved(keys.join(shared, "key").distinct())
        last = Window.partitionBy("node", F.col("spared") % 2).orderBy(F.desc("rows"), F.desc("key"))
        kept = several.withColumn("place", F.row_number().over(last)).where("place > shiftright(spared, 1)")
        weight = several.groupBy("node").agg(F.sum("rows").alias("weight"))
        kept = kept.select("key", "node").distinct().join(weight, "node").join(self.sets.select("node", "n"), "node")
        kept = saved(kept)
        heads = kept.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("head"), F.count("*").alias("rows")).where("rows > 1")
        return saved(kept.join(heads, "key").select("key", "node", "n", F.col("head.node").alias("top")))

    def _across(self, members: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs that agree on a block from different components. Of each block, only members outside the component of its
        head are paired with all others, since two members of one component need no link; and of these pairs, only those whose
        sketches differ in no more bits than similar rows of their sizes do in columns. A pair that agrees on many blocks
        leaves the join at few of them: not at a block if its members have a smaller one in common among the first of each. The
        smallest block that they share is never left out."""
        labelled = members.join(groups, "node", "left").select("key", "node", "top", "n", F.coalesce("component", "node").alias("label"))
        labelled = saved(labelled)
        ends = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max(F.when(F.col("node") == F.col("top"), F.col("label"))).alias("head"))
        several = saved(labelled.join(ends.where("least != most").select("key", "head"), "key"))
        # one list of a row's own blocks, as long as its text at most
        low = several.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("key")), 1, LOW).alias("low"))
        several = saved(several.join(low, "node").join(self.sets.select("node", *SKETCH), "node"))
        own = ["low", *SKETCH]
        minor = several.where("label != head").select("key", F.col("node").alias("x"), F.col("label").alias("lx"), F.col("n").alias("nx"), "head", *(F.col(c).alias(f"x{c}") for c in own))
        every = several.select(F.col("key").alias("_key"), F.col("node").alias("y"), F.col("label").alias("ly"), F.col("n").alias("ny"), *(F.col(c).alias(f"y{c}") for c in own))
        # a pair of two minor members comes once, from its smaller side
        once = (F.col("ly") == F.col("head")) | (F.col("x") < F.col("y"))
        near = F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * self.percent
        apart = sum((F.bit_count(F.col(f"x{c}").bitwiseXOR(F.col(f"y{c}"))) for c in SKETCH), F.lit(0))
        few = apart * (100 + self.percent) <= (F.col("nx") + F.col("ny")) * (100 - self.percent)
        early = ~F.exists("xlow", lambda k: (k < F.col("key")) & F.array_contains("ylow", k))
        pairs = minor.join(every, (F.col("key") == F.col("_key")) & (F.col("lx") != F.col("ly")) & once & near & few & early)
        first = F.col("x") < F.col("y")
        ends = [F.when(first, F.col(p)).otherwise(F.col(q)).alias(name) for p, q, name in (("x", "y", "a"), ("y", "x", "b"), ("nx", "ny", "na"), ("ny", "nx", "nb"))]
        return pairs.select(*ends).distinct()

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) whose overlap reaches the bound, of `pairs` with their sizes."""
        near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent
        pairs = saved(pairs.where(near).select("a", "b"))
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        names = handy(saved(self.sets.join(nodes, "node", "left_semi").select(F.col("name").alias("id"))))
        rows = self.docs.join(names, "id", "left_semi").mapInPandas(_rows(self.n), "node long, columns binary").dropDuplicates(["node"])
        both = pairs.join(rows.toDF("a", "x"), "a").join(rows.toDF("b", "y"), "b")
        return saved(both.mapInPandas(_product(self.percent), "a long, b long"))

    def groups(self) -> DataFrame:
        """(id, n, component) of every row. Rows without words get their own identifier, rows without identifier null.

        Rows with one identifier are one document, which has the links of all its texts."""
        links, names = self.links(), self.sets.select("node", "name")
        edges = links.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        copies = self.profile.where("n > 0 and id is not null").join(names, "node").select(F.col("id").alias("a"), F.col("name").alias("b"))
        group = components(edges.union(copies))
        return self.profile.join(group, self.profile["id"] == group["node"], "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def near_copies(docs: DataFrame, id_col: str, text_col: str, n: int = 5, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row.

    Documents whose sets of n-word shingles have 100 * intersection >= percent * union are linked; component_id is the
    smallest identifier reachable by links. A text with fewer than n words is one shingle of them all; null texts and texts
    without words have no shingle and no link, so they are a component of their own. A null identifier has no component.
    """
    out = NgramJoin(docs, id_col, text_col, n, percent).groups()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
