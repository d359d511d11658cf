"""Ranked search and centroid clustering against plain versions, with nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from plotstats.llm import centroids, strata

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, k):
    sized = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(sized), sum(n for *_, n in sized)
    df = Counter(w for _, c, _ in sized for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, counts, n in sized:
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * counts[w] // (1000 * counts[w] + 8 * m)) for w in terms(text) if w in counts)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return out


def _rows(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, score string, rank string, id string")


def test_ranked_search(spark, documents, items, prose):
    draw = random.Random(5)
    words = prose(1, 60)
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 120))) for _ in range(400)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(1000 + i, texts[7], "en", None) for i in range(30)]  # a group of copies: equal scores
    rows += [(2000, None, None, None), (2001, "", "", ""), (2002, " .,; \x00\t", "en", "s"), (None, texts[7], "en", "s"), rows[3], rows[3]]
    rows += [(2003, " ".join(draw.choices(words, k=40000)), "en", "s"), (2004, "日本語 ÄÖ-Über x9", "en", "s"), (2005, words[0].upper() + "_" + words[1], "en", "s")]
    asked = [(i, " ".join(draw.choices(words, k=draw.randint(1, 12))), "x", "x", "x") for i in range(15)]
    asked += [(20, texts[7], "x", "x", "x"), (21, None, "x", "x", "x"), (22, "", "x", "x", "x"), (23, "nowhere", "x", "x", "x"), (24, "ÄÖ 日本語 X9", "x", "x", "x"), (None, words[2], "x", "x", "x"), asked[0], asked[0]]
    want = Counter(ranked([r[:2] for r in rows], [a[:2] for a in asked], 10))
    found = strata.search(documents(rows), items(asked), "doc_id", "text", "item_id", "text")
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert _rows(found) == want


def test_ranked_search_in_many_blocks(monkeypatch, documents, items, prose):
    monkeypatch.setattr(strata, "ITEM_BYTES", 200)
    monkeypatch.setattr(strata, "TASK_POSTINGS", 300)
    draw = random.Random(6)
    words = prose(2, 40)
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60))), "en", "s") for i in range(200)]
    asked = [(i, " ".join(draw.choices(words, k=5)), "x", "x", "x") for i in range(25)]
    found = strata.search(documents(rows), items(asked), "doc_id", "text", "item_id", "text", k=3)
    assert _rows(found) == Counter(ranked([r[:2] for r in rows], [a[:2] for a in asked], 3))


def test_strata_are_left_out_without_loss(monkeypatch):
    monkeypatch.setattr(strata, "FIRST_VISIT", 1)
    draw = np.random.default_rng(3)
    import pyarrow as pa

    n = 600
    m = draw.integers(25, 90, n)
    lists = [np.sort(draw.choice(30, draw.integers(1, 12), replace=False)) for _ in range(n)]
    sizes = np.array([len(x) for x in lists])
    flat, tfs = np.concatenate(lists), draw.integers(1, 40, sizes.sum())
    block = strata.Block(pa.array(draw.permutation(n)), m, sizes, flat, tfs)
    own, weights = np.array([1, 4, 9, 17]), np.array([900, 40, 7000, 3])
    docs, scores = block.search(own, weights, 10, 0)
    of = np.repeat(np.arange(n), sizes)
    total = np.zeros(n, np.int64)
    for t, w in zip(own, weights, strict=True):
        use = flat == t
        np.add.at(total, of[use], w * ((10**9 * tfs[use]) // (1000 * tfs[use] + 8 * m[of[use]])))
    assert sorted(scores, reverse=True) == sorted(total, reverse=True)[:10] and list(scores) == sorted(scores, reverse=True)
    assert block.search(own, weights, 10, int(scores[0]) + 1)[0].size == 0


def test_ranked_search_without_rows(documents, items):
    assert strata.search(documents([]), items([(1, "a", "x", "x", "x")]), "doc_id", "text", "item_id", "text").count() == 0
    assert strata.search(documents([(1, "a", "en", "s")]), items([]), "doc_id", "text", "item_id", "text").count() == 0
    assert strata.search(documents([(1, None, "en", "s")]), items([(1, "a", "x", "x", "x")]), "doc_id", "text", "item_id", "text").count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType()), T.StructField("k", T.StringType()), T.StructField("id", T.StringType()), T.StructField("vector", T.StringType())])


def clustered(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    centers = [v for *_, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centers]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        groups = defaultdict(list)
        for (own, _), (_, v) in zip(assign(), kept, strict=True):
            groups[own].append(v)
        for own, members in groups.items():
            centers[own] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    last = assign()
    inertia = Counter()
    for own, d in last:
        inertia[own] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((i, own, d, inertia[own], sum(inertia.values()), digests[own]) for (own, d), (i, _) in zip(last, kept, strict=True))


@pytest.mark.parametrize("spread", [0.2, 300.0])
def test_clusters(spark, spread):
    draw = random.Random(int(spread))
    rows = [(i, [draw.gauss(0, spread) for _ in range(64)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [rows[5], rows[5]]  # copies tie with each other and as centroids
    rows += [(300, None), (301, [1.0] * 63), (302, [None] + [1.0] * 63), (303, [math.nan] * 64), (304, [math.inf] + [0.0] * 63), (305, []), (None, rows[0][1]), (306, [0.0] * 64)]
    table = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS)
    found = centroids.clusters(table, "vec_id", "embedding")
    assert Counter(tuple(r) for r in found.collect()) == clustered(rows, 40, 5)


def test_clusters_of_few_and_large_vectors(spark):
    few = [(i, [float(i * j) for j in range(64)]) for i in range(3)]
    large = [(i, [float(x) * 1e12 for x in np.random.default_rng(i).normal(size=64)]) for i in range(60)]
    for rows in (few, large):
        table = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS)
        found = centroids.clusters(table, "vec_id", "embedding").select("vec_id", "cluster", "centroid_sha256")
        assert Counter(tuple(r) for r in found.collect()) == Counter((r[0], r[1], r[5]) for r in clustered(rows, 40, 5).elements())
    assert centroids.clusters(spark.createDataFrame([], VECTORS), "vec_id", "embedding").count() == 0
    assert centroids.clusters(spark.createDataFrame([(1, None, "x", "x", "x", "x")], VECTORS), "vec_id", "embedding").count() == 0


def test_search_of_nearest_centroid_with_ties():
    draw = np.random.default_rng(1)
    x, c = draw.integers(-4, 4, (500, 64)), draw.integers(-4, 4, (40, 64))
    c[9] = c[4]
    c[20:25] = 0
    own, distance = centroids.nearest(x, c)
    plain = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (own == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert (centroids.SIGNS @ centroids.SIGNS.T == 64 * np.eye(64)).all()
