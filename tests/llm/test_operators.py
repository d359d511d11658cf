"""Each operator against a plain version of itself, with nulls, empty texts, repeated rows, ties and empty tables."""

import math
import os
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plotstats.llm import bands, decontaminate, graph, language, licences, lines, mixing, ngram_join, quality, redirects, weighting
from plotstats.llm.queries import RULES
from plotstats.llm.store import saved
from plotstats.session import shared_dir

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def groups_of(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_of_a_chain_a_star_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(100, 101), (7, 7), (200, 300), (300, 200)]
    edges = spark.createDataFrame(links + [(None, 5), (6, None)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    want = groups_of({x for p in links for x in p}, links)
    assert found == {k: v for k, v in want.items()}
    assert graph.components(edges.where("a < 0")).count() == 0


# 1


def shingles(text, n):
    words = SPACE.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join(documents, prose, n, percent):
    rows = []
    for group in range(6):
        base = prose(group, 40 + 60 * group)
        for copy in range(14):
            words = list(base)
            for i in range(copy % 5):
                words[(copy * 13 + i * 17) % len(words)] = f"x{copy}y{i}"
            rows.append((len(rows), " ".join(words if copy != 13 else base), "en", "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, " \n\t", "en", "s"), (903, "One two", "en", "s"), (904, "one\nTWO", "en", "s")]
    rows += [(905, " ".join(prose(99, 30000)), "en", "s"), (906, " ".join(prose(99, 30000)[:-40]), "en", "s"), rows[0], rows[0], (None, rows[0][1], "en", "s")]
    sets = {d: shingles(t, n) for d, t, _, _ in rows if d is not None}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = groups_of(ids, links)
    out = ngram_join.near_copies(documents(rows), "doc_id", "text", n, percent).collect()
    assert len(out) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out} == {(d, len(sets[d]), want[d]) for d in ids} | {(None, len(sets[0]), None)}


def test_similar_rows_share_a_key_that_both_keep():
    """Whatever the frequencies are: half of the keys count as frequent, ordered at random."""
    draw = np.random.default_rng(3)

    def kept(columns, percent, order):
        keys, spared = ngram_join.block_keys(columns, percent)
        out = set()
        for kind in set(spared % 2):
            mine = sorted(keys[spared % 2 == kind], key=lambda key: (order(key), key), reverse=True)
            out |= set(mine[int(spared[spared % 2 == kind][0] // 2) :])
        return out

    met = 0
    for percent in (80, 85):
        for _ in range(400):
            a = np.unique(draw.integers(0, 1 << 63, int(draw.integers(1, 300))).astype(np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([draw.permutation(a)[int(draw.integers(0, len(a) // 5 + 1)) :], draw.integers(0, 1 << 63, int(draw.integers(0, len(a) // 6 + 1))).astype(np.uint64)]))
            if len(a) * (100 - percent) < percent or 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)) or np.array_equal(a, b):
                continue
            salt = np.uint64(draw.integers(0, 1 << 62))
            order = lambda key: max(int(ngram_join.mix(np.array([key ^ salt]))[0] >> np.uint64(32)) - (1 << 31), 0)
            assert kept(a, percent, order) & kept(b, percent, order)
            bits = int(np.bitwise_count((ngram_join.sketch_of(a) ^ ngram_join.sketch_of(b)).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(a, b)) <= ngram_join.differing(len(a), len(b), percent)
            met += 1
    assert met > 100


def test_ngram_join_of_nothing(documents):
    assert ngram_join.near_copies(documents([]), "doc_id", "text").collect() == []


# 2


def test_quality_model_learns_and_repeats(spark, documents, prose):
    rows = [(i, " ".join(prose(i, 60)) if i % 2 else " ### ".join(w.upper() for w in prose(i, 60)), "en", "s") for i in range(160)]
    rows += [(500, None, "en", "s"), (501, "", "en", "s"), (None, "bare", "en", "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(130, None)], "doc_id long, quality int")
    docs = documents(rows)
    scores = []
    for _ in range(2):
        model = quality.fit(docs, labels, "doc_id", "text", "quality")
        scores.append({r["doc_id"]: r["score"] for r in quality.score(docs, model, "doc_id", "text").collect()})
    assert scores[0] == scores[1] and len(scores[0]) == len(rows)
    assert all(0 <= s <= 1 for s in scores[0].values())
    right = [(scores[0][i] > 0.5) == bool(i % 2) for i in range(120, 160)]
    assert np.mean(right) > 0.9
    none = quality.fit(docs, labels.where("doc_id < 0"), "doc_id", "text", "quality")
    assert {r["score"] for r in quality.score(docs, none, "doc_id", "text").collect()} == {0.5}


# 3


def test_lm_base_and_both_ways_of_joining_words(documents, prose):
    rows = [(i, " ".join(prose(i % 30, 50)).title(), "en", "s") for i in range(80)] + [(900, None, "en", "s"), (901, "  ", "en", "s"), (902, "é Ü X", "en", "s")]
    rows += [rows[0]]
    docs = documents(rows)
    learn = F.col("doc_id") % 7 != 2
    counts = Counter()
    for d, t, _, _ in rows:
        if d % 7 != 2:
            counts.update([*SPACE.findall("".join(c.lower() if c.isascii() else c for c in t or "")), None])
    total, distinct = sum(counts.values()), len(counts)
    sent = weighting.score(docs, learn, "doc_id", "text").collect()
    joined = weighting.score(docs, learn, "doc_id", "text", vocabulary_rows=0).collect()
    assert len(sent) == len(joined) == len(rows)
    other = {r["doc_id"]: r for r in joined}
    texts = {d: t for d, t, _, _ in rows}
    for r in sent:
        words = [*SPACE.findall("".join(c.lower() if c.isascii() else c for c in texts[r["doc_id"]] or "")), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
        for c in ("n_tokens", "n_known", "train_tokens", "score"):
            assert r[c] == other[r["doc_id"]][c]
        assert r["base_score"] == pytest.approx(other[r["doc_id"]]["base_score"], rel=1e-9)


def test_tree_probabilities_sum_to_one(documents, prose):
    docs = documents([(i, " ".join(prose(i, 40)), "en", "s") for i in range(40)])
    tree = weighting.fit_tree(weighting.word_counts(docs.select(F.col("text").cast("binary").alias("text"))))
    assert np.allclose((10.0 ** tree.classes.astype(float)).sum(axis=1), 1, atol=1e-4)
    cells = 10.0 ** tree.bytes.astype(float).reshape(-1, 256)
    assert np.allclose(cells.sum(axis=1), 1, atol=1e-3)
    logs = weighting.word_logs(weighting.spell_list([b"banban", b"zzzzzzzz"]), tree)
    assert logs[0] > logs[1]


def test_lm_without_training_rows(documents):
    out = weighting.score(documents([(2, "ab c", "en", "s")]), F.lit(False), "doc_id", "text").collect()
    assert (out[0]["n_tokens"], out[0]["n_known"], out[0]["train_tokens"]) == (3, 0, 0)
    assert out[0]["score"] < 0 and weighting.score(documents([]), F.lit(True), "doc_id", "text").collect() == []


def plain_context_tree(taught, text):
    """log10 probability of a text by a tree of all contexts of 0 to CONTEXT bytes, node by node and bit by bit."""
    pad = b"\xff" * weighting.CONTEXT
    spell = lambda t: b"".join(w + b" " for w in t.encode().lower().split()) + b"\xff"
    steps = lambda t: [((pad + t)[i : i + weighting.CONTEXT], b) for i, b in enumerate(t)]
    count = Counter((before[weighting.CONTEXT - d :], 1 << k | b >> 8 - k) for t in taught for before, b in steps(spell(t)) for d in range(weighting.CONTEXT + 1) for k in range(9))
    children, heads = defaultdict(set), defaultdict(set)
    for context, head in count:
        heads[context].add(head)
        if context:
            children[context[1:]].add(context)

    def estimate(context):
        out = 0.0
        for head in heads[context]:
            if head < 256:
                a, b = count[context, 2 * head], count[context, 2 * head + 1]
                out += math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        return out

    kept = {}

    def weighted(context):
        if context not in kept:
            own = estimate(context)
            below = sum(weighted(c) for c in children[context])
            both = own if len(context) == weighting.CONTEXT else max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)
            kept[context] = both, math.exp(own - both) / (1 if len(context) == weighting.CONTEXT else 2)
        return kept[context][0]

    def p(before, b, d=0):
        context = before[weighting.CONTEXT - d :]
        own = math.prod((count[context, 1 << k + 1 | b >> 7 - k] + 0.5) / (count[context, 1 << k | b >> 8 - k] + 1) for k in range(8))
        weighted(context)
        share = kept[context][1]
        return own if d == weighting.CONTEXT else share * own + (1 - share) * p(before, b, d + 1)

    return sum(math.log10(p(before, b)) for before, b in steps(spell(text)))


def test_scores_are_those_of_a_plain_context_tree(monkeypatch, documents, prose):
    """Real bytes, contexts across blanks, and every context has a node, however rare."""
    monkeypatch.setattr(weighting, "BATCH_BYTES", 1500)
    monkeypatch.setattr(weighting, "WINDOW", 100)
    texts = [" ".join(prose(i % 9, 30)) for i in range(12)] + ["é Ü 長い行 X", "", "a b", "b a", "a  B\n", "b a b a"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(18, None, "en", "s"), (None, "b a", "en", "s")]
    learn = F.col("doc_id") % 3 != 1
    taught = [t or "" for d, t, _, _ in rows if d is not None and d % 3 != 1]
    out = weighting.score(documents(rows), learn, "doc_id", "text").collect()
    assert len(out) == len(rows)
    want = {d: plain_context_tree(taught, t or "") for d, t, _, _ in rows}
    for r in out:
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-5)


def test_the_order_of_words_counts_and_rare_contexts_are_kept(documents, prose):
    rows = [(i, " ".join(prose(i, 60)), "en", "s") for i in range(300)] + [(1000, "qzx jvw qzx jvw", "en", "s")]
    asked = [(2000, "qzx jvw", "en", "s"), (2001, "jvw qzx", "en", "s"), (2002, "qjx zvw", "en", "s")]
    out = {r["doc_id"]: r["score"] for r in weighting.score(documents(rows + asked), F.col("doc_id") < 2000, "doc_id", "text").collect()}
    assert out[2000] > out[2001] > out[2002]


def test_keys_of_a_window_are_looked_up_in_about_their_order(documents, prose):
    """The places of a window's keys were sorted by the whole keys, which took a third of the time of scoring."""
    keys = np.concatenate([keys for _, keys in weighting.windows([" ".join(prose(1, 4000)).encode(), "ÿé 長い".encode() * 50, b""])])
    order = weighting.roughly_sorted(keys)
    assert sorted(order.tolist()) == list(range(len(keys)))
    assert (np.diff(keys[order] >> 12) >= 0).all()


def test_keys_of_a_batch_carry_the_counts_of_its_training_texts(prose):
    texts = [" ".join(prose(i, 60)).encode() for i in range(6)]
    frame = pd.DataFrame({"learn": [True, False, True, False, True, True], "text": texts})
    found = weighting._keys_of_batch(3)((0,), frame)
    got = {}
    for g, n in zip(found["grams"], found["times"]):
        got |= dict(zip(np.cumsum(weighting.unpacked(g)).tolist(), weighting.unpacked(n).tolist()))
    taught = Counter(k for _, keys in weighting.windows([t for t, learn in zip(texts, frame["learn"]) if learn]) for k in keys.tolist())
    assert got == {k: taught[k] for _, keys in weighting.windows(texts) for k in keys.tolist()}


def test_estimate_is_the_product_of_its_steps():
    p, zeros, ones = 1.0, 0, 0
    for bit in (1, 0, 1, 1, 0, 1):
        p *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        zeros, ones = zeros + (not bit), ones + bit
    assert weighting.estimate(np.array([2.0]), np.array([4.0]))[0] == pytest.approx(math.log(p))


# 4


def plain_counts(text):
    words = SPACE.findall(text or "")
    where = defaultdict(list)
    for i in range(len(words) - 2):
        where[tuple(words[i : i + 3])].append(i)
    inside = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside)


def test_bands(documents, prose):
    texts = [None, "", "a", "a b a b a b", " ".join(prose(1, 300)), "spam and eggs " * 100, "é ü\nX\nX\n\n\nX <a>|#", "\n".join([" ".join(prose(2, 20))] * 5), " ".join(prose(3, 40000)), "a b c d a b c"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(4, texts[4], "en", "s"), (None, texts[4], "en", "s")]
    out = bands.judge(documents(rows), "doc_id", "text").collect()
    assert len(out) == len(rows)
    for r in out:
        text = texts[r["doc_id"] if r["doc_id"] is not None else 4]
        assert tuple(r[c] for c in bands.COLUMNS) == plain_counts(text), text
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert next(r for r in out if r["doc_id"] == 4)["kept"] and not next(r for r in out if r["doc_id"] == 5)["kept"]
    assert not bands.within(5000, 9.0, 0.0, bands.Bands()) and not bands.within(5000, 1.01, 0.0, bands.Bands()) and not bands.within(5000, 2.0, 0.5, bands.Bands())
    assert bands.judge(documents([]), "doc_id", "text").collect() == []


# 5


def normal_words(line):
    plain = re.sub("[1-9]", "0", line).lower()
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain) if w]


def test_line_dedup(spark, documents, prose):
    long = prose(5, 80)
    near = [*long[:40], "changed", *long[41:]]
    rows = [
        (3, " ".join(long) + "\nown line number three here", "en", "s"),
        (1, "Some line, that repeats 12!\nfresh words of one\nSome line, that repeats 12!", "en", "s"),
        (2, "  SOME line that - repeats 34\nok\nok\n\nother words of two", "en", "s"),
        (4, " ".join(near), "en", "s"), (5, None, "en", "s"), (6, "", "en", "s"), (None, "some LINE that repeats 99", "en", "s"),
        (7, "\n".join(" ".join(prose(50 + i, 12)) for i in range(40)), "en", "s"), (3, " ".join(long) + "\nown line number three here", "en", "s"),
    ]
    out = {(r["doc_id"], r["text"], r["n_removed"]) for r in lines.dedup(documents(rows), "doc_id", "text").collect()}
    # brute force over all pairs of lines
    places = [(d is None, d or 0, i, at, line) for i, (d, t, _, _) in enumerate(rows) for at, line in enumerate((t or "").split("\n")) if len(set(normal_words(line))) >= 3 and i != 8]

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    order = sorted(range(len(places)), key=lambda n: places[n][:4])
    rank = {n: i for i, n in enumerate(order)}
    links = []
    for x in range(len(places)):
        for y in range(x):
            a, b = normal_words(places[x][4]), normal_words(places[y][4])
            # the rule of the docstring, whatever the SimHashes are
            if a == b or edit(a, b) <= max(len(a), len(b)) // 10:
                links.append((rank[x], rank[y]))
    group = groups_of(range(len(places)), links)
    gone = {(places[order[i]][2], places[order[i]][3]) for i in group if group[i] != i}
    want = set()
    for i, (d, t, _, _) in enumerate(rows[:8]):
        left = [line for at, line in enumerate(t.split("\n")) if (i, at) not in gone] if t is not None else None
        want.add((d, "\n".join(left) if left is not None else None, sum(1 for x in gone if x[0] == i)))
    assert out == want
    assert lines.dedup(documents([]), "doc_id", "text").collect() == []


def test_short_lines_are_compared_exactly(documents):
    rows = [(1, "les\nand ornd\n長い行はここにある\n--", "en", "s"), (2, "LES!\nand ornd\nand arnd\n長い行はここにある\n--\n", "en", "s")]
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup(documents(rows), "doc_id", "text", least_exact=1).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("and arnd\n--\n", 3)}


@pytest.mark.parametrize("n", [10, 20, 30, 50, 100])
def test_every_line_within_the_edit_rule_is_found(documents, prose, n):
    rows = []
    for i in range(25):
        words = prose(9000 + 100 * n + i, n)
        changed, shorter, far = list(words), list(words), list(words)
        for k in range(n // 10):
            changed[(7 * i + 10 * k + 3 * (k % 2)) % n] = f"new{k}"
        for k in range(n // 10):
            del shorter[(5 * i + 9 * k) % len(shorter)]
        for k in range(n // 5 + 1):
            far[(7 * i + 4 * k) % n] = f"far{k}"
        rows += [(10 * i + j, " ".join(w), "en", "s") for j, w in enumerate([words, changed, shorter, far])]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(rows), "doc_id", "text").collect()}
    assert [out[10 * i + j] for i in range(25) for j in range(4)] == [0, 1, 1, 0] * 25


@pytest.mark.parametrize("few,signs", [(256, 50_000), (1, 50_000), (256, 3), (1, 3)])
def test_words_of_a_pair_are_told_apart(monkeypatch, documents, few, signs):
    """Any two different words count as different, however they are looked up and written."""
    monkeypatch.setattr(lines, "FEW_WORDS", few)
    monkeypatch.setattr(lines, "SIGNS", signs)
    rows = []
    for i in range(60):
        words = [f"w{chr(97 + i % 26)}x{chr(97 + k)}{chr(97 + i // 26)}" for k in range(19)]
        one, two = list(words), list(words)
        one[3], two[3], two[11] = "other", "other", "another"
        rows += [(10 * i + j, " ".join(w), "en", "s") for j, w in enumerate([words, one, [*two, "tail"]])]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(rows), "doc_id", "text").collect()}
    # one word of 19 is within a tenth, two of 19 are not; the third has two more edits than the second allows
    assert [out[10 * i + j] for i in range(60) for j in range(2)] == [0, 1] * 60
    far = [(1, " ".join(f"a{chr(97 + k)}" for k in range(19)), "en", "s")]
    far += [(2, " ".join("new" + chr(97 + k) if k in (2, 9) else f"a{chr(97 + k)}" for k in range(19)), "en", "s")]
    assert {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(far), "doc_id", "text").collect()} == {1: 0, 2: 0}


def test_very_long_lines(documents, prose):
    words = prose(41, 3000)
    near, far = list(words), list(words)
    for k in range(250):
        near[11 * k] = f"near{chr(97 + k % 26)}{chr(97 + k // 26)}"
    for k in range(400):
        far[7 * k] = f"far{chr(97 + k % 26)}{chr(97 + k // 26)}"
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate([words, near, far])]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(rows), "doc_id", "text").collect()}
    assert out == {0: 0, 1: 1, 2: 0}


def test_simhash_bits(spark, documents, prose):
    rows = [(i, " ".join(prose(i, 5 + 7 * i)), "en", "s") for i in range(20)]
    job = lines.LineDedup(documents(rows), "doc_id", "text")
    words = {w for _, t, _, _ in rows for w in t.split()}
    bits = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in sorted(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    sims = {r["id"]: r["sim"] for r in job.lines.collect()}
    for d, t, _, _ in rows:
        own = set(t.split())
        want = sum(1 << i for i in range(63) if 2 * sum((bits[w] >> i) & 1 for w in own) > len(own))
        assert sims[d] == want


def test_marks_tell_long_unlike_lines_apart(spark, documents, prose):
    """One long for a mark let about half of such pairs pass, and each carried the words of its lines through a shuffle."""
    far = [(i, " ".join(prose(700 + i, 170)), "en", "s") for i in range(20)]
    line = far[0][1].split()
    near = (20, " ".join([*line[:80], "other", *line[81:150], "another", *line[150:]]), "en", "s")
    job = lines.LineDedup(documents([*far, near]), "doc_id", "text")
    own = job.distinct.select(F.col("first.id").alias("i"), "n", "mark")
    pairs = own.toDF("a", "na", "ma").join(own.toDF("b", "nb", "mb"), F.col("a") < F.col("b")).where(lines.like_marks("ma", "mb", "na", "nb"))
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [(0, 20)]


def test_keys_are_runs_of_long_words_and_like_lines_share_some(spark, prose):
    """Keys were chosen by their hash alone, so with more text more and more unlike lines shared one."""
    rows = []
    for i in range(40):
        words = [w if k % 3 else "de" for k, w in enumerate(prose(500 + i, 9 + 3 * i))]
        changed = list(words)
        for k in range(len(words) // 10):
            changed[(7 * i + 10 * k) % len(words)] = f"other{k}"
        rows += [(i, words), (i, changed)]
    cut = spark.createDataFrame(rows, "i int, words array<string>").withColumn("s", F.size("words")).withColumn("ranks", lines.ranked(F.col("words")))
    found = defaultdict(list)
    for r in cut.select("i", "s", lines.gram_keys("ranks", "s", "s").alias("keys"), "ranks").collect():
        assert len(r["keys"]) == min(r["s"] // 9 * lines.GRAM + lines.SHARED, r["s"] - lines.GRAM + 1)
        found[r["i"]].append(set(r["keys"]))
    assert all(len(a & b) >= lines.SHARED for a, b in found.values())
    short = spark.createDataFrame([(["de", "la", "en"], 0)], "words array<string>, n int").select(lines.ranked(F.col("words")).alias("r")).first()["r"]
    long = spark.createDataFrame([(["responsibilities"],)], "words array<string>").select(lines.ranked(F.col("words")).alias("r")).first()["r"]
    assert long[0] < min(short) and long[0] < 1 << 48


def test_marks_count_a_word_more_or_less_once(spark):
    """Two words changed and one less passed for two edits."""
    def mark(*bits):
        return tuple(sum(1 << b for b in bits) if i == 0 else 0 for i in range(lines.MARKS))
    schema = "ma struct<m0: long, m1: long, m2: long, m3: long>, mb struct<m0: long, m1: long, m2: long, m3: long>, na int, nb int"
    rows = [(mark(1, 2), mark(3, 4), 20, 20), (mark(1, 2), mark(3), 20, 19), (mark(1, 2), mark(3, 4), 20, 19), (mark(1, 2), mark(), 20, 18), (mark(1, 2), mark(3), 20, 18)]
    out = spark.createDataFrame(rows, schema).select(lines.like_marks("ma", "mb", "na", "nb").alias("like")).collect()
    assert [r["like"] for r in out] == [True, True, False, True, False]


def test_lines_meet_whatever_part_their_keys_are_in(monkeypatch, documents, prose):
    monkeypatch.setattr(lines, "PARTS", 5)
    rows = []
    for i in range(30):
        words = prose(800 + i, 12)
        rows += [(2 * i, " ".join(words), "en", "s"), (2 * i + 1, " ".join([*words[: i % 12], "other", *words[i % 12 + 1 :]]), "en", "s")]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(rows), "doc_id", "text").collect()}
    assert out == {i: i % 2 for i in range(60)}


def test_lm_writes_little(spark, documents, prose):
    """The word table stayed on disk to the end, and answers took four bytes a key."""
    p = np.repeat(np.array([0.5, 0.25, 0.9, 1e-6], "<f4"), 500)
    assert len(weighting.answer(p)) < len(p) and (weighting.answered(weighting.answer(p)) == p).all()
    assert len(weighting.answered(weighting.answer(p[:0]))) == 0
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    out = weighting.score(documents([(i, " ".join(prose(i, 20)), "en", "s") for i in range(5)]), F.lit(True), "doc_id", "text")
    assert len(set(os.listdir(shared)) - before) == 1
    assert out.count() == 5


def test_shuffles_of_written_tables_leave_the_disk(spark):
    """Files of a write's shuffles stayed until the driver happened to collect its garbage."""

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "shuffle_" in f}

    before = files()
    out = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    # the table itself and other statements are as they were
    assert out.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_keys_of_near_simhashes_meet(spark):
    near = spark.range(200).select(F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1)).alias("x"), F.xxhash64("id", F.lit(1)).alias("r"))
    flip = [F.expr(f"shiftleft(1L, cast(pmod(shiftright(r, {8 * i}), 63) as int))") for i in range(3)]
    near = near.withColumn("y", F.col("x").bitwiseXOR(flip[0].bitwiseOR(flip[1]).bitwiseOR(flip[2])))
    for m in (4, 5, 6):
        both = near.where(~F.arrays_overlap(lines.block_keys(F.col("x"), m, m - 3), lines.block_keys(F.col("y"), m, m - 3)))
        assert both.count() == 0


# 6


def test_redirects(spark):
    pages = [
        (1, "http://a.net/start", '<LINK href="https://example.org/es/x" rel="canonical">'),
        (2, "https://b.net", '<meta http-equiv="refresh" content="0; url=http://a.net/start#part">'),
        (3, "http://c.net/?q=1", "<link rel=canonical href=/other>"),
        (4, "http://c.net/other", ""),
        (5, "http://EXAMPLE.org/en/123", None), (6, "http://www.example.org/en/2", ""), (7, "http://notexample.com/de/1", ""), (8, "http://org", ""),
        (9, None, "<link rel=canonical href=http://x.com/de/>"), (10, "no scheme/de/", ""),
        (11, "http://d.net/1", '<link rel="canonical" href="http://x.com/de/1">'), (12, "http://d.net/2", '<link rel="canonical" href="//d.net/1"><link rel="canonical" href="http://y.com/fr/1">'),
        (13, "http://x.com/de/1", ""), (1, "http://a.net/start", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "node": F.lit(2), "v": F.lit(3)})
    out = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in redirects.judge(frame, RULES, "page_id", "url", "html").collect()}
    assert out == {
        (1, "a.net", "/start", None, "block"), (2, "b.net", "", None, "block"), (3, "c.net", "/", None, "allow"), (4, "c.net", "/other", None, "allow"),
        (5, "example.org", "/en/123", "example.org/en/1", "block"), (6, "www.example.org", "/en/2", "org/", "allow"), (7, "notexample.com", "/de/1", "com/de/", "block"),
        (8, "org", "", None, "allow"), (9, "", "", None, "allow"), (10, "", "", None, "allow"), (11, "d.net", "/1", None, "allow"), (12, "d.net", "/2", None, "allow"),
        (13, "x.com", "/de/1", "com/de/", "block"),
    }
    assert redirects.judge(frame.where("page_id < 0"), RULES, "page_id", "url", "html").collect() == []


LINKS = [
    ("http://h.com/a/b", "?p=2", "http://h.com/a/b?p=2"), ("http://h.com/a/b?q=1", "?p=2", "http://h.com/a/b?p=2"), ("http://h.com", "?p=2", "http://h.com?p=2"),
    ("http://h.com/a/?q=1#y", "#x", "http://h.com/a/?q=1#x"), ("http://h.com/a/b", "../c", "http://h.com/c"), ("http://h.com/a/b/d", "./c/.", "http://h.com/a/b/c/"),
    ("http://h.com/a", "../../../c", "http://h.com/c"), ("http://h.com/a/b/", "..", "http://h.com/a/"), ("https://h.com/a", "//k.net/x/../y?u=/../", "https://k.net/y?u=/../"),
    ("http://h.com/a", "c//d", "http://h.com/c//d"), ("http://h.com", "c", "http://h.com/c"), ("http://h.com/a", "mailto:x@h.com", "mailto:x@h.com"),
    ("http://h.com/a", "HTTP://k.net/...", "HTTP://k.net/..."), ("http://h.com/?x=a/b", "/c/./d", "http://h.com/c/d"), ("http://h.com/a/b", "..c/.d", "http://h.com/a/..c/.d"),
]


def test_links_of_every_form(spark):
    rows = spark.createDataFrame(LINKS, "url string, link string, want string").select("*", redirects.resolved(F.col("url"), F.col("link")).alias("got")).collect()
    assert [(r["url"], r["link"], r["got"]) for r in rows] == [(r["url"], r["link"], r["want"]) for r in rows]


def test_links_in_comments_with_references_and_a_base(spark):
    bad = "http://x.com/de/1?a=1&b=2"
    pages = [
        (1, "http://p.net/1", f'<!-- <link rel=canonical href={bad}> -->'),
        (2, "http://p.net/2", '<link rel=canonical href="http://x.com/de/1?a=1&amp;b=2">'),
        (3, "http://p.net/3", '<base href="http://x.com/de/k/"><link rel=canonical href="../1?a=1&#38;b=2">'),
        (4, "http://p.net/z/../4", ""), (5, "http://p.net/5", "<link rel=canonical href=./z/.././4>"), (6, "http://q.net/", "<link rel=canonical href=http://p.net/4><link rel=canonical href=//x.com/de/2>"),
        (7, "http://p.net/7", "<!-- open <link rel=canonical href=http://x.com/de/1>" + " x" * 50_000), (8, "http://p.net/8", "<link rel=canonical href" + "<meta" * 1000),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r["page_id"]: r["verdict"] for r in redirects.judge(frame, RULES, "page_id", "url", "html").collect()}
    assert out == {1: "allow", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "block", 8: "allow"}


# 7


def water(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        share = {s: total * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            total -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("block", [16, 1024])
def test_mixing(documents, prose, block):
    rows = [(i, " ".join(prose(i, 5 + i % 90)), "en", ["a", "b", "é", None, "hot", "hot", "hot"][i % 7]) for i in range(300)]
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), (902, " ".join(prose(902, 9000)), "en", "b"), rows[5], rows[5]]
    docs = documents(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    target = water(sizes)
    out = mixing.taken(docs, "doc_id", "text", "source", block=block).collect()
    assert len(out) == len(rows)
    source_of = {d: s for d, _, _, s in rows}
    got = Counter()
    for r in out:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        got[s] += r["taken"]
    assert all(abs(got[s] - target[s]) <= 0.5 for s in sizes)
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, mixing.taken(docs.repartition(7), "doc_id", "text", "source", block=block).collect()))
    mixed = Counter()
    for r in mixing.mix(docs, "doc_id", "text", "source", block=block).collect():
        mixed[r["doc_id"]] += r["words"]
    again = Counter()
    for r in out:
        again[r["doc_id"]] += r["taken"]
    assert mixed == Counter({k: v for k, v in again.items() if v})
    assert mixing.taken(documents([]), "doc_id", "text", "source").collect() == []


# 8


def test_language(documents, prose):
    french = lambda i: " ".join("é" + w + "eaux" for w in prose(i, 40))
    rows = [(i, french(i) if i % 2 else " ".join(prose(i, 40)), "fr" if i % 2 else "en", "s") for i in range(120)]
    rows += [(500, None, None, "s"), (501, "", "en", "s"), (502, "12 ²³ !!", "en", "s"), (503, "éqqqqqeaux", None, "s"), (None, "ban", "en", "s")]
    docs = documents(rows)
    model = language.fit(docs.where("doc_id < 80"), "doc_id", "text", "lang")
    out = {r["doc_id"]: r for r in language.identify(docs, model, "doc_id", "text").collect()}
    assert model.languages == ["en", "fr"] and len(out) == len(rows)
    assert all(out[i]["lang_pred"] == ("fr" if i % 2 else "en") for i in range(80, 120))
    assert [out[i]["lang_pred"] for i in (500, 501, 502, 503)] == ["und", "und", "und", "fr"] and out[500]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in out.values())
    kept = language.recognised(docs, model, "text")
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    nothing = language.fit(docs.where("doc_id < 0"), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language.identify(docs, nothing, "doc_id", "text").collect()} == {"und"}


# 9


def test_licences(documents):
    texts = [
        "Released under the MIT License.", "mit\nLicense and the APACHE license; general public license MIT-license", None, "", "nothing here",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided", "é mit Licence", "Licensed under CC BY-NC 4.0.",
        "general public general public license", "license " * 2000 + "mit license",
        "licensed under CC BY-SA 4.0", "This work is licensed under the GNU General Public License, version 3.", "licensed under the GNU Lesser General Public License",
        "licensed under the GNU General Public License", "licensed under CC BY 4.0 and licensed under CC BY NC 4.0", "Licensed under cc by 4.0\nlicensed under CC BY SA 4.0",
    ]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s")]
    out = {r["doc_id"]: r for r in licences.scan(documents(rows), "doc_id", "text").collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    templates = [(label, set(licences.split_words(t))) for label, t in licences.TEMPLATES]

    def held(line):
        """Templates that hold for a line: (label, containment)."""
        line, met = set(word.findall(line)), []
        for label, t in templates:
            rivals = [t - o for name, o in templates if name != label and len(t & o) / len(t) >= licences.THRESHOLD - 1e-12]
            if len(t & line) / len(t) >= licences.THRESHOLD - 1e-12 and all(r <= line for r in rivals):
                met.append((label, t & line, len(t & line) / len(t)))
        return [(label, share) for label, s, share in met if not any(name != label and s < o for name, o, _ in met)]

    for i, text in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = word.findall(low)
        places = [(k, label) for phrase, label in licences.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        met = [found for line in low.split("\n") for found in held(line)]
        base = {label for _, label in places}
        want = (
            len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {label for label, _ in met})), 1.0 if places else max((s for _, s in met), default=0.0),
        )
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], pytest.approx(r["score"])) == want
    assert [out[i]["labels"] for i in range(10, 16)] == ["cc-by-sa", "gpl", "gpl,lgpl", "gpl", "cc-by-nc", "cc-by,cc-by-sa"]
    assert licences.scan(documents([]), "doc_id", "text").collect() == []


# 10


def test_decontamination(spark, documents, prose):
    items = [(i, " ".join(prose(1000 + i, 12 + 9 * i))) for i in range(30)] + [(90, None), (91, ""), (92, " ".join(prose(1092, 700)))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"id": F.lit(0), "item": F.lit(1)})
    rows = []
    for i, text in items[:30] + items[-1:]:
        words = text.split()
        changed = [*words[: len(words) // 3], "odd", *words[len(words) // 3 + 1 :]]
        rows.append((i, " ".join([*prose(i, 70), *words, *prose(500 + i, 90)]), "en", "s"))
        rows.append((100 + i, " ".join([*prose(300 + i, 30), *[w.upper() + "," for w in changed]]), "en", "s"))
        rows.append((300 + i, " ".join([*prose(700 + i, 200), *words[: len(words) // 2]]), "en", "s"))
    rows += [(800, None, "en", "s"), (801, "", "en", "s"), (802, " ".join(prose(802, 20000) + items[7][1].split()), "en", "s"), rows[0], (None, items[3][1], "en", "s")]
    out = decontaminate.leaks(documents(rows), bench, "doc_id", "text", "item_id", "text").collect()
    found = {(r["doc_id"], r["item_id"]) for r in out}
    assert len(found) == len(out)
    # brute force: every item against the words of every document
    want = set()
    plain = {d: t.translate({ord(","): " "}).lower().split() for d, t, _, _ in rows if d is not None and t}
    for item, text in items:
        own = (text or "").split()
        cut = len(own) - len(own) * decontaminate.ANSWER_PERCENT // 100
        parts = [own[:cut], own[cut:]]
        for d, words in plain.items():
            if own and all(share(p, words) >= decontaminate.OVERLAP for p in parts):
                want.add((d, item))
    assert found == want and (7, 7) in found and (110, 10) in found and (310, 10) not in found and (802, 7) in found
    assert decontaminate.leaks(documents([]), bench, "doc_id", "text", "item_id", "text").collect() == []
    assert decontaminate.leaks(documents(rows), bench.where("item_id < 0"), "doc_id", "text", "item_id", "text").collect() == []


def share(part, words):
    width = min(decontaminate.RUN, len(part))
    if not width:
        return 1.0
    there = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    inside = {i + k for i in range(len(part) - width + 1) if tuple(part[i : i + width]) in there for k in range(width)}
    return len(inside) / len(part)


def test_items_without_answer_with_edits_anywhere_and_cut_ends(spark, documents, prose):
    item = prose(4000, 38)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    texts = [[*item[:at], "odd", *item[at + 1 :]] for at in range(38)] + [item[:35], item[3:], item[2:36], item[:20]]
    rows = [(i, " ".join([*prose(5000 + i, 40), *t, *prose(6000 + i, 40)]), "en", "s") for i, t in enumerate(texts)]
    found = {r["doc_id"] for r in decontaminate.leaks(documents(rows), bench, "doc_id", "text", "item_id", "text").collect()}
    assert found == set(range(41))


def test_rows_without_identifier_are_decontaminated(spark, documents, prose):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("text is not null").first()["text"]
    rows = [(None, f"{' '.join(prose(1, 30))} {item}", "en", "s"), (None, " ".join(prose(2, 30)), "en", "s"), (1, item, "en", "s"), (1, " ".join(prose(3, 30)), "en", "s")]
    left = corpus_pipeline.without_benchmark(spark, documents(rows), sf).collect()
    assert sorted(r["text"] for r in left) == sorted([rows[1][1], rows[3][1]])


def test_parts_of_the_index_give_the_same(spark, documents, prose, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(prose(i, 20))) for i in range(40)], "item_id long, text string")
    docs = documents([(i, " ".join([*prose(i, 20), *prose(100 + i, 40)]), "en", "s") for i in range(60)])
    run = lambda: sorted(map(tuple, decontaminate.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()))
    whole = run()
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 1500)
    parts = run()
    assert [r[:2] for r in whole] == [r[:2] for r in parts] and len(whole) == 40
    assert [r[2] for r in whole] == pytest.approx([r[2] for r in parts], rel=1e-5)


def test_crc_split_is_that_of_the_text(spark):
    from plotstats.llm.text import remainder

    rows = spark.range(50).select("id", remainder(F.col("id"), 7).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in rows)
