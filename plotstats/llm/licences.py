"""License scans: an exact set-similarity join of text blocks with license templates, all in DataFrame expressions.

A block is a line. It meets a template when at least `threshold` of the template's distinct words stand in it. Words are
ordered by the number of blocks that have them, rarest first: a block that meets a template of n words with an overlap of
m or more has one of the n - m + 1 first words of the template (prefix), has m words (length), and has, from the first
shared word on, enough words left on both sides (position).

Licenses with nearly the same sentences are told apart: a template that a sibling's text would meet must be met in the words
that the sibling lacks, and of the templates that a block meets, one whose shared words are all among those of a template
of another label, which shares more, is dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotstats.llm.redirects import lower
from plotstats.llm.store import saved

#: Between words: ASCII except letters and digits, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same on text with its capitals.
WORD_ANY = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Sentences by which texts name their license, and sentences of well-known license texts.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the Apache License Version 2.0"),
    ("gpl", "licensed under the GNU General Public License version 3"),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the BSD License"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "subject to the terms of the Mozilla Public License v 2.0"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-nc", "licensed under CC BY NC 4.0"),
    ("cc-by-sa", "licensed under CC BY SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.85


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower(text), GAP), lambda w: w != "")


def phrase_places(words: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase begins."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    fits = [lambda i, k=k, p=p: F.get(words, i + k) == p for k, p in enumerate(parts)]

    def here(i: Column) -> Column:
        out = fits[0](i)
        for f in fits[1:]:
            out = out & f(i)
        return out

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def _template_words(templates) -> list[tuple[int, str, str]]:
    return [(i, label, w) for i, (label, text) in enumerate(templates) for w in sorted({w for w in split_words(text)})]


def split_words(text: str) -> list[str]:
    plain = "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text)
    return plain.split(" ") if plain == " ".join(plain.split()) else plain.split()


def telling_words(templates, threshold: float) -> list[list[str]]:
    """Of each template, the words that are not in a template of another label which holds enough of its words to meet it."""
    sets = [(label, set(split_words(text))) for label, text in templates]
    out = []
    for label, words in sets:
        others = [other for name, other in sets if name != label and len(words & other) >= threshold * len(words) - 1e-9]
        out.append(sorted(set().union(*[words - other for other in others])))
    return out


def meet(docs: DataFrame, key: Column, text_col: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, block, template, label, containment) of every line that meets a template; `block` counts lines from 0.

    Texts with one key are one text: what they meet comes once."""
    spark = docs.sparkSession
    listed = [(i, label, w) for i, label, w in _template_words(templates)]
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, _, w in listed})])
    lines = docs.select(key.alias("key"), F.posexplode(F.split(F.col(text_col), "\n")).alias("block", "line"))
    hits = lines.select("key", "block", F.array_intersect(words_of(F.col("line")), vocabulary).alias("hits")).where(F.size("hits") > 0)

    # rarest first; a word that no block has comes first of all and can never be met
    counts = hits.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count("*").alias("blocks"))
    table = spark.createDataFrame(listed, "template int, label string, word string").join(F.broadcast(counts), "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("blocks", F.lit(0)).alias("blocks"), "word")))
    table = table.groupBy("template", "label").agg(F.transform(ordered, lambda x: x["word"]).alias("words"))
    least = {i: max(1, math.ceil(threshold * len({w for t, _, w in listed if t == i}) - 1e-9)) for i, _, _ in listed}
    table = table.withColumn("need", F.element_at(F.create_map(*[F.lit(x) for kv in least.items() for x in kv]), F.col("template")))
    telling = [F.array(*[F.lit(w) for w in words]).cast("array<string>") for words in telling_words(templates, threshold)]
    table = table.withColumn("telling", F.get(F.array(*telling), F.col("template")) if telling else F.array().cast("array<string>"))
    # one row per template and word of its prefix: a list that the caller gives, a few dozen rows
    prefix = table.withColumn("prefix", F.slice("words", F.lit(1), F.size("words") - F.col("need") + 1))
    prefix = saved(prefix.select("template", "label", "words", "need", "telling", F.posexplode("prefix").alias("place", "word")))
    wanted = [r["word"] for r in prefix.select("word").distinct().collect()]

    near = hits.where(F.size("hits") >= min(least.values(), default=1)).where(F.arrays_overlap("hits", F.array(*[F.lit(w) for w in wanted])))
    pairs = near.select("key", "block", "hits", F.explode("hits").alias("word")).join(F.broadcast(prefix), "word")
    pairs = pairs.where(F.size("hits") >= F.col("need")).where(F.size("words") - F.col("place") >= F.col("need"))
    shared = F.array_intersect("words", "hits")
    # the pair is kept once, at the first word that both have
    pairs = pairs.withColumn("shared", shared).where((F.element_at("shared", 1) == F.col("word")) & (F.size("shared") >= F.col("need")))
    pairs = pairs.where(F.size(F.array_except("telling", "shared")) == 0)
    # at most one entry per template, however many texts are equal
    met = pairs.groupBy("key", "block").agg(F.collect_set(F.struct("template", "label", "shared", (F.size("shared") / F.size("words")).alias("containment"))).alias("met"))

    def beaten(m: Column) -> Column:
        return F.exists("met", lambda o: (o["label"] != m["label"]) & (F.size(o["shared"]) > F.size(m["shared"])) & (F.size(F.array_except(m["shared"], o["shared"])) == 0))

    best = met.select("key", "block", F.explode(F.filter("met", lambda m: ~beaten(m))).alias("m"))
    return best.select("key", "block", "m.template", "m.label", "m.containment")


def scan(docs: DataFrame, id_col: str, text_col: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    base: places of the fixed phrases among the words of the whole text, which may cross lines. labels adds those of the
    templates that hold for a line. score: 1 with a base phrase, else the largest containment met, else 0. A null text is empty: no
    words, no labels (empty strings), null first and last word. Repeated rows give repeated results.
    """
    key = F.xxhash64(F.col(text_col))
    found = meet(docs.where(F.col(text_col).isNotNull()), key, text_col, templates, threshold)
    # at most one label per template is gathered for a text
    found = found.groupBy("key").agg(F.collect_set("label").alias("met"), F.max("containment").alias("most"))
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), key.alias("key"))
    rows = rows.withColumn("n_words", F.regexp_count(text, F.lit(WORD_ANY)).cast("long"))
    # all phrases end with the same word, so texts without it need not be cut up
    ends = "|".join(sorted({p.split()[-1] for p, _ in PHRASES}))
    rows = rows.withColumn("_words", F.when(text.rlike(f"(?i)(?:{ends})"), words_of(text)).otherwise(F.array().cast("array<string>")))
    for i, (phrase, _) in enumerate(PHRASES):
        rows = rows.withColumn(f"_at{i}", phrase_places(F.col("_words"), phrase))
    rows = rows.withColumn("_at", F.concat(*[F.col(f"_at{i}") for i in range(len(PHRASES))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"_at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]))
    rows = rows.select("_id", "key", "n_words", F.size("_at").cast("long").alias("n_base"), F.array_min("_at").cast("long").alias("first_word"),
                       F.array_max("_at").cast("long").alias("last_word"), F.array_sort(F.array_distinct(base)).alias("base"))
    out = rows.join(found, "key", "left")
    met = F.coalesce("met", F.array().cast("array<string>"))
    return out.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", met)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )
