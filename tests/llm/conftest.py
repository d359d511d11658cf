import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("id", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("size", T.StringType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Builds a table of documents with extra columns from (doc_id, text, lang, source) rows."""

    def build(rows):
        full = [(d, t, lang, source, len(t or ""), "x", "x", "x", "x", "x", "x") for d, t, lang, source in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


WORDS = [f"{a}{b}" for a in ("ba", "ke", "lo", "mu", "ni", "ro", "sa", "te") for b in ("n", "r", "s", "t", "lin", "mor", "pad", "vek")]


@pytest.fixture
def prose():
    """Words drawn by a seed; the same seed gives the same words."""
    import random

    def write(seed, n):
        draw = random.Random(seed)
        return [draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n)]

    return write
