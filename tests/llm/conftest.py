import os
import random

import pytest

# the Python workers import the library too
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")])

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def make_docs(spark):
    """A documents table from (doc_id, text, source); extra columns clash with internal names on purpose."""
    def make(items, extra=True):
        data = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in items]
        df = spark.createDataFrame(data, DOCS)
        if extra:
            for name in ("key", "digest", "row", "text_key", "copies", "a", "b", "score"):
                from pyspark.sql import functions as F

                df = df.withColumn(name, F.lit("extra"))
        return df
    return make


@pytest.fixture()
def edge_docs(make_docs):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    long = " ".join(r.choice(words) for _ in range(60_000))
    items = [(1, None, "a"), (2, "", None), (None, "one two three four five six", "b"), (None, None, None),
             (3, "one two three four five six", "a"), (4, "one two three four five six", "a"),
             (4, "one two three four five six", "a"), (5, long, "b"), (6, long + " end", "b"),
             (7, "  spaced\t out \n text\x0b", None), (8, "!!! ...", "c"), (9, "übung mit ümläuten und mehr", "c")]
    return items, make_docs(items)
