import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents_of(spark):
    """A documents table from (doc_id, text[, lang[, source]]) tuples."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
    return [(None, None, None, None), (1, None), (2, ""), (3, "a"), (3, "a"), (None, "some words without an id stand here"),
            (4, "the quick brown fox jumps over the lazy dog " * 30), (4, "the quick brown fox jumps over the lazy dog " * 30),
            (5, long_text, None, None), (6, " \t\n\r "), (7, "é ü ñ ß 漢字 🙂"), (8, "same tie text of five words"), (9, "same tie text of five words")]
