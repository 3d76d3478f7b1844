import pytest
from made_up import prose
from pyspark.sql import types as T

# Names that operators use inside or return.
CLASHING = ["size", "shard", "slot", "fp", "score", "spans", "kept", "_ord", "_d", "_keep", "component_id", "n_words"]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows ``(doc_id, text[, lang[, source]])`` as documents with clashing extra columns."""

    def make(rows):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = (*rest, "en", "s1")[:2] if len(rest) < 2 else rest
            full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * len(CLASHING)))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    return [
        (1, prose(1, 120), "en", "s1"),
        (1, prose(1, 120), "en", "s1"),
        (1, prose(2, 80), "en", "s1"),
        (2, None, None, None),
        (3, "", "en", None),
        (4, " \n\t ", None, "s2"),
        (None, prose(3, 60), "en", "s1"),
        (None, prose(3, 60), "en", "s1"),
        (None, None, None, None),
        (5, prose(4, 30_000), "en", "s1"),
        (6, "!!! 123 ###", "en", "s1"),
        (7, prose(5, 90, "fr"), "fr", "s1"),
        (8, prose(1, 120), "de", "s2"),
    ]
