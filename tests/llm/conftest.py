import pytest
from pyspark.sql import functions as F


def with_clashes(frame):
    """Extra columns whose names an operator may use inside."""
    for name in ("size", "fp", "score", "t", "key", "data", "block", "rows", "copies", "token", "weight", "n", "segments", "_bucket_",
                 "_bucket", "_known", "_gone", "_keep", "_copies", "_sha", "_id", "_source", "_hash", "_key", "row", "id", "h0", "h1", "best", "times", "sha",
                 "keep_id", "group_size", "root", "node", "d", "s", "h", "text_hash", "mark"):
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="session")
def clash():
    return with_clashes


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text, lang, source, n_chars) rows with nulls, empties, ties, repeats and one long text, plus clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35), (2, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (3, "", "en", "b", 0), (4, None, None, None, None), (5, long, "en", "b", len(long)), (6, long, "en", None, len(long)),
        (None, "alpha beta gamma delta epsilon zeta", "en", "a", 35), (7, "one", "en", "c", 3), (7, "one", "en", "c", 3), (8, "  \t\n ", "en", "c", 5),
        (9, "Größe ÉTÉ 日本語 text 😀", "de", "ü", 20), (10, long + " tail", "en", "b", len(long) + 5)]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
