import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(20_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case: NULLs, empty and very long texts, repeated rows, clashing columns."""
    rows = [
        (1, "Some plain text about nothing much at all.\nSecond line here.\nThird line here.", "en", "a", 5),
        (1, "Some plain text about nothing much at all.\nSecond line here.\nThird line here.", "en", "a", 5),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \n\t ", "en", "b", 4),
        (5, LONG, "en", "b", len(LONG)),
        (None, "A row without any key, which has a text of its own.", "en", None, 9),
        (None, None, None, None, None),
        (6, "12345 67 --- ###", "en", "b", 3),
        (7, "Ein kurzer Text über nichts, äöü ß 🎉.", "de", "c", 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("node", "key", "doc", "score", "label", "bucket", "_key", "_hash", "samples", "class_id", "at"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
