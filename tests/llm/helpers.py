"""Small frames with the awkward rows that every operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=DOCS):
    """Documents 0, 1, ... with these texts; further columns are null."""
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], schema)


def awkward(spark):
    """Null, empty, blank, very long and repeated texts, and a repeated row."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "de", "a", 4), (4, long, "en", None, 9),
        (5, long, "en", None, 9), (6, "one", "fr", "b", 3), (7, "one", "fr", "b", 3), (7, "one", "fr", "b", 3),
        (8, "x" * 70_000, None, "b", 70_000), (None, "no id here at all", "en", "c", 1),
    ]
    return spark.createDataFrame(rows, DOCS)
