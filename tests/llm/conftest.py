from __future__ import annotations

import pytest

LONG = "Whatever is long enough to be found again must hold more than fifty bytes of plain text, as this sentence does."


@pytest.fixture
def docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and columns with clashing names."""
    prose = " ".join(f"word{i % 97} is number{i}" for i in range(400))
    rows = [
        (1, prose, "en", 10), (2, prose, "en", 11), (2, prose, "en", 11), (3, prose.replace("number7 ", "seven "), None, None),
        (4, None, None, None), (5, "", "de", 0), (6, " \n\t ", "de", 4), (7, "two words", "fr", 9), (8, "TWO Words", "fr", 9),
        (9, "x" * 70_000, "en", None), (10, "Émile a été là. " + LONG, "fr", 5), (11, "Autre chose. " + LONG + " Fin.", "fr", 5),
        (None, LONG, "en", 5), (12, "中文字符没有空格" * 50, "zh", None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    for name in ("id", "key", "size", "packed", "regions", "row", "k_id", "rest", "host", "component"):
        frame = frame.selectExpr("*", f"'{name}' AS `{name}`")
    return frame
