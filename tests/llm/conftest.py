import re

import pytest

TRICKY = "x" * 30_000


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@pytest.fixture
def documents(spark):
    """Builds a documents frame; extra columns clash with names the operators use inside."""

    def build(rows):
        frame = spark.createDataFrame(
            [(*r, 7, "extra", 1.5) for r in rows],
            "doc_id long, text string, lang string, source string, n_chars long, "
            "n int, label string, target double",
        )
        return frame.repartition(3)

    return build


EDGE_ROWS = [
    (1, "one two three four five six", "en", "a", 27),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, "word", "en", None, 4),
    (5, "one two three four five six", "en", "a", 27),
    (5, "one two three four five six", "en", "a", 27),
    (None, "one two three four five six", "en", "a", 27),
    (6, " \t\n ", "de", "b", 4),
    (7, TRICKY + " " + "long words in a row " * 3000, "en", "c", 90_000),
    (8, "ÄÖÜ \u212a İstanbul 漢字 emoji 😀 end", "de", "c", 30),
]


@pytest.fixture
def edge_rows():
    return list(EDGE_ROWS)
