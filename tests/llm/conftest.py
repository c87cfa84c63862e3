import datetime

import pytest
from pyspark.sql import functions as F

#: Columns whose names clash with those that operators make on the way.
CLASHING = ["bucket", "name", "block", "pass", "fp", "node", "label_fp", "lines", "limits", "host", "wrapper", "path", "_id", "_kept", "_all", "_cut", "_hash", "_parts", "kept", "score", "edits", "size", "target", "rank", "start", "length"]

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong potions near old stone bridges under pale moons".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, odd characters, extra columns."""
    shared = sentence(1, 60)
    rows = [
        (1, shared, "en", "a"), (2, shared, "en", "a"), (2, shared, "en", "a"), (3, None, "en", None), (4, "", None, "b"), (5, " \t\n ", "de", "b"), (None, "no id here", "en", "a"), (None, shared + " tail", None, None),
        (6, sentence(2, 40) + " " + shared + "\n" + sentence(3, 30), "en", "a"), (7, "x", "en", "b"), (8, "In. " * 50, "en", "b"), (9, sentence(9, 6000), "fr", "c"), (10, sentence(9, 6000) + " more", "fr", "c"),
        (11, "é ß ﬁ x 𝔘𝔫𝔦 é Ö ΣΑΣ. don't I'll, ...,", "de", "c"), (12, "\n\n".join(sentence(i, 20) for i in range(5)), "en", "a"), (13, shared.upper(), "en", "a"),
    ]
    d = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for i, c in enumerate(CLASHING):
        d = d.withColumn(c, F.lit(i if i % 2 else f"x{i}"))
    return d.withColumn("when", F.lit(datetime.date(2020, 1, 1)))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
