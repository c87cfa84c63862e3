"""Rows that are repeated, share an id or have none, in the two deduplicating stages."""

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], COLUMNS)


def kept(out):
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_substrings_keep_the_first_of_repeated_rows(spark):
    a, b, c = words(1, 30), words(2, 40), "é " + words(3, 25)
    rows = [(1, a), (1, a), (1, a), (2, b), (2, c + " " + a), (None, c), (None, words(4, 22)), (None, words(4, 22)), (5, "short one"), (5, "short one")]
    out = corpus_pipeline.substrings(spark, frame(spark, rows), "")
    assert kept(out) == sorted([(1, a), (2, b), (2, c), (None, words(4, 22)), (5, "short one"), (5, "short one")], key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_near_duplicates_keep_the_first_of_repeated_rows(spark):
    a, b = words(1, 30), words(2, 40)
    rows = [(1, a), (1, a), (1, b), (None, a), (None, b), (None, words(3, 9)), (None, words(3, 9)), (4, b)]
    assert kept(corpus_pipeline.near_duplicates(spark, frame(spark, rows), "")) == sorted([(1, a), (1, b), (None, words(3, 9))], key=repr)
