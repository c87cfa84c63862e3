"""The pipeline's near-duplicate stage against brute force, and rows that are repeated or have no id."""

import random

import pytest

import corpus_pipeline
from genoweave.llm import simhash


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_kept(docs):
    """Of (id, text) with distinct ids: the smallest of each component of similarity 0.8 or more."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {find(i) for i in sets}


def edited(words, n, r):
    out = list(words)
    for at in r.sample(range(len(out)), n):
        out[at] = f"new{r.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("small", [{}, {"trie_block": 60, "unit": 4, "salted": 2, "hot": 3}])
def test_near_copies_go(spark, small):
    r = random.Random(5)
    texts = []
    for _ in range(30):
        words = [f"w{r.randrange(3000)}" for _ in range(r.randrange(60, 300))]
        texts += [edited(words, n, r) for n in (0, 0, 1, len(words) // 80, len(words) // 45, len(words) // 30, len(words) // 10)]
    texts += ["", None, "a", "a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n o", "A b c d e f g h i j k l m n"]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_kept(list(enumerate(texts)))
    assert len(want) < len(texts) - 100
    assert {x["doc_id"] for x in simhash.deduplicated(docs, simhash.NearParams(**small)).collect()} == want
    if not small:
        assert {x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == want


def test_stage_on_the_smallest_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_kept([(x["doc_id"], x["text"]) for x in docs.collect()])
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()) == sorted(want)
