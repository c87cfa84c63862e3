"""Every operator on crooked rows and on none, against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import sentence  # noqa: F401
from pyspark.sql import functions as F

from genoweave.llm import merkle, mixing, packing, quality_rules, simhash, substring_dedup, token_counts, toxicity


def words(text):
    return (text or "").encode().split()


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *(str(x) for x in r[1:])))


# --- substring dedup ---


def brute_repeats(docs, w=20):
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        ws = words(t)
        drop = [False] * len(ws)
        for s in range(len(ws) - w + 1):
            key = tuple(ws[s : s + w])
            if key in seen:
                drop[s : s + w] = [True] * w
            seen.add(key)
        kept = b" ".join(x for x, d in zip(ws, drop) if not d)
        out.append((i, len(ws), sum(drop), hashlib.sha256(kept).hexdigest()))
    return in_order(out)


@pytest.mark.parametrize("bucket_bytes", [200, 4_000_000])
@pytest.mark.parametrize("rounds", [0, 2, 6])
def test_repeats(odd_docs, bucket_bytes, rounds):
    p = substring_dedup.RepeatParams(bucket_bytes=bucket_bytes, rounds=rounds)
    found = substring_dedup.repeats(odd_docs, p).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert in_order(tuple(r) for r in found) == brute_repeats(rows_of(odd_docs))


def test_repeats_of_periodic_and_random_texts(spark):
    import random

    r = random.Random(3)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(120))) for _ in range(40)] + ["a " * 70, "a b " * 40, "b a " * 40, "a a b " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substring_dedup.repeats(docs, substring_dedup.RepeatParams(bucket_bytes=300)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert in_order(tuple(x) for x in found) == brute_repeats(rows_of(docs))


def test_removed_text_keeps_its_white_space(spark):
    a, b = sentence(5, 25), sentence(6, 8)
    docs = spark.createDataFrame([(1, a), (2, f"one\ttwo\n{a}\n\nthree  four"), (3, b), (4, a)], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs).collect()}
    assert kept == {1: a, 2: "one\ttwo\n\nthree  four", 3: b}


# --- SimHash ---


def brute_simhash(text):
    ws = (text or "").encode().lower().split()
    parts = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [b" ".join(ws)] if ws else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("block", [2, 32_768])
def test_simhash(odd_docs, block):
    docs = rows_of(odd_docs)
    fp = [brute_simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    expected = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        expected.append((d, f"{fp[i]:016x}", min(ids, default=None)))
    found = simhash.simhash_components(odd_docs, simhash.SimHashParams(block=block)).collect()
    assert in_order(tuple(r) for r in found) == in_order(expected)


def test_trie_walk_finds_all_links():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 12).astype(np.uint64)[r.integers(0, 12, 700)]
    for _ in range(4):
        a = a ^ np.where(r.random(700) < 0.7, np.uint64(1) << r.integers(0, 64, 700).astype(np.uint64), np.uint64(0))
    a = np.unique(a)
    forest = simhash.Forest(len(a))
    i, j = np.nonzero(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    forest.join(i, j)
    p = simhash.SimHashParams(leaf=4, chunk=50)
    assert (simhash.walk(a, None, 0, 0, p) == forest.root).all()
    half = np.uint64(1) << np.uint64(63)
    x, y = a[a < half], a[a < half] | half
    both = simhash.Forest(2 * len(x))
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= 2)
    both.join(i, j + len(x))
    assert (simhash.walk(x, y, 1, 1, p) == both.root).all()


# --- fingerprints ---


def test_fingerprints(odd_docs):
    docs = sorted([r for r in rows_of(odd_docs) if r[0] is not None], key=lambda r: (r[0], r[1] or ""))
    found = merkle.with_next_edit(odd_docs, per_block=2).collect()
    expected = []
    for i, (d, t) in enumerate(docs):
        t, after = t or "", docs[i - 1][1] or ""
        k = len(t) // 3
        expected.append((d, len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest()))
    assert in_order((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found if r["doc_id"] is not None) == in_order(expected)
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    same = {r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}
    assert len(same) == 1 and len({r["fingerprint"] for r in found if r["doc_id"] in (3, 4)}) == 1
    twins = [r for r in found if r["doc_id"] == 2]
    assert all(r["near_next"] == 1.0 for r in twins)


def test_fingerprint_text_holds_the_tree(spark):
    texts = ["a b c\nd e f\n\ng h " + sentence(4, 40), "", "x"]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select(merkle.tree(F.col("t")).alias("tree"))
    for r in d.select("tree", merkle.from_fingerprint(merkle.fingerprint(F.col("tree"))).alias("back")).collect():
        assert r["tree"] == r["back"]


def test_edits_are_located(spark):
    d = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\nX"), ("a\nb", "a\nb"), ("a", "a\nb")], "a string, b string")
    found = [[tuple(x) for x in r[0]] for r in d.select(merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b")))).collect()]
    assert found == [[(1, 1)], [], [(0, 1)]]
    # from two fingerprints alone
    told = lambda c: merkle.from_fingerprint(merkle.fingerprint(merkle.tree(F.col(c))))
    assert [[tuple(x) for x in r[0]] for r in d.select(merkle.edits(told("a"), told("b"))).collect()] == found


def brute_tree(text):
    """The fingerprint and the leaves of a text, in plain Python."""
    out, every = [], []
    sections, roots = text.split("\n\n"), []
    for section in sections:
        digests, told = [], ""
        for p in section.split("\n"):
            digests.append(hashlib.sha256(p.encode()).hexdigest())
            ws = words(p)
            width = 1 if len(ws) < 16 else 4
            leaves = []
            for i in range(0, len(ws), width):
                h = 42
                for w in ws[i : i + width]:
                    h = xxhash.xxh64_intdigest(w, h)
                leaves.append(h & 0xFFFFFF)
            every += leaves
            told += "." + digests[-1][:8] + "".join(f"{x:06x}" for x in leaves)
        roots.append(hashlib.sha256("".join(digests).encode()).hexdigest())
        out.append(roots[-1][:8] + told)
    return hashlib.sha256("".join(roots).encode()).hexdigest() + ":" + "/".join(out), set(every)


def brute_likeness(a, b):
    (fa, x), (fb, y) = brute_tree(a), brute_tree(b)
    return 1.0 if fa.split(":")[0] == fb.split(":")[0] else 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_fingerprints_and_likeness_by_brute_force(spark, odd_docs):
    extra = [(50, "a b\n\n\nc " + sentence(5, 30)), (51, "\n\n"), (52, "a b\n\n\nc " + sentence(5, 30) + "!"), (53, "é 𝔘\x0bx\n" + sentence(5, 30))]
    d = odd_docs.select("doc_id", "text").filter("doc_id IS NOT NULL").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    docs = sorted(rows_of(d), key=lambda r: (r[0], r[1] or ""))
    expected = []
    for i, (k, t) in enumerate(docs):
        t, after = t or "", docs[i - 1][1] or ""
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        expected.append((k, brute_tree(t)[0], brute_tree(edited)[0], brute_likeness(t, edited), brute_likeness(t, after)))
    found = merkle.with_next_edit(d, per_block=3).collect()
    assert in_order((r["doc_id"], r["fingerprint"], r["edited_fingerprint"], pytest.approx(r["near_edited"]), pytest.approx(r["near_next"])) for r in found) == in_order(expected)


# --- quality rules ---


def test_base_counts(odd_docs):
    for r in quality_rules.quality_rules(odd_docs).join(odd_docs.select("doc_id", F.col("text")).distinct(), "doc_id").collect():
        ws = [w.decode() for w in words(r["text"])]
        c = Counter(zip(ws, ws[1:], ws[2:]))
        inside = {k for i in range(len(ws) - 2) if c[tuple(ws[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in (r["text"] or "").split("\n") if x.encode().split()]
        assert (r["n_words"], r["n_repeat_words"], r["word_chars"], r["n_dup_lines"]) == (len(ws), len(inside), sum(map(len, ws)), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(ws) < 50 or 100 * len(inside) > 50 * len(ws))
        assert not (r["base_failed"] and r["kept"])


def brute_fences(rows, params):
    """Fences of every group, from whole sorted columns; rows are the operator's, by their ratios."""
    passed = [r for r in rows if not r["base_failed"]]

    def level(rs):
        def at(m, q):
            x = sorted(r[m] for r in rs)
            return x[max(1, math.ceil(round(q * len(x), 6))) - 1] if x else 0.0

        return len(rs), {(m, k): at(m, q) for m, t in params.tails.items() for k, q in enumerate((1 - t, 0.5, t))}

    shrunk = lambda own, above: {k: (own[0] * v + params.prior * above[k]) / (own[0] + params.prior) for k, v in own[1].items()}
    _, corpus = level(passed)
    out = {}
    for lang, source in {(r["lang"], r["source"]) for r in rows}:
        by_lang = shrunk(level([r for r in passed if r["lang"] == lang]), corpus)
        own = shrunk(level([r for r in passed if (r["lang"], r["source"]) == (lang, source)]), by_lang)
        fence = {}
        for m in params.tails:
            tail, mid = own[m, 2], own[m, 1]
            beyond = 1 - (1 - tail) * ((1 - tail) / max(1 - mid, 1e-12)) ** params.spread if m in quality_rules.SHARES else tail + params.spread * (tail - mid)
            fence[f"{m}_high"] = max(tail, beyond, by_lang[m, 2])
        fence["mean_word_low"] = min(own["mean_word", 0] + params.spread * (own["mean_word", 0] - own["mean_word", 1]), by_lang["mean_word", 0])
        out[lang, source] = fence
    return out


def check_fences(out, params):
    expected = brute_fences(out, params)
    for r in out:
        want = expected[r["lang"], r["source"]]
        assert {k: v for k, v in r["limits"].asDict().items() if k != "n"} == pytest.approx(want)
        within = all(r[m] <= want[f"{m}_high"] * (1 + 1e-9) for m in params.tails) and r["mean_word"] >= want["mean_word_low"] * (1 - 1e-9)
        assert r["kept"] == (within and not r["base_failed"])


def test_thresholds_follow_the_source(spark):
    """Sources have fences of their own, small ones nearer to their language's."""
    marked = lambda i, every, mark: " ".join(w + (mark if k % every == 0 else "") for k, w in enumerate(sentence(i, 80).split()))
    prose = [(i, sentence(i, 80) if i % 10 else marked(i, 40, "#"), "en", "prose") for i in range(120)]
    code = [(200 + i, marked(i, 3, "#") if i % 10 == 0 else sentence(i, 80), "en", "code") for i in range(120)]
    few = [(400 + i, marked(i, 20, "#"), "en", "few") for i in range(20)]
    other = [(600 + i, sentence(i, 60), None, "few") for i in range(5)] + [(700, "short", "de", None)]
    odd = [(500, marked(99, 1, "####"), "en", "prose"), (502, marked(97, 1, "####"), "en", "code")]
    d = spark.createDataFrame(prose + code + few + other + odd, "doc_id long, text string, lang string, source string")
    params = quality_rules.QualityParams(tails=quality_rules.TAILS | {"mean_word": 0.99})
    out = quality_rules.quality_rules(d, params).collect()
    high = {r["source"]: r["limits"]["symbol_ratio_high"] for r in out if r["lang"] == "en"}
    assert high["prose"] < high["code"] and len(set(high.values())) == 3
    assert {500, 502} <= {r["doc_id"] for r in out if not r["kept"]}
    check_fences(out, params)
    salted = quality_rules.quality_rules(d, quality_rules.QualityParams(tails=params.tails, max_broadcast_groups=0))
    assert {r["doc_id"]: r["kept"] for r in salted.collect()} == {r["doc_id"]: r["kept"] for r in out}


def test_each_ratio_has_a_fence_that_fires(spark):
    clean = [(i, "\n".join(sentence(1_000 * i + k, 20) for k in range(6)), "en", "a" if i % 3 else "b") for i in range(300)]
    plain = [sentence(10**6 + k, 20) for k in range(6)]
    planted = {
        900: "\n".join(x.replace(" ", " ## ") for x in plain),  # symbols
        901: "\n".join([*plain, "one two", "one two", "one two"]),  # repeated lines
        902: "\n".join(plain) + " " + " ".join([*plain[0].split()] * 2),  # repeated words
        903: " ".join("x" * 40 for _ in range(3)) + " " + " ".join(f"{w}{w}{w}{w}" for w in " ".join(plain).split()),  # long words
        904: " ".join(chr(97 + k % 26) + chr(97 + k // 26) for k in range(120)),  # short words
    }
    d = spark.createDataFrame(clean + [(k, t, "en", "a") for k, t in planted.items()], "doc_id long, text string, lang string, source string")
    out = quality_rules.quality_rules(d).collect()
    assert set(planted) <= {r["doc_id"] for r in out if not r["kept"]}
    assert sum(not r["kept"] for r in out) <= len(planted) + 6 and not any(r["base_failed"] for r in out)
    check_fences(out, quality_rules.QualityParams())


def test_fences_move_on_with_the_group(spark):
    """Groups of other documents have other fences, however small, and every share's fence is one that a document can exceed."""
    out = quality_rules.quality_rules(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    check_fences(out, quality_rules.QualityParams())
    limits = {(r["lang"], r["source"]): r["limits"] for r in out}
    ratios = {g: (g[0], *sorted(tuple(r[m] for m in quality_rules.TAILS) for r in out if (r["lang"], r["source"]) == g and not r["base_failed"])) for g in limits}
    assert len({tuple(x) for x in limits.values()}) == len(set(ratios.values()))
    assert all(x[f"{m}_high"] < 1 for x in limits.values() for m in quality_rules.SHARES)


def test_repeated_words_by_whole_hashes(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 4, 9, 30, 200)] + ["x " * 50, " ".join(f"w{i}" for i in range(500)) + " w1 w2 w3 w7 w8"]
    d = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for row in quality_rules.text_stats(d).collect():
        ws = texts[row["doc_id"]].split()
        c = Counter(zip(ws, ws[1:], ws[2:]))
        assert row["n_repeat_words"] == len({k for i in range(len(ws) - 2) if c[tuple(ws[i : i + 3])] > 1 for k in (i, i + 1, i + 2)})


# --- mixing ---


def water(sizes, weights):
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        level = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if level[i] > 3 * sizes[i]]
        if not over:
            return fixed | level
        fixed |= {i: 3.0 * sizes[i] for i in over}


def test_mix(spark, odd_docs):
    big = spark.createDataFrame([(1000 + i, sentence(i, 30 + i % 90), "en", f"s{(i * i) % 5 if i % 3 else 9}") for i in range(400)], "doc_id long, text string, lang string, source string")
    docs = big.unionByName(odd_docs.select("doc_id", "text", "lang", "source"))
    p = mixing.MixParams(block=16)
    found = mixing.mix_sources(docs, p).collect()
    assert len(found) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in found)
    sources = sorted({r["source"] for r in found}, key=lambda s: (s is None, s))
    sizes = [sum(r["size"] for r in found if r["source"] == s) for s in sources]
    target = water(sizes, [(1, 2, 3)[i % 3] for i in range(len(sources))])
    for i, s in enumerate(sources):
        own = [r for r in found if r["source"] == s]
        assert own[0]["source_size"] == sizes[i] and own[0]["target"] == pytest.approx(target[i])
        assert abs(sum(r["taken"] for r in own) - target[i]) <= 17
    again = mixing.mix_sources(docs.repartition(7), p).collect()
    assert in_order(tuple(r) for r in again) == in_order(tuple(r) for r in found)
    mixed = mixing.mixed_documents(docs, p).collect()
    assert sum(len(words(r["text"])) for r in mixed) == sum(r["taken"] for r in found)


def test_words_taken_by_brute_force(spark):
    """Every slot read word by word: which document's, in which shard, and the mixed texts."""
    docs = spark.createDataFrame([(i, sentence(i, 5 + i * 37 % 120), "en", "abc"[i * i % 3]) for i in range(120)], "doc_id long, text string, lang string, source string")
    p = mixing.MixParams(block=16, shard_slots=8, docs_per_bucket=10)
    sizes = mixing.word_sizes(docs)
    places, targets = mixing.placed(sizes, p)
    text = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    line = {}
    for r in sorted(places.collect(), key=lambda r: (r["sid"], r["start"])):
        own = line.setdefault(r["sid"], [])
        assert r["start"] == len(own)
        own += [(r["doc_id"], k) for k in range(r["size"])]
    slots = mixing.slots(targets, p).collect()
    n = len(slots)
    assert sorted(r["shard"] * 8 + r["place"] for r in slots) == list(range(n))
    taken, shards, parts = Counter(), {}, {}
    for r in slots:
        assert 0 < r["take"] <= 16
        for i, k in line[r["sid"]][r["block"] * 16 : r["block"] * 16 + r["take"]]:
            taken[i] += 1
            shards.setdefault(i, set()).add(r["shard"])
            parts.setdefault((i, r["pass"]), []).append((k, r["shard"] * 8 + r["place"]))
    found = {r["doc_id"]: (r["taken"], r["shards"], r["first_shard"]) for r in mixing.mix_sources(docs, p).collect()}
    assert found == {i: (taken[i], len(shards.get(i, ())), min(shards[i]) if i in shards else None) for i in text}
    uses = Counter((i, k, n) for (i, n), x in parts.items() for k, _ in x)
    assert max(uses.values()) == 1  # a pass takes no word twice
    out = mixing.mixed_documents(docs, p)
    want = Counter((i, " ".join(text[i][k] for k, _ in sorted(x))) for (i, _), x in parts.items())
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    # a partition has whole shards, in order
    first = {}
    for (i, _), x in parts.items():
        first.setdefault((i, " ".join(text[i][k] for k, _ in sorted(x))), set()).add(min(at for _, at in x))
    for part in out.rdd.glom().collect():
        at = [min(first[r["doc_id"], r["text"]]) // 8 for r in part if len(first[r["doc_id"], r["text"]]) == 1]
        assert at == sorted(at)


def test_shards_are_drawn_at_random(spark):
    """The counts of a source in the shards spread as they do when slots are drawn without choice."""
    targets = spark.createDataFrame([("a", 0, 40_000, 40_000.0), ("b", 1, 10_000, 30_000.0), ("c", 2, 50_000, 30_000.0)], "source string, sid long, source_size long, target double")
    for seed in (7, 8, 9):
        p = mixing.MixParams(block=10, shard_slots=50, seed=seed)
        counts = mixing.shard_counts(mixing.slots(targets, p)).collect()
        total, shards = sum(r["n"] for r in counts), 200
        assert total == 10_000
        for sid, n in ((0, 4_000), (1, 3_000), (2, 3_000)):
            q = n / total
            of = {r["shard"]: r["n"] for r in counts if r["sid"] == sid}
            assert sum(of.values()) == n
            variance = 50 * q * (1 - q) * (total - 50) / (total - 1)
            chi = sum((of.get(k, 0) - 50 * q) ** 2 / variance for k in range(shards))
            assert abs(chi - (shards - 1)) < 5 * math.sqrt(2 * (shards - 1)), (seed, sid, chi)


def test_mixed_rows_keep_their_columns(spark):
    text = sentence(3, 40)
    rows = [(1, text, "en", "a", 1), (1, text, "de", "a", 2), (1, text, None, "b", 3), (1, text, "b", None, 3), (None, text, "fr", "b", 4), (2, text, "en", "a", 1), (2, text, "en", "a", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, hash int")
    out = Counter(tuple(r) for r in mixing.mixed_documents(d, mixing.MixParams(block=8)).collect() if r["text"] == text)
    assert set(out) <= set(rows) and out[1, text, None, "b", 3] <= 3
    whole = mixing.mixed_documents(d, mixing.MixParams(block=8, weights=(1,))).collect()
    assert {(r["doc_id"], r["lang"], r["source"], r["hash"]) for r in whole} == {(r[0], *r[2:]) for r in rows}


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 1000):
        d = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), 16, F.lit(1)).alias("x"))
        assert sorted(r["x"] for r in d.collect()) == list(range(n))


# --- packing ---


def test_packing(odd_docs):
    p = packing.PackParams(capacity=64)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(p.path())
    pieces = []
    for i, t in rows_of(odd_docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        pieces += [(i, k, a, len(ids[a : a + 64]), zlib.crc32(np.array(ids[a : a + 64], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    found = packing.pack(odd_docs, p).collect()
    assert in_order(tuple(r)[:5] for r in found) == in_order(pieces)
    used = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 64
    assert len(used) <= packing.lower_bound(Counter(x[3] for x in pieces), 64) + 1


def exact_bins(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[i]}:
            rest = list(rooms)
            rest[rest.index(r)] = r - lengths[i]
            go(i + 1, rest)
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_as_short_as_can_be(seed):
    import random

    r = random.Random(seed)
    lengths = [r.randrange(5, 60) for _ in range(11)]
    plan = packing.plan(Counter(lengths), packing.PackParams(capacity=100))
    used = Counter()
    for times, filling in plan:
        assert sum(x * k for x, k in filling) <= 100
        for x, k in filling:
            used[x] += k * times
    assert used == Counter(lengths)
    n = sum(t for t, _ in plan)
    assert packing.lower_bound(Counter(lengths), 100) <= exact_bins(lengths, 100) == n


def test_words_forgotten_are_learnt_again():
    ids = packing.WordIds(packing.PackParams().path(), 5)
    whole = packing.WordIds(packing.PackParams().path(), 10_000)
    for i in range(20):
        text = (sentence(i, 40) + ". The end, once. More.. it's; ÉCOLE. naïve,").encode()
        assert ids.of(text) == whole.of(text) == np.array(__import__("tokenizers").Tokenizer.from_file(packing.PackParams().path()).encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


# --- token counts ---


def test_token_counts(odd_docs):
    p = token_counts.CountParams()
    encode = token_counts.Counter(*p.resolved(), 1000).encode
    docs = odd_docs.select("doc_id", "text").distinct()
    found = {(r["doc_id"], r["n_tokens"], r["edited_tokens"]) for r in token_counts.count_with_edits(docs, token_counts.sample_edits(F.col("text"))).collect()}
    expected = set()
    for i, t in rows_of(docs):
        s = t or ""
        n = len(s)
        edited = s
        if t is not None:
            edited = edited[: 3 * n // 4] + s[:32] + edited[3 * n // 4 :]
            edited = edited[: n // 2] + s[n // 2 : n // 2 + 16][::-1] + edited[n // 2 + 16 :]
            edited = edited[: n // 4] + edited[n // 4 + 16 :]
        expected.add((i, len(encode(s)), len(encode(edited))))
    assert {x for x in found if x[0] not in (4, 7, 11, None)} == {x for x in expected if x[0] not in (4, 7, 11, None)}
    assert {x[:2] for x in found} == {x[:2] for x in expected}


def test_edits_count_as_a_whole_count_does():
    import random

    p = token_counts.CountParams()
    counter, r = token_counts.Counter(*p.resolved(), 5000), random.Random(2)
    for text in [sentence(3, 700), "", "a", "'ll  x", "\n\n \t", "é" * 300]:
        tree, s = token_counts.TokenTree(text, counter), text
        for _ in range(60):
            a = r.randint(0, len(s))
            b = min(len(s), a + r.choice([0, 1, 3, 50, 900]))
            new = r.choice(["", " ", "'", "ll", "  x", "é", "\n\n", sentence(r.randrange(9), 30)])
            s = s[:a] + new + s[b:]
            assert tree.edit(a, b, new) == len(counter.encode(s)) and tree.text == s
    long = token_counts.TokenTree(sentence(8, 9000), counter)
    long.edit(20_000, 20_005, "xyz")
    assert long.recounted < 40


# --- toxicity ---


def toxic_table(spark, n=500):
    docs = [(i, sentence(i, 60) + (" you vile grobnak fool" if i % 5 == 0 else "") + " " + sentence(i + 3, 40)) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(n)] + [(None, 1), (n + 5, 0), (3, None)], "doc_id long, toxic int")


def test_toxicity_on_rows_kept_out(spark, odd_docs):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(*toxicity.sample(docs, labels.filter("doc_id % 3 <> 1")))
    rest = toxicity.score(docs.filter("doc_id % 3 = 1"), model).collect()
    right = sum((r["predicted"] == 1) == (r["doc_id"] % 5 == 0) for r in rest)
    assert right / len(rest) > 0.97
    crooked = toxicity.score(odd_docs, model).collect()
    assert len(crooked) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in crooked)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 380 <= kept.count() <= 410


def test_toxicity_without_labels(odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(*toxicity.sample(odd_docs, none)) is None
    assert {(r["score"], r["predicted"]) for r in toxicity.score(odd_docs, None).collect()} == {(0.0, 0)}
    assert toxicity.without_toxic(odd_docs, none).count() == odd_docs.count()


# --- no rows ---


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    results = [
        substring_dedup.repeats(no_docs), substring_dedup.without_repeats(no_docs), simhash.simhash_components(no_docs), simhash.deduplicated(no_docs), merkle.with_next_edit(no_docs), merkle.fingerprints(no_docs), quality_rules.quality_rules(no_docs),
        mixing.mix_sources(no_docs), mixing.mixed_documents(no_docs), packing.pack(no_docs), token_counts.count_with_edits(no_docs, token_counts.sample_edits(F.col("text"))), toxicity.score(no_docs, None), toxicity.without_toxic(no_docs, labels),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_operators_that_return_documents_keep_all_columns(odd_docs):
    for f in (substring_dedup.without_repeats, simhash.deduplicated, mixing.mixed_documents):
        out = f(odd_docs)
        assert out.columns == odd_docs.columns
        assert out.count() > 0
