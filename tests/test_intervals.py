"""Intervals of one hot pair: unions by blocks, genes in spans by bins, chains against themselves."""

import random

import numpy as np
from pyspark.sql import functions as F

from genoweave.operators import hits, synteny


def test_union_of_intervals_by_blocks(spark):
    """Blocks so small that most intervals are cut; negative and turned intervals, ties."""
    r = random.Random(4)
    rows = [(r.choice("xy"), a := r.randint(-50, 200), a + r.choice([0, 1, 5, -7, 60])) for _ in range(150)]
    want = {k: len({p for q, a, b in rows if q == k for p in range(min(a, b), max(a, b) + 1)}) for k in "xy"}
    d = spark.createDataFrame(rows, "k string, a long, b long")
    for wide in (1, 3, 16, 1 << 16):
        assert dict(tuple(x) for x in hits.interval_coverage(d, ["k"], "a", "b", wide).collect()) == want


def test_a_pair_with_very_many_intervals_is_many_groups(spark):
    n = 200_000
    d = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 5_000_000).alias("a"), (F.col("id") * 7919 % 5_000_000 + F.col("id") % 40).alias("b"))
    seen = np.zeros(5_000_100, bool)
    for i in range(n):
        a = i * 7919 % 5_000_000
        seen[a : a + i % 40 + 1] = True
    found = hits.interval_coverage(d, ["k"], "a", "b")
    assert found.collect()[0]["covered"] == seen.sum()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan.split("Window")[1].split("\n")[0]  # the window is as large as a block


def test_genes_of_a_pair_with_many_spans(spark):
    """100,000 genes and 20,000 spans on one pair of contigs, against arrays."""
    n, m = 100_000, 20_000
    key = [F.lit(v).alias(c) for c, v in (("genome_a", "A"), ("genome_b", "B"), ("contig_a", "1"), ("contig_b", "2"))]
    pairs = spark.range(n).select(*key, F.col("id").alias("gene_a"), (F.col("id") * 31 % 1_000_003).alias("start_a"), (F.col("id") * 17 % 900_001).alias("start_b"))
    left_a, left_b = F.col("id") * 53 % 1_000_003, F.col("id") * 71 % 900_001
    spans = spark.range(m).select(*key, left_a.alias("left_a"), (left_a + F.col("id") % 97 - 1).alias("right_a"), left_b.alias("left_b"), (left_b + 20_000).alias("right_b"), F.lit(1).alias("grp"))
    got = sorted(r["gene_a"] for r in synteny.genes_in_spans(pairs, spans).collect())
    i, j = np.arange(n), np.arange(m)
    x, y, la, lb = i * 31 % 1_000_003, i * 17 % 900_001, j * 53 % 1_000_003, j * 71 % 900_001
    order = np.argsort(x)
    inside = np.zeros(n, bool)
    for k in range(m):
        a, b = np.searchsorted(x[order], la[k]), np.searchsorted(x[order], la[k] + k % 97 - 1, "right")
        at = order[a:b]
        inside[at[(y[at] >= lb[k]) & (y[at] <= lb[k] + 20_000)]] = True
    assert got == np.flatnonzero(inside).tolist() and len(got) > 500


def test_spans_of_no_width(spark):
    keys = "genome_a string, genome_b string, contig_a string, contig_b string"
    pairs = spark.createDataFrame([("A", "B", "1", "2", 5, 7), ("A", "B", "1", "2", -5, -7)], f"{keys}, start_a long, start_b long")
    spans = lambda rows: spark.createDataFrame(rows, f"{keys}, left_a long, right_a long, left_b long, right_b long")
    assert synteny.genes_in_spans(pairs, spans([])).collect() == []
    assert [r["start_a"] for r in synteny.genes_in_spans(pairs, spans([("A", "B", "1", "2", -5, -5, -9, -7), ("A", "B", "1", "2", 9, 3, 0, 9)])).collect()] == [-5]


def test_chains_of_a_molecule_with_itself(spark):
    keys = "genome_a string, contig_a string, genome_b string, contig_b string, orient string, chain long, gene_a long, gene_b long"
    own = ("A", "1", "A", "1", "+")
    chained = spark.createDataFrame([(*own, 0, 1, 5), (*own, 0, 2, 6), (*own, 1, 1, 3), (*own, 1, 3, 5), (*own, 2, 1, 4), (*own, 2, 5, 2), ("A", "1", "B", "1", "+", 0, 1, 1)], keys)
    places = spark.createDataFrame([(g, 10 * g, 10 * g + 5) for g in range(1, 7)], "gene long, lend long, rend long")
    kept = {(r["genome_b"], r["chain"]) for r in synteny.without_tandem_overlap(chained, places).collect()}
    assert kept == {("A", 0), ("B", 0)}  # 1 repeats a gene, 2 overlaps itself


def test_coorthologs_are_those_of_the_squared_closure(spark):
    """Against all pairs of in-paralogs of the ends of each edge."""
    r = random.Random(9)
    genome = {g: f"G{g % 3}" for g in range(60)}
    bits = {(q, s): r.randint(1, 99) for q in range(60) for s in range(60) if q != s and r.random() < 0.5}
    h = spark.createDataFrame([(q, s, b, genome[q], genome[s]) for (q, s), b in bits.items()], "q long, s long, bit long, genome_q string, genome_s string")
    two = hits.two_way(h)
    mutual = {(a, b): bits[a, b] + bits[b, a] for a, b in bits if a < b and (b, a) in bits}
    assert {(x["a"], x["b"]): x["weight_sum"] for x in two.collect()} == mutual
    pick = lambda same, share: {e for e in sorted(mutual) if (genome[e[0]] == genome[e[1]]) == same and r.random() < share}
    ortho, inpara = pick(False, 0.08), pick(True, 0.15)
    also = {g: {g} for e in ortho for g in e}
    for a, b in inpara:
        also.setdefault(a, set()).add(b)
        also.setdefault(b, set()).add(a)
    want = {(min(x, y), max(x, y)) for a, b in ortho for x in also[a] for y in also[b]} - ortho
    edges = lambda chosen: two.filter(F.concat_ws("-", "a", "b").isin([f"{a}-{b}" for a, b in chosen]))
    got = {(x["a"], x["b"]): x["weight_sum"] for x in hits.coorthologs(edges(ortho), edges(inpara), h).collect()}
    assert got == {e: w for e, w in mutual.items() if e in want and genome[e[0]] != genome[e[1]]} and got


def test_coverage_of_rows_that_lie_together_is_the_same_without_a_table_of_keys(spark):
    r = random.Random(6)
    rows = [(q % 2, q, r.randrange(3), a, a + r.randrange(-30, 60)) for q in range(12) for _ in range(40) for a in [r.randrange(-200, 200)]]
    d = spark.createDataFrame([*rows, *rows[:50]], "lot int, q long, s long, st long, en long")
    plain = hits.interval_coverage(d.drop("lot"), ["q", "s"], "st", "en", 64)
    dealt = hits.interval_coverage(d.repartitionById(2, "lot"), ["lot", "q", "s"], "st", "en", 64)
    assert sorted(map(tuple, dealt.drop("lot").collect())) == sorted(map(tuple, plain.collect()))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Sort [lot") == 1
