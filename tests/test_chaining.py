"""Chains over tiles and tasks against the plain programme on whole contig pairs."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from genoweave.operators import chaining, synteny
from genoweave.plans import queries
from genoweave.plans.fixtures import Fixtures
from tests.test_large_inputs import plain_chains

COLUMNS = ["genome_a", "contig_a", "genome_b", "contig_b", "orient", "chain", "chain_score", "n", "gene_a", "gene_b"]
MATCH = "genome_a string, contig_a string, genome_b string, contig_b string, gene_a long, gene_b long, pos_a long, pos_b long, score double"


def brute(matches, p):
    pairs = defaultdict(list)
    for r in matches.select(*COLUMNS[:4], "gene_a", "gene_b", "pos_a", "pos_b", "score").collect():
        pairs[tuple(r)[:4]].append(tuple(r)[4:])
    out = []
    for pair, ms in pairs.items():
        ms.sort()
        top = max(m[3] for m in ms) + 1
        for orient in "+-":
            found = plain_chains([m[2] for m in ms], [m[3] if orient == "+" else top - m[3] for m in ms], [m[4] for m in ms], p)
            out += [(*pair, orient, k, total, n, *ms[m][:2]) for k, (total, chain) in enumerate(found) for n, m in enumerate(chain)]
    return sorted(out)


def random_matches(spark, seed, n, wide):
    r = random.Random(seed)
    rows = {}
    for _ in range(n):
        contig, a, b = r.choice(["1", "2"]), r.randrange(1, wide), r.randrange(1, wide)
        if r.random() < 0.7:
            b = max(1, a + r.choice([-1, 0, 0, 1]) if contig == "1" else wide - a)
        rows["A", contig, "B", "3", a, b, a, b] = r.choice([3.0, 3.0, 5.5])
    return spark.createDataFrame([(*k, s) for k, s in rows.items()], MATCH)


@pytest.mark.parametrize(("seed", "tile", "distance"), [(1, 16, 0), (2, 16, 2), (3, 1024, 5), (4, 20, 5)])
def test_chains_over_tiles(spark, seed, tile, distance):
    p = chaining.ChainParams(tile=tile, max_distance=distance, min_score=3.0)
    m = random_matches(spark, seed, 350, 300)
    assert sorted(tuple(r) for r in chaining.chains(m, p).select(*COLUMNS).collect()) == brute(m, p)


def test_small_tables_of_whole_groups(spark, monkeypatch):
    """Groups stay whole where a task's rows come in many pieces."""
    monkeypatch.setattr(chaining, "_HELD", 3)
    p, m = chaining.ChainParams(tile=16, max_distance=0, min_score=3.0), random_matches(spark, 7, 300, 150)
    assert sorted(tuple(r) for r in chaining.chains(m, p).select(*COLUMNS).collect()) == brute(m, p)


def test_query_against_the_plain_programme(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.QUERIES["gr_dag_chain"](spark, sf_dir).select(*COLUMNS).collect())
    p = chaining.ChainParams()
    assert got and got == brute(synteny.match_scores(queries._filtered(Fixtures(spark, sf_dir)), p), p)


def test_no_matches(spark):
    assert chaining.chains(spark.createDataFrame([], MATCH)).collect() == []


def test_one_pair_of_contigs_is_the_work_of_many_tasks(spark):
    """200,000 matches of one pair: runs of 40 collinear ones between scattered ones; tiles of 1,024 places."""
    n = 200_000
    b = F.when(F.col("id") % 50 < 40, F.col("id")).otherwise((F.col("id") * 7919) % n)
    fixed = [F.lit(v).alias(c) for c, v in zip(COLUMNS, ("A", "1", "B", "2"), strict=False)]
    m = spark.range(n).select(*fixed, F.col("id").alias("gene_a"), b.alias("gene_b"), F.col("id").alias("pos_a"), b.alias("pos_b"), F.lit(3.0).alias("score"))
    rows = chaining.tiled(chaining.oriented(m, chaining.ChainParams()), chaining.ChainParams())
    sizes = rows.groupBy("orient", "tx", "tz").count()
    assert sizes.count() > 10_000 and sizes.agg(F.max("count")).first()[0] < 2_000
    long = chaining.chains(m).filter("orient = '+'").groupBy("chain").agg(F.count(F.lit(1)).alias("n"), F.min("gene_a").alias("g")).filter("n >= 40")
    assert long.count() == n // 50 and long.filter("g % 50 BETWEEN 1 AND 39").count() == 0
