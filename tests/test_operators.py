"""Small cases worked out by hand, and properties."""

import random

import numpy as np
import pytest

from genoweave.operators import clusters, hits, layout, markov, synteny
from genoweave.operators.graph import connected_components
from genoweave.sources import formats, repository


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def hit_table(spark, data):
    return spark.createDataFrame(data, "q long, s long, bit long, genome_q string, genome_s string")


def test_best_hits_keep_ties_and_pairs_are_mutual(spark):
    h = hit_table(spark, [(1, 10, 9, "A", "B"), (1, 11, 9, "A", "B"), (1, 12, 5, "A", "B"), (10, 1, 8, "B", "A"), (11, 2, 9, "B", "A"), (12, 1, 4, "B", "A")])
    best = hits.best_hits(h)
    assert rows(best.select("q", "s")) == [(1, 10), (1, 11), (10, 1), (11, 2), (12, 1)]
    assert rows(hits.reciprocal_best(best)) == [(1, 10, "A", "B", 9)]


def test_better_prefix_puts_own_genome_first_in_a_tie(spark):
    h = hits.ranked(hit_table(spark, [(1, 10, 9, "A", "B"), (1, 2, 9, "A", "A"), (1, 3, 8, "A", "A"), (4, 5, 3, "A", "A")]))
    assert rows(hits.better_prefix(h).select("q", "s")) == [(1, 2), (4, 5)]
    assert rows(hits.best_prefix(h).select("q", "s")) == [(1, 10)]


def test_coorthologs_skip_edges_that_exist(spark):
    e = "a long, b long, genome_a string, genome_b string, weight_sum long"
    ortho = spark.createDataFrame([(1, 10, "A", "B", 9)], e)
    inpara = spark.createDataFrame([(1, 2, "A", "A", 9)], e)
    h = hit_table(spark, [(1, 10, 4, "A", "B"), (10, 1, 5, "B", "A"), (2, 10, 3, "A", "B"), (10, 2, 3, "B", "A"), (2, 11, 3, "A", "B")])
    assert rows(hits.coorthologs(ortho, inpara, h).select("a", "b", "weight_sum")) == [(2, 10, 6)]


def test_inparalogs_need_the_members_best_score(spark):
    h = hit_table(spark, [(1, 2, 9, "A", "A"), (1, 3, 4, "A", "A"), (5, 6, 9, "A", "A")])
    c = spark.createDataFrame([(1, 7)], "gene long, cluster long")
    top = spark.createDataFrame([(1, 5)], "gene long, top_bit long")
    found = hits.inparalog_hits(h, c, top)
    assert rows(found) == [(2, 7, 9)]
    more = spark.createDataFrame([(2, 7, 9), (2, 8, 9), (2, 9, 3)], "gene long, cluster long, bit long")
    assert rows(hits.inparalog_argmax(more)) == [(2, 7, 9)]


def test_interval_coverage_of_nested_overlapping_and_apart(spark):
    d = spark.createDataFrame([("x", 1, 10), ("x", 3, 5), ("x", 8, 14), ("x", 20, 21), ("y", 9, 2)], "k string, a long, b long")
    assert rows(hits.interval_coverage(d, ["k"], "a", "b")) == [("x", 16), ("y", 8)]


def test_match_percent_is_null_without_lengths(spark):
    cov = spark.createDataFrame([(1, 2, 50)], "q long, s long, covered long")
    assert rows(hits.match_percent(cov, cov, spark.createDataFrame([(1, 200), (2, 100)], "id long, n long"))) == [(1, 2, 50.0)]
    assert rows(hits.match_percent(cov, cov, spark.createDataFrame([(1, 0), (2, 100)], "id long, n long"))) == [(1, 2, None)]


def test_unknown_gene_in_code_lookup_is_an_error(spark):
    with pytest.raises(Exception, match="no code"):
        hits.code_lookup(hit_table(spark, [(1, 2, 3, "A", "A")]), spark.createDataFrame([(1, "G001")], "gene long, code string")).collect()


@pytest.mark.parametrize("seed", range(3))
def test_components_do_not_depend_on_the_order_of_edges(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    expected = sorted((x, find(x)) for x in root)
    r.shuffle(edges)
    assert rows(connected_components(spark.createDataFrame(edges, "src long, dst long"))) == expected


def test_components_of_nothing(spark):
    assert rows(connected_components(spark.createDataFrame([], "src long, dst long"))) == []


def test_markov_splits_what_single_linkage_joins(spark):
    clique = lambda xs: [(a, b, 10.0) for a in xs for b in xs if a < b]
    edges = spark.createDataFrame(clique([1, 2, 3, 4]) + clique([5, 6, 7, 8]) + [(4, 5, 0.5)], "a long, b long, w double")
    assert {c for _, c in rows(connected_components(edges, "a", "b"))} == {1}
    assert rows(markov.markov_clusters(edges)) == [(g, 1 if g < 5 else 5) for g in range(1, 9)]
    assert {c for _, c in rows(markov.markov_clusters(edges, task_nodes=2))} <= {1, 5}


def test_markov_columns_sum_to_one(spark):
    edges = spark.createDataFrame([(1, 2, 3.0), (2, 3, 1.0)], "a long, b long, w double")
    sums = markov.one_step(edges).groupBy("j").sum("m").collect()
    assert all(abs(r[1] - 1) < 1e-9 for r in sums)


def brute_chain(x, y, s, p):
    n, best = len(x), 0.0

    def extend(i, total):
        nonlocal best
        best = max(best, total)
        for j in range(n):
            dx, dy = x[j] - x[i] - 1, y[j] - y[i] - 1
            if 0 <= dx <= p.max_distance and 0 <= dy <= p.max_distance:
                gaps = int(max(dx, dy) / p.gap_length + 0.5)
                extend(j, total + s[j] + p.gap_extend * gaps)

    for i in range(n):
        extend(i, s[i])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_the_first_chain_is_the_best(seed):
    r, p = random.Random(seed), synteny.ChainParams(min_score=0.5)
    pts = r.sample([(a, b) for a in range(1, 14) for b in range(1, 14)], 14)
    x, y, s = np.array([a for a, _ in pts]), np.array([b for _, b in pts]), np.full(14, 3.0)
    found = synteny.best_chains(x, y, s, p)
    assert found[0][0] == pytest.approx(brute_chain(x, y, s, p))
    assert sorted(m for _, c in found for m in c) == list(range(14))
    for _, c in found:
        assert all(x[a] < x[b] <= x[a] + 6 and y[a] < y[b] <= y[a] + 6 for a, b in zip(c, c[1:]))


def test_short_chains_go(spark):
    keys = ("A", "c", "B", "d", "+")
    data = [(*keys, 0, i, i) for i in range(3)] + [(*keys, 1, i, i) for i in range(4)]
    d = spark.createDataFrame(data, "genome_a string, contig_a string, genome_b string, contig_b string, orient string, chain long, gene_a long, gene_b long")
    assert {r["chain"] for r in synteny.enough_pairs(d).collect()} == {1}
    assert synteny.ChainParams().least_score() == 6


def test_inverted_run_chains_on_the_reverse_pass(spark):
    data = [("A", "c", "B", "d", i, 10 + i, i, 20 - i) for i in range(1, 6)]
    d = spark.createDataFrame(data, "genome_a string, contig_a string, genome_b string, contig_b string, gene_a long, gene_b long, pos_a long, pos_b long")
    found = synteny.chains(d).collect()
    assert {r["orient"] for r in found if r["chain_score"] > 6} == {"-"} and sum(r["orient"] == "-" for r in found) == 5


def test_noise_filter_breaks_runs_at_gaps_over_five(spark):
    data = [("c", "d", 1, b, 1, pos, 1.0) for b, pos in ((10, 1), (11, 6), (12, 12))]
    d = spark.createDataFrame(data, "contig_a string, contig_b string, gene_a long, gene_b long, pos_a long, pos_b long, evalue double")
    marked = synteny.noise_filter(d)
    assert rows(marked.select("gene_b")) == [(10,), (11,), (12,)]  # each is the only partner of its own gene


def test_flip_twice_is_no_flip(spark):
    d = spark.createDataFrame([("A", "c", "B", "d", 5, 9, 7, 8), ("A", "e", "B", "d", 1, 2, 3, 4)], "genome_a string, contig_a string, genome_b string, contig_b string, start_a long, stop_a long, start_b long, stop_b long")
    flip = spark.createDataFrame([("A", "c", 100), ("B", "d", 50)], "genome string, contig string, len long")
    once = layout.flipped(d, flip)
    assert rows(once)[0][4:] == (91, 95, 42, 43)
    assert rows(layout.flipped(once, flip)) == rows(d)


def test_axis_of_1461000():
    places, shown, unit = layout.axis_ticks(1_461_000)
    assert places[0] == 200_000 and places[-1] == 1_500_000 and unit == "Kb" and shown[-1] == "1500"


def test_distribution_classes(spark):
    g = ["A", "B", "C"]
    m = spark.createDataFrame([(1, 1, 1, 1), (2, 2, 1, 1), (3, 2, 2, 3), (4, 0, 1, 1), (5, 0, 0, 1), (6, 0, 0, 2)], "cluster long, A long, B long, C long")
    found = {r["cluster"]: r["c"] for r in m.select("cluster", clusters.distribution_class(g).alias("c")).collect()}
    assert found == {1: "orthologs", 2: "paralog_in_A", 3: "paralog_in_all", 4: "missing_in_A", 5: "unique_in_C", 6: "missing_in_A_and_B"}


def test_readers_of_crooked_input(spark):
    line = lambda *xs: spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "value string, ord long")
    assert formats.gff(line("# c", "a\tb", "c\ts\tgene\t1\tx\t.\t+\t.\tID=1")).select("start", "stop").collect() == [(1, None)]
    with pytest.raises(Exception, match="not 12 columns"):
        formats.m8(line("a\tb")).collect()
    with pytest.raises(Exception, match="two definitions"):
        formats.enzymes(line("g\t\t\t\t\t\tEC1\t\tx", "g\t\t\t\t\t\tEC1\t\ty")).collect()
    head = formats.fasta_headers(formats.fasta_records(line('t1 gene_id=g locus=l name="a long name" genome=G analysisRun=r\r\nMK\r\nL')))
    assert head.collect() == [("t1", "g", "l", "a long name", "G", "r")]
    block = line("## alignment A vs. B", "A c1 word A:g1 1 2 3 MATCHES B c2 B:g2 5 6 7 e s", "A c1 A:g1 1 2 3 MATCHES B c2 word B:g2 5 6 7 e s")
    assert [tuple(r)[1:] for r in formats.aligncoords(block).collect()] == [("A", "c1", "g1", 1, 2, 3, "B", "c2", "g2", 5, 6)] * 2


def test_example_spans_hold_their_invariants(spark):
    s = formats.spans(spark.createDataFrame([("A;c\t5-14\t10\tB;d\t1-20\t20\t-\t4\t0.50",)], "value string")).first()
    assert s["len_a"] == s["right_a"] - s["left_a"] + 1 and s["ratio"] == s["len_a"] / s["len_b"]


def test_configurations():
    with pytest.raises(ValueError):
        repository.PlotConfig.parse("plot_synteny=x\n").check()
    assert repository.chain_config("[Parameters]\nINCLUDE_SELF_COMPARISONS = FALSE\n")["include_self"] is False


def test_scalars(spark):
    from pyspark.sql import functions as F

    from genoweave.functions import scalars

    one = spark.range(1).select(
        scalars.evalue_score(F.lit(0.0)), scalars.evalue_score(F.lit(1e-5)), scalars.genome_code(F.lit(26)), scalars.genome_number(F.lit("G01a")), scalars.nearest(F.lit(162_333), F.lit(100_000)), scalars.zeros(F.lit(20_000)),
        scalars.base_name(F.lit("a/b/c.x")), scalars.dir_name(F.lit("a/b/c.x")), scalars.end5(F.lit("-"), F.lit(1), F.lit(9)), scalars.end3(F.lit("-"), F.lit(1), F.lit(9)),
    ).first()
    assert tuple(one) == (316.0, 5.0, "G01a", 26, 200_000, 4, "c.x", "a/b", 9, 1)


def test_synteny_end_to_end(spark):
    from genoweave.plans import analyses

    data = [(g, f"c{g}", i + 100 * k, "x", i, 1000 * (i if k == 0 else 13 - i) + 1, 1000 * (i if k == 0 else 13 - i) + 300, "+") for k, g in enumerate("AB") for i in range(1, 13)]
    genes = spark.createDataFrame(data, "genome string, contig string, gene long, annotation string, family long, lend long, rend long, strand string")
    found = analyses.synteny_of(genes.withColumnRenamed("family", "cluster"), genes)
    span = found.spans.collect()
    assert len(span) == 1 and span[0]["orient"] == "-" and span[0]["n_pairs"] == 12
    assert (span[0]["left_a"], span[0]["right_a"], span[0]["len_a"], span[0]["ratio_pct"]) == (1001, 12300, 11300, 100)


def test_training_data_subpackage_is_optional():
    import subprocess
    import sys

    hidden = (
        "import sys, importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'genoweave.llm' or name.startswith('genoweave.llm.') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert 'jn_rbh' in e.queries() and not any(k.startswith('op') for k in e.queries()) and len(e.oracle_sql()) > 100\n"
    )
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", hidden], check=True, cwd=root)
