"""Hits from shared items: against brute force, and that what is asked of a query or a pair shuffles no hits."""

import random
from collections import defaultdict

import pytest

from genoweave.lineage import cut
from genoweave.operators import hits
from genoweave.plans import catalogue


@pytest.mark.parametrize(("lots", "width", "wide"), [(1, 64, 1 << 17), (5, 7, 16), (3, 4, 4), (40, 2, 1 << 17)])
def test_shared_items_match_brute_force(spark, lots, width, wide):
    r = random.Random(lots)
    held = {(r.randrange(60), r.randrange(12)): float(r.randrange(1, 50)) for _ in range(250)} | {(-3, 0): 4.0, (10_000, 0): 7.0}
    want = defaultdict(float)
    for (q, i), x in held.items():
        for (s, j), y in held.items():
            if i == j and q != s:
                want[q, s] += min(x, y)
    rows = spark.createDataFrame([(g, i, x, g % 3) for (g, i), x in held.items()], "gene long, item long, x double, g int")
    found = hits.shared_item_hits(rows, lots, width, wide).collect()
    assert {(h["q"], h["s"]): h["shared"] for h in found} == dict(want) and len(found) == len(want)
    assert all(h["g_q"] == h["q"] % 3 and h["g_s"] == h["s"] % 3 for h in found)


@pytest.mark.parametrize(("lots", "width", "wide"), [(1, 64, 1 << 17), (5, 7, 16), (3, 4, 4), (40, 2, 1 << 17)])
def test_hits_by_pair_are_the_same_hits(spark, lots, width, wide):
    r = random.Random(lots)
    held = [(r.randrange(60), r.randrange(12), float(r.randrange(1, 50))) for _ in range(250)] + [(-3, 0, 4.0), (10_000, 0, 7.0), (10_000, 0, 2.0)]  # some gene and item twice
    rows = spark.createDataFrame([(g, i, x, g % 3) for g, i, x in held], "gene long, item long, x double, g int")
    one = [h.asDict() for h in hits.shared_item_hits(rows, lots, width, wide).drop("lot").collect()]
    two = [h.asDict() for h in hits.shared_item_hits_by_pair(rows, lots, width, wide).collect()]
    lot_of = defaultdict(set)
    for h in two:
        lot_of[min(h["q"], h["s"]), max(h["q"], h["s"])].add(h.pop("pair_lot"))
    key = lambda h: (h["q"], h["s"])
    assert sorted(one, key=key) == sorted(two, key=key) and len({key(h) for h in two}) == len(two)
    assert all(len(x) == 1 for x in lot_of.values())


@pytest.mark.parametrize("name", ["agg_min_evalue_pair", "src_blast_parse", "flt_no_self_hit", "flt_evalue", "flt_cutoffs", "flt_genome_restrict", "src_m8_lines", "agg_hsp_identity"])
def test_what_asks_nothing_of_a_query_takes_hits_by_pair(spark, sf_dir, name):
    plan = catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate explode(held")[0]
    assert "Generate explode(array(" in above and "Exchange hashpartitioning" not in above and plan.count("Generate explode(held") == 1


def test_lots_grow_with_the_genes():
    assert [hits.lots_of(m) for m in (None, 0, 14_999, 899_999)] == [(1, 64), (1, 64), (24, 625), (440, 2048)]
    assert hits.lots_of(10**12)[0] == 100_000


def test_full_lots_are_halved_for_pairs():
    assert [hits.pair_lots_of(hits.lots_of(m)) for m in (14_999, 899_999)] == [(24, 625), (880, 1024)]


@pytest.mark.parametrize("name", ["agg_best_hit", "agg_interval_coverage", "agg_hsp_identity", "src_blast_parse", "ddp_hit_pairs", "jn_hit_lookup", "src_bpo", "snk_bpo_gg", "win_tie_runs", "flt_cutoffs", "flt_genome_restrict"])
def test_pairs_are_not_shuffled(spark, sf_dir, name):
    plan = catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate explode(held")[0]
    assert "Generate explode(held" in plan
    assert "Exchange hashpartitioning" not in above and "Exchange rangepartitioning" not in above
    assert plan.count("Generate explode(held") == 1


def test_edge_hits_are_those_of_the_prefixes(spark):
    r = random.Random(3)
    rows = [(q, s, r.choice((5, 6, 7, 40)), f"R{q % 3}", f"R{s % 3}") for q in range(30) for s in range(30) if r.random() < 0.4 and (q % 5 or q % 3 == s % 3)]
    d = spark.createDataFrame(rows, "q long, s long, bit long, genome_q string, genome_s string")
    found, ranked = hits.edge_hits(d).collect(), hits.ranked(d)
    pairs = lambda x: sorted((h["q"], h["s"]) for h in x)
    assert pairs(h for h in found if h["best"]) == pairs(hits.best_prefix(ranked).collect())
    assert pairs(h for h in found if h["better"]) == pairs(hits.better_prefix(ranked).collect())
    assert any(h["best"] for h in found) and any(h["better"] for h in found)


@pytest.mark.parametrize("name", ["src_bpo", "agg_top_ortho_score", "ddp_nonredundant", "flt_no_self_hit", "flt_cutoffs", "flt_genome_restrict"])
def test_a_task_keeps_no_table_of_its_pairs(spark, sf_dir, name):
    plan = catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate explode(held")[0]
    assert "HashAggregate(keys=[lot" not in above and "HashAggregate(keys=[pair_lot" not in above and plan.count("Generate explode(held") == 1


@pytest.mark.parametrize("by_pair", [False, True])
def test_amounts_and_groups_of_any_kind(spark, by_pair):
    r, far = random.Random(9), 1 << 61
    amounts = [None, 0.5, 3.0, -2.0, 40_000.0, 1e300]
    held = {(g, i): r.choice(amounts) for g in [*range(-40, 40, 3), far, -far, far + 1] for i in range(8) if r.random() < 0.5}
    group = lambda g: None if g % 4 == 0 else f"R{g % 3}"
    want = defaultdict(list)
    for (q, i), x in held.items():
        for (s, j), y in held.items():
            if i == j and q != s:
                want[q, s].append(min((v for v in (x, y) if v is not None), default=None))
    rows = spark.createDataFrame([(g, i, x, group(g)) for (g, i), x in held.items()] + [(None, 1, 2.0, "R0"), (1, None, 2.0, "R1")], "gene long, item long, x double, g string")
    found = (hits.shared_item_hits_by_pair if by_pair else hits.shared_item_hits)(rows, 5, 7, 16).collect()
    assert len(found) == len(want) and {(h["q"], h["s"]) for h in found} == set(want)
    for h in found:
        known = [v for v in want[h["q"], h["s"]] if v is not None]
        assert h["shared"] == (pytest.approx(sum(known)) if known else None)
        assert h["g_q"] == group(h["q"]) and h["g_s"] == group(h["s"])


def test_only_the_wanted_genomes_genes_are_paired(spark, sf_dir):
    found = catalogue.queries()["flt_genome_restrict"](spark, sf_dir)
    assert found.columns == ["q", "s", "bit", "genome_q", "genome_s"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode(held")[0], plan.split("Generate explode(held")[1]
    assert "LeftSemi" in below and "LeftSemi" not in above

@pytest.mark.parametrize("name", ["jn_coortholog", "jn_inparalog_rbh", "flt_orthologous", "jn_code_lookup"])
def test_hits_are_held_against_tables_where_they_lie(spark, sf_dir, name, monkeypatch):
    """However many genes there are: nothing is broadcast but rows of genomes, and between the hits and what holds them is no exchange."""
    monkeypatch.setattr(hits, "light", lambda rows, most=0: rows)
    plans = []
    monkeypatch.setattr("genoweave.plans.analyses.cut", lambda d: plans.append(d) or cut(d))
    monkeypatch.setattr(hits, "cut", cut)
    found = catalogue.queries()[name](spark, sf_dir)
    seen = [p for p in (d._jdf.queryExecution().executedPlan().toString() for d in [*plans, found]) if "Generate explode(held" in p]
    if name == "jn_code_lookup":
        assert all(f"code_{x}" in seen[-1] for x in "qs") and "Exchange hashpartitioning(q" not in seen[-1] and "Exchange hashpartitioning(s" not in seen[-1]
        return
    held = [line for line in seen[-1].split("Generate explode(held")[0].splitlines()]
    join = max(i for i, line in enumerate(held) if "ShuffledHashJoin [lot" in line)
    depth = held[join].index("ShuffledHashJoin")
    assert not any("Exchange" in line for line in held[join:] if line.find("Exchange") > depth)


def test_edges_of_hits_alone_need_one_pass(spark, sf_dir, monkeypatch):
    passes = []
    monkeypatch.setattr("genoweave.plans.analyses.hits.coorthologs", lambda *a, **b: passes.append(a))
    for name in ("jn_recip_better", "agg_norm_inpara"):
        assert catalogue.queries()[name](spark, sf_dir).count() and not passes


def test_a_lookup_of_best_hits_makes_hits_once(spark, sf_dir, monkeypatch):
    done = []
    monkeypatch.setattr("genoweave.plans.queries.cut", lambda d: done.append(d) or cut(d))
    plan = catalogue.queries()["jn_hit_lookup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not done and plan.count("Generate explode(held") == 1
