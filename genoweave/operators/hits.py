"""Similarity hits: best and reciprocal hits, prefixes of ranked hits, in-paralogs, normalised reciprocal graphs.

Hits are (q, s, bit) with, where taxa matter, genome_q and genome_s; score columns are BIGINT or DOUBLE alike. Every
ranking has a total order, so results do not depend on partitioning. Hits may carry `lot`, a function of q by which they are
dealt (`shared_item_hits`); what is asked of a query or of a pair then finds its rows together and shuffles no hits. Or they
carry `pair_lot`, a function of the lesser of q and s (`shared_item_hits_by_pair`): both directions of a pair then lie together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, IntegerType, LongType, StructField, StructType

from genoweave.functions.scalars import LEAST_EVALUE, genome_code
from genoweave.lineage import cut
from genoweave.operators.holders import dealt, met, parted


def of_query(hits: DataFrame) -> list[str]:
    """The columns that tell a query: q, and its lot in front where hits carry one."""
    return ["lot", "q"] if "lot" in hits.columns else ["q"]


def of_pair(hits: DataFrame) -> list[str]:
    """The columns that tell an ordered pair: q and s, and the lot that hits carry in front."""
    return [*(c for c in ("lot", "pair_lot") if c in hits.columns), "q", "s"]


def lots_of(greatest: int | None) -> tuple[int, int]:
    """How many lots genes up to the greatest are, and how wide: 24 lots or less of few genes, of many genes lots of 2,048, each
    a task, up to 100,000."""
    n = (greatest or 0) + 1
    width = min(max(-(-n // 24), 64), 1 << 11)
    return min(100_000, -(-n // width)), width


def lot_of(gene: str, lots: tuple[int, int]) -> Column:
    """The lot of a gene, by the number and width of lots (`lots_of`)."""
    return F.pmod(F.expr(f"{gene} div {lots[1]}"), F.lit(lots[0])).cast("int")


def dealt_like_hits(rows: DataFrame, lots: tuple[int, int]) -> DataFrame:
    """rows of q (a few each) with the lot of q, sent to where the hits of that lot are: a join on lot and q then moves no hits."""
    return rows.withColumn("lot", lot_of("q", lots)).repartitionById(lots[0], "lot").hint("shuffle_hash")


def pair_lots_of(lots: tuple[int, int]) -> tuple[int, int]:
    """Lots for hits by pair: the full ones are halved, as the first lots have both directions of nearly all pairs of their genes."""
    return (2 * lots[0], lots[1] // 2) if lots[1] >= 1 << 11 else lots


def light(rows: DataFrame, most: int = 4_000_000) -> DataFrame:
    """rows, cut before, to be held against hits where these lie: broadcast if there are at most so many (some hundred MB in an
    executor), else left to a join that shuffles both."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _paired(g: DataType, once: bool):
    """Arrow aggregate of parts of lists (`holders.parted`): q, s, g_q, g_s, shared as lists of equal length; shared is NaN where
    no amount is known."""
    kinds = {"q": LongType(), "s": LongType(), "g_q": g, "g_s": g, "shared": DoubleType()}

    def paired(parts: pa.Array, named: pa.Array) -> dict:
        q, s, amount, known, a, b, names = met(parts, named)
        at = np.flatnonzero(q < s if once else q != s)
        if len(at):
            spans, key = 1, 0
            for c in (q, s, a, b):  # one number of all four, where it has room
                least = int(c[at].min())
                span = int(c[at].max()) - least + 1
                spans, key = spans * span, key * span + (c[at] - least) if spans * span < 1 << 62 else None
                if key is None:
                    break
            at = at[np.lexsort((b[at], a[at], s[at], q[at])) if key is None else np.argsort(key)]
        q, s, a, b, known = q[at], s[at], a[at], b[at], known[at]
        new = np.ones(len(at), bool)
        new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        shared = np.add.reduceat(np.where(known, amount[at], 0.0), first) if len(at) else np.zeros(0)
        if not known.all():
            shared[~np.logical_or.reduceat(known, first)] = np.nan
        told = lambda c: c.to_pylist() if c.null_count else c.to_numpy(zero_copy_only=False)
        of = lambda c: told(names.take(pa.array(c[first])))
        return {"q": q[first], "s": s[first], "g_q": of(a), "g_s": of(b), "shared": shared}

    return F.arrow_udf(paired, StructType([StructField(k, ArrayType(v)) for k, v in kinds.items()]))


def _shared_item_pairs(holdings: DataFrame, lots: int, width: int, wide: int, once: bool, together: int = 64) -> DataFrame:
    """lot, q, s, g_q, g_s, shared: pairs of genes that hold the same items, dealt by the lot of q; once: only those with q < s.

    Lists go packed, a block for each lot from each task that lists the holders (`holders`); how many of these there are grows
    with the lots. In a lot, `together` genes at a time meet the holders of their items, so a task has the pairs of these in memory
    and no table of all its pairs."""
    g, tasks = holdings.schema["g"].dataType, max(min(lots, 96), lots // 24)
    rows = holdings.filter("gene IS NOT NULL AND item IS NOT NULL").repartition(tasks, "item").groupBy("gene", "item", "g").agg(F.sum("x").cast("double").alias("x"))
    rows = rows.withColumn("lot", lot_of("gene", (lots, width))).sortWithinPartitions("item", "gene")
    blocks = rows.mapInArrow(dealt(once), StructType([StructField("lot", IntegerType()), StructField("packed", BinaryType()), StructField("kinds", ArrayType(g))])).withColumn("piece", F.expr("spark_partition_id() div 16")).repartitionById(lots, "lot")  # a lot's lists of some tasks at a time
    parts = blocks.groupBy("lot", "piece").agg(parted(g, together, wide)("packed", "kinds").alias("p"))
    parts = parts.select("lot", F.explode(F.arrays_zip("p.few", "p.base", "p.part", "p.kinds")).alias("p")).select("lot", "p.few", "p.base", "p.part", "p.kinds")
    each = parts.groupBy("lot", "few", "base").agg(_paired(g, once)("part", "kinds").alias("m"))
    held = each.select("lot", F.arrays_zip("m.q", "m.s", "m.g_q", "m.g_s", "m.shared").alias("held"))
    return held.select("lot", F.explode("held").alias("h")).select("lot", "h.q", "h.s", "h.g_q", "h.g_s", F.nanvl("h.shared", F.lit(None).cast("double")).alias("shared"))


def shared_item_hits(holdings: DataFrame, lots: int, width: int, wide: int = 1 << 17) -> DataFrame:
    """lot, q, s, g_q, g_s, shared: pairs of genes that hold the same items; `shared` sums up the lesser amounts. holdings:
    gene (BIGINT), item, x (an amount; those of a gene and item are summed up), g (what goes with the gene).

    A lot is a range of `width` genes (from the `lots`th on, they begin anew). Of an item's holders, in pieces of `wide` genes,
    one copy goes to each lot that has some, and pairs are made and summed there: holders are shuffled, a copy a lot, but no
    pairs, and a task's pairs do not grow with the number of genes."""
    return _shared_item_pairs(holdings, lots, width, wide, False)


def shared_item_hits_by_pair(holdings: DataFrame, lots: int, width: int, wide: int = 1 << 17) -> DataFrame:
    """pair_lot, q, s, g_q, g_s, shared: the rows of shared_item_hits, but both directions of a pair in the lot of its lesser
    gene. A pair is made and summed once and then told both ways, and a lot needs only the holders behind its own: half the
    work and half the copies, where nothing is asked of a query."""
    p = _shared_item_pairs(holdings, lots, width, wide, True)
    way = lambda q, s: F.struct(F.col(q).alias("q"), F.col(s).alias("s"), F.col(f"g_{q}").alias("g_q"), F.col(f"g_{s}").alias("g_s"))
    return p.select(F.col("lot").alias("pair_lot"), F.explode(F.array(way("q", "s"), way("s", "q"))).alias("h"), "shared").select("pair_lot", "h.q", "h.s", "h.g_q", "h.g_s", "shared")


def with_genomes(hits: DataFrame, genes: DataFrame) -> DataFrame:
    """Hits with genome_q and genome_s; a hit of an unknown gene is an error of the input and is dropped."""
    g = genes.select("gene", "genome")
    return hits.join(g.toDF("q", "genome_q"), "q").join(g.toDF("s", "genome_s"), "s")


def code_lookup(hits: DataFrame, codes: DataFrame, q: str = "q", s: str = "s") -> DataFrame:
    """Hits with the codes of both genes (gene, code); a missing gene raises an error. Where hits tell their genes' genomes, codes
    may be of these (genome, code) with q and s the hits' columns of genomes: a few rows, however many genes there are."""
    codes = light(cut(codes))
    joined = hits.join(codes.toDF(q, "code_q"), q, "left").join(codes.toDF(s, "code_s"), s, "left")
    found = F.assert_true(F.col("code_q").isNotNull() & F.col("code_s").isNotNull(), "a hit's gene has no code")
    return joined.withColumn("_ok", found).filter("_ok IS NULL").drop("_ok")


def genome_codes(genes: DataFrame) -> DataFrame:
    """genome, code (G and three hexadecimal digits) by lexical order."""
    n = F.row_number().over(Window.orderBy("genome"))  # one row per genome
    return genes.select("genome").distinct().withColumn("code", genome_code(n))


def without_self(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("q") != F.col("s"))


def within_evalue(hits: DataFrame, most: float, column: str = "evalue") -> DataFrame:
    """Hits up to an e-value; those below the least one are raised to it."""
    return hits.withColumn(column, F.greatest(F.col(column), F.lit(LEAST_EVALUE))).filter(F.col(column) <= most)


def within_cutoffs(hits: DataFrame, evalue: float = 1e-5, identity: float = 0.0, match: float = 0.0) -> DataFrame:
    """Hits within the cutoffs; a match percentage that is unknown passes only a cutoff of 0."""
    return hits.filter((F.col("evalue") <= evalue) & (F.col("pident") >= identity) & (F.coalesce("match", F.lit(0.0)) >= match))


def best_hits(hits: DataFrame) -> DataFrame:
    """Of each query and other genome the hits with the greatest score, ties kept."""
    w = Window.partitionBy(*of_query(hits), "genome_q", "genome_s").orderBy(F.col("bit").desc())
    return hits.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


def both_ways(hits: DataFrame, value: str) -> DataFrame:
    """a < b, genome_a, genome_b, there and back (the values): pairs that hit each other, a hit a direction. The two hits meet
    in one aggregate, so what hits are made of is computed once."""
    up = F.col("q") < F.col("s")
    met = hits.filter("q <> s").groupBy(F.least("q", "s").alias("a"), F.greatest("q", "s").alias("b")).agg(
        F.max(F.when(up, F.col("genome_q"))).alias("genome_a"), F.max(F.when(up, F.col("genome_s"))).alias("genome_b"), F.max(F.when(up, F.col(value))).alias("there"), F.max(F.when(~up, F.col(value))).alias("back"),
    )
    return met.filter("there IS NOT NULL AND back IS NOT NULL")


def reciprocal_best(best: DataFrame) -> DataFrame:
    """a < b, genome_a, genome_b, bit: pairs that are each other's best hits; bit is the greater of both directions."""
    return both_ways(best, "bit").select("a", "b", "genome_a", "genome_b", F.greatest("there", "back").alias("bit"))


def top_ortholog_score(pairs: DataFrame) -> DataFrame:
    """gene, top_bit: the greatest score of a gene's reciprocal pairs with another genome."""
    cross = pairs.filter("genome_a <> genome_b")
    ends = cross.select(F.explode(F.array("a", "b")).alias("gene"), "bit")
    return ends.groupBy("gene").agg(F.max("bit").alias("top_bit"))


def inparalog_hits(hits: DataFrame, clusters: DataFrame, top: DataFrame, lots: tuple[int, int] | None = None) -> DataFrame:
    """gene, cluster, bit: hits within a genome of which exactly one end is clustered, and which score at least that end's
    best ortholog; gene is the end that is in no cluster.

    Hits are held against their query first, with lots, those of the hits, where they lie. Only those of queries in no cluster, and
    those that score as their query's best ortholog, are held against their subject."""
    own = without_self(hits).filter("genome_q = genome_s")
    placed = cut(clusters.select("gene", "cluster").join(top.select("gene", "top_bit"), "gene", "left"))
    queries = placed.toDF("q", "cq", "top_q")
    met = own.join(dealt_like_hits(queries, lots), ["lot", "q"], "left") if lots else own.join(light(queries), "q", "left")
    near = met.filter("cq IS NULL OR bit >= top_q").select("q", "s", "bit", "cq").join(placed.toDF("s", "cs", "top_s"), "s", "left")
    found = near.filter((F.col("cq").isNull() & (F.col("bit") >= F.col("top_s"))) | (F.col("cq").isNotNull() & F.col("cs").isNull()))
    return found.select(F.when(F.col("cq").isNull(), F.col("q")).otherwise(F.col("s")).alias("gene"), F.coalesce("cq", "cs").alias("cluster"), "bit").distinct()


def inparalog_argmax(inparalogs: DataFrame) -> DataFrame:
    """gene, cluster, bit: each in-paralog's best cluster, the smaller on ties."""
    best = inparalogs.groupBy("gene").agg(F.max_by(F.struct("cluster", "bit"), F.struct(F.col("bit"), -F.col("cluster"))).alias("m"))
    return best.select("gene", "m.cluster", "m.bit")


def min_evalue_pair(hits: DataFrame, value: str = "evalue") -> DataFrame:
    """a <= b and the least value of either direction."""
    lot = [c for c in ("pair_lot",) if c in hits.columns]
    return hits.groupBy(*lot, F.least("q", "s").alias("a"), F.greatest("q", "s").alias("b")).agg(F.min(value).alias(value)).drop(*lot)


def ranked(hits: DataFrame) -> DataFrame:
    """hit_rank, hit by hit of a query: score descending, then subject."""
    return hits.withColumn("hit_rank", F.row_number().over(Window.partitionBy(*of_query(hits)).orderBy(F.col("bit").desc(), "s")))


def first_of_pair(hits: DataFrame, order: str = "ord") -> DataFrame:
    """The first row of each ordered pair."""
    w = Window.partitionBy(*of_pair(hits)).orderBy(order)
    return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def query_ranges(hits: DataFrame, number: str = "sim_id") -> DataFrame:
    return hits.groupBy(*of_query(hits)).agg(F.min(number).alias("first_id"), F.max(number).alias("last_id")).drop("lot")


def top_hits(hits: DataFrame, cross: int = 5, within: int = 1_000) -> DataFrame:
    """Of each query and other genome the best `cross` subjects, of the own genome the best `within`.

    A limit on a rank that is a plain number, as the first of the two is, lets tasks drop what is beyond it before the
    shuffle: from a task come at most `within` subjects of a query and genome."""
    w = Window.partitionBy(*of_query(hits), "genome_s").orderBy(F.col("bit").desc(), "s")
    ranked = hits.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= max(cross, within))
    return ranked.filter(F.col("_r") <= F.when(F.col("genome_q") == F.col("genome_s"), within).otherwise(cross)).drop("_r")


def tie_runs(ranked_hits: DataFrame, value: str = "bit") -> DataFrame:
    """run: the number of the run of equal values that a hit of a query is in, from 1."""
    w = Window.partitionBy(*of_query(ranked_hits)).orderBy("hit_rank")
    fresh = F.when(F.col(value) == F.lag(value).over(w), 0).otherwise(1)
    return ranked_hits.withColumn("_f", fresh).withColumn("run", F.sum("_f").over(w).cast("long")).drop("_f")


def best_prefix(ranked_hits: DataFrame, value: str = "bit") -> DataFrame:
    """Of each query and other genome the first hit and those right behind it with the same value."""
    w = Window.partitionBy(*of_query(ranked_hits), "genome_s").orderBy("hit_rank")
    other = ranked_hits.filter("genome_q <> genome_s").withColumn("_first", F.first(value).over(w))
    broken = F.max((F.col(value) != F.col("_first")).cast("int")).over(w)
    return other.withColumn("_b", broken).filter("_b = 0").drop("_b", "_first")


def better_prefix(ranked_hits: DataFrame, value: str = "bit") -> DataFrame:
    """Of each query the hits of its own genome before the first of another; among equal values own ones come first."""
    runs = tie_runs(without_self(ranked_hits), value).withColumn("_foreign", (F.col("genome_q") != F.col("genome_s")).cast("int"))
    w = Window.partitionBy(*of_query(ranked_hits)).orderBy("run", "_foreign", "hit_rank")
    return runs.withColumn("_stop", F.max("_foreign").over(w)).filter("_stop = 0").drop("_stop", "_foreign", "run")


def edge_hits(hits: DataFrame) -> DataFrame:
    """Hits with best (in best_prefix of the hits ranked by score) or better (in better_prefix), and these two marks: found in
    one pass by greatest scores, as a rank by score has the equal ones and the greater ones in front."""
    q, foreign = of_query(hits), F.col("genome_q") != F.col("genome_s")
    top = F.max("bit").over(Window.partitionBy(*q, "genome_s"))
    bar = F.max(F.when(foreign, F.col("bit"))).over(Window.partitionBy(*q))
    seen = without_self(hits).withColumn("_top", top).withColumn("_bar", bar)
    marked = seen.withColumn("best", foreign & (F.col("bit") == F.col("_top"))).withColumn("better", ~foreign & (F.col("_bar").isNull() | (F.col("bit") >= F.col("_bar"))))
    return marked.filter("best OR better").drop("_top", "_bar")


def two_way(hits: DataFrame, value: str = "bit") -> DataFrame:
    """a < b, genome_a, genome_b, weight_sum: pairs that hit each other; the edge's weight is half the sum."""
    return both_ways(hits, value).select("a", "b", "genome_a", "genome_b", (F.col("there") + F.col("back")).alias("weight_sum"))


def coorthologs(orthologs: DataFrame, inparalogs: DataFrame, hits: DataFrame, value: str = "bit", lots: tuple[int, int] | None = None) -> DataFrame:
    """Edges a < b between in-paralogs of the ends of an ortholog edge, where hits go both ways and no edge is yet.

    Only pairs with an in-paralog on one side at least are listed, from distinct (gene, ortholog of it or of its in-paralogs)
    on; an end itself comes in by its edge. Hits are held against these pairs where they lie and before any two hits meet, so of the
    hits no more is shuffled than what may be an edge: with lots, those of the hits, the pairs go to the hits' lots (else see `light`)."""
    own = inparalogs.select(F.col("a").alias("gene"), F.col("b").alias("also")).union(inparalogs.select("b", "a"))
    edges = orthologs.select(F.col("a").alias("gene"), F.col("b").alias("other")).union(orthologs.select("b", "a"))
    moved = own.join(edges, "gene").select(F.col("also").alias("x"), "other").distinct()  # x is an in-paralog of an end
    both_moved = moved.join(own.toDF("other", "y"), "other").select("x", "y")
    pairs = moved.select("x", F.col("other").alias("y")).union(both_moved).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    fresh = cut(pairs.join(orthologs.select("a", "b"), ["a", "b"], "left_anti"))
    cross = hits.filter("genome_q <> genome_s")
    if lots:
        ways = fresh.select(F.explode(F.array(F.struct(F.col("a").alias("q"), F.col("b").alias("s")), F.struct(F.col("b").alias("q"), F.col("a").alias("s")))).alias("p")).select("p.*").distinct()
        near = cross.join(dealt_like_hits(ways, lots), ["lot", "q", "s"], "left_semi")
    else:
        near = cross.withColumn("a", F.least("q", "s")).withColumn("b", F.greatest("q", "s")).join(light(fresh), ["a", "b"], "left_semi")
    return two_way(near.select("q", "s", "genome_q", "genome_s", value), value)


def pair_normaliser(edges: DataFrame) -> DataFrame:
    """genome_a, genome_b (in order), weight_sum, edges of ortholog and co-ortholog edges: their mean weight's parts."""
    return edges.groupBy(F.least("genome_a", "genome_b").alias("genome_a"), F.greatest("genome_a", "genome_b").alias("genome_b")).agg(F.sum("weight_sum").alias("weight_sum"), F.count(F.lit(1)).alias("edges"))


def inparalog_normaliser(inparalogs: DataFrame, orthologs: DataFrame) -> DataFrame:
    """genome, weight_sum, edges: over in-paralog edges that touch a gene with an ortholog; if there are none, over all."""
    genes = orthologs.select(F.explode(F.array("a", "b")).alias("gene")).distinct()
    ga, gb = genes.select(F.col("gene").alias("a"), F.lit(True).alias("_a")), genes.select(F.col("gene").alias("b"), F.lit(True).alias("_b"))
    marked = inparalogs.join(ga, "a", "left").join(gb, "b", "left").withColumn("_t", F.coalesce("_a", "_b", F.lit(False)))
    found = marked.groupBy(F.col("genome_a").alias("genome")).agg(
        F.sum(F.when(F.col("_t"), F.col("weight_sum"))).alias("ws"), F.count_if("_t").alias("n"), F.sum("weight_sum").alias("all_ws"), F.count(F.lit(1)).alias("all_n")
    )
    touched = F.col("n") > 0
    return found.select("genome", F.when(touched, F.col("ws")).otherwise(F.col("all_ws")).alias("weight_sum"), F.when(touched, F.col("n")).otherwise(F.col("all_n")).alias("edges"))


def normalised_graph(orthologs: DataFrame, coortho: DataFrame, inparalogs: DataFrame) -> DataFrame:
    """a < b, w: all edges, each over its taxon pair's (or taxon's) mean weight, to three decimals."""
    cross = orthologs.unionByName(coortho).withColumn("x", F.least("genome_a", "genome_b")).withColumn("y", F.greatest("genome_a", "genome_b"))
    pair = pair_normaliser(cross.select("a", "b", "genome_a", "genome_b", "weight_sum")).toDF("x", "y", "total", "n")
    own = inparalog_normaliser(inparalogs, orthologs).toDF("genome_a", "total", "n")
    ratio = F.floor(F.col("weight_sum") * F.col("n") * 1000 / F.col("total") + 0.5) / 1000
    return cross.join(pair, ["x", "y"]).select("a", "b", ratio.alias("w")).unionByName(inparalogs.join(own, "genome_a").select("a", "b", ratio.alias("w")))


def interval_coverage(hsps: DataFrame, key: list[str], start: str, stop: str, wide: int = 1 << 16) -> DataFrame:
    """key and covered: the length of the union of closed intervals.

    Intervals are cut at the edges of blocks of `wide` places. Of each block the union is found by itself (one row a place
    that an interval begins at, with its farthest end), and unions of blocks, which do not overlap, add up. So a key with
    any number of intervals is the work of as many tasks as it has blocks, and equal starts meet before the shuffle. Rows that carry
    a lot lie together already: they are sorted once, and no table of a lot's keys is kept."""
    together = any(c in key for c in ("lot", "pair_lot"))
    lo, hi = F.least(start, stop).cast("long"), F.greatest(start, stop).cast("long")
    at = lambda x: F.floor(x / wide).cast("long")
    cut_up = hsps.select(*key, lo.alias("_lo"), hi.alias("_hi")).withColumn("_block", F.explode(F.sequence(at(F.col("_lo")), at(F.col("_hi")))))
    begin, end = F.greatest("_lo", F.col("_block") * wide).alias("_lo"), F.least("_hi", (F.col("_block") + 1) * wide - 1).alias("_hi")
    ends = cut_up.select(*key, "_block", begin, end) if together else cut_up.groupBy(*key, "_block", begin).agg(F.max(end).alias("_hi"))
    w = Window.partitionBy(*key, "_block").orderBy("_lo")
    seen = ends.withColumn("_top", F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = F.greatest(F.lit(0), F.col("_hi") - F.greatest(F.col("_lo") - 1, F.coalesce("_top", F.col("_lo") - 1)))
    if not together:
        return seen.groupBy(*key).agg(F.sum(fresh).cast("long").alias("covered"))
    first = F.row_number().over(Window.partitionBy(*key).orderBy("_block", "_lo"))
    summed = seen.withColumn("covered", F.sum(fresh).over(Window.partitionBy(*key)).cast("long")).withColumn("_n", first)
    return summed.filter("_n = 1").select(*key, "covered")


def match_percent(coverage_q: DataFrame, coverage_s: DataFrame, lengths: DataFrame) -> DataFrame:
    """q, s, match: the covered share of the shorter sequence in percent; null where a length is unknown or 0."""
    lq, ls = lengths.toDF("q", "len_q"), lengths.toDF("s", "len_s")
    both = coverage_q.withColumnRenamed("covered", "cq").join(coverage_s.withColumnRenamed("covered", "cs"), ["q", "s"]).join(lq, "q", "left").join(ls, "s", "left")
    shorter_q = F.col("len_q") <= F.col("len_s")
    return both.select("q", "s", (100.0 * F.when(shorter_q, F.col("cq")).otherwise(F.col("cs")) / F.nullif(F.least("len_q", "len_s"), F.lit(0))).alias("match"))


def hsp_identity(hsps: DataFrame) -> DataFrame:
    """q, s, pident (whole percent, by length), hsps: one row for each pair."""
    grouped = hsps.groupBy(*of_pair(hsps)).agg(F.floor(F.sum(F.col("identity") * F.col("length")) / F.sum("length")).cast("long").alias("pident"), F.count(F.lit(1)).alias("hsps"))
    return grouped.drop("lot", "pair_lot")


def orthologous_only(pairs: DataFrame, members: DataFrame, lots: tuple[int, int] | None = None) -> DataFrame:
    """Distinct pairs (q, s) whose genes are in one ortholog list (list, gene); the lists are looked up, not paired out. With lots,
    those of the pairs, a list goes to each lot that has a gene of it, and pairs are held against it where they lie."""
    queries, subjects = members.select(F.col("gene").alias("q"), "list"), members.select(F.col("gene").alias("s"), "list")
    if lots:
        having = queries.select(lot_of("q", lots).alias("lot"), "list").distinct()
        there = having.join(subjects, "list").repartitionById(lots[0], "lot").hint("shuffle_hash")
        listed = pairs.join(dealt_like_hits(queries, lots), ["lot", "q"]).join(there, ["lot", "s", "list"], "left_semi")
    else:
        listed = pairs.join(queries, "q").join(subjects, ["s", "list"], "left_semi")
    return listed.select(*pairs.columns).distinct()


def all_pairs_of_genomes(genomes: DataFrame) -> DataFrame:
    """genome_a, genome_b: every ordered pair of the few genomes, a genome with itself too; the list of comparisons."""
    return genomes.select(F.col("genome").alias("genome_a")).crossJoin(genomes.select(F.col("genome").alias("genome_b")))
