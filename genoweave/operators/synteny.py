"""Synteny: gene positions, match pairs, noise filter, chaining, spans, contig order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators import chaining
from genoweave.operators.chaining import ChainParams, best_chains  # noqa: F401  part of this module's interface


def gene_positions(genes: DataFrame) -> DataFrame:
    """pos: the rank of a gene on its contig by midpoint, from 1."""
    w = Window.partitionBy("genome", "contig").orderBy(F.floor((F.col("lend") + F.col("rend")) / 2), "gene")
    return genes.withColumn("pos", F.row_number().over(w).cast("long"))


def match_features(pairs: DataFrame, positions: DataFrame) -> DataFrame:
    """Pairs (gene_a, gene_b) with genome, contig, pos and ends of both genes, the smaller genome and contig first. Pairs
    of a gene with itself, or without both places, drop out."""
    cols = ["genome", "contig", "pos", "lend", "rend"]
    a = positions.select(F.col("gene").alias("gene_a"), F.struct("gene", *cols).alias("x"))
    b = positions.select(F.col("gene").alias("gene_b"), F.struct("gene", *cols).alias("y"))
    both = pairs.filter("gene_a <> gene_b").join(a, "gene_a").join(b, "gene_b")
    swap = F.struct("y.genome", "y.contig") < F.struct("x.genome", "x.contig")
    ordered = both.withColumn("p", F.when(swap, F.col("y")).otherwise(F.col("x"))).withColumn("q", F.when(swap, F.col("x")).otherwise(F.col("y")))
    rest = [c for c in pairs.columns if c in ("evalue", "cluster")]
    return ordered.select(*rest, *(F.col(f"p.{c}").alias(f"{c}_a") for c in ("gene", *cols)), *(F.col(f"q.{c}").alias(f"{c}_b") for c in ("gene", *cols)))


def noise_filter(matches: DataFrame, distance: int = 5) -> DataFrame:
    """Of each gene's partners on one contig that lie close together the best alone, by e-value, then place; a match
    stays if it is the best from either side."""

    def best(me: str, other: str, flag: str, frame: DataFrame) -> DataFrame:
        line = Window.partitionBy(f"gene_{me}", "contig_a", "contig_b").orderBy(f"pos_{other}", f"gene_{other}")
        gap = F.col(f"pos_{other}") - F.lag(f"pos_{other}").over(line)
        runs = frame.withColumn("_new", F.when(gap <= distance, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(line))
        run = Window.partitionBy(f"gene_{me}", "contig_a", "contig_b", "_run").orderBy("evalue", f"pos_{other}", f"gene_{other}")
        return runs.withColumn(flag, F.row_number().over(run) == 1).drop("_new", "_run")

    marked = best("b", "a", "_b", best("a", "b", "_a", matches))
    return marked.filter("_a OR _b").drop("_a", "_b")


def match_scores(matches: DataFrame, p: ChainParams = ChainParams()) -> DataFrame:
    """score: the constant, or a tenth of the rounded -10 log10 of the e-value, up to the most."""
    if p.constant_match is not None:
        return matches.withColumn("score", F.lit(float(p.constant_match)))
    e = F.greatest(F.col("evalue"), F.lit(1e-250))
    return matches.withColumn("score", F.least(F.lit(float(p.max_match)), F.floor(-10 * F.log10(e) + 0.5) / 10))


def chains(matches: DataFrame, p: ChainParams = ChainParams()) -> DataFrame:
    """The chains of matches, scored first unless they have a score; see chaining.chains."""
    return chaining.chains(matches if "score" in matches.columns else match_scores(matches, p), p)


CHAIN = ["genome_a", "contig_a", "genome_b", "contig_b", "orient", "chain"]


def enough_pairs(chained: DataFrame, least: int = 4) -> DataFrame:
    """Rows of the chains with at least so many pairs."""
    sizes = chained.groupBy(*CHAIN).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).drop("_n")
    return chained.join(sizes, CHAIN, "left_semi")


def without_tandem_overlap(chained: DataFrame, places: DataFrame) -> DataFrame:
    """On one molecule against itself, chains in which a gene repeats or the two extents overlap go. Both are aggregates that
    begin before the shuffle; a chain's genes are never gathered."""
    g = places.select("gene", "lend", "rend")
    same = chained.filter("genome_a = genome_b AND contig_a = contig_b")
    ends = same.join(g.toDF("gene_a", "la", "ra"), "gene_a").join(g.toDF("gene_b", "lb", "rb"), "gene_b")
    crossed = ends.groupBy(*CHAIN).agg(F.min("la").alias("la"), F.max("ra").alias("ra"), F.min("lb").alias("lb"), F.max("rb").alias("rb")).filter("la <= rb AND lb <= ra")
    twice = ends.select(*CHAIN, F.explode(F.array("gene_a", "gene_b")).alias("gene")).groupBy(*CHAIN, "gene").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = chained.join(g.select(F.col("gene").alias("gene_a")), "gene_a", "left_semi").join(g.select(F.col("gene").alias("gene_b")), "gene_b", "left_semi")
    return known.join(crossed.select(*CHAIN).unionByName(twice.select(*CHAIN)).distinct(), CHAIN, "left_anti").select(*chained.columns)


def without_local_inversions(chained: DataFrame, header: str = "header") -> DataFrame:
    return chained.filter(~F.coalesce(F.contains(F.col(header), F.lit("local inversion")), F.lit(False)))


def spans(members: DataFrame, keys: list[str]) -> DataFrame:
    """keys, left and right of both sides, lengths (closed intervals), n_pairs, ratio in hundredths; members have end5 and
    end3 of both genes."""
    return (
        members.groupBy(*keys)
        .agg(
            *(F.min(F.least(f"end5_{s}", f"end3_{s}")).alias(f"left_{s}") for s in "ab"), *(F.max(F.greatest(f"end5_{s}", f"end3_{s}")).alias(f"right_{s}") for s in "ab"), F.count(F.lit(1)).alias("n_pairs")
        )
        .withColumn("len_a", F.col("right_a") - F.col("left_a") + 1)
        .withColumn("len_b", F.col("right_b") - F.col("left_b") + 1)
        .withColumn("ratio_pct", F.floor(100.0 * F.col("len_a") / F.col("len_b") + 0.5).cast("long"))
    )


def symmetric(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs in both directions; columns come as x_a, x_b."""
    swapped = pairs.select(*(F.col(f"{c}_b").alias(f"{c}_a") for c in columns), *(F.col(f"{c}_a").alias(f"{c}_b") for c in columns))
    return pairs.select(*(f"{c}_a" for c in columns), *(f"{c}_b" for c in columns)).unionByName(swapped).distinct()


def last_wins(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """Of each key the row with the greatest order; rows meet before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def contig_order(span_rows: DataFrame, order_a: DataFrame, order_b: DataFrame) -> DataFrame:
    """contig, place (from 1): the contigs of the second genome along the first. A contig goes to the contig of the first
    genome with most aligned length (the earlier on ties), at its first span there; contigs without spans follow in their
    own order. span_rows: contig_a, contig_b, left_a, len_a; the orders: contig, idx."""
    placed = span_rows.join(order_a.select(F.col("contig").alias("contig_a"), F.col("idx").alias("idx_a")), "contig_a")
    sums = placed.groupBy("contig_b", "contig_a", "idx_a").agg(F.sum("len_a").alias("aligned"), F.min("left_a").alias("start"))
    w = Window.partitionBy("contig_b").orderBy(F.col("aligned").desc(), "idx_a")
    best = sums.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    found = best.select(F.col("contig_b").alias("contig"), F.lit(0).alias("late"), F.col("idx_a").alias("k1"), F.col("start").alias("k2"))
    rest = order_b.join(found, "contig", "left_anti").select("contig", F.lit(1).alias("late"), F.col("idx").cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    line = Window.orderBy("late", "k1", "k2", "contig")  # the contigs of one genome
    return found.unionByName(rest).select("contig", F.row_number().over(line).cast("long").alias("place"))


def genes_in_spans(pairs: DataFrame, highlight: DataFrame) -> DataFrame:
    """Pairs whose starts lie in a highlighted span on both axes.

    The first axis is divided in bins as wide as the mean span, so spans, each copied to the bins that it reaches, are three
    times as many rows at most; a pair is in one bin. Contigs and bin are the keys of the join, so a contig pair with many
    spans and genes is the work of many tasks, and a pair meets the spans near it alone."""
    keys = ["genome_a", "genome_b", "contig_a", "contig_b"]
    h = highlight.select(*keys, "left_a", "right_a", "left_b", "right_b").filter("left_a <= right_a AND left_b <= right_b")
    width = h.agg(F.greatest(F.lit(1), F.coalesce(F.avg(F.col("right_a") - F.col("left_a") + 1), F.lit(1)).cast("long")).alias("_w"))
    at = lambda c: F.floor(F.col(c) / F.col("_w")).cast("long")
    copies = h.join(F.broadcast(width)).withColumn("_bin", F.explode(F.sequence(at("left_a"), at("right_a")))).drop("_w")  # one row
    binned = pairs.join(F.broadcast(width)).withColumn("_bin", at("start_a")).alias("p")
    h = copies.alias("h")
    near = [F.col(f"p.{k}") == F.col(f"h.{k}") for k in (*keys, "_bin")]
    inside = F.col("p.start_a").between(F.col("h.left_a"), F.col("h.right_a")) & F.col("p.start_b").between(F.col("h.left_b"), F.col("h.right_b"))
    on = inside
    for k in near:
        on = on & k
    return binned.join(h, on, "left_semi").select(*(f"p.{c}" for c in pairs.columns)).distinct()


def exact_highlight(span_rows: DataFrame, highlight: DataFrame) -> DataFrame:
    """highlighted: whether the same span (genomes, contigs, left and right of the first side) is in the list."""
    keys = ["genome_a", "genome_b", "contig_a", "contig_b", "left_a", "right_a"]
    marks = highlight.select(*keys).distinct().withColumn("_h", F.lit(True))
    return span_rows.join(marks, keys, "left").withColumn("highlighted", F.coalesce("_h", F.lit(False))).drop("_h")
