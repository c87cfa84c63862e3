"""Ortholog clusters: counts per genome, classes, names, genes outside clusters, annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators.ranking import global_rank


def genome_counts(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster", "genome").agg(F.count(F.lit(1)).alias("n"))


def genome_totals(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("genome").agg(F.count(F.lit(1)).alias("n"))


def matrix(clusters: DataFrame, genomes: list[str]) -> DataFrame:
    """One row per cluster, one column per genome, counts; genomes is the (sorted) list of the repository's genomes."""
    return clusters.groupBy("cluster").pivot("genome", genomes).count().na.fill(0)


def popular_name(clusters: DataFrame) -> DataFrame:
    """cluster, name: the most frequent annotation, the first by name on ties, with `_` for all but word characters."""
    counted = clusters.groupBy("cluster", "annotation").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cluster").orderBy(F.col("n").desc(), "annotation")
    first = counted.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return first.select("cluster", F.regexp_replace(F.coalesce("annotation", F.lit("hypothetical protein")), "\\W", "_").alias("name"))


def uniques(genes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Genes in no cluster."""
    return genes.join(clusters.select("gene"), "gene", "left_anti")


def numbered_uniques(unique_genes: DataFrame) -> DataFrame:
    """unique_id: uniq_N by gene."""
    return global_rank(unique_genes, ["gene"], "_n").withColumn("unique_id", F.concat(F.lit("uniq_"), "_n")).drop("_n")


def core_aux_unique(counts: DataFrame, n_genomes: int) -> DataFrame:
    """cluster, class: core (in all genomes), unique (in one), aux."""
    present = counts.groupBy("cluster").agg(F.count_if(F.col("n") > 0).alias("k"))
    return present.select("cluster", F.when(F.col("k") == n_genomes, "core").when(F.col("k") == 1, "unique").otherwise("aux").alias("class"))


def class_sums(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """genome, core, aux, unique: genes of each class."""
    return counts.join(classes, "cluster").groupBy("genome").pivot("class", ["core", "aux", "unique"]).agg(F.sum("n")).na.fill(0)


def class_membership(counts: DataFrame, classes: DataFrame) -> DataFrame:
    return counts.filter("n > 0").join(classes, "cluster").select("genome", "class", "cluster").distinct()


def distribution_class(genomes: list[str]) -> Column:
    """The exclusive class of a matrix row."""
    g = sorted(genomes)
    cells = F.array(*(F.struct(F.lit(x).alias("g"), F.col(x).alias("n")) for x in g))
    names = lambda keep: F.array_join(F.transform(F.filter(cells, keep), lambda c: c["g"]), "_and_")
    zeros, ones, many = (F.size(F.filter(cells, k)) for k in (lambda c: c["n"] == 0, lambda c: c["n"] == 1, lambda c: c["n"] > 1))
    return (
        F.when((zeros == len(g) - 1) & (ones == 1), F.concat(F.lit("unique_in_"), names(lambda c: c["n"] == 1)))
        .when(zeros > 0, F.concat(F.lit("missing_in_"), names(lambda c: c["n"] == 0)))
        .when((many > 0) & (ones == 0), F.lit("paralog_in_all"))
        .when(many > 0, F.concat(F.lit("paralog_in_"), names(lambda c: c["n"] > 1)))
        .otherwise(F.lit("orthologs"))
    )


def distribution(matrix_rows: DataFrame, genomes: list[str]) -> DataFrame:
    """class, clusters, genes."""
    total = sum((F.col(g) for g in genomes), F.lit(0))
    return matrix_rows.withColumn("class", distribution_class(genomes)).groupBy("class").agg(F.count(F.lit(1)).alias("clusters"), F.sum(total).alias("genes"))


def missing_per_genome(matrix_rows: DataFrame, genomes: list[str]) -> DataFrame:
    """genome, missing: clusters without a gene of it."""
    cells = matrix_rows.select(F.explode(F.array(*(F.struct(F.lit(g).alias("genome"), F.col(g).alias("n")) for g in genomes))).alias("c")).select("c.*")
    return cells.filter("n = 0").groupBy("genome").agg(F.count(F.lit(1)).alias("missing"))


def reference_view(genes: DataFrame, clusters: DataFrame, genomes: list[str], reference: str) -> DataFrame:
    """Each gene of the reference genome in order of contig and place, with how many genes of each genome its cluster has
    (itself alone if it is in none)."""
    counts = matrix(clusters, genomes)
    own = genes.filter(F.col("genome") == reference).select("gene", "contig", "lend")
    joined = own.join(clusters.select("gene", "cluster"), "gene", "left").join(counts, "cluster", "left")
    cells = [F.coalesce(F.col(g), F.lit(1 if g == reference else 0)).alias(g) for g in genomes]
    return joined.select("gene", "contig", "lend", *cells)


def annotations_of(clusters: DataFrame) -> DataFrame:
    """cluster, annotations: the distinct ones in order."""
    return clusters.groupBy("cluster").agg(F.array_join(F.sort_array(F.collect_set("annotation")), " && ").alias("annotations"))


def with_annotation(clusters: DataFrame, annotation: DataFrame) -> DataFrame:
    return clusters.join(annotation.select("gene", "annotation"), "gene", "left")


def orthologs_of(clusters: DataFrame, genome: str | None = None) -> DataFrame:
    """gene, ortholog, genome: members of a gene's cluster in other genomes (or in one)."""
    other = clusters.select("cluster", F.col("gene").alias("ortholog"), F.col("genome").alias("ortholog_genome"))
    pairs = clusters.select("cluster", "gene", "genome").join(other, "cluster").filter("ortholog_genome <> genome")
    if genome is not None:
        pairs = pairs.filter(F.col("ortholog_genome") == genome)
    return pairs.select("gene", "ortholog", "ortholog_genome")


def genes_and_taxa(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("genes"), F.count_distinct("genome").alias("taxa"))


def id_reconciliation(gff: DataFrame, fasta: DataFrame) -> DataFrame:
    """matched, only_gff, only_fasta: distinct ids (id) of both sides."""
    a, b = gff.select("id").distinct().withColumn("_g", F.lit(1)), fasta.select("id").distinct().withColumn("_f", F.lit(1))
    return a.join(b, "id", "full_outer").agg(F.count_if(F.col("_g").isNotNull() & F.col("_f").isNotNull()).alias("matched"), F.count_if(F.col("_f").isNull()).alias("only_gff"), F.count_if(F.col("_g").isNull()).alias("only_fasta"))


def cluster_pairs(clusters: DataFrame) -> DataFrame:
    """gene_a, gene_b of one cluster, genome_a < genome_b."""
    a = clusters.select("cluster", F.col("genome").alias("genome_a"), F.col("gene").alias("gene_a"))
    b = clusters.select("cluster", F.col("genome").alias("genome_b"), F.col("gene").alias("gene_b"))
    return a.join(b, "cluster").filter("genome_a < genome_b")
