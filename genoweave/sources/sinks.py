"""Writers of the text formats: each returns lines (value), to be written with DataFrame.write.text, or a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.lineage import cut
from genoweave.operators.hits import light

TAB = "\t"


def combined_gff(genes: DataFrame) -> DataFrame:
    """genome, value: GFF lines with the genome as source and the bare id as attribute."""
    return genes.select("genome", F.concat_ws(TAB, "contig", "genome", F.lit("mRNA"), "lend", "rend", F.lit("."), "strand", F.lit("."), "gene").alias("value"))


def write_by_genome(rows: DataFrame, path: str) -> None:
    """A folder for each genome."""
    rows.write.partitionBy("genome").text(path)


def fasta(seqs: DataFrame, width: int = 60) -> DataFrame:
    """value: a record, its sequence in lines of a width."""
    body = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return seqs.select(*(c for c in ("genome",) if c in seqs.columns), F.concat(F.lit(">"), F.concat_ws(" ", "id", F.nullif("desc", F.lit(""))), F.lit("\n"), body).alias("value"))


def annotation_map(headers: DataFrame) -> DataFrame:
    return headers.select(F.concat_ws(TAB, "transcript", "gene_id", F.coalesce("locus", F.lit("")), F.coalesce("name", F.lit("hypothetical protein"))).alias("value"))


def clusters(rows: DataFrame) -> DataFrame:
    return rows.select("cluster", F.concat_ws(TAB, *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("cluster", "genome", "set", "transcript", "gene", "locus", "annotation"))).alias("value"))


def uniques(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws(TAB, "unique_id", "genome", F.lit("Ortho"), "gene", "gene", F.lit(""), F.coalesce("annotation", F.lit(""))).alias("value"))


def matrix(rows: DataFrame, names: DataFrame, genomes: list[str]) -> DataFrame:
    """cluster, value: id, name and the counts of the genomes."""
    return rows.join(names, "cluster").select("cluster", F.concat_ws(TAB, "cluster", "name", *genomes).alias("value"))


def matrix_header(totals: DataFrame, genomes: list[str]) -> list[str]:
    n = {r["genome"]: r["n"] for r in totals.collect()}  # one row per genome
    return [TAB.join(["#", "totals", *(str(n.get(g, 0)) for g in genomes)]), TAB.join(["#cluster_id", "name", *genomes])]


def markov_matrix(edges: DataFrame) -> DataFrame:
    """value: each node with its neighbours and weights, in order."""
    both = edges.select("a", "b", "w").union(edges.select("b", "a", "w"))
    cell = F.concat(F.col("b").cast("string"), F.lit(":"), F.col("w").cast("string"))
    grouped = both.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("b", cell.alias("c")))).alias("x"))
    return grouped.select("a", F.concat(F.col("a").cast("string"), F.lit(" "), F.array_join(F.transform("x", lambda y: y["c"]), " "), F.lit(" $")).alias("value"))


def markov_clusters(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """value: `CLUSTERn(g genes,t taxa):` and the genes with their taxa. rows: cluster, gene, genome; sizes: backindex."""
    words = rows.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("gene", F.concat(F.col("gene").cast("string"), F.lit("("), "genome", F.lit(")")).alias("w")))).alias("x"))
    return sizes.join(words, "cluster").select("cluster_id", F.concat(F.lit("CLUSTER"), "cluster_id", F.lit("("), "genes", F.lit(" genes,"), "taxa", F.lit(" taxa):\t"), F.array_join(F.transform("x", lambda y: y["w"]), " ")).alias("value"))


def similarities(hits: DataFrame) -> DataFrame:
    """value: numbered similarity rows of the first hit of each pair; a `lot` of the hits goes along."""
    return hits.select(*(c for c in ("lot",) if c in hits.columns), "sim_id", F.concat_ws(";", "sim_id", "q", F.lit(0), "s", F.lit(0), "evalue", F.floor(F.col("pident") + 0.5), F.concat(F.lit("1:"), "qstart", F.lit("-"), "qend", F.lit(":"), "sstart", F.lit("-"), "send")).alias("value"))


def genome_index(genes: DataFrame) -> DataFrame:
    """value: `taxon: gene gene ...`."""
    return genes.groupBy("genome").agg(F.array_join(F.sort_array(F.collect_set(F.col("gene").cast("string"))), " ").alias("g")).select("genome", F.concat("genome", F.lit(": "), "g").alias("value"))


def numbered_ids(genes: DataFrame) -> DataFrame:
    """genome, gene, species (from 0), seq_id `species_n`: ids for an orthogroup program's input."""
    species = F.dense_rank().over(Window.orderBy("genome")) - 1
    listed = genes.select("genome").distinct().withColumn("species", species)
    n = F.row_number().over(Window.partitionBy("genome").orderBy("gene")) - 1
    return genes.join(F.broadcast(listed), "genome").withColumn("seq_id", F.concat_ws("_", "species", n)).select("genome", "gene", "species", "seq_id")


def numbered_hits(hits: DataFrame, ids: DataFrame) -> DataFrame:
    """Hits with both ids replaced."""
    i = light(cut(ids.select("gene", "seq_id")))
    return hits.join(i.toDF("q", "q_id"), "q").join(i.toDF("s", "s_id"), "s").select("q_id", "s_id", "bit")


def hit_pairs(pairs: DataFrame, evalue: str = "1e-50") -> DataFrame:
    """value: `genome:gene genome:gene e-value`, by genome pair."""
    return pairs.select("genome_a", "genome_b", F.concat_ws(TAB, F.concat_ws(":", "genome_a", "gene_a"), F.concat_ws(":", "genome_b", "gene_b"), F.lit(evalue)).alias("value"))


def aligncoords(members: DataFrame) -> DataFrame:
    """One text per chain: its header and its pairs. members: chain keys, n, genes with ends and places, score."""
    from genoweave.operators.synteny import CHAIN

    side = lambda s: [f"genome_{s}", f"contig_{s}", F.concat_ws(":", f"genome_{s}", f"gene_{s}"), f"end5_{s}", f"end3_{s}", f"pos_{s}"]
    line = F.concat_ws(TAB, *side("a"), F.lit("MATCHES"), *side("b"), F.lit("1e-50"), "score")
    grouped = members.groupBy(*CHAIN).agg(F.sort_array(F.collect_list(F.struct("n", line.alias("l")))).alias("x"), F.count(F.lit(1)).alias("k"))
    head = F.concat(F.lit("## alignment "), F.concat_ws(";", "genome_a", "contig_a"), F.lit(" vs. "), F.concat_ws(";", "genome_b", "contig_b"), F.when(F.col("orient") == "-", " (reverse)").otherwise(""), F.lit(" (num aligned pairs: "), "k", F.lit("):"))
    return grouped.select(F.concat_ws("\n", head, F.array_join(F.transform("x", lambda y: y["l"]), "\n")).alias("value"))


def spans(rows: DataFrame) -> DataFrame:
    side = lambda s: [F.concat_ws(";", f"genome_{s}", f"contig_{s}"), F.concat_ws("-", f"left_{s}", f"right_{s}"), f"len_{s}"]
    ratio = F.concat(F.floor(F.col("ratio_pct") / 100), F.lit("."), F.lpad((F.col("ratio_pct") % 100).cast("string"), 2, "0"))
    return rows.select("n_pairs", F.concat_ws(TAB, *side("a"), *side("b"), "orient", "n_pairs", ratio).alias("value"))


def plot_script(primitives: DataFrame) -> DataFrame:
    """value: plotting commands of polygons (ord, x, y, colour)."""
    listed = lambda c: F.concat(F.lit("c("), F.array_join(F.transform(F.col(c), lambda v: v.cast("string")), ", "), F.lit(")"))
    return primitives.select("ord", F.concat(F.lit("polygon("), listed("x"), F.lit(", "), listed("y"), F.lit(', col="'), "colour", F.lit('", border=NA)')).alias("value"))


def svg(primitives: DataFrame, x_scale: float = 1e-3, y_scale: float = 100.0) -> DataFrame:
    """value: an SVG polygon each."""
    points = F.array_join(F.zip_with("x", "y", lambda a, b: F.concat_ws(",", F.round(a * x_scale, 3), F.round(b * y_scale, 3))), " ")
    return primitives.select("ord", F.concat(F.lit('<polygon points="'), points, F.lit('" fill="'), "colour", F.lit('"/>')).alias("value"))


def bar_data(class_sums: DataFrame) -> DataFrame:
    """genome, class, genes of the stacked bars."""
    return class_sums.unpivot(["genome"], ["core", "aux", "unique"], "class", "genes")


def heat_data(matrix_rows: DataFrame, genomes: list[str]) -> DataFrame:
    """The matrix with counts up to 2."""
    return matrix_rows.select("cluster", *(F.least(F.col(g), F.lit(2)).alias(g) for g in genomes))


def run_log(counts: dict[str, int]) -> str:
    return "".join(f"{k}{TAB}{v}\n" for k, v in counts.items())


def cell(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))
