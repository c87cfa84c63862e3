"""Queries over the text formats: what the writers make of the domain views, the readers read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.operators import clusters, hits, layout, prep
from genoweave.plans.fixtures import FX, GENOMES, Fixtures
from genoweave.lineage import shared_folder
from genoweave.sources import callers, files, formats, repository, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TAB = "\t"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql:
            SQL[f.__name__] = FX + sql
        return f

    return add


def text(x: str):
    return F.lit(x)


def written(fx, rows, order: list, extension: str, header: str | None = None, in_place: bool = False) -> str:
    """The folder, of its own below the shared one, of the files (name, value) that were written."""
    path = f"{shared_folder(fx.spark)}/files-{uuid.uuid4().hex}"
    files.write_lines(rows, path, "name", order, extension, header, in_place)
    return path


# --- repository and configuration ---


def _stanzas(fx):
    notes = fx.contig.groupBy("genome").agg(F.array_join(F.transform(F.sort_array(F.collect_list("contig_idx")), lambda i: F.concat(F.lit("Note n"), i)), "\n").alias("notes"))
    return notes.select(F.concat(F.lit("\nGenome "), "genome", F.lit("\nAnnotation dir/"), "genome", F.lit("_run\nKEGG .\nRNA r_"), "genome", F.lit("\n"), "notes", F.lit("\n")).alias("value"))


@query(
    "SELECT genome, 'Genome' AS attr, genome AS \"values\" FROM fx_genome UNION ALL SELECT genome, 'Annotation', concat('dir/', genome, '_run') FROM fx_genome UNION ALL SELECT genome, 'RNA', concat('r_', genome) FROM fx_genome UNION ALL SELECT genome, 'Note', string_agg(concat('n', contig_idx), ',' ORDER BY contig_idx) FROM fx_contig GROUP BY genome"
)
def src_repo_spec(fx):
    return repository.spec_rows(_stanzas(fx)).select("genome", "attr", F.array_join("values", ",").alias("values"))


@query("SELECT 'genome' AS kind, genome AS value FROM fx_genome UNION ALL SELECT 'type', unnest(['Genome', 'Annotation', 'RNA', 'Note']) UNION ALL SELECT 'note', concat('n', contig_idx) FROM fx_contig WHERE genome = 'R1'")
def src_repo_accessors(fx):
    spec = repository.spec_rows(_stanzas(fx))
    kinds = (("genome", repository.genomes(spec)), ("type", repository.attribute_types(spec, "R1")), ("note", repository.attribute_values(spec, "R1", "Note")))
    parts = [d.toDF("value").select(F.lit(k).alias("kind"), "value") for k, d in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT genome, attr, concat('/repo/', genome, '/', base, '.', ext) AS file FROM (SELECT genome, concat(genome, '_run') AS base, unnest(['Annotation', 'AnnotationBasic', 'GO_file', 'SigP4', 'ARDB_file', 'PEP', 'CDS']) AS attr, unnest(['annotation.gff3', 'annotation', 'annotation.GO', 'SigP4', 'ARDB', 'annotation.pep', 'annotation.cds']) AS ext FROM fx_genome
UNION ALL SELECT genome, genome, 'Genome', 'genome.fa' FROM fx_genome UNION ALL SELECT genome, concat('r_', genome), unnest(['RNA', 'RNA_GFF']), unnest(['rna', 'rna.gff3']) FROM fx_genome)"""
)
def src_file_resolve(fx):
    return repository.file_names(repository.spec_rows(_stanzas(fx)), "/repo").select("genome", "attr", "file")


@query("SELECT concat('/b/', a.genome, '_vs_', b.genome, '.m8') AS hits, concat('/b/', least(a.genome, b.genome), '_vs_', greatest(a.genome, b.genome), '.RBH') AS reciprocal FROM fx_genome a, fx_genome b")
def src_blast_paths(fx):
    p = hits.all_pairs_of_genomes(fx.genome)
    a, b = F.col("genome_a"), F.col("genome_b")
    return p.select(repository.hit_file("/b", a, b).alias("hits"), repository.hit_file("/b", a, b, True).alias("reciprocal"))


@query("SELECT 'constant_match' AS key, '3.0' AS value UNION ALL SELECT 'gap_extend', '-2.0' UNION ALL SELECT 'include_self', 'True' UNION ALL SELECT 'max_distance', '7' UNION ALL SELECT 'min_pairs', '4' UNION ALL SELECT 'noise_distance', '9'")
def src_chain_config(fx):
    read = repository.chain_config("[NoiseFilter]\nBEST_MATCH_AGGREGATE_DIST = 9\n[Parameters]\n# gaps\nGAP_EXTEND = -2\nCONSTANT_MATCH_SCORE = 3\nMAX_DIST_BETWEEN_SYN_PAIRS = 7\nINCLUDE_SELF_COMPARISONS = TRUE\n")
    keys = ["constant_match", "gap_extend", "include_self", "max_distance", "min_pairs", "noise_distance"]
    return fx.spark.createDataFrame([(k, str(read[k])) for k in keys], "key string, value string")


@query("SELECT 'A' AS section, 'x' AS key, '1' AS value UNION ALL SELECT 'A', 'Y', 'two words' UNION ALL SELECT 'B', 'z', ''")
def src_ini(fx):
    read = repository.read_ini("; head\n[A]\n x = 1 \nY='two words'\n# no\n[B]\nz=\n")
    return fx.spark.createDataFrame([(s, k, v) for s, d in read.items() for k, v in d.items()], "section string, key string, value string")


def _plot(fx):
    contigs = fx.contig.orderBy("contig_idx").collect()  # the contigs of the figure
    orders = {g: [r["contig"] for r in contigs if r["genome"] == g] for g in GENOMES}
    return repository.default_plot_config(GENOMES, orders, {g: {r["contig"]: r["len"] for r in contigs if r["genome"] == g} for g in GENOMES})


@query("SELECT concat('contig_order_', genome) AS key, string_agg(contig, ',' ORDER BY contig_idx) AS value FROM fx_contig GROUP BY genome UNION ALL SELECT 'genome_order', 'R0,R1,R2,R3,R4'")
def src_plot_config(fx):
    read = repository.PlotConfig.parse(_plot(fx).text()).check()
    return fx.spark.createDataFrame([(k, v) for k, v in read.values.items() if k.startswith("contig_order_") or k == "genome_order"], "key string, value string")


@query("SELECT concat('genome_contig_lengths_', genome) AS key, contig AS subkey, len::VARCHAR AS value FROM fx_contig")
def snk_config(fx):
    read = repository.PlotConfig.parse(_plot(fx).text())
    return fx.spark.createDataFrame([(k, s, v) for k, d in read.nested.items() for s, v in d.items()], "key string, subkey string, value string")


# --- genes and sequences ---


def _gff(fx, genome: str | None = None):
    rows = sinks.combined_gff(fx.gene if genome is None else fx.gene.filter(F.col("genome") == genome))
    return rows.withColumn("ord", F.monotonically_increasing_id())


@query("SELECT genome, concat_ws(chr(9), contig, genome, 'mRNA', lend, rend, '.', strand, '.', gene) AS value FROM fx_gene")
def snk_combined_gff(fx):
    return sinks.combined_gff(fx.gene)


@query("SELECT genome, count(*) AS n, sum(rend - lend)::BIGINT AS total FROM fx_gene GROUP BY genome")
def snk_split_gff(fx):
    path = written(fx, sinks.combined_gff(fx.gene).withColumnRenamed("genome", "name"), ["value"], "gff", "##gff-version 3")
    read = files.read(fx.spark, "gff", path)
    return read.groupBy("genome").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("stop") - F.col("start")).alias("total"))


@query("SELECT contig, gene::VARCHAR AS gene, strand, concat(lend, '-', rend) AS spans FROM fx_gene")
def src_gff(fx):
    path = written(fx, sinks.combined_gff(fx.gene).withColumnRenamed("genome", "name"), ["value"], "gff")
    return formats.contig_genes(files.read(fx.spark, "gff", path))


@query("SELECT gene::VARCHAR AS gene, contig, lend AS start FROM fx_gene WHERE genome IN ('R1', 'R3')")
def src_gff_genomes(fx):
    path = written(fx, sinks.combined_gff(fx.gene).withColumnRenamed("genome", "name"), ["value"], "gff")
    return files.read(fx.spark, "gff", path).filter(F.col("genome").isin("R1", "R3")).select(F.col("attributes").alias("gene"), "contig", "start")


@query("SELECT concat('R1:', gene) AS gene_id, concat('R1;', contig) AS org_mol, (lend + rend) // 2 AS mid, CASE strand WHEN '+' THEN lend ELSE rend END AS end5, CASE strand WHEN '+' THEN rend ELSE lend END AS end3, strand AS orient FROM fx_gene WHERE genome = 'R1'")
def src_gene_struct(fx):
    return formats.gene_structs(_gff(fx, "R1"), "R1").select("gene_id", "org_mol", "mid", "end5", "end3", "orient")


@query("SELECT CASE WHEN gene % 2 = 0 THEN concat('a', gene) ELSE concat('i', gene) END AS gene_id, CASE WHEN gene % 2 = 0 THEN concat('i', gene) END AS locus, CASE WHEN gene % 5 = 0 THEN 'hypothetical protein' ELSE annotation END AS name, contig, lend AS start FROM fx_gene WHERE gene % 7 <> 0")
def src_gff_annot(fx):
    g = fx.gene
    attrs = F.concat(F.lit("ID=i"), "gene", F.when(F.col("gene") % 5 != 0, F.concat(F.lit(";Name="), "annotation")).otherwise(""), F.when(F.col("gene") % 2 == 0, F.concat(F.lit(";Alias=a"), "gene")).otherwise(""))
    kind = F.when(F.col("gene") % 7 == 0, "exon").otherwise("gene")
    return formats.gene_annotations(g.select(F.concat_ws(TAB, "contig", text("src"), kind, "lend", "rend", text("."), "strand", text("."), attrs).alias("value")))


@query("SELECT gene::VARCHAR AS gene, genome, concat('G', printf('%03x', r)) AS code FROM fx_gene JOIN (SELECT genome, row_number() OVER (ORDER BY genome) AS r FROM fx_genome) USING (genome)")
def src_genome_codes(fx):
    g = formats.gene_genomes(_gff(fx))
    return g.join(F.broadcast(hits.genome_codes(g)), "genome").select("gene", "genome", "code")  # a row for each genome


_SEQ = ", sq AS (SELECT p_partkey AS k, concat('p', p_partkey) AS id, p_name AS \"desc\", repeat(upper(replace(replace(p_type, ' ', ''), '#', '')), 1 + (p_partkey % 9)::INTEGER) AS seq FROM part) "


def _seqs(fx):
    p = fx.table("part")
    seq = F.expr("repeat(upper(replace(replace(p_type, ' ', ''), '#', '')), cast(1 + p_partkey % 9 as int))")
    return p.select(F.col("p_partkey").alias("ord"), F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("desc"), seq.alias("seq"))


def _records(fx):
    return sinks.fasta(_seqs(fx).drop("ord"), 20).select(F.substr("value", F.lit(2)).alias("value")).withColumn("ord", F.regexp_extract("value", "^p(\\d+)", 1).cast("long"))


@query(_SEQ + 'SELECT id, "desc", seq FROM sq')
def src_fasta(fx):
    path = written(fx, sinks.fasta(_seqs(fx).drop("ord"), 20).withColumn("name", F.lit("parts")), ["value"], "fa")
    return files.read(fx.spark, "fasta", path, splitBytes=100_000).select("id", "desc", "seq")


@query(_SEQ + "SELECT id, length(seq) AS length FROM sq")
def src_fasta_lengths(fx):
    return formats.fasta_lengths(formats.fasta_records(_records(fx)))


@query(_SEQ + "SELECT sum(length(seq))::BIGINT AS total FROM sq")
def src_fasta_total(fx):
    return formats.fasta_total(formats.fasta_records(_records(fx)))


@query(_SEQ + "SELECT id, row_number() OVER (ORDER BY k) AS place FROM sq")
def src_fasta_order(fx):
    return formats.fasta_order(formats.fasta_records(_records(fx)))


def _headed(fx):
    g = fx.gene
    cell = lambda p: F.concat(F.lit(p), "gene")
    head = prep.fasta_header(cell("t"), cell("g"), cell("l"), F.concat("annotation", F.lit(" like")), F.col("genome"), F.concat(F.lit("run_"), "genome"))
    return g.select("genome", F.substring_index(head, " ", 1).alias("id"), F.regexp_replace(head, "^\\S+ ", "").alias("desc"), F.lit("MK").alias("seq"))


@query("SELECT concat('t', gene) AS transcript, concat('g', gene) AS gene_id, concat('l', gene) AS locus, concat(annotation, ' like') AS name, genome, concat('run_', genome) AS analysis_run FROM fx_gene")
def src_fasta_broad(fx):
    return formats.fasta_headers(_headed(fx))


@query("SELECT genome, count(*) AS n FROM fx_gene GROUP BY genome")
def snk_split_fasta(fx):
    path = written(fx, sinks.fasta(_headed(fx)).withColumnRenamed("genome", "name"), ["value"], "fa")
    return formats.fasta_headers(files.read(fx.spark, "fasta", path)).groupBy("genome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT concat_ws(chr(9), concat('t', gene), concat('g', gene), concat('l', gene), concat(annotation, ' like')) AS value FROM fx_gene")
def snk_annotation_map(fx):
    return sinks.annotation_map(formats.fasta_headers(_headed(fx)))


@query("SELECT concat_ws(chr(9), contig, '.', 'mRNA', lend, rend, '.', strand, '.', concat('ID=XP_', gene)) AS value FROM fx_gene WHERE gene % 3 <> 1 AND gene % 4 <> 0")
def src_ncbi_feature_table(fx):
    kind = F.when(F.col("gene") % 3 == 1, "gene").otherwise("CDS")
    acc = F.when(F.col("gene") % 4 == 0, "").otherwise(F.concat(F.lit("XP_"), "gene"))
    e = text("")
    return formats.feature_table(fx.gene.select(F.concat_ws(TAB, kind, e, e, e, e, e, "contig", "lend", "rend", "strand", acc, e, e, e, e, e, e, e, e, e).alias("value")))


@query("SELECT concat('XP_', gene) AS id, annotation AS note FROM fx_gene WHERE gene % 4 <> 0")
def src_ncbi_fasta(fx):
    desc = F.when(F.col("gene") % 4 == 0, F.col("annotation")).otherwise(F.concat("annotation", F.lit(" [protein_id=XP_"), "gene", F.lit("]")))
    rows = fx.gene.select(F.concat(F.lit("lcl|"), "gene").alias("id"), desc.alias("desc"))
    return formats.protein_records(rows).select("id", F.regexp_extract("desc", "^(\\S+)", 1).alias("note"))


# --- hits ---


def _m8_files(fx):
    name = F.concat_ws("_vs_", "genome_q", "genome_s").alias("name")
    return written(fx, _m8(fx, name, "bit", "q", "s"), ["bit", "q", "s"], "m8", in_place=True)  # lines that are alike pack best


def _m8(fx, *more):
    cells = ["q", "s", (F.col("bit") % 100).cast("int"), *(F.lit(x) for x in (90, 1, 2)), F.lit(3), (F.col("bit") + 3), F.lit(5), (F.col("bit") + 5), F.concat(F.lit("e-"), "bit"), "bit"]
    return fx.pair_hit.select(*more, F.concat_ws(TAB, *cells).alias("value"))


@query("SELECT q::VARCHAR AS query, s::VARCHAR AS subject, (bit % 100)::DOUBLE AS pident, bit + 3 AS qend, bit::DOUBLE AS bitscore, bit AS minus_log FROM fx_hit")
def src_m8(fx):
    read = files.read(fx.spark, "m8", _m8_files(fx))
    return read.select("query", "subject", "pident", "qend", "bitscore", F.round(-F.log10("evalue")).cast("long").alias("minus_log"))


@query("SELECT q::VARCHAR AS query, s::VARCHAR AS subject, bit::DOUBLE AS bitscore FROM fx_hit WHERE genome_q = 'R0' AND genome_s = 'R1' AND bit >= 60")
def src_m8_pair(fx):
    read = files.read(fx.spark, "m8", _m8_files(fx)).filter("genome_a = 'R0' AND genome_b = 'R1' AND bitscore >= 60")
    return read.select("query", "subject", "bitscore")


@query("SELECT q::VARCHAR AS query, s::VARCHAR AS subject, bit::DOUBLE AS bitscore FROM fx_hit WHERE genome_q = 'R0'")
def src_m8_lines(fx):
    return formats.m8(_m8(fx, "genome_q").filter("genome_q = 'R0'")).select("query", "subject", "bitscore")


@query("SELECT bit, bit AS minus_log FROM (SELECT DISTINCT bit FROM fx_hit)")
def src_numeric_pvalue(fx):
    e = formats.numeric_evalue(F.concat(F.lit("e-"), "bit"))
    return fx.pair_hit.select("bit").distinct().select("bit", F.round(-F.log10(e)).cast("long").alias("minus_log"))


def _similar(fx):
    numbered = hits.ranked(fx.hit).withColumn("sim_id", F.col("q") * 100000 + F.col("hit_rank"))
    return sinks.similarities(numbered.select("lot", "sim_id", "q", "s", F.concat(F.lit("2e-"), "bit").alias("evalue"), (F.col("bit") % 100 + 0.5).alias("pident"), F.lit(1).alias("qstart"), F.col("bit").alias("qend"), F.lit(2).alias("sstart"), (F.col("bit") + 1).alias("send")))


@query("SELECT q::VARCHAR AS query, s::VARCHAR AS subject, bit % 100 + 1 AS pident, 2::DOUBLE AS mantissa, -bit AS exponent, bit AS qe, bit + 1 AS se FROM fx_hit")
def src_bpo(fx):
    return formats.bpo(_similar(fx)).select("query", "subject", "pident", "mantissa", "exponent", F.col("hsps")[0]["qe"].alias("qe"), F.col("hsps")[0]["se"].alias("se"))


@query("SELECT q * 100000 + row_number() OVER (PARTITION BY q ORDER BY bit DESC, s) AS sim_id, concat(q, ';0;', s, ';0;2e-', bit) AS head FROM fx_hit")
def snk_bpo_gg(fx):
    return _similar(fx).select("sim_id", F.regexp_extract("value", "^[^;]*;(.*?;0;.*?;0;[^;]*);", 1).alias("head"))


@query("SELECT q, s, floor(sum((40 + k * 15) * (20 + k)) / sum(20 + k))::BIGINT AS pident, count(*) AS hsps FROM fx_hit, (SELECT unnest(range(0, 4)) AS k) WHERE bit > 10 AND (q + s + k) % 3 > 0 GROUP BY q, s")
def src_blast_parse(fx):
    k = fx.pair_hit.filter("bit > 10").withColumn("k", F.explode(F.array(*map(F.lit, range(4))))).filter("(q + s + k) % 3 > 0")
    return hits.hsp_identity(k.select("pair_lot", "q", "s", (40 + F.col("k") * 15).alias("identity"), (20 + F.col("k")).alias("length")))


@query("SELECT genome AS taxon, gene::VARCHAR AS gene FROM fx_gene")
def src_gg(fx):
    return formats.gg(sinks.genome_index(fx.gene).select(F.regexp_replace("value", "^(R\\d)", "$1(12)").alias("value")))


@query("SELECT genome, gene, (row_number() OVER (PARTITION BY genome ORDER BY gene) - 1)::VARCHAR AS n, substr(genome, 2) AS species FROM fx_gene")
def snk_orthofinder_in(fx):
    return sinks.numbered_ids(fx.gene).select("genome", "gene", F.split_part("seq_id", F.lit("_"), F.lit(2)).alias("n"), F.col("species").cast("string").alias("species"))


@query(", i AS (SELECT gene, concat(substr(genome, 2), '_', row_number() OVER (PARTITION BY genome ORDER BY gene) - 1) AS id FROM fx_gene) SELECT x.id AS q_id, y.id AS s_id, bit FROM fx_hit JOIN i x ON q = x.gene JOIN i y ON s = y.gene")
def jn_seqid_lookup(fx):
    return sinks.numbered_hits(fx.hit, sinks.numbered_ids(fx.gene))


# --- clusters ---


def _sevens(fx):
    return fx.cluster.select("cluster", "genome", F.lit("Ortho").alias("set"), F.col("gene").alias("transcript"), "gene", F.lit(None).cast("string").alias("locus"), "annotation")


@query("SELECT cluster, concat_ws(chr(9), cluster, genome, 'Ortho', gene, gene, '', annotation) AS value FROM fx_cluster")
def snk_clusters(fx):
    return sinks.clusters(_sevens(fx))


@query("SELECT cluster::VARCHAR AS cluster, genome, gene::VARCHAR AS gene, annotation FROM fx_cluster")
def src_clusters_rbh(fx):
    lines = _sevens(fx).select(F.concat_ws(TAB, "cluster", "set", "genome", "transcript", "gene", F.coalesce("locus", F.lit("")), "annotation").alias("value"))
    return formats.cluster_rows(lines.union(fx.spark.range(3).select(F.lit(" ")))).select("cluster", "genome", "gene", "annotation")


def _sizes(fx):
    return clusters.genes_and_taxa(fx.cluster).withColumn("cluster_id", F.col("cluster"))


@query("SELECT cluster AS cluster_id, concat('CLUSTER', cluster, '(', count(*), ' genes,', count(DISTINCT genome), ' taxa):', chr(9), string_agg(concat(gene, '(', genome, ')'), ' ' ORDER BY gene)) AS value FROM fx_cluster GROUP BY cluster")
def snk_omcl_out(fx):
    rows = sinks.markov_clusters(fx.cluster, _sizes(fx)).withColumn("name", F.lit("all_orthomcl"))
    read = files.read(fx.spark, "lines", written(fx, rows, ["cluster_id"], "out"), extension="out")
    return read.select(F.regexp_extract("value", "^CLUSTER(\\d+)", 1).cast("long").alias("cluster_id"), "value")


@query("SELECT cluster, genome AS code, gene::VARCHAR AS gene, (count(*) OVER (PARTITION BY cluster))::BIGINT AS genes FROM fx_cluster")
def src_clusters_omcl(fx):
    return formats.markov_cluster_lines(sinks.markov_clusters(fx.cluster, _sizes(fx))).select("cluster", "code", "gene", "genes")


@query("SELECT cluster, genome, gene::VARCHAR AS gene FROM fx_cluster")
def src_clusters_orthofinder(fx):
    wide = fx.cluster.groupBy(F.concat(F.lit("OG000"), "cluster").alias("og")).pivot("genome", GENOMES).agg(F.array_join(F.collect_list("gene"), ", "))
    renamed = wide.toDF("og", *(f"{g}.pep" for g in GENOMES))
    return formats.wide_clusters(renamed.toDF("og", *(f"{g}_pep" for g in GENOMES)), {f"{g}_pep": g for g in GENOMES}, "og")


@query("SELECT cluster::VARCHAR AS cluster, genome, gene::VARCHAR AS gene, caller FROM fx_cluster, (SELECT unnest(['RBH', 'OMCL', 'Orthofinder']) AS caller)")
def src_clusters_called(fx):
    """One schema of clusters from the files of three programs."""
    seven = _sevens(fx).select(F.lit("rbh").alias("name"), F.concat_ws(TAB, "cluster", "set", "genome", "transcript", "gene", F.coalesce("locus", F.lit("")), "annotation").alias("value"))
    graph = sinks.markov_clusters(fx.cluster, _sizes(fx)).select(F.lit("all_orthomcl").alias("name"), "value")
    wide = fx.cluster.groupBy("cluster").pivot("genome", GENOMES).agg(F.array_join(F.sort_array(F.collect_list("gene")), ", "))
    table = wide.select(F.lit("Orthogroups").alias("name"), F.concat_ws(TAB, F.concat(F.lit("OG"), "cluster"), *(F.coalesce(F.col(g), F.lit("")) for g in GENOMES)).alias("value"))
    made = {"RBH": written(fx, seven, ["value"], "txt"), "OMCL": written(fx, graph, ["value"], "out"), "Orthofinder": written(fx, table, ["value"], "csv", TAB.join(["", *(f"{g}.pep" for g in GENOMES)]))}
    read = [callers.read_clusters(fx.spark, k, p).select("cluster", "genome", "gene", F.lit(k).alias("caller")) for k, p in made.items()]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query("SELECT concat_ws(chr(9), concat('uniq_', row_number() OVER (ORDER BY gene)), genome, 'Ortho', gene, gene, '', annotation) AS value FROM fx_gene WHERE gene NOT IN (SELECT gene FROM fx_cc)")
def snk_uniques(fx):
    return sinks.uniques(clusters.numbered_uniques(clusters.uniques(fx.gene, fx.components)))


@query(
    "SELECT cluster, concat_ws(chr(9), cluster, regexp_replace(annotation, '\\W', '_', 'g'), R0, R1, R2, R3, R4) AS value FROM (SELECT cluster, annotation, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, annotation) AS r FROM fx_cluster GROUP BY cluster, annotation) JOIN fx_matrix USING (cluster) WHERE r = 1"
)
def snk_matrix(fx):
    rows = sinks.matrix(fx.matrix, clusters.popular_name(fx.cluster), GENOMES).withColumn("name", F.lit("matrix"))
    head = "\n".join(sinks.matrix_header(clusters.genome_totals(fx.cluster), GENOMES))
    read = files.read(fx.spark, "lines", written(fx, rows, ["cluster"], "txt", head))
    return read.select(formats.number(formats.field(0)).alias("cluster"), "value")


@query("SELECT a, concat(a, ' ', string_agg(concat(b, ':', bit), ' ' ORDER BY b), ' $') AS value FROM (SELECT a, b, bit FROM fx_rbh UNION ALL SELECT b, a, bit FROM fx_rbh) GROUP BY a")
def snk_mcl_matrix(fx):
    return sinks.markov_matrix(fx.rbh.select("a", "b", F.col("bit").alias("w")))


@query("SELECT genome, class, sum(n)::BIGINT AS genes FROM fx_count JOIN fx_class USING (cluster) GROUP BY ALL")
def snk_barplot(fx):
    return sinks.bar_data(clusters.class_sums(fx.counts, fx.classes)).filter("genes > 0")


@query("SELECT cluster, least(R0, 2) AS R0, least(R1, 2) AS R1, least(R2, 2) AS R2, least(R3, 2) AS R3, least(R4, 2) AS R4 FROM fx_matrix")
def snk_heatmap(fx):
    return sinks.heat_data(fx.matrix, GENOMES)


@query("SELECT 'genes' AS key, (SELECT count(*) FROM fx_gene)::VARCHAR AS value UNION ALL SELECT 'hits', (SELECT count(*) FROM fx_hit)::VARCHAR")
def snk_logs(fx):
    log = sinks.run_log({"genes": fx.gene.count(), "hits": fx.pair_hit.count()})
    return fx.spark.createDataFrame([tuple(x.split(TAB)) for x in log.splitlines()], "key string, value string")


# --- synteny ---


@query("SELECT genome_a, genome_b, concat_ws(chr(9), concat(genome_a, ':', gene_a), concat(genome_b, ':', gene_b), '1e-50') AS value FROM fx_match")
def snk_hit_pairs(fx):
    return sinks.hit_pairs(fx.match)


def _members(fx):
    n = F.row_number().over(Window.partitionBy("genome_a", "contig_a", "genome_b", "contig_b", F.expr("cluster div 20")).orderBy("gene_a", "gene_b"))
    ends = [F.col(f"{x}_{s}").alias(f"{y}_{s}") for s in "ab" for x, y in (("lend", "end5"), ("rend", "end3"))]
    keys = ["genome_a", "contig_a", "genome_b", "contig_b", "gene_a", "gene_b", "pos_a", "pos_b"]
    return fx.match.select(*keys, F.lit("-").alias("orient"), F.expr("cluster div 20").alias("chain"), n.alias("n"), F.lit(3).alias("score"), *ends)


@query("SELECT split_part(head, chr(10), 1) AS head FROM (SELECT concat('## alignment ', genome_a, ';', contig_a, ' vs. ', genome_b, ';', contig_b, ' (reverse) (num aligned pairs: ', n_pairs, '):') AS head FROM fx_span)")
def snk_aligncoords(fx):
    return sinks.aligncoords(_members(fx)).select(F.substring_index("value", "\n", 1).alias("head"))


@query("SELECT genome_a, contig_a, gene_a::VARCHAR AS gene_a, lend_a AS start_a, rend_a AS stop_a, genome_b, gene_b::VARCHAR AS gene_b, pos_a FROM fx_match")
def src_aligncoords(fx):
    blocks = sinks.aligncoords(_members(fx)).select(F.lit("all").alias("name"), "value")
    lines = formats.lines(fx.spark, files.paths(written(fx, blocks, ["value"], "aligncoords")))
    stray = lines.withColumn("value", F.when((F.col("ord") % 2 == 1) & ~F.startswith("value", F.lit("##")), F.regexp_replace("value", "^(\\S+\\t\\S+\\t)", "$1desc\t")).otherwise(F.col("value")))
    return formats.aligncoords(stray).select("genome_a", "contig_a", "gene_a", "start_a", "stop_a", "genome_b", "gene_b", "pos_a")


@query("SELECT concat_ws(chr(9), concat(genome_a, ';', contig_a), concat(left_a, '-', right_a), len_a, concat(genome_b, ';', contig_b), concat(left_b, '-', right_b), len_b, '+', n_pairs, concat(ratio_pct // 100, '.', lpad((ratio_pct % 100)::VARCHAR, 2, '0'))) AS value FROM fx_span")
def snk_spans(fx):
    return sinks.spans(fx.span.withColumn("orient", F.lit("+"))).select("value")


@query("SELECT genome_a, contig_a, left_a, right_a, len_a, genome_b, contig_b, left_b, right_b, len_b, '+' AS orient, n_pairs, ratio_pct FROM fx_span")
def src_spans(fx):
    spaced = F.when(F.col("n_pairs") % 2 == 0, F.regexp_replace("value", "\t", "   ")).otherwise(F.col("value"))
    lines = sinks.spans(fx.span.withColumn("orient", F.lit("+"))).select(F.lit("all").alias("name"), spaced.alias("value"))
    return files.read(fx.spark, "spans", written(fx, lines, ["value"], "spans")).withColumn("ratio_pct", F.round(F.col("ratio") * 100).cast("long")).drop("ratio")


@query("SELECT genome_a AS genome FROM fx_span UNION SELECT genome_b FROM fx_span")
def src_span_genomes(fx):
    return formats.span_genomes(formats.spans(sinks.spans(fx.span.withColumn("orient", F.lit("+"))).select("value")))


@query("SELECT DISTINCT concat('g', gene // 3) AS id FROM fx_gene")
def src_gene_list(fx):
    return formats.column_set(fx.gene.select(F.concat_ws(TAB, "contig", F.concat(F.lit("g"), F.expr("gene div 3"))).alias("value")), 1)


@query("SELECT genome AS key1, contig AS key2, max(gene)::VARCHAR AS value1 FROM fx_gene GROUP BY ALL")
def src_tab_nested(fx):
    return formats.nested(fx.gene.select(F.concat_ws(TAB, "genome", "contig", "gene").alias("value"), F.col("gene").alias("ord")))


@query('SELECT genome, contig, lend AS start, rend AS "stop" FROM fx_gene')
def src_gene_list_positions(fx):
    return formats.gene_places(fx.gene.select(F.concat_ws(TAB, "genome", "contig", "lend", "rend").alias("value")))


@query("SELECT genome, contig, row_number() OVER (PARTITION BY genome ORDER BY contig_idx DESC) AS place FROM fx_contig")
def src_chain_order_file(fx):
    heads = fx.genome.select(F.concat(F.lit("#"), "genome").alias("value"), (F.col("idx") * 1000).cast("long").alias("ord"))
    rest = fx.contig.join(fx.genome, "genome").select(F.col("contig").alias("value"), (F.col("idx") * 1000 + 100 - F.col("contig_idx")).cast("long").alias("ord"))
    rows = heads.unionByName(rest).withColumn("name", F.lit("order"))
    return formats.contig_lists(formats.lines(fx.spark, files.paths(written(fx, rows, ["ord"], "txt"))))


@query("SELECT row_number() OVER (ORDER BY contig_a, contig_b, grp) AS ord, right_a - left_a AS width, colour FROM (SELECT *, CASE WHEN grp % 3 = 0 THEN 'red' ELSE 'azure4' END AS colour FROM fx_span)")
def snk_rscript(fx):
    s = fx.span.withColumn("ord", F.row_number().over(Window.orderBy("contig_a", "contig_b", "grp"))).withColumn("colour", layout.colour(F.col("grp") % 3 == 0, F.lit(False)))
    drawn = s.select("ord", layout.polygon(F.col("left_a"), F.col("right_a"), F.col("left_b"), F.col("right_b"), F.lit(0).cast("long")).alias("p"), "colour").select("ord", "p.x", "p.y", "colour")
    number = lambda i: F.regexp_extract("value", f"c\\((\\d+), (\\d+), (\\d+), (\\d+),", i).cast("long")
    return sinks.plot_script(drawn).select(F.col("ord").cast("long").alias("ord"), (number(4) - number(1)).alias("width"), F.regexp_extract("value", 'col="(\\w+)"', 1).alias("colour"))


# --- annotations of genes ---


def _rows(fx, width: int, cells: dict) -> DataFrame:
    listed = [F.coalesce(cells[i].cast("string"), F.lit("")) if i in cells else F.lit("") for i in range(width)]
    return fx.gene.select(F.concat_ws(TAB, *listed).alias("value"), F.col("gene").alias("ord"))


def gene_id():
    return F.expr("concat('g', gene div 3)")


@query("SELECT concat('g', gene // 3) AS gene_id, string_agg(DISTINCT CASE WHEN gene % 2 = 0 THEN concat('P', gene % 5, '[d', gene % 5, ']') ELSE concat('H', gene % 5, '|P', gene % 5, '[d', gene % 5, ']') END, ';' ORDER BY CASE WHEN gene % 2 = 0 THEN concat('P', gene % 5, '[d', gene % 5, ']') ELSE concat('H', gene % 5, '|P', gene % 5, '[d', gene % 5, ']') END) AS annotation FROM fx_gene WHERE gene % 4 <> 3 GROUP BY 1")
def src_annot_pfam(fx):
    five = F.expr("gene % 5")
    score = F.when(F.col("gene") % 4 == 3, 10).otherwise(25)
    model = F.when(F.col("gene") % 2 == 0, F.concat(F.lit("P"), five)).otherwise(F.concat(F.lit("H"), five))
    return formats.pfam(_rows(fx, 21, {1: gene_id(), 9: F.concat(F.lit("P"), five), 15: score, 16: model, 18: F.concat(F.lit("d"), five), 19: F.lit(15), 20: F.lit(20)}))


@query("SELECT concat('g', gene // 3) AS gene_id, string_agg(DISTINCT concat('GO:', gene % 7), ';' ORDER BY concat('GO:', gene % 7)) AS annotation FROM fx_gene GROUP BY 1")
def src_annot_go(fx):
    return formats.gene_ontology(_rows(fx, 2, {0: F.concat(F.lit("x "), gene_id()), 1: F.concat(F.lit("GO:"), F.expr("gene % 7"))}))


@query("SELECT DISTINCT concat('g', gene // 3) AS gene_id, concat('EC', gene % 6) AS accession, concat('def ', gene % 6) AS definition FROM fx_gene")
def src_annot_kegg_ec(fx):
    return formats.enzymes(_rows(fx, 9, {0: gene_id(), 6: F.concat(F.lit(" EC"), F.expr("gene % 6"), F.lit(" ")), 8: F.concat(F.lit("def "), F.expr("gene % 6"), F.lit(" "))}))


@query("SELECT DISTINCT concat('g', gene // 3) AS gene_id, concat('K', gene % 6) AS accession, concat('way ', gene % 6) AS definition FROM fx_gene")
def src_annot_kegg_pathway(fx):
    return formats.pathways(_rows(fx, 7, {1: gene_id(), 5: F.concat(F.lit("K"), F.expr("gene % 6")), 6: F.concat(F.lit("way "), F.expr("gene % 6"))}))


@query("SELECT concat('g', gene // 3) AS gene_id, arg_max(concat('db:', gene, '  abc; x'), (gene * 7) % 5 * 1000000 - gene) AS annotation FROM fx_gene WHERE gene % 4 <> 0 GROUP BY 1")
def src_annot_kegg_blast(fx):
    name = F.when(F.col("gene") % 4 == 0, F.lit("unnamed")).otherwise(F.concat(F.lit("db:"), "gene", F.lit("  abc; x")))
    return formats.top_named_hit(_rows(fx, 10, {1: gene_id(), 4: name, 9: F.expr("(gene * 7) % 5")}))


@query("SELECT concat('g', gene) AS gene_id, concat('SigP[len:', gene % 30, ',SProb:0.', gene % 10, ']') AS annotation FROM fx_gene")
def src_annot_signalp(fx):
    return formats.signal_peptides(_rows(fx, 7, {0: F.concat(F.lit("g"), "gene"), 4: F.expr("gene % 30"), 6: F.concat(F.lit("0."), F.expr("gene % 10"))}))


@query("SELECT concat('g', gene) AS gene_id, concat('SigP4[DScore:0.', gene % 10, ']') AS annotation FROM fx_gene WHERE gene % 3 = 0")
def src_annot_signalp4(fx):
    flag = F.when(F.col("gene") % 3 == 0, "Y").otherwise("N")
    cells = [F.concat(F.lit("g"), "gene"), *(F.lit("0") for _ in range(7)), F.concat(F.lit("0."), F.expr("gene % 10")), flag]
    return formats.signal_peptides4(fx.gene.select(F.concat_ws("  ", *cells).alias("value")))


@query("SELECT concat('g', gene) AS gene_id, CASE WHEN gene % 4 = 0 THEN '' ELSE concat('TMH:', gene % 4) END AS annotation FROM fx_gene")
def src_annot_tmhmm(fx):
    return formats.membrane_helices(_rows(fx, 7, {1: F.concat(F.lit("g"), "gene"), 6: F.expr("gene % 4")}))


@query("SELECT concat('g', gene) AS gene_id FROM fx_gene WHERE gene % 4 > 0")
def src_annot_abstract(fx):
    reader = formats.ANNOTATION_READERS["TMHMM"]
    return reader(_rows(fx, 7, {1: F.concat(F.lit("g"), "gene"), 6: F.expr("gene % 4")})).filter("annotation <> ''").select("gene_id")


@query("SELECT concat('g', gene // 3) AS gene_id, max((gene * 7) % 5)::BIGINT AS score FROM fx_gene GROUP BY 1")
def top_kegg(fx):
    rows = fx.gene.select(gene_id().alias("gene_id"), F.expr("(gene * 7) % 5").alias("score"))
    return rows.groupBy("gene_id").agg(F.max_by("score", "score").cast("long").alias("score"))
