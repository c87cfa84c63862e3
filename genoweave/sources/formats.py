"""Readers of the text formats. Each takes lines (value, and ord where the order of lines matters) and returns typed
columns; lines(spark, path) reads files as such."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.operators.ranking import global_rank

TAB = "\t"


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, split (where the piece of a file that a task reads begins) and ord: the lines of text files; ord grows
    within a file."""
    raw = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    return raw.withColumn("ord", F.monotonically_increasing_id())


def carried(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """rows with the last value that is not null at or before each row of its file, by ord.

    Where rows say their split, windows are as large as splits: each split's last value is carried to the splits behind it
    by a window over the splits, a row each, and joined back. A file of any length is so the work of all who read it.
    """
    file = [F.col("file")] if "file" in rows.columns else []
    split = [F.col("split")] if "split" in rows.columns else []
    marked = rows.withColumn("_v", value)
    own = F.last("_v", True).over(Window.partitionBy(*file, *split).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    if not split:
        return marked.withColumn(name, own).drop("_v")
    ends = marked.groupBy(*file, "split").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("ord"))).alias("_end"))
    before = F.last("_end", True).over(Window.partitionBy(*file).orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    keys = ["file", "split"] if file else ["split"]
    return marked.withColumn("_own", own).join(ends.select(*keys, before.alias("_before")), keys, "left").withColumn(name, F.coalesce("_own", "_before")).drop("_v", "_own", "_before")


def field(i: int, value: Column | str = "value", sep: str = TAB) -> Column:
    """The i-th field from 0, null beyond the last."""
    return F.get(F.split(value, sep), F.lit(i))


def number(value: Column, kind: str = "bigint") -> Column:
    return value.try_cast(kind)


# --- genes ------------------------------------------------------------------------------------------------------------


def gff(rows: DataFrame) -> DataFrame:
    """contig, source, type, start, stop, score, strand, phase, attributes; comments and lines of under 8 columns go."""
    kept = rows.filter(~F.startswith("value", F.lit("#"))).withColumn("f", F.split("value", TAB)).filter(F.size("f") >= 8)
    names = ["contig", "source", "type", "start", "stop", "score", "strand", "phase", "attributes"]
    extra = [c for c in rows.columns if c != "value"]
    return kept.select(*extra, *((number(F.get("f", F.lit(i))) if n in ("start", "stop") else F.get("f", F.lit(i))).alias(n) for i, n in enumerate(names)))


def contig_genes(rows: DataFrame) -> DataFrame:
    """contig, gene, strand, spans: the intervals of a gene, "s-e" in order of place, and its strand; of lines, or of the
    columns of gff()."""
    g = gff(rows) if "value" in rows.columns else rows
    one = F.concat_ws("-", "start", "stop")
    return g.groupBy("contig", F.col("attributes").alias("gene")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", one.alias("s")))), lambda x: x["s"]), " ").alias("spans"), F.max_by("strand", "start").alias("strand"))


def gene_structs(rows: DataFrame, organism: str) -> DataFrame:
    """Genes of a normalised GFF: org:gene, org;contig, ends by strand and the midpoint; a repeated gene's last row stands."""
    g = gff(rows).filter(F.col("strand").isin("+", "-"))
    plus = F.col("strand") == "+"
    made = g.select(
        "ord", F.lit(organism).alias("org"), "source", "contig", F.col("type").alias("feature"), F.concat_ws(";", F.lit(organism), "contig").alias("org_mol"), F.col("start").alias("lend"), F.col("stop").alias("rend"),
        F.floor((F.col("start") + F.col("stop")) / 2).alias("mid"), F.when(plus, F.col("start")).otherwise(F.col("stop")).alias("end5"), F.when(plus, F.col("stop")).otherwise(F.col("start")).alias("end3"),
        F.col("strand").alias("orient"), F.concat_ws(":", F.lit(organism), "attributes").alias("gene_id"),
    )
    w = Window.partitionBy("gene_id").orderBy(F.col("ord").desc())
    return made.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "ord")


def gene_annotations(rows: DataFrame) -> DataFrame:
    """gene_id, locus, name, contig, start of the `gene` rows: with an alias that is the gene's id and ID its locus."""
    a = F.col("attributes")
    got = lambda key: F.nullif(F.regexp_extract(a, f"(?:^|;)\\s*{key}=([^;]*)", 1), F.lit(""))
    g = gff(rows).filter("type = 'gene'")
    return g.select(F.coalesce(got("Alias"), got("ID")).alias("gene_id"), F.when(got("Alias").isNotNull(), got("ID")).alias("locus"), F.coalesce(got("Name"), F.lit("hypothetical protein")).alias("name"), "contig", "start")


def gene_genomes(rows: DataFrame) -> DataFrame:
    """gene, genome of a combined GFF."""
    return gff(rows).select(F.col("attributes").alias("gene"), F.col("source").alias("genome")).distinct()


# --- sequences --------------------------------------------------------------------------------------------------------


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, desc, seq, ord of FASTA files, a record a row. A record begins at a line that begins with >."""
    records = spark.read.option("lineSep", "\n>").text(path).withColumn("ord", F.monotonically_increasing_id())
    return fasta_records(records.withColumn("value", F.regexp_replace("value", "^\\s*>", "")))  # the first one's mark


def fasta_records(records: DataFrame) -> DataFrame:
    """id, desc, seq, ord of records (value: header line, then sequence lines; ord)."""
    head = F.regexp_replace(F.substring_index("value", "\n", 1), "\r$", "")
    body = F.regexp_replace(F.when(F.instr("value", "\n") > 0, F.regexp_replace("value", "^[^\\n]*\\n", "")).otherwise(""), "\\s", "")
    return records.filter(F.trim("value") != "").select(F.regexp_extract(head, "^(\\S*)", 1).alias("id"), F.regexp_extract(head, "^\\S*\\s+(.*)$", 1).alias("desc"), body.alias("seq"), "ord")


def fasta_lengths(seqs: DataFrame) -> DataFrame:
    return seqs.select("id", F.length("seq").cast("long").alias("length"))


def fasta_total(seqs: DataFrame) -> DataFrame:
    return seqs.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).cast("long").alias("total"))


def fasta_order(seqs: DataFrame) -> DataFrame:
    return global_rank(seqs.select("id", "ord"), ["ord"]).select("id", "place")


def fasta_headers(seqs: DataFrame) -> DataFrame:
    """transcript, gene_id, locus, name, genome, analysis_run of structured headers."""
    h = F.concat_ws(" ", "id", "desc")
    word = lambda key: F.nullif(F.regexp_extract(h, f"(?:^|\\s){key}=(\\S+)", 1), F.lit(""))
    return seqs.select(
        F.col("id").alias("transcript"), word("gene_id").alias("gene_id"), word("locus").alias("locus"), F.nullif(F.regexp_extract(h, 'name="([^"]*)"', 1), F.lit("")).alias("name"), word("genome").alias("genome"), word("analysisRun").alias("analysis_run")
    )


def structured_header(transcript: Column, gene: Column, locus: Column, name: Column, genome: Column, run: Column) -> Column:
    return F.concat(transcript, F.lit(" gene_id="), gene, F.lit(" locus="), locus, F.lit(' name="'), F.coalesce(name, F.lit("hypothetical protein")), F.lit('" genome='), genome, F.lit(" analysisRun="), run)


def protein_records(rows: DataFrame) -> DataFrame:
    """Records of downloaded proteins that name a protein_id: it becomes the id."""
    accession = F.regexp_extract(F.concat_ws(" ", "id", "desc"), "protein_id=([^\\]\\s]+)", 1)
    return rows.withColumn("id", accession).filter("id <> ''")


def feature_table(rows: DataFrame) -> DataFrame:
    """GFF lines of mRNA for the CDS rows of a 20-column feature table that name a product."""
    f = [field(i) for i in range(20)]
    kept = rows.filter((f[0] == "CDS") & (F.coalesce(f[10], F.lit("")) != ""))
    return kept.select(F.concat_ws(TAB, f[6], F.lit("."), F.lit("mRNA"), f[7], f[8], F.lit("."), f[9], F.lit("."), F.concat(F.lit("ID="), f[10])).alias("value"))


# --- hits -------------------------------------------------------------------------------------------------------------

M8 = ["query", "subject", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore"]


def numeric_evalue(value: Column) -> Column:
    """A number from text; `e-10` stands for 1e-10."""
    return number(F.regexp_replace(value, "^e-", "1e-"), "double")


def m8(rows: DataFrame) -> DataFrame:
    """The 12 columns of tabular hits; another number of columns is an error."""
    f = F.split("value", TAB)
    checked = F.when(F.size(f) == 12, f).otherwise(F.raise_error(F.concat(F.lit("not 12 columns: "), F.col("value"))).cast("array<string>"))
    kinds = ["string", "string", "double", *["bigint"] * 7]
    extra = [c for c in rows.columns if c != "value"]
    return rows.select(*extra, checked.alias("f")).select(*extra, *(number(F.get("f", F.lit(i)), k).alias(M8[i]) for i, k in enumerate(kinds)), numeric_evalue(F.get("f", F.lit(10))).alias("evalue"), number(F.get("f", F.lit(11)), "double").alias("bitscore"))


def bpo(rows: DataFrame) -> DataFrame:
    """Similarities: ids, lengths, e-value with its mantissa and exponent, percent identity and the intervals of the HSPs. A
    `lot` beside the lines stays beside them.

    A list without a dot is one HSP and told by plain columns; only lists of several go through functions of arrays, which
    Spark does not compile."""
    g = lambda i: F.get("f", F.lit(i))
    part = lambda x, i, j: number(F.get(F.split(F.get(F.split(x, ":"), F.lit(i)), "-"), F.lit(j)))
    hsp = lambda x: F.struct(number(F.get(F.split(x, ":"), F.lit(0))).alias("n"), part(x, 1, 0).alias("qs"), part(x, 1, 1).alias("qe"), part(x, 2, 0).alias("ss"), part(x, 2, 1).alias("se"))
    several = F.transform(F.filter(F.split(F.regexp_replace(g(7), "\\.$", ""), "\\."), lambda x: x != ""), hsp)
    lot = [c for c in ("lot",) if c in rows.columns]
    split = rows.select(*lot, F.split("value", ";").alias("f")).select("*", F.split(g(7), ":").alias("c"), F.when(F.startswith(g(5), F.lit("e-")), F.concat(F.lit("1"), g(5))).otherwise(g(5)).alias("v"))
    split = split.select("*", *(F.split(F.get("c", F.lit(i)), "-").alias(n) for i, n in ((1, "on_q"), (2, "on_s"))), F.split("v", "e").alias("e"))
    of = lambda c, i: number(F.get(c, F.lit(i)))
    one = F.array(F.struct(of("c", 0).alias("n"), of("on_q", 0).alias("qs"), of("on_q", 1).alias("qe"), of("on_s", 0).alias("ss"), of("on_s", 1).alias("se")))
    return split.select(
        *lot, number(g(0)).alias("sim_id"), g(1).alias("query"), number(g(2)).alias("qlen"), g(3).alias("subject"), number(g(4)).alias("slen"), number(F.col("v"), "double").alias("evalue"),
        number(F.get("e", F.lit(0)), "double").alias("mantissa"), F.coalesce(of("e", 1), F.lit(0)).cast("long").alias("exponent"), of("f", 6).alias("pident"),
        F.when((g(7) != "") & ~F.contains(g(7), F.lit(".")), one).otherwise(several).alias("hsps"),
    )


def gg(rows: DataFrame) -> DataFrame:
    """taxon, gene; a count in brackets behind the taxon is dropped."""
    taxon = F.regexp_replace(F.substring_index("value", ":", 1), "\\(\\d+\\)$", "")
    genes = F.filter(F.split(F.regexp_replace("value", "^[^:]*:", ""), "\\s+"), lambda x: x != "")
    return rows.select(F.trim(taxon).alias("taxon"), F.explode(genes).alias("gene"))


# --- clusters ---------------------------------------------------------------------------------------------------------


def markov_cluster_lines(rows: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """cluster, genes, taxa, code, gene, (genome): lines `NAMEn(g genes,t taxa):` and gene(taxon) words; a gene may carry
    its genome's code before a bar."""
    head = "^[A-Z]+(\\d+)\\((\\d+) genes,(\\d+) taxa\\):"
    words = F.filter(F.split(F.regexp_replace("value", head, ""), "\\s+"), lambda x: x != "")
    each = rows.select(*(number(F.regexp_extract("value", head, i)).alias(n) for i, n in ((1, "cluster"), (2, "genes"), (3, "taxa"))), F.explode(words).alias("w"))
    bare = F.regexp_replace("w", "\\([^()]*\\)$", "")
    out = each.select("cluster", "genes", "taxa", F.regexp_extract("w", "\\(([^()]*)\\)$", 1).alias("code"), F.regexp_replace(bare, "^G[0-9a-f]{3,}\\|", "").alias("gene"))
    return out if codes is None else out.join(F.broadcast(codes), "code", "left")  # one row per genome


CLUSTER = ["cluster", "set", "genome", "transcript", "gene", "locus", "annotation"]


def cluster_rows(rows: DataFrame) -> DataFrame:
    """The seven columns of cluster rows; blank lines between clusters go, a missing annotation is empty."""
    return rows.filter(F.trim("value") != "").select(*(F.coalesce(field(i), F.lit("")).alias(n) for i, n in enumerate(CLUSTER)))


def wide_clusters(table: DataFrame, genome_of: dict[str, str], id_col: str) -> DataFrame:
    """cluster, genome, gene from one column per genome with genes divided by ", "; cluster ids lose their prefix."""
    long = table.unpivot([id_col], list(genome_of), "column", "genes")
    names = F.create_map(*(F.lit(x) for p in genome_of.items() for x in p))
    genes = F.filter(F.split(F.coalesce("genes", F.lit("")), ", "), lambda x: F.trim(x) != "")
    return long.select(number(F.regexp_replace(id_col, "^OG", "")).alias("cluster"), names[F.col("column")].alias("genome"), F.explode(genes).alias("gene")).withColumn("gene", F.trim("gene"))


# --- synteny ----------------------------------------------------------------------------------------------------------

ALIGNED = ["genome_a", "contig_a", "gene_a", "start_a", "stop_a", "pos_a", "mark", "genome_b", "contig_b", "gene_b", "start_b", "stop_b"]


def aligncoords(rows: DataFrame) -> DataFrame:
    """block (its header's ord), both genes with their places: rows below `##` headers. A word of description that slipped
    in before a gene's start is taken out; genes come without their genome. Headers are carried over the splits of a file."""
    head = F.startswith("value", F.lit("##"))
    blocks = carried(rows, F.when(head, F.col("ord")), "block").filter(~head & (F.trim("value") != ""))
    f = F.split(F.trim("value"), "\\s+")
    has = lambda a, i: F.contains(F.get(a, F.lit(i)), F.lit(":"))
    without = lambda a, i: F.concat(F.slice(a, 1, i), F.slice(a, i + 2, 100))
    one = F.when(~has(f, 2) & has(f, 3), without(f, 2)).otherwise(f)
    stepped = blocks.withColumn("f", one)
    two = F.when(~has("f", 9) & has("f", 10), without(F.col("f"), 9)).otherwise(F.col("f"))
    g = stepped.withColumn("f", two)
    cell = lambda i, n: number(F.get("f", F.lit(i))) if n.startswith(("start", "stop", "pos")) else F.regexp_replace(F.get("f", F.lit(i)), "^[^:]*:", "") if n.startswith("gene_") else F.get("f", F.lit(i))
    return g.select("block", *(cell(i, n).alias(n) for i, n in enumerate(ALIGNED) if n != "mark"))


def spans(rows: DataFrame) -> DataFrame:
    """The nine columns of spans, divided by tabs or spaces, with genome and contig, left and right apart."""
    f = F.split(F.trim("value"), "\\t|\\s+")
    g = lambda i: F.get(f, F.lit(i))
    part = lambda x, sep, i: F.split_part(x, F.lit(sep), F.lit(i))
    return rows.filter(F.trim("value") != "").select(
        part(g(0), ";", 1).alias("genome_a"), part(g(0), ";", 2).alias("contig_a"), number(part(g(1), "-", 1)).alias("left_a"), number(part(g(1), "-", 2)).alias("right_a"), number(g(2)).alias("len_a"),
        part(g(3), ";", 1).alias("genome_b"), part(g(3), ";", 2).alias("contig_b"), number(part(g(4), "-", 1)).alias("left_b"), number(part(g(4), "-", 2)).alias("right_b"), number(g(5)).alias("len_b"),
        g(6).alias("orient"), number(g(7)).alias("n_pairs"), number(g(8), "double").alias("ratio"),
    )


def span_genomes(span_rows: DataFrame) -> DataFrame:
    return span_rows.select(F.col("genome_a").alias("genome")).union(span_rows.select("genome_b")).distinct()


def column_set(rows: DataFrame, n: int = 0) -> DataFrame:
    """The distinct values of one column of a list."""
    return rows.filter(F.trim("value") != "").select(field(n).alias("id")).distinct()


def nested(rows: DataFrame, columns: int = 3) -> DataFrame:
    """key1, key2, value (and value2 of four columns): later rows of the same keys stand."""
    f = [field(i).alias(n) for i, n in enumerate(["key1", "key2", "value1", "value2"][:columns])]
    w = Window.partitionBy("key1", "key2").orderBy(F.col("ord").desc())
    return rows.select("ord", *f).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "ord")


def gene_places(rows: DataFrame) -> DataFrame:
    """genome, contig, start, stop of an explicit list."""
    return rows.select(field(0).alias("genome"), field(1).alias("contig"), number(field(2)).alias("start"), number(field(3)).alias("stop"))


def contig_lists(rows: DataFrame) -> DataFrame:
    """genome, contig, place of an order file: `#genome`, then a contig a line."""
    head = F.startswith("value", F.lit("#"))
    named = carried(rows.filter(F.trim("value") != ""), F.when(head, F.substr("value", F.lit(2))), "genome").filter(~head)
    return named.select("genome", F.trim("value").alias("contig"), F.row_number().over(Window.partitionBy("genome").orderBy("ord")).cast("long").alias("place"))


# --- annotations of genes ---------------------------------------------------------------------------------------------


def _joined(rows: DataFrame, text: Column) -> DataFrame:
    """gene_id, annotation: a gene's distinct texts in order."""
    return rows.groupBy("gene_id").agg(F.array_join(F.sort_array(F.collect_set(text)), ";").alias("annotation"))


def _data(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.startswith("value", F.lit("#")))


def pfam(rows: DataFrame, cutoff: str = "TRUSTED") -> DataFrame:
    """Domains at or above the trusted (or noise) cutoff: accession[description], with the model's accession before a bar
    where it differs. Rows without scores, accessions or a description go."""
    score, noise, trusted = (number(field(i), "double") for i in (15, 19, 20))
    acc, model, text = field(9), field(16), field(18)
    least = noise if cutoff == "NOISE" else trusted
    kept = _data(rows).filter(score.isNotNull() & trusted.isNotNull() & (score >= least) & (acc != "") & (model != "") & (text != ""))
    name = F.when(model != acc, F.concat_ws("|", model, acc)).otherwise(acc)
    return _joined(kept.select(field(1).alias("gene_id"), F.concat(name, F.lit("["), text, F.lit("]")).alias("a")), F.col("a"))


def gene_ontology(rows: DataFrame) -> DataFrame:
    return _joined(_data(rows).select(F.get(F.split(field(0), "\\s+"), F.lit(1)).alias("gene_id"), field(1).alias("a")), F.col("a"))


def _defined(rows: DataFrame, gene: int, key: int, text: int) -> DataFrame:
    """gene_id, accession, definition; two definitions of one accession are an error."""
    got = _data(rows).select(field(gene).alias("gene_id"), F.trim(field(key)).alias("accession"), F.trim(field(text)).alias("definition")).distinct()
    by = Window.partitionBy("accession")
    clash = F.min("definition").over(by) != F.max("definition").over(by)
    return got.withColumn("accession", F.when(clash, F.raise_error(F.concat(F.lit("two definitions of "), F.col("accession"))).cast("string")).otherwise(F.col("accession")))


def enzymes(rows: DataFrame) -> DataFrame:
    return _defined(rows, 0, 6, 8)


def pathways(rows: DataFrame) -> DataFrame:
    return _defined(rows, 1, 5, 6)


def top_named_hit(rows: DataFrame) -> DataFrame:
    """gene_id, annotation: each gene's best hit whose name reads `db:id  abc;`; the first on ties."""
    kept = _data(rows).filter(F.rlike(field(4), F.lit("\\w+:\\w+  [a-z]{3}[A-Z|0-9]{0,2};")))
    score = number(field(9), "double")
    return kept.groupBy(field(1).alias("gene_id")).agg(F.max_by(field(4), F.struct(score, -F.col("ord"))).alias("annotation"))


def signal_peptides(rows: DataFrame) -> DataFrame:
    return _data(rows).select(field(0).alias("gene_id"), F.concat(F.lit("SigP[len:"), field(4), F.lit(",SProb:"), field(6), F.lit("]")).alias("annotation"))


def signal_peptides4(rows: DataFrame) -> DataFrame:
    f = lambda i: field(i, F.trim("value"), "\\s+")
    return _data(rows).filter(f(9) == "Y").select(f(0).alias("gene_id"), F.concat(F.lit("SigP4[DScore:"), f(8), F.lit("]")).alias("annotation"))


def membrane_helices(rows: DataFrame) -> DataFrame:
    n = number(field(6))
    return _data(rows).select(field(1).alias("gene_id"), F.when(n > 0, F.concat(F.lit("TMH:"), n)).otherwise("").alias("annotation"))


#: The annotation readers by kind: each is a function of lines.
ANNOTATION_READERS = {"Pfam": pfam, "GO": gene_ontology, "KeggEC": enzymes, "KeggPathways": pathways, "KeggBlast": top_named_hit, "SignalP": signal_peptides, "SignalP4": signal_peptides4, "TMHMM": membrane_helices}
CLUSTER_READERS = {"RBH": cluster_rows, "OMCL": markov_cluster_lines, "Orthofinder": wide_clusters}
