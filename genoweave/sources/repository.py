"""Genome repositories and configuration files, read on the driver: all are small."""

from __future__ import annotations

import configparser
import posixpath
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The file extension of each type of attribute.
EXTENSIONS = {
    "Genome": "genome.fa",
    "Annotation": "annotation.gff3",
    "AnnotationBasic": "annotation",
    "PFAM": "Pfam",
    "TIGRfam": "TIGRfam",
    "KEGG": "Kegg_Blast",
    "KEGG_EC": "Kegg_EC",
    "COG": "COG",
    "GO_file": "annotation.GO",
    "TMHMM": "TMHMM",
    "SignalP": "SignalP",
    "SigP4": "SigP4",
    "ARDB_file": "ARDB",
    "TBLASTN": "alignment.gff3",
    "BLAT_EST": "alignment.gff3",
    "GENEWISE": "prediction.gff3",
    "AUGUSTUS": "prediction.gff3",
    "GENEMARK": "prediction.gff3",
    "GLIMMERHMM": "prediction.gff3",
    "METAGENE": "prediction.gff3",
    "PRODIGAL": "prediction.gff3",
    "GLIMMER": "prediction.gff3",
    "RNA": "rna",
    "TRNA": "trna",
    "RNA_GFF": "rna.gff3",
    "TRNA_GFF": "trna.gff3",
    "PEP": "annotation.pep",
    "CDS": "annotation.cds",
    "KEGG_PATHWAYS": "Kegg_Blast.Kegg_Pathways",
}
GENE_PREDICTIONS = ["GENEWISE", "AUGUSTUS", "GENEMARK", "GLIMMERHMM", "METAGENE", "PRODIGAL", "GLIMMER"]
GENOME_ALIGNMENTS = ["TBLASTN", "BLAT_EST"]
#: Types whose base name is another type's.
BASE = dict.fromkeys(["PEP", "CDS", "AnnotationBasic", "GO_file", "SigP4", "ARDB_file"], "Annotation") | {"KEGG_PATHWAYS": "KEGG", "RNA_GFF": "RNA", "TRNA_GFF": "TRNA"}


def spec_rows(stanzas: DataFrame) -> DataFrame:
    """genome, attr, values of stanzas (value: the lines between `//`): the genome's name is its first `Genome`; a value of
    `.` counts as none; a later stanza of a genome replaces its attributes."""
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.split(F.trim(x), "\\s+")), lambda f: (F.size(f) >= 2) & (F.get(f, F.lit(1)) != "."))
    pairs = stanzas.select(F.monotonically_increasing_id().alias("n"), F.transform(lines, lambda f: F.struct(F.get(f, F.lit(0)).alias("k"), F.get(f, F.lit(1)).alias("v"))).alias("p"))
    named = pairs.withColumn("genome", F.get(F.filter("p", lambda x: x["k"] == "Genome"), F.lit(0))["v"]).filter("genome IS NOT NULL")
    keys = named.select("n", "genome", "p", F.explode(F.array_distinct(F.transform("p", lambda x: x["k"]))).alias("attr"))
    values = keys.select("n", "genome", "attr", F.transform(F.filter("p", lambda x: x["k"] == F.col("attr")), lambda x: x["v"]).alias("values"))
    return values.groupBy("genome", "attr").agg(F.max_by("values", "n").alias("values"))


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    return spec_rows(spark.read.option("lineSep", "//").text(path))


def genomes(spec: DataFrame) -> DataFrame:
    return spec.select("genome").distinct()


def attribute_types(spec: DataFrame, genome: str) -> DataFrame:
    return spec.filter(F.col("genome") == genome).select("attr")


def attribute_values(spec: DataFrame, genome: str, attr: str) -> DataFrame:
    return spec.filter((F.col("genome") == genome) & (F.col("attr") == attr)).select(F.explode("values").alias("value"))


def genome_dir(repo: str, genome: str) -> str:
    return posixpath.join(repo, genome)


def file_names(spec: DataFrame, repo: str) -> DataFrame:
    """genome, attr, file: every file of each type of attribute that a genome has or that is derived from one it has."""
    kinds = F.array(*(F.struct(F.lit(t).alias("attr"), F.lit(BASE.get(t, t)).alias("base"), F.lit(x).alias("ext")) for t, x in EXTENSIONS.items()))
    wanted = spec.select("genome", F.col("attr").alias("have"), F.posexplode("values").alias("n", "value")).select("*", F.explode(kinds).alias("k")).filter("have = k.base")
    return wanted.select("genome", F.col("k.attr").alias("attr"), "n", F.concat(F.lit(repo + "/"), "genome", F.lit("/"), F.regexp_extract("value", "([^/]*)$", 1), F.lit("."), "k.ext").alias("file"))


def hit_file(repo: str, a: Column, b: Column, reciprocal: bool = False) -> Column:
    """The path of a pair's hits; of its reciprocal hits with the pair in order."""
    x, y = (F.least(a, b), F.greatest(a, b)) if reciprocal else (a, b)
    return F.concat(F.lit(repo + "/"), x, F.lit("_vs_"), y, F.lit(".RBH" if reciprocal else ".m8"))


def read_ini(text: str) -> dict[str, dict[str, str]]:
    """section -> attribute -> value, trimmed, without quotes; lines after `;` or `#` are comments."""
    parser = configparser.ConfigParser(comment_prefixes=(";", "#"), interpolation=None, strict=False)
    parser.optionxform = str
    parser.read_string(text)
    return {s: {k.strip(): v.strip().strip("\"'") for k, v in parser[s].items()} for s in parser.sections()}


def chain_config(text: str) -> dict[str, object]:
    """The chaining parameters of a configuration; INCLUDE_SELF_COMPARISONS is a boolean in any case of letters."""
    p = read_ini(text).get("Parameters", {})
    get = lambda k, default: type(default)(float(p[k])) if k in p and p[k] else default
    out: dict[str, object] = {
        "gap_open": get("GAP_OPEN", 0.0), "gap_extend": get("GAP_EXTEND", -1.0), "gap_length": get("GAP_LENGTH", 1), "max_match": get("MAX_MATCH_SCORE", 50.0), "max_evalue": get("MAX_EVALUE", 10.0),
        "max_distance": get("MAX_DIST_BETWEEN_SYN_PAIRS", 5), "min_pairs": get("MIN_ALIGNED_PAIRS", 4), "constant_match": float(p["CONSTANT_MATCH_SCORE"]) if p.get("CONSTANT_MATCH_SCORE") else None,
        "min_score": float(p["MIN_ALIGNMENT_SCORE"]) if p.get("MIN_ALIGNMENT_SCORE") else None,
    }
    if p.get("MODE", "RELATIVE_POSITION") not in ("RELATIVE_POSITION", "GENOME_COORDINATE"):
        raise ValueError(f"MODE {p['MODE']}")
    return out | {"mode": p.get("MODE", "RELATIVE_POSITION"), "include_self": p.get("INCLUDE_SELF_COMPARISONS", "").strip().lower() == "true", "noise_distance": int(read_ini(text).get("NoiseFilter", {}).get("BEST_MATCH_AGGREGATE_DIST", 5))}


@dataclass
class PlotConfig:
    """`key=value` and `key=sub=value` lines."""

    values: dict[str, str] = field(default_factory=dict)
    nested: dict[str, dict[str, str]] = field(default_factory=dict)

    REQUIRED = ("genome_order", "genome_labels", "genome_number_of", "plot_synteny")

    @classmethod
    def parse(cls, text: str) -> PlotConfig:
        out = cls()
        for line in text.splitlines():
            parts = line.strip().split("=")
            if not line.strip() or line.startswith("#") or len(parts) < 2:
                continue
            if len(parts) == 2:
                out.values[parts[0]] = parts[1]
            else:
                out.nested.setdefault(parts[0], {})[parts[1]] = parts[2]
        return out

    def check(self) -> PlotConfig:
        if missing := [k for k in self.REQUIRED if k not in self.values]:
            raise ValueError(f"missing in the configuration: {missing}")
        if self.values["plot_synteny"] not in ("c", "g"):
            raise ValueError("plot_synteny is neither c nor g")
        if len(self.listed("genome_order")) != len(self.listed("genome_labels")):
            raise ValueError("genome_order and genome_labels differ in length")
        return self

    def listed(self, key: str) -> list[str]:
        return [x for x in self.values.get(key, "").split(",") if x]

    def pairs(self, key: str) -> list[tuple[str, str]]:
        """`a:b` entries; an entry without `:` has an empty second part."""
        return [(x.partition(":")[0], x.partition(":")[2]) for x in self.listed(key)]

    def text(self) -> str:
        flat = [f"{k}={v}" for k, v in self.values.items()]
        return "\n".join(flat + [f"{k}={s}={v}" for k, d in self.nested.items() for s, v in d.items()]) + "\n"


def default_plot_config(order: list[str], contig_orders: dict[str, list[str]], lengths: dict[str, dict[str, int]], synteny: str = "c") -> PlotConfig:
    """A configuration from genomes in order, their contigs in order and the contigs' lengths."""
    from genoweave.operators.layout import COLOURS, GENE_COLOURS, MIN_LABEL, figure_size

    size = figure_size(len(order))
    longest = max(sum(d.values()) for d in lengths.values())
    values = {
        "genome_order": ",".join(order), "genome_labels": ",".join(order), "genome_number_of": str(len(order)), "genome_half_way_point": str(size["half_way"]), "contig_min_length_for_label": str(MIN_LABEL), "reverse_compliment": "",
        "contig_name_replace": "Supercontig:sc,Contig:c,Scaffold:,Chromosome:chr", "height_inches": str(size["height"]), "xmax": str(longest), "ymax": str(size["ymax"]), "plot_synteny": synteny, "plot_individual_genes": "n",
        **{f"aligncoords_spans_colour{i + 1}": c for i, c in enumerate(COLOURS)}, **{f"gene_list_colour{i + 1}": c for i, c in enumerate(GENE_COLOURS)}, **{f"contig_order_{g}": ",".join(c) for g, c in contig_orders.items()},
    }
    return PlotConfig(values, {f"genome_contig_lengths_{g}": {c: str(n) for c, n in d.items()} for g, d in lengths.items()}).check()
