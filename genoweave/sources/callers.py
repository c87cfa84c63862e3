"""Clusters of orthologs from the files of the programs that call them: a registry of readers behind one schema.

    read_clusters(spark, "RBH", path)
    register_caller("Mine", reader)   # reader(spark, path, **options) -> DataFrame with columns of SCHEMA

A reader gives what its format has; columns that it lacks are null. A path is a file, a folder of files, or what the sink of
sources/files has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.sources import files, formats

SCHEMA = ["cluster", "set", "genome", "transcript", "gene", "locus", "annotation"]
Reader = Callable[..., DataFrame]
_READERS: dict[str, Reader] = {}


def register_caller(name: str, reader: Reader) -> None:
    """Adds a format, or replaces one."""
    _READERS[name] = reader


def callers() -> list[str]:
    return sorted(_READERS)


def read_clusters(spark: SparkSession, caller: str, path: str, **options) -> DataFrame:
    """SCHEMA as strings, of the clusters in a caller's files; an unknown caller is an error."""
    if caller not in _READERS:
        raise ValueError(f"no reader of {caller!r}; there are {', '.join(callers())}")
    found = _READERS[caller](spark, path, **options)
    return found.select(*(F.col(c).cast("string").alias(c) if c in found.columns else F.lit(None).cast("string").alias(c) for c in SCHEMA))


def _parts(path: str) -> str | list[str]:
    """What Spark's readers take: the parts of a written folder, or the path itself."""
    fs, root = files.opened(path)
    return files.paths(path) if files.current_version(fs, root) else path


def _reciprocal(spark: SparkSession, path: str) -> DataFrame:
    return formats.cluster_rows(formats.lines(spark, _parts(path)))


def _graph(spark: SparkSession, path: str, codes: DataFrame | None = None) -> DataFrame:
    """Taxa in brackets are genomes, unless codes (code, genome) name them."""
    rows = formats.markov_cluster_lines(formats.lines(spark, _parts(path)), codes)
    return rows if codes is not None else rows.withColumn("genome", F.col("code"))


def _wide(spark: SparkSession, path: str, suffix: str = ".pep") -> DataFrame:
    """One column a genome; a column's genome is its heading without the suffix. The heading is the first line of the file
    or, of a written folder, its header."""
    fs, root = files.opened(path)
    now = files.current_version(fs, root)
    head = next((files.posixpath.join(root, now["version"], p["path"]) for p in now["parts"] if p["header"]), None) if now else None
    if head:
        with fs.open_input_file(head) as f:
            names = f.read().decode().rstrip("\n").split("\t")
    else:
        names = spark.read.text(path).first()["value"].split("\t")
    columns = ["id", *(f"g{i}" for i in range(1, len(names)))]
    rows = formats.lines(spark, _parts(path)).filter(F.col("value") != "\t".join(names))
    table = rows.select(*(formats.field(i).alias(c) for i, c in enumerate(columns)))
    return formats.wide_clusters(table, {c: n.removesuffix(suffix) for c, n in zip(columns[1:], names[1:], strict=True)}, "id")


register_caller("RBH", _reciprocal)
register_caller("OMCL", _graph)
register_caller("Orthofinder", _wide)
