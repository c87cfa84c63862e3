"""Preparation of gene and sequence tables: types, ids, duplicates, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.sources.formats import structured_header


def of_type(genes: DataFrame, kind: str = "mRNA") -> DataFrame:
    return genes.filter(F.col("type") == kind)


def attribute_id(attributes: Column, sep: str = ";", part: int = 0, remove: str = "ID=") -> Column:
    """The id: a part of the attributes without what a pattern matches."""
    return F.regexp_replace(F.get(F.split(attributes, sep), F.lit(part)), remove, "")


def first_in_genome(rows: DataFrame) -> DataFrame:
    """Of rows with one id in a genome the first."""
    w = Window.partitionBy("genome", "id").orderBy("ord")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def unique_ids(rows: DataFrame) -> DataFrame:
    """old_id, id: an id that an earlier genome has gets a suffix, _dup1 and so on."""
    n = F.row_number().over(Window.partitionBy("id").orderBy("genome")) - 1
    return rows.withColumn("_n", n).withColumn("old_id", F.col("id")).withColumn("id", F.when(F.col("_n") == 0, F.col("id")).otherwise(F.concat("id", F.lit("_dup"), "_n"))).drop("_n")


def renamed(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """rows with the ids that unique_ids gave their genome."""
    r = renames.select("genome", F.col("old_id").alias("id"), F.col("id").alias("_new"))
    return rows.join(r, ["genome", "id"], "left").withColumn("id", F.coalesce("_new", "id")).drop("_new")


def fasta_header(transcript: Column, gene: Column, locus: Column, name: Column, genome: Column, run: Column) -> Column:
    """The structured header, without carriage returns; an empty name is a hypothetical protein."""
    clean = lambda c: F.regexp_replace(c, "\r", "")
    return structured_header(clean(transcript), clean(gene), clean(locus), F.nullif(clean(name), F.lit("")), genome, run)
