"""Helpers that the training-data operators share: words, let-bindings, lineage cuts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.lineage import cut  # noqa: F401  shared by the operators

#: ASCII white space; what lies between is a word.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, inside one expression."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; none for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (all columns of docs as a struct), id, text: whatever docs' columns are called, no name clashes beside them."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def with_text(rows: DataFrame, text_col: str, text: Column) -> DataFrame:
    """The documents of packed rows with another text, and n_chars, where they have it, to match."""
    row = F.col("row").withField(f"`{text_col}`", text)
    if "n_chars" in rows.schema["row"].dataType.names:
        kind = rows.schema["row"].dataType["n_chars"].dataType
        row = row.withField("n_chars", F.when(text.eqNullSafe(F.col("text")), F.col("row.n_chars")).otherwise(F.length(text).cast(kind)))
    return rows.select(row.alias("row")).select("row.*")


def buckets_for(spark: SparkSession, total: int, per_bucket: int) -> int:
    """How many hash buckets hold about per_bucket units each; grows with the data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / per_bucket), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_groups(big: DataFrame, small: DataFrame, keys: list[str], spread: list[str], most: int = 5_000, salts: int = 64) -> DataFrame:
    """big with the columns of small, a row for each group, joined on keys (nulls match).

    small is counted first: up to `most` rows it is broadcast; beyond that a hot key of big is spread over salts by the
    columns `spread`, and small is copied to each salt.
    """
    renamed = small.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(c for c in small.columns if c not in keys))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    if renamed.limit(most + 1).count() <= most:
        renamed = F.broadcast(renamed)
    else:
        big = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
        renamed = renamed.withColumn("_copy", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        on = on & (F.col("_salt") == F.col("_copy"))
    return big.join(renamed, on, "left").drop("_salt", "_copy", *(f"_k{i}" for i in range(len(keys))))
