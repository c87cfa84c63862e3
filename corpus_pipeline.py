"""A corpus pipeline: toxicity, SimHash near-dedup, substring dedup, mixing to target weights, best-fit packing.

Each stage takes what its predecessor kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genoweave.llm.common import table
from genoweave.llm.mixing import mixed_documents
from genoweave.llm.packing import pack
from genoweave.llm.simhash import deduplicated
from genoweave.llm.substring_dedup import without_repeats
from genoweave.llm.toxicity import without_toxic
from genoweave.lineage import shared_folder
from genoweave.ship import ship


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance model, trained on the labelled rows, does not reject."""
    ship(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents whose sets of five-word shingles are alike by 0.8 or more the one with the smallest id."""
    ship(spark)
    return deduplicated(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that occur before; documents that lose all words go."""
    ship(spark)
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights: a document for each pass that takes words of it."""
    ship(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the token pieces in sequences."""
    ship(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

#: The trained model and the keyed permutations have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path on it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def run(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """The last stage's rows; each stage's result is written as Parquet to the cluster's shared folder and read again.

    A run with a name can be resumed: stages whose results are there whole are not run again (forget() removes them). Without
    one, a stage's result goes as soon as the next one is written.
    Defined edge cases are those of the operators: null texts are empty, rows without an id or with a repeated one are
    documents of their own, of equal rows the near-duplicate stage keeps one, an empty table gives an empty result with the
    same columns, and further columns of documents travel with their rows up to the last stage.
    """
    base = f"{shared_folder(spark)}/pipeline-{name or uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for stage_name, stage in STAGES:
        path = f"{base}/{stage_name}"
        files, done = _folder(spark, f"{path}/_SUCCESS")
        if not files.exists(done):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before and not name:
            files, old = _folder(spark, before)
            files.delete(old, True)
        before = path
    return docs


def forget(spark: SparkSession, name: str) -> None:
    """Removes what a named run has written."""
    files, path = _folder(spark, f"{shared_folder(spark)}/pipeline-{name}")
    files.delete(path, True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
