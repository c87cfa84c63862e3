"""Which comparisons are to be made, in which batches. Running and repeating them is the cluster's scheduler's work."""

from __future__ import annotations

import subprocess

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators.hits import all_pairs_of_genomes

#: Comparisons in a batch.
BATCH = 10


def pending(genomes: DataFrame, done: DataFrame) -> DataFrame:
    """genome_a, genome_b: the ordered pairs, a genome with itself too, that have no output yet."""
    return all_pairs_of_genomes(genomes).join(done.select("genome_a", "genome_b"), ["genome_a", "genome_b"], "left_anti")


def batches(pairs: DataFrame, size: int = BATCH) -> DataFrame:
    """batch: numbers of up to `size` pairs each, in order (the square of the number of genomes is small)."""
    return pairs.withColumn("batch", F.floor((F.row_number().over(Window.orderBy("genome_a", "genome_b")) - 1) / size))


def run(command: list[str]) -> str:
    """A command's output; an error if it fails."""
    return subprocess.run(command, check=True, capture_output=True, text=True).stdout
