"""What holds beyond small inputs: long codes, long records, chains against the plain programme, shared folders."""

import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave import lineage
from genoweave.functions import scalars
from genoweave.operators import synteny
from genoweave.sources import formats


def test_codes_of_many_genomes(spark):
    d = spark.createDataFrame([(n,) for n in (1, 255, 4095, 4096, 1_000_000)], "n long")
    found = [tuple(r) for r in d.select("n", scalars.genome_code(F.col("n")).alias("c")).select("n", "c", scalars.genome_number(F.col("c"))).collect()]
    assert found == [(n, f"G{n:03x}", n) for n in (1, 255, 4095, 4096, 1_000_000)]


def test_fasta_records_are_read_whole(spark, tmp_path):
    long = "ACGT" * 300_000
    (tmp_path / "a.fa").write_text(f">one a > b >c\nAC\nGT\n>two\n{long}\n>three  last\r\nMK\r\n")
    found = {r["id"]: (r["desc"], r["seq"]) for r in formats.fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert found == {"one": ("a > b >c", "ACGT"), "two": ("", long), "three": ("last", "MK")}


def plain_chains(x, y, score, p):
    """The whole programme anew for each chain."""
    alive, out = sorted(range(len(x)), key=lambda m: (x[m], y[m], m)), []
    while alive:
        best, back = [], []
        for i, m in enumerate(alive):
            gain, prev = 0.0, -1
            for j in range(i):
                dx, dy = x[m] - x[alive[j]] - 1, y[m] - y[alive[j]] - 1
                if 0 <= dx <= p.max_distance and 0 <= dy <= p.max_distance:
                    gaps = int(max(dx, dy) / p.gap_length + 0.5)
                    got = best[j] + (p.gap_open if gaps else 0.0) + p.gap_extend * gaps
                    if got > gain:
                        gain, prev = got, j
            best.append(score[m] + gain)
            back.append(prev)
        top = max(range(len(alive)), key=lambda i: (best[i], -i))
        if best[top] < p.least_score():
            break
        chain, i = [], top
        while i >= 0:
            chain.insert(0, i)
            i = back[i]
        out.append((best[top], [alive[i] for i in chain]))
        alive = [m for i, m in enumerate(alive) if i not in chain]
    return out


def test_chains_match_the_plain_programme():
    r = random.Random(2)
    for _ in range(60):
        n = r.randrange(1, 90)
        x, y = (np.array([r.randrange(r.choice((20, 60, 200))) for _ in range(n)]) for _ in "xy")
        score = np.array([r.choice((3.0, 3.0, 5.5)) for _ in range(n)])
        p = synteny.ChainParams(gap_open=r.choice((0.0, -1.0)), gap_length=r.choice((1, 3)), min_score=r.choice((None, 3.0)))
        assert synteny.best_chains(x, y, score, p) == plain_chains(x.tolist(), y.tolist(), score.tolist(), p)


def test_a_cluster_has_to_name_its_shared_folder(spark):
    session = lambda master, named=None: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: named), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError):
        lineage.shared_folder(session("spark://host:7077"))
    with pytest.raises(ValueError):
        lineage.shared_folder(session("local-cluster[3,2,1000]"))
    assert lineage.shared_folder(session("yarn", "hdfs:///tmp/x/")) == "hdfs:///tmp/x"
    assert lineage.shared_folder(session("local[4]"))
