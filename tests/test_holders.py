"""Packed lists of holders: what goes in comes out, of any kind, and spread holders take few bytes."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from genoweave.operators import hits, holders


def test_columns_come_back_as_they_were():
    far = 1 << 61
    genes = np.array([5, -far, far, 0, far + 1, -3, -3], np.int64)
    columns = [holders._steps(genes), np.array([], np.uint32), np.array([0.5, np.nan, -0.0]), np.zeros(9, np.int16), np.arange(300).astype(np.uint8)]
    found = holders.unpacked(holders.packed(columns))
    assert [c.dtype for c in found] == [c.dtype for c in columns] and all(a.tobytes() == b.tobytes() for a, b in zip(found, columns, strict=True))
    assert holders._genes(found[0]).tolist() == genes.tolist()


@pytest.mark.parametrize(("once", "many"), [(False, 700), (True, 350)])
def test_a_spread_holder_takes_few_bytes(once, many):
    """Each of an item's 30 buyers is in another lot, so a copy of the list goes to 30 lots: 8.1 bytes a holder before."""
    r, n, lots = np.random.default_rng(1), 20_000, 100
    gene = np.sort(r.integers(0, 900_000, (n, 30)), axis=1).reshape(-1)
    rows = pa.RecordBatch.from_pydict({"gene": gene, "item": np.repeat(np.arange(n), 30), "g": (gene % 5).astype(np.int32), "x": r.integers(1, 51, n * 30).astype(float), "lot": (gene // 9_000).astype(np.int32)})
    blocks = [b for batch in holders.dealt(once)(rows.slice(i, 10_000) for i in range(0, n * 30, 10_000)) for b in batch["packed"].to_pylist()]
    entries = sum(int(holders.unpacked(b)[1].sum()) for b in blocks)
    assert entries > n * many and len(blocks) == lots
    assert sum(map(len, blocks)) / entries < 4


def test_an_items_rows_stay_together(monkeypatch):
    monkeypatch.setattr(holders, "_ROWS", 10)
    item = [0] * 3 + [1] * 45 + [2] * 2 + [3] * 9 + [4] * 40 + [5] * 30 + [6]
    rows = pa.RecordBatch.from_pydict({"item": item})
    found = [t["item"].to_pylist() for t in holders._whole_items(rows.slice(i, 4) for i in range(0, len(item), 4))]
    assert sum(found, []) == item and len(found) > 2
    assert all(not set(a) & set(b) for i, a in enumerate(found) for b in found[:i])


@pytest.mark.parametrize("group", [lambda g: None, lambda g: f"name {g}", lambda g: None if g % 3 else f"{g}"])
@pytest.mark.parametrize("by_pair", [False, True])
def test_any_number_of_groups(spark, group, by_pair):
    r = random.Random(4)
    held = {(r.randrange(400), r.randrange(60)): float(r.randrange(1, 400)) for _ in range(1500)}
    want = defaultdict(float)
    for (q, i), x in held.items():
        for (s, j), y in held.items():
            if i == j and q != s:
                want[q, s] += min(x, y)
    rows = spark.createDataFrame([(g, i, x, group(g)) for (g, i), x in held.items()] + [(1, None, 2.0, None), (2, None, 2.0, None)], "gene long, item long, x double, g string")
    found = (hits.shared_item_hits_by_pair if by_pair else hits.shared_item_hits)(rows, 3, 150, 64).collect()
    assert {(h["q"], h["s"]): h["shared"] for h in found} == dict(want) and len(found) == len(want)
    assert all(h["g_q"] == group(h["q"]) and h["g_s"] == group(h["s"]) for h in found)
