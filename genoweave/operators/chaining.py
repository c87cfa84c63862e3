"""Collinear chains of matches, by tiles of contig pairs.

A match can follow another only within max_distance places on both contigs, so matches that are linked by no such steps are
chained apart. Each orientation of a contig pair is divided into square tiles; a tile also gets the matches of its lower
neighbours that reach into it. A task finds the groups of linked matches of its tile. Groups that touch no edge are chained
right there; of the others, groups of neighbouring tiles that share a match are joined (connected components of the groups,
which are few), and each joined group is chained by itself. So one contig pair is the work of as many tasks as it has tiles,
and what a task holds is a tile or one group of linked matches.

Chains of a group are taken off one by one, best first. The scores are a dynamic programme over the matches in order; as
every place holds one match, a match has at most (max_distance + 1) ** 2 predecessors, found by ranges of the sorted matches.
Once a chain is off, only matches whose best way led through it are scored anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.lineage import cut
from genoweave.operators.graph import connected_components


@dataclass(frozen=True)
class ChainParams:
    """The defaults of the chaining stage."""

    gap_open: float = 0.0
    gap_extend: float = -1.0
    gap_length: int = 1
    constant_match: float | None = 3.0
    max_match: float = 50.0
    max_evalue: float = 10.0
    max_distance: int = 5
    min_pairs: int = 4
    min_score: float | None = None
    #: Places along a tile's side; at least 16 times the greatest distance are taken.
    tile: int = 1_024

    def least_score(self) -> float:
        """Half a match for each pair that a chain needs, unless set."""
        best = self.constant_match if self.constant_match is not None else self.max_match
        return self.min_score if self.min_score is not None else int(self.min_pairs * 0.5 * best)

    def side(self) -> int:
        return max(self.tile, 16 * (self.max_distance + 1))


# --- one group of matches -------------------------------------------------------------------------------------------------


def predecessors(x: np.ndarray, z: np.ndarray, p: ChainParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, before, gain): before[start[i]:start[i + 1]] are the matches that i can follow, in order, and gain what the
    gap to each costs. Matches are in order of x, then z."""
    n, far = len(x), p.max_distance
    column = np.concatenate([[0], np.cumsum(np.diff(x) > 0)]) if n else np.zeros(0, np.int64)
    at = x[np.concatenate([[0], np.flatnonzero(np.diff(x) > 0) + 1])] if n else x
    low = z - (z.min() if n else 0)
    wide = int(low.max(initial=0)) + far + 2
    key = column * wide + low
    mine, first, stop = [], [], []
    back = 1
    while n:
        c = column - back
        i = np.flatnonzero((c >= 0) & (x - at[np.maximum(c, 0)] - 1 <= far))
        if not len(i):
            break
        a = np.searchsorted(key, c[i] * wide + np.maximum(low[i] - 1 - far, 0), "left")
        b = np.searchsorted(key, c[i] * wide + low[i] - 1, "right")
        some = b > a
        mine.append(i[some]), first.append(a[some]), stop.append(b[some])
        back += 1
    if not mine or not sum(map(len, mine)):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    mine, first, stop = (np.concatenate(v[::-1]) for v in (mine, first, stop))  # farther columns come before
    order = np.argsort(mine, kind="stable")
    mine, first, stop = mine[order], first[order], stop[order]
    size = stop - first
    i = np.repeat(mine, size)
    before = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    gaps = np.floor(np.maximum(x[i] - x[before] - 1, z[i] - z[before] - 1) / p.gap_length + 0.5)
    return np.searchsorted(i, np.arange(n + 1)), before, np.where(gaps > 0, p.gap_open, 0.0) + p.gap_extend * gaps


def best_chains(x: np.ndarray, z: np.ndarray, score: np.ndarray, p: ChainParams) -> list[tuple[float, list[int]]]:
    """(score, matches) of the collinear chains, best first, each match in one chain at most.

    A chain goes up in both coordinates with at most max_distance places between neighbours; gaps cost open and extend for
    each gap_length. Ties go to the chain that ends earlier, then to the earlier predecessor.
    """
    order = np.lexsort((z, x))
    x, z, score = x[order], z[order], score[order]
    start, before, gain = (v.tolist() for v in predecessors(x, z, p))
    worth, n = score.tolist(), len(x)
    best, back, gone = [0.0] * n, [-1] * n, [False] * n
    heirs: list[list[int]] = [[] for _ in range(n)]

    def rate(i: int) -> None:
        top, by = 0.0, -1
        for e in range(start[i], start[i + 1]):
            j = before[e]
            if not gone[j] and (v := best[j] + gain[e]) > top:
                top, by = v, j
        best[i], back[i] = worth[i] + top, by
        if by >= 0:
            heirs[by].append(i)

    for i in range(n):
        rate(i)
    least, out = p.least_score(), []
    heap = [(-b, i) for i, b in enumerate(best) if b >= least]
    heapq.heapify(heap)
    while heap:
        total, i = heapq.heappop(heap)
        if gone[i] or -total != best[i]:
            continue
        chain = []
        while i >= 0:
            chain.append(i)
            gone[i] = True
            i = back[i]
        out.append((-total, order[chain[::-1]].tolist()))
        lost = [h for m in chain for h in heirs[m] if not gone[h] and back[h] == m]
        heapq.heapify(lost)
        last = -1
        while lost:
            if (i := heapq.heappop(lost)) == last:
                continue
            last, was = i, best[i]
            rate(i)
            if best[i] != was:
                for h in heirs[i]:
                    if not gone[h] and back[h] == i:
                        heapq.heappush(lost, h)
                if best[i] >= least:
                    heapq.heappush(heap, (-best[i], i))
    return out


def _groups(n: int, start: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The least match of the group that each match is in."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    starts = start.tolist()
    for i in range(n):
        for j in before[starts[i] : starts[i + 1]].tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], np.int64)


# --- tiles ----------------------------------------------------------------------------------------------------------------

PAIR = ["genome_a", "contig_a", "genome_b", "contig_b", "orient"]
_MATCH = ["gene_a", "gene_b", "x", "z", "score"]


def oriented(matches: DataFrame, p: ChainParams) -> DataFrame:
    """Each match in both orientations, x and z its places; backwards (-) z goes down with the second contig. The shift keeps
    a contig's first places off a tile's edge."""
    y = F.col("pos_b").cast("long")
    ways = F.array(F.struct(F.lit("+").alias("orient"), y.alias("z")), F.struct(F.lit("-").alias("orient"), (-y - (p.max_distance + 2)).alias("z")))
    return matches.select(*PAIR[:-1], "gene_a", "gene_b", F.col("pos_a").cast("long").alias("x"), F.col("score").cast("double").alias("score"), F.explode(ways).alias("w")).select("*", "w.orient", "w.z").drop("w")


def tiled(rows: DataFrame, p: ChainParams) -> DataFrame:
    """Rows with the tiles that they belong to (tx, tz; own) or reach into; shared: whether a match reaches into others."""
    side, reach = p.side(), p.max_distance + 1
    at = lambda c, more=0: F.floor((F.col(c) + more) / side).cast("long")
    own = F.struct(at("x").alias("tx"), at("z").alias("tz"))
    every = F.array_distinct(F.array(*(F.struct(at("x", i).alias("tx"), at("z", j).alias("tz")) for i in (0, reach) for j in (0, reach))))
    return rows.withColumn("own_tile", own).withColumn("shared", F.size(every) > 1).withColumn("tile", F.explode(every)).select(*PAIR, *_MATCH, "shared", F.col("tile.tx").alias("tx"), F.col("tile.tz").alias("tz"), (F.col("tile") == F.col("own_tile")).alias("own"))


#: Matches that a task holds at once, besides one tile or group.
_HELD = 200_000


def _lists(table: pa.Table, columns: list[str], members: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int32)
    picked = table.select(columns).take(pa.array(np.concatenate([*members, np.zeros(0, np.int64)]).astype(np.int64))).combine_chunks()
    arrays = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in picked.columns]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, names=columns))


def _schemas(rows: DataFrame) -> tuple[str, str]:
    kinds = dict(rows.dtypes)
    pair = ", ".join(f"{c} {kinds[c]}" for c in PAIR)
    match = ", ".join(f"{c}: {kinds[c]}" for c in _MATCH)
    return f"{pair}, chain_score double, end_x long, end_z long, members array<struct<gene_a: {kinds['gene_a']}, gene_b: {kinds['gene_b']}>>", f"part long, own array<struct<{match}, shared: boolean>>, ghosts array<struct<{match}>>"


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where in a sorted table rows with other keys than the row before begin."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in keys:
        column = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        codes = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _by_group(keys: list[str], work) -> object:
    """For mapInArrow over rows sorted by keys: work(table, starts) on tables of whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _HELD:
                table = pa.Table.from_batches(held)
                starts = _starts(table, keys)
                if cut_at := int(starts[-1]):
                    yield from work(table.slice(0, cut_at), starts[:-1]).to_batches()
                held = table.slice(cut_at).combine_chunks().to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield from work(table, _starts(table, keys)).to_batches()

    return run


def _apart(table: pa.Table, starts: np.ndarray, p: ChainParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, z, score of the matches of many groups, moved along x so that no match is near one of another group."""
    x, z, s = (table.column(c).to_numpy() for c in ("x", "z", "score"))
    low = x - x.min()
    return low + np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)])) * (int(low.max()) + p.max_distance + 2), z, s


def _chain_columns(table: pa.Table, x: np.ndarray, z: np.ndarray, s: np.ndarray, places: np.ndarray, p: ChainParams) -> dict:
    """The columns of the chains of the matches at these places."""
    found = best_chains(x[places], z[places], s[places], p)
    chains = [places[np.array(m)] for _, m in found]
    ends = pa.array(np.array([c[-1] for c in chains], np.int64))
    out = {c: table.column(c).take(ends) for c in PAIR}
    return out | {"chain_score": pa.array([t for t, _ in found], pa.float64()), "end_x": table.column("x").take(ends), "end_z": table.column("z").take(ends), "members": _lists(table, ["gene_a", "gene_b"], chains)}


def _tile_job(p: ChainParams):
    """Chains of the groups that no other tile sees; the other groups as they are, with the matches of other tiles (ghosts)."""

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        own, shared = (table.column(c).to_numpy() for c in ("own", "shared"))
        x, z, s = _apart(table, starts, p)
        whole, opened = np.arange(len(x)), []
        if not own.all() or shared.any():
            group = _groups(len(x), *predecessors(x, z, p)[:2])
            order = np.argsort(group, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
            inside = [own[m].all() and not shared[m].any() for m in parts]
            whole = np.sort(np.concatenate([*(m for m, i in zip(parts, inside, strict=True) if i), np.zeros(0, np.int64)]).astype(np.int64))
            opened = [m for m, i in zip(parts, inside, strict=True) if not i and own[m].any()]
        chained = _chain_columns(table, x, z, s, whole, p)
        k, n, first = len(chained["chain_score"]), len(opened), pa.array(np.array([m[0] for m in opened], np.int64))
        rest = {c: table.column(c).take(first) for c in (*PAIR, "tx", "tz")}
        rest |= {"part": pa.array(first, pa.int64()), "own": _lists(table, [*_MATCH, "shared"], [m[own[m]] for m in opened]), "ghosts": _lists(table, _MATCH, [m[~own[m]] for m in opened])}
        kinds = {c: v.type for c, v in (chained | rest).items()}
        filled = lambda columns, size: pa.table({c: columns[c] if c in columns else pa.nulls(size, t) for c, t in kinds.items()})
        return pa.concat_tables([filled(chained, k), filled(rest, n)])

    return _by_group([*PAIR, "tx", "tz"], work)


def _group_job(p: ChainParams):
    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        return pa.table(_chain_columns(table, *_apart(table, starts, p), np.arange(table.num_rows), p))

    return _by_group([*PAIR, "component"], work)


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, "x", "z", "gene_a", "gene_b")


def _open_chains(parts: DataFrame, p: ChainParams, schema: str) -> DataFrame:
    """Chains of the groups that touch tiles' edges, joined where they share a match."""
    named = parts.withColumn("id", F.concat_ws("|", *PAIR, "tx", "tz", "part"))
    match = [*PAIR, "gene_a", "gene_b", "x", "z"]
    ours = named.select("id", *PAIR, F.explode(F.filter("own", lambda m: m["shared"])).alias("m")).select("id", *PAIR, "m.*").select("id", *match)
    theirs = named.select(F.col("id").alias("other"), *PAIR, F.explode("ghosts").alias("m")).select("other", *PAIR, "m.*").select("other", *match)
    edges = ours.join(theirs, match).select("id", "other").distinct()
    joined = connected_components(edges, "id", "other").toDF("id", "component")
    rows = named.join(joined, "id", "left").select(*PAIR, F.coalesce("component", "id").alias("component"), F.explode("own").alias("m")).select(*PAIR, "component", *(f"m.{c}" for c in _MATCH))
    return _dealt(rows, [*PAIR, "component"]).mapInArrow(_group_job(p), schema)


def chains(matches: DataFrame, p: ChainParams = ChainParams()) -> DataFrame:
    """genome_a, contig_a, genome_b, contig_b, orient, chain (from 0, best first), chain_score, n and gene_a, gene_b of every
    chain of each pair of contigs, forward (+) and with the second contig reversed (-), of matches with a score."""
    rows = oriented(matches, p)
    whole, opened = _schemas(rows)
    parts = cut(_dealt(tiled(rows, p), [*PAIR, "tx", "tz"]).mapInArrow(_tile_job(p), f"{whole}, tx long, tz long, {opened}"))
    columns = [*PAIR, "chain_score", "end_x", "end_z", "members"]
    found = parts.filter("part IS NULL").select(*columns)
    if (rest := parts.filter("part IS NOT NULL")).limit(1).count():
        found = found.unionByName(_open_chains(rest, p, whole).select(*columns))
    last = F.element_at("members", -1)
    best_first = Window.partitionBy(*PAIR).orderBy(F.col("chain_score").desc(), "end_x", "end_z", last["gene_a"], last["gene_b"])
    numbered = found.withColumn("chain", (F.row_number().over(best_first) - 1).cast("long"))
    return numbered.select(*PAIR, "chain", "chain_score", F.posexplode("members").alias("n", "m")).select(*PAIR, "chain", "chain_score", F.col("n").cast("long").alias("n"), "m.gene_a", "m.gene_b")
