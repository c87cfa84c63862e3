"""SimHash near-duplicates by a binary trie self-join (operator 5).

Fingerprints are the strings of a binary trie. The self-join walks pairs of nodes together from the root, adds up the
bits in which their paths differ, and drops a pair once they are more than the budget. The upper levels are walked by
Spark joins, four bits a round, until each pair of nodes holds few enough fingerprints; heavy nodes alone go deeper, so a
crowded part of the trie is divided like any other. Each remaining pair is walked to the leaves by one task, which
returns a spanning forest of the links it found; connected components join the forests.

Deduplication (`deduplicated`) links documents whose sets of shingles are alike enough by Jaccard. The SimHash of a whole
set tells little of that: at 0.8 some 10 of 64 bits differ, a budget that prunes nothing in the upper trie. So each set
gets several fingerprints, each of a small sample that similar sets have in common with a known probability; the same
trie join finds the candidates, which are then verified on the texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import cut, packed
from genoweave.operators.graph import connected_components

SEED = 42


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 3
    max_bits: int = 2
    block: int = 32_768  # fingerprints of a node pair that one task walks
    step: int = 4  # bits of a round
    leaf: int = 32  # pairs of fingerprints below which a node pair is compared outright
    chunk: int = 16_384  # node pairs walked at a time, with up to `leaf` pairs each


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of each k-word shingle of a text with A-Z lower-cased; of the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    parts = map(joined.__getitem__, map(slice, starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(words) - k + 1)


def simhash(text: str, k: int) -> int:
    """The fingerprint as a signed 64-bit number: a bit is set if over half the shingles' hashes have it."""
    return majority(shingle_hashes(text, k))


def majority(h: np.ndarray) -> int:
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        set_bits += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, params: SimHashParams = SimHashParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (long): one row per input row; texts without words (null ones too) have fingerprint 0."""
    k = params.shingle

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([simhash(t.as_py() or "", k) for t in b.column(1)], pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Union-find over 0 .. n-1, by arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, diff: int, params: SimHashParams) -> np.ndarray:
    """Forest roots of the fingerprints a, then b (both sorted, unsigned, each under one node of the trie at depth;
    b None: the same node), joined where they differ in at most max_bits."""
    same, other = b is None, a if b is None else b
    shift = 0 if same else len(a)
    forest = Forest(len(a) + (0 if same else len(b)))
    one = lambda x: np.array([x], np.int64)
    stack = [(depth, one(0), one(len(a)), one(0), one(len(other)), one(diff))]
    while stack:
        k, a0, a1, b0, b1, d = stack.pop()
        if len(a0) > params.chunk:
            half = len(a0) // 2
            stack += [(k, *(x[:half] for x in (a0, a1, b0, b1, d))), (k, *(x[half:] for x in (a0, a1, b0, b1, d)))]
            continue
        count = (a1 - a0) * (b1 - b0)
        small = count <= params.leaf
        if small.any():
            p0, q0, n, width = a0[small], b0[small], count[small], (b1 - b0)[small]
            which = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            i, j = p0[which] + at // width[which], q0[which] + at % width[which]
            near = np.bitwise_count(a[i] ^ other[j]) <= params.max_bits
            if same:
                near &= i < j
            forest.join(i[near], j[near] + shift)
        a0, a1, b0, b1, d = (x[~small] for x in (a0, a1, b0, b1, d))
        if not len(a0):
            continue
        bit = np.uint64(1) << np.uint64(63 - k)
        high = ~(bit | (bit - np.uint64(1)))
        am = np.searchsorted(a, (a[a0] & high) | bit)
        bm = np.searchsorted(other, (other[b0] & high) | bit)
        twin = same & (a0 == b0) & (a1 == b1)
        parts = [(a0, am, b0, bm, d, None), (am, a1, bm, b1, d, None), (a0, am, bm, b1, d + 1, None), (am, a1, b0, bm, d + 1, ~twin)]
        kept = []
        for p0, p1, q0, q1, e, also in parts:
            ok = (p1 > p0) & (q1 > q0) & (e <= params.max_bits)
            if also is not None:
                ok &= also
            kept.append(tuple(x[ok] for x in (p0, p1, q0, q1, e)))
        merged = [np.concatenate(x) for x in zip(*kept, strict=True)]
        if len(merged[0]):
            stack.append((k + 1, *merged))
    return forest.root


def _prefix(fp: Column, depth: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(fps: DataFrame, params: SimHashParams) -> list[tuple[int, DataFrame]]:
    """(depth, DataFrame a, b, diff): the pairs of trie nodes, a <= b, that tasks walk on from there.

    In a round each heavy pair goes to its children: a's children by a join, and for each the children that b may have
    within the budget, which another join looks up.
    """
    n = fps.count()
    root = fps.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").cast("int").alias("diff"))
    if n <= params.block:
        return [(0, root)] if n else []
    heavy, out, depth = root, [], 0
    while True:
        depth += params.step
        nodes = cut(fps.groupBy(_prefix(F.col("fp"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n")))
        left = nodes.select(F.shiftrightunsigned("node", params.step).alias("a"), F.col("node").alias("x"), F.col("n").alias("nx"))
        flips = F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("bits")) for m in range(1 << params.step))))
        pairs = heavy.join(left, "a").select("a", "b", "diff", "x", "nx", flips.alias("flip")).filter(F.col("diff") + F.col("flip.bits") <= params.max_bits)
        low = F.lit((1 << params.step) - 1).cast("long")
        pairs = pairs.withColumn("y", F.shiftleft("b", params.step).bitwiseOR(F.col("x").bitwiseAND(low).bitwiseXOR(F.col("flip.mask")))).filter("a < b OR x <= y")
        pairs = pairs.join(nodes.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y")
        held = F.when(F.col("x") == F.col("y"), F.col("nx")).otherwise(F.col("nx") + F.col("ny"))
        pairs = cut(pairs.select(F.col("x").alias("a"), F.col("y").alias("b"), (F.col("diff") + F.col("flip.bits")).alias("diff"), (held > params.block).alias("heavy")))
        out.append((depth, pairs.filter(~F.col("heavy")).select("a", "b", "diff")))
        heavy = pairs.filter("heavy").select("a", "b", "diff")
        if depth + params.step > 64 or not heavy.limit(1).count():
            return out


def near_links(fps: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """u, v: links whose components are those of all pairs of distinct fingerprints within max_bits of each other."""
    units = None
    for depth, pairs in node_pairs(fps, params):
        keyed = fps.withColumn("node", _prefix(F.col("fp"), depth))
        key = [F.lit(depth).alias("depth"), "a", "b", "diff"]
        sides = keyed.join(pairs, F.col("node") == F.col("a")).select(*key, F.lit(0).alias("side"), "fp")
        sides = sides.unionByName(keyed.join(pairs.filter("a <> b"), F.col("node") == F.col("b")).select(*key, F.lit(1).alias("side"), "fp"))
        units = sides if units is None else units.unionByName(sides)
    if units is None:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        side, fp = frame["side"].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        root = walk(a, b if len(b) else None, int(frame["depth"].iloc[0]), int(frame["diff"].iloc[0]), params)
        every = np.concatenate([a, b]).view(np.int64)
        hung = root != np.arange(len(root))
        return pd.DataFrame({"u": every[hung], "v": every[root[hung]]})

    return units.groupBy("depth", "a", "b", "diff").applyInPandas(run, "u long, v long")


def simhash_components(docs: DataFrame, params: SimHashParams = SimHashParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: one row per input row.

    Defined edge cases: texts without words, null ones too, have fingerprint zero and link like any other; fewer words
    than a shingle are hashed as a whole; rows that repeat an id are rows of their own; a null id has the component of its
    fingerprint; an empty table gives no rows; only the two columns are read.
    """
    marked = cut(fingerprints(docs, params, id_col, text_col))  # 16 bytes a row; texts are hashed once
    fps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))  # copies meet here, before any pair is made
    joined = connected_components(cut(near_links(fps.select("fp"), params)), "u", "v")
    of = fps.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    of = cut(of)
    firsts = of.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = cut(of.join(firsts, "component").select(F.col("fp").alias("label_fp"), "component_id"))
    out = marked.join(labels.hint("merge"), F.col("fp") == F.col("label_fp"), "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near-duplicates by shingle similarity ------------------------------------------------------------------------------


@dataclass(frozen=True)
class NearParams:
    shingle: int = 5
    similarity: float = 0.8  # Jaccard, of the sets of shingles
    samples: int = 14  # fingerprints of a set
    sample: int = 3  # shingles behind each; two sets of similarity s have a sample in common with probability s ** sample
    max_bits: int = 1  # of candidates: another shingle in a sample changes some 16 bits of 64
    trie_block: int = 524_288  # fingerprints of a node pair that one task walks
    parts_bits: int = 7  # log2 of the parts of the hash range in which a set's members are counted
    salted: int = 64  # texts that meet one copy of the text they are compared with
    unit: int = 512  # members of a group that meet each other in one piece
    hot: int = 100_000  # members of a group that are looked up by a broadcast: at most one group for so many fingerprints


def sampled_fingerprints(h: np.ndarray, params: NearParams) -> np.ndarray:
    """The SimHash of each sample of a set of hashes: its least members in as many orders. Equal samples, equal bits."""
    k = min(params.sample, len(h))
    if not k:
        return np.zeros(params.samples, np.int64)
    if len(h) <= params.sample:
        return np.full(params.samples, majority(h), np.int64)
    salts = (np.arange(1, params.samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    step = max(1, 1_000_000 // len(h))  # orders at a time, to bound memory
    chosen = []
    for at in range(0, params.samples, step):
        x = (h[None, :] ^ salts[at : at + step]) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        chosen.append(h[np.argpartition(x ^ (x >> np.uint64(32)), k - 1, axis=1)[:, :k]])
    bits = np.unpackbits(np.concatenate(chosen).view(np.uint8).reshape(params.samples, k, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
    return np.packbits(2 * bits > k, axis=1, bitorder="little").view(np.int64).ravel()


def signature(text: str, params: NearParams) -> tuple[int, list[int], int, bytes]:
    """Of the set of shingles: its hash, its samples' fingerprints, its size, and how many members each part of the hash
    range has."""
    h = np.unique(shingle_hashes(text, params.shingle))
    parts = np.bincount((h >> np.uint64(64 - params.parts_bits)).astype(np.int64), minlength=1 << params.parts_bits)
    whole = xxhash.xxh64_intdigest(h.tobytes(), SEED)
    return whole - ((whole >> 63) << 64), np.unique(sampled_fingerprints(h, params)).tolist(), len(h), np.minimum(parts, 255).astype(np.uint8).tobytes()


def may_be_similar(n: tuple, parts: tuple, similarity: float) -> np.ndarray:
    """Whether sets can have the similarity, by their sizes and the counts of their parts, which bound it from above."""
    x, y = n
    ok = np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9
    unlike = np.abs(parts[0][ok].astype(np.int16) - parts[1][ok]).sum(axis=1)
    ok[ok] = unlike * (1 + similarity) <= (x[ok] + y[ok]) * (1 - similarity) + 1e-9
    return ok


def _by_group(big: DataFrame, groups: DataFrame, params: NearParams) -> DataFrame:
    """big joined with groups (fp, size, ...) on fp. The few large groups are broadcast, so that no task reads one whole."""
    large = F.col("size") > params.hot
    rest = big.join(groups.filter(~large), "fp")
    return rest.unionByName(big.join(F.broadcast(groups.filter(large)), "fp")) if groups.filter(large).limit(1).count() else rest


def _members(nodes: DataFrame, params: NearParams) -> DataFrame:
    """fp, sig, size, rep: the groups of two nodes and more whose samples' fingerprints the trie join puts together, and
    of each the node whose groups hold most, which is nearest to the common text of near copies."""
    each = nodes.select("sig", F.explode("fps").alias("fp"))
    fps = cut(each.groupBy("fp").agg(F.count(F.lit(1)).alias("size")))  # equal ones meet here
    links = cut(near_links(fps.select("fp"), SimHashParams(max_bits=params.max_bits, block=params.trie_block, step=2)))
    groups = fps.filter("size > 1")
    if links.limit(1).count():  # fingerprints that are near, not equal: their groups become one, named by the least
        joined = cut(connected_components(links, "u", "v").toDF("fp", "group"))
        each = each.join(joined, "fp", "left").select("sig", F.coalesce("group", "fp").alias("fp")).distinct()
        groups = fps.join(joined, "fp", "left").groupBy(F.coalesce("group", "fp").alias("fp")).agg(F.sum("size").alias("size")).filter("size > 1")
    members = cut(_by_group(each, cut(groups), params))
    central = members.join(members.groupBy("sig").agg(F.sum("size").alias("reach")), "sig")
    reps = central.groupBy("fp").agg(F.max("size").alias("size"), F.max(F.struct("reach", "sig"))["sig"].alias("rep"))
    return cut(_by_group(members.drop("size"), cut(reps), params))


def _similar(p: np.ndarray, q: np.ndarray, params: NearParams) -> bool:
    """Whether two sets of shingle hashes have the similarity."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both >= params.similarity * (len(p) + len(q) - both) - 1e-9


def _verified(pairs: DataFrame, params: NearParams) -> DataFrame:
    """u, v of those rows u, v, text_u, text_v whose texts have the similarity; exact."""
    hashes = lambda t: np.unique(shingle_hashes(t.as_py() or "", params.shingle))

    def run(batches):
        for b in batches:
            keep = [_similar(hashes(x), hashes(y), params) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


_UNIT = "fp long, x long, y long, block long, sig long, comp long, n long, parts binary, groups array<long>"


def whole_units(batches) -> Iterator[pa.Table]:
    """The rows of batches, sorted by unit (fp, x, y), in tables that hold whole units."""
    rest = None  # the last unit so far, which may go on
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        key = [t[c].to_numpy() for c in ("fp", "x", "y")]
        at = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
        begin = int(at[-1]) + 1 if len(at) else 0
        if begin:
            yield t.slice(0, begin).combine_chunks()
        rest = t.slice(begin).combine_chunks()
    if rest is not None:
        yield rest


def pairs_apart(t: pa.Table, params: NearParams, at_a_time: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of a unit that are not of one comp and may be similar. Units of two blocks pair one with the
    other; a pair that meets in several groups is one of the least group alone."""
    fp, x, y, block, comp, n = (t[c].to_numpy() for c in ("fp", "x", "y", "block", "comp", "n"))
    parts = np.frombuffer(b"".join(t["parts"].to_pylist()), np.uint8).reshape(len(n), -1)
    none = np.iinfo(np.int64).max
    groups = np.array([(g + [none] * params.samples)[: params.samples] for g in t["groups"].to_pylist()], np.int64).reshape(len(n), params.samples)
    new = np.append(True, (fp[1:] != fp[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    begin = np.flatnonzero(new)
    count = np.append(begin[1:], len(n))[np.cumsum(new) - 1] - np.arange(len(n)) - 1  # rows of the unit behind each
    total = np.cumsum(count)
    at = 0
    while at < len(n):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + at_a_time, "right")))
        own = np.arange(at, upto)
        i = np.repeat(own, count[own])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
        at = upto
        ok = (comp[i] != comp[j]) & ((x[i] == y[i]) | (block[i] != block[j]))
        i, j = i[ok], j[ok]
        ok = may_be_similar((n[i], n[j]), (parts[i], parts[j]), params.similarity)
        i, j = i[ok], j[ok]
        common = ((groups[i][:, :, None] == groups[j][:, None, :]).any(axis=2)) & (groups[i] != none)
        ok = np.where(common, groups[i], none).min(axis=1, initial=none) == fp[i]
        if ok.any():
            yield i[ok], j[ok]


def _links_apart(members: DataFrame, nodes: DataFrame, texts: DataFrame, params: NearParams) -> DataFrame:
    """u, v: verified links between the comps (of nodes: sig, comp, n, parts) that a group has; of a unit a spanning
    forest, so that no list of all its pairs is made.

    A first pass finds the members that have anyone to be compared with, a second one has their texts.
    """
    located = members.select("fp", "size", "sig").join(nodes, "sig")
    mixed = cut(located.groupBy("fp").agg(F.max("size").alias("size"), F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("fp", "size"))
    located = _by_group(located.drop("size"), mixed, params)
    # a large group is divided into blocks, which meet two at a time
    dealt = located.withColumn("blocks", F.ceil(F.col("size") / params.unit).cast("long")).withColumn("block", F.pmod(F.xxhash64("sig", F.lit("block")), F.col("blocks")))
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = sent.select("fp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "sig", "comp", "n", "parts", "groups")
    key = ["fp", "x", "y"]

    def open_ones(batches):
        for t in whole_units(batches):
            some = np.zeros(t.num_rows, bool)
            for i, j in pairs_apart(t, params):
                some[i] = some[j] = True
            yield from t.filter(pa.array(some)).to_batches()

    def forests(batches):
        for t in whole_units(batches):
            sig, text, sets = t["sig"].to_numpy(), t["text"], {}
            root = {c: c for c in t["comp"].to_pylist()}
            comp = t["comp"].to_numpy()

            def find(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            def of(k):
                if k not in sets:
                    sets[k] = np.unique(shingle_hashes(text[k].as_py() or "", params.shingle))
                return sets[k]

            found, unit = [], None
            fp, x, y = (t[c].to_numpy() for c in key)
            for i, j in pairs_apart(t, params):
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    if unit != (now := (fp[a], x[a], y[a])):
                        unit = now
                        sets.clear()
                    p, q = find(comp[a]), find(comp[b])
                    if p != q and _similar(of(a), of(b), params):
                        root[max(p, q)] = min(p, q)
                        found.append((sig[a], sig[b]))
            u, v = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    opened = units.repartition(*key).sortWithinPartitions(*key).mapInArrow(open_ones, _UNIT)
    with_texts = opened.join(texts.select("sig", "text").hint("merge"), "sig").repartition(*key).sortWithinPartitions(*key)
    return with_texts.mapInArrow(forests, "u long, v long")


def similar_links(nodes: DataFrame, rows: DataFrame, params: NearParams) -> DataFrame:
    """u, v: verified links whose components are those of all candidates with the similarity.

    Each node is first verified against the central node of the group that it shares most samples with, which makes one
    component of most of a group of near copies, however large; then all candidates that are not yet in one component are.
    """
    members = _members(nodes, params)
    shared = members.filter("sig <> rep").groupBy("sig", "rep").agg(F.count(F.lit(1)).alias("k"), F.max("size").alias("size"))
    tried = cut(shared.groupBy("sig").agg(F.max(F.struct("k", "size", "rep")).alias("best")).select(F.col("sig").alias("u"), F.col("best.rep").alias("v"), F.ceil(F.col("best.size") / params.salted).alias("copies")))
    heads = tried.groupBy("v").agg(F.max("copies").alias("copies"))
    named = members.groupBy("sig").agg(F.sort_array(F.collect_set("fp")).alias("groups"))  # at most one for each sample
    roles = named.join(tried.select(F.col("u").alias("sig"), "v", F.pmod(F.xxhash64("u", F.lit("salt")), F.col("copies")).alias("salt")), "sig", "left")
    roles = roles.join(heads.select(F.col("v").alias("sig"), "copies"), "sig", "left")
    touched = cut(nodes.join(roles, "sig").select("sig", "first", "n", "parts", "groups", "v", "salt", "copies"))
    wanted = touched.select("sig", "v", "salt", "copies", F.col("first.id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    found = rows.select("id", "mark", "text").join(wanted, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark")))
    texts = cut(found.select("sig", "v", "salt", "copies", "text").dropDuplicates(["sig"]))  # of nodes in groups alone
    one = texts.filter("v IS NOT NULL").select(F.col("sig").alias("u"), "v", "salt", F.col("text").alias("text_u"))
    other = texts.filter("copies IS NOT NULL").select(F.col("sig").alias("v"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"), F.col("text").alias("text_v"))
    good = cut(_verified(one.join(other.hint("merge"), ["v", "salt"]), params))
    comps = connected_components(good, "u", "v")
    located = cut(touched.join(comps, F.col("sig") == F.col("node"), "left").select("sig", F.coalesce("component", "sig").alias("comp"), "n", "parts", "groups"))
    return cut(good.unionByName(_links_apart(members, located, texts, params)))


def deduplicated(docs: DataFrame, params: NearParams = NearParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates: of each component of links of at least the similarity one row stays, that with the
    smallest id (nulls last), the least hash of its text among equal ids.

    Candidates are sets with a sample's fingerprint in common, or within max_bits of it; a pair of similarity s is none
    with probability (1 - s ** sample) ** samples, 4e-05 at 0.8. Candidates are verified on the texts.
    Defined edge cases: texts without words, null ones too, are copies of each other; fewer words than a shingle are one
    shingle; of rows that repeat both id and text one stays; rows that share an id with different texts, and rows without
    an id, are documents of their own; an empty table gives no rows; other columns travel as they are, whatever their names.
    """
    rows = packed(docs, id_col, text_col).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            sig, fps, n, parts = zip(*(signature(t.as_py() or "", params) for t in b.column(2)), strict=True) if b.num_rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sig, pa.int64()), pa.array(fps, pa.list_(pa.int64())), pa.array(n, pa.int64()), pa.array(parts, pa.binary())], names=["id", "mark", "sig", "fps", "n", "parts"])

    marked = cut(rows.select("id", "mark", "text").mapInArrow(run, f"id {kind}, mark long, sig long, fps array<long>, n long, parts binary"))  # texts are hashed once
    order = F.struct(F.col("id").isNull().alias("last"), "id", "mark")
    nodes = cut(marked.groupBy("sig").agg(F.min(order).alias("first"), *(F.first(c).alias(c) for c in ("fps", "n", "parts"))))  # copies meet here
    joined = connected_components(similar_links(nodes, rows, params), "u", "v")
    firsts = nodes.select("sig", "first").join(joined, F.col("sig") == F.col("node"), "left").groupBy(F.coalesce("component", "sig").alias("of")).agg(F.min("first").alias("first"))
    kept = cut(firsts.select(F.col("first.id").alias("kept_id"), F.col("first.mark").alias("kept_mark")))
    out = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")), "left_semi")
    if marked.groupBy("id", "mark").count().filter("count > 1").limit(1).count():  # rows that are repeated
        alike = Window.partitionBy("id", "mark").orderBy(F.xxhash64("row"))
        out = out.withColumn("nth", F.row_number().over(alike)).filter("nth = 1")
    return out.select("row.*")
