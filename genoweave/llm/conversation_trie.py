"""Conversation prefix trie (operator 11).

Conversations that begin with the same turns share nodes. The trie is built by an LCP-aware external mergesort:

1. Tasks sort their conversations in runs; a row of a run carries its LCP, the number of first turns that it shares with
   the row before it.
2. Spark deals the runs out by ranges of (turns, id), so copies of one conversation and conversations behind one first
   turn spread over many tasks, and the shuffle files are the external storage of the runs.
3. A task merges the pieces of the runs that it got with a loser tree. Turns that two heads are known to share with the
   row that went out last are never compared again: the greater LCP wins, and equal ones are compared behind it.
4. Over the merged stream goes the stack of the open path: what the next conversation does not share is finished.
5. Only nodes on the first and on the last path of a task can go on in another task. Of those each task hands over the two
   paths, and one more pass with the same stack over these paths, two a task, finishes them.

Turns are compared by 128 bits of the SHA-256 of role and text, so texts are neither sorted nor sent; equality of turns
is exact up to collisions. A task holds the turns' digests of its range, `turns_per_range` on average, and a conversation is
one row of digests. The ids of conversations that end in a node are hashed as they come, or handed over in chunks.

Edge cases: a row without a conversation id belongs to none and is left out; null roles and texts are empty; turns go up
with nulls first, ties by role, then text, and repeated rows are turns of their own; a conversation without turns ends in
the root; no conversations give no rows. Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import buckets_for, cut, join_groups

#: Bytes of a turn's digest.
WIDE = 16


@dataclass(frozen=True)
class TrieParams:
    turns_per_range: int = 500_000
    run_bytes: int = 4_000_000
    ids_per_chunk: int = 50_000


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, i (a turn's place from 0), digest (hex) and size (bytes of the text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).filter("conv_id IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv_id", place.alias("i"), F.substring(F.sha2(said, 256), 1, 2 * WIDE).alias("digest"), F.octet_length("text").cast("long").alias("size"))


def kept_of_family(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 9


def regrown(turns: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """The turns of rebuilt conversations: the first h of the family's first conversation c - c % 5, then those behind the
    first h of its own; h is the CRC-32 of the decimal id, modulo 9. Rows (conv_id, phase, i, digest, size); a conversation
    that is left without turns keeps a row without a digest. Only the first `most` turns of a family's first are copied."""
    h = kept_of_family(F.col("conv_id"))
    own = turns.filter((F.col("i") >= h) | (F.col("i") == 0)).select("conv_id", F.lit(1).alias("phase"), "i", F.when(F.col("i") >= h, F.col("digest")).alias("digest"), "size")
    near = F.filter(F.transform(F.sequence(F.lit(1 - family), F.lit(family - 1)), lambda k: F.try_add("conv_id", k.cast("long"))), lambda c: c.isNotNull())
    heirs = F.filter(near, lambda c: (c - c % family == F.col("conv_id")) & (kept_of_family(c) > F.col("i")))
    copies = turns.filter(F.col("i") < most).filter(F.col("conv_id") % family == 0).select(F.explode(heirs).alias("conv_id"), F.lit(0).alias("phase"), "i", "digest", "size")
    return own.unionByName(copies)


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, key (the turns' digests in order) and sizes of conversations that have a row of their own (phase 1)."""
    turn = F.when(F.col("digest").isNotNull(), F.struct("phase", "i", "digest", "size"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"), F.max("phase").alias("own")).filter("own = 1")
    return grouped.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), "")).alias("key"), F.transform("t", lambda x: x["size"]).alias("sizes"))


# --- runs, and their merge ---


def shared_turns(a: bytes, b: bytes, known: int = 0) -> int:
    """How many first turns two keys share, of which `known` are known."""
    n, most = known, min(len(a), len(b)) // WIDE
    while n < most and a[n * WIDE : (n + 1) * WIDE] == b[n * WIDE : (n + 1) * WIDE]:
        n += 1
    return n


_RUNS = "run long, n long, lcp long, conv_id long, key binary, sizes array<long>"


def sorted_runs(p: TrieParams):
    """For mapInArrow over (conv_id, key, sizes): sorted runs of about run_bytes, each row with its LCP."""

    def write(run: int, rows: list) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0], r[1]))
        lcps = [0, *(shared_turns(a[0], b[0]) for a, b in zip(rows, rows[1:], strict=False))]
        return pa.RecordBatch.from_pydict(
            {"run": [run] * len(rows), "n": range(len(rows)), "lcp": lcps, "conv_id": [r[1] for r in rows], "key": [r[0] for r in rows], "sizes": [r[2] for r in rows]},
            pa.schema([("run", pa.int64()), ("n", pa.int64()), ("lcp", pa.int64()), ("conv_id", pa.int64()), ("key", pa.binary()), ("sizes", pa.list_(pa.int64()))]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for conv, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes")), strict=True):
                rows.append((key, conv, sizes))
                held += len(key) + 64
                if held >= p.run_bytes:
                    yield write(number, rows)
                    number, rows, held = number + 1, [], 0
        if rows:
            yield write(number, rows)

    return run


class _Head:
    """The head of a run's rows (n, lcp, key, conv_id, sizes); lcp is what it shares with the row that went out last."""

    __slots__ = ("at", "conv", "i", "key", "lcp", "live", "rows", "sizes")

    def __init__(self, i: int, rows: list):
        self.i, self.rows, self.at = i, rows, -1
        self.step()
        self.lcp = 0  # nothing went out yet

    def step(self) -> None:
        self.at += 1
        self.live = self.at < len(self.rows)
        if self.live:
            _, self.lcp, self.key, self.conv, self.sizes = self.rows[self.at]


def _play(a: _Head, b: _Head) -> tuple[_Head, _Head]:
    """(winner, loser): the lesser head, and the other one with its LCP to the winner."""
    if not (a.live and b.live):
        return (a, b) if a.live else (b, a)
    if a.lcp != b.lcp:
        return (a, b) if a.lcp > b.lcp else (b, a)
    lcp = shared_turns(a.key, b.key, a.lcp)
    x, y = a.key[lcp * WIDE : (lcp + 1) * WIDE], b.key[lcp * WIDE : (lcp + 1) * WIDE]
    winner, loser = (a, b) if (x, a.conv) < (y, b.conv) else (b, a)
    loser.lcp = lcp
    return winner, loser


def merged(runs: list[list]) -> Iterator[tuple[bytes, int, list, int]]:
    """(key, conv_id, sizes, LCP with the one before) of sorted runs in order, by a loser tree."""
    k = len(runs)
    heads, losers = [_Head(i, rows) for i, rows in enumerate(runs)], [None] * k

    def first(node: int) -> _Head:
        if node >= k:
            return heads[node - k]
        winner, losers[node] = _play(first(2 * node), first(2 * node + 1))
        return winner

    winner = first(1)
    while winner.live:
        yield winner.key, winner.conv, winner.sizes, winner.lcp
        winner.step()
        node = (winner.i + k) // 2
        while node:
            winner, losers[node] = _play(winner, losers[node])
            node //= 2


# --- the open path ---


class _Ends:
    """The SHA-256 of the decimal ids of a node, as they come."""

    __slots__ = ("hash", "some")

    def __init__(self):
        self.hash, self.some = hashlib.sha256(), False

    def add(self, ids: str) -> None:
        self.hash.update(("," + ids if self.some else ids).encode())
        self.some = True


_NOBODY = hashlib.sha256(b"").hexdigest()
#: What a node adds up, besides its least conversation.
_SUMS = ("n", "kids", "leaves", "saved")


class _Path:
    """A stack of open nodes, and columns with what is known of every node so far."""

    def __init__(self):
        self.depth, self.parent, self.size, self.least = array("q"), array("q"), array("q"), array("q")
        self.n, self.kids, self.leaves, self.saved = (array("q") for _ in _SUMS)
        self.sha: list[str | None] = []
        self.open: list[int] = []
        self.ends: dict[int, object] = {}

    def push(self, size: int) -> int:
        i = len(self.depth)
        self.depth.append(len(self.open))
        self.parent.append(self.open[-1] if self.open else -1)
        self.size.append(size)
        self.least.append(2**63 - 1)
        for name in _SUMS:
            getattr(self, name).append(0)
        self.sha.append(None)
        self.open.append(i)
        return i

    def finish(self, i: int) -> None:
        """Adds a node that is whole to its parent."""
        if not self.kids[i]:
            self.leaves[i] = 1
        self.saved[i] += (self.n[i] - 1) * self.size[i]
        if (up := self.parent[i]) >= 0:
            self.least[up] = min(self.least[up], self.least[i])
            self.kids[up] += 1
            for name in ("n", "leaves", "saved"):
                column = getattr(self, name)
                column[up] += column[i]


_OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PARTS = f"{_OUT}, place long, part long, key binary, stats array<long>, ids string"
_OUT_TYPES = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")]
_PART_SCHEMA = pa.schema([*_OUT_TYPES, ("place", pa.int64()), ("part", pa.int64()), ("key", pa.binary()), ("stats", pa.list_(pa.int64())), ("ids", pa.string())])
_EACH = 10_000


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= _EACH:
            yield _table(held, schema)
            held = []
    if held:
        yield _table(held, schema)


def _nodes(t: _Path, which: Iterator[int], parent_of) -> Iterator[tuple]:
    for i in which:
        yield t.least[i], t.depth[i], parent_of(i), t.n[i], t.kids[i], t.leaves[i], t.saved[i], t.sha[i] or _NOBODY


def ranges_to_nodes(p: TrieParams):
    """For mapInArrow over rows of runs, one range a task: the nodes that are whole in the range, and the two paths that
    may go on elsewhere. Of a path there is a row with its key and what its nodes add up in the range (least, sums, size),
    then rows with ids of conversations that end in one of its nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list] = {}
        for batch in batches:
            for r, *row in zip(*(batch.column(c).to_pylist() for c in ("run", "n", "lcp", "key", "conv_id", "sizes")), strict=True):
                pieces.setdefault(r, []).append(tuple(row))
        if not pieces:
            return
        for rows in pieces.values():
            rows.sort(key=lambda r: r[0])
        t, outer, ends = _Path(), [], {}
        last = b""

        def pop() -> None:
            i = t.open.pop()
            if i in first:
                return
            t.finish(i)
            if i in ends:
                held, sha = ends.pop(i), _Ends()
                for a in range(0, len(held), p.ids_per_chunk):
                    sha.add(",".join(map(str, held[a : a + p.ids_per_chunk])))
                t.sha[i] = sha.hash.hexdigest()

        first: set[int] = set()
        t.push(0)
        for key, conv, sizes, lcp in merged(list(pieces.values())):
            while len(t.open) > lcp + 1:
                pop()
            for size in sizes[lcp:]:
                t.push(size)
            if not outer:
                first = set(t.open)
                outer.append((key, list(t.open)))
            i, last = t.open[-1], key
            t.n[i] += 1
            t.least[i] = min(t.least[i], conv)
            ends.setdefault(i, array("q")).append(conv)
        if (tail := [i for i in t.open if i not in first]) or last != outer[0][0]:
            outer.append((last, list(t.open)))
        on_edge = first | set(tail)
        here = TaskContext.get().partitionId() * 2
        place = {i: here + w for w, (_, path) in reversed(list(enumerate(outer))) for i in path}
        seen: set[int] = set()

        def rows() -> Iterator[tuple]:
            whole = (i for i in range(len(t.depth)) if i not in on_edge)
            for row, i in zip(_nodes(t, whole, lambda i: None if t.parent[i] in on_edge else t.least[t.parent[i]]), (i for i in range(len(t.depth)) if i not in on_edge), strict=True):
                yield (*row, place[t.parent[i]] if t.parent[i] in on_edge else None, None, None, None, None)
            for w, (key, path) in enumerate(outer):
                stats = [x for i in path for x in ((t.least[i], *(getattr(t, s)[i] for s in _SUMS), t.size[i]) if i not in seen else (2**63 - 1, 0, 0, 0, 0, t.size[i]))]
                yield (*[None] * 8, here + w, 0, key, stats, None)
                part = 1
                for d, i in enumerate(path):
                    held = ends.get(i, ()) if i not in seen else ()
                    for a in range(0, len(held), p.ids_per_chunk):
                        yield (None, d, *[None] * 6, here + w, part, None, None, ",".join(map(str, held[a : a + p.ids_per_chunk])))
                        part += 1
                seen.update(path)

        yield from _batches(rows(), _PART_SCHEMA)

    return run


_TOP_SCHEMA = pa.schema([*_OUT_TYPES, ("place", pa.int64())])


def join_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over the paths of all ranges, in order: the nodes on them, and rows (place, depth, conv_id) that say
    which node is at a depth of a path."""
    t, last, names, sha = _Path(), None, [], {}
    each = 1 + len(_SUMS) + 1

    def pop() -> None:
        i = t.open.pop()
        t.finish(i)
        if i in sha:
            t.sha[i] = sha.pop(i).hash.hexdigest()

    for batch in batches:
        for place, key, stats, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("place", "key", "stats", "depth", "ids")), strict=True):
            if ids is not None:
                sha.setdefault(t.open[depth], _Ends()).add(ids)
                continue
            if last is None:
                t.push(0)
            else:
                lcp = shared_turns(last, key)
                while len(t.open) > lcp + 1:
                    pop()
            for d in range(len(t.open), len(key) // WIDE + 1):
                t.push(stats[d * each + each - 1])
            for d, i in enumerate(t.open):
                least, *sums, _ = stats[d * each : (d + 1) * each]
                t.least[i] = min(t.least[i], least)
                for name, x in zip(_SUMS, sums, strict=True):
                    getattr(t, name)[i] += x
            names.append((place, array("q", t.open)))
            last = key
    while t.open:
        pop()

    def rows() -> Iterator[tuple]:
        for row in _nodes(t, range(len(t.depth)), lambda i: t.least[t.parent[i]] if t.parent[i] >= 0 else None):
            yield (*row, None)
        for place, path in names:
            for d, i in enumerate(path):
                yield (t.least[i], d, *[None] * 6, place)

    yield from _batches(rows(), _TOP_SCHEMA)


def prefix_trie(seqs: DataFrame, turns: int, p: TrieParams = TrieParams()) -> DataFrame:
    """conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each
    node of the trie of sequences (conv_id, key, sizes); turns says about how many turns there are, for the ranges."""
    runs = seqs.select("conv_id", "key", "sizes").mapInArrow(sorted_runs(p), _RUNS)
    dealt = runs.repartitionByRange(buckets_for(seqs.sparkSession, turns, p.turns_per_range), "key", "conv_id")
    parts = cut(dealt.mapInArrow(ranges_to_nodes(p), _PARTS))
    out = [c for c, _ in _OUT_TYPES]
    paths = parts.filter("part IS NOT NULL").select("place", "part", "key", "stats", "depth", "ids")
    top = cut(paths.repartition(1).sortWithinPartitions("place", "part").mapInArrow(join_paths, f"{_OUT}, place long"))  # two paths a range
    whole = parts.filter("part IS NULL")
    named = top.filter("place IS NOT NULL").select("place", F.col("depth").alias("up"), F.col("conv_id").alias("_parent"))
    joined = join_groups(whole.filter("place IS NOT NULL").withColumn("up", F.col("depth") - 1), named, ["place", "up"], ["conv_id", "depth"])
    below = joined.withColumn("parent_conv_id", F.col("_parent"))
    return whole.filter("place IS NULL").select(*out).unionByName(below.select(*out)).unionByName(top.filter("place IS NULL").select(*out))


def with_last_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations as they are, with role and text of their last turn (null for the root)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    return nodes.join(rows.select("conv_id", place.cast("long").alias("depth"), "role", "text"), ["conv_id", "depth"], "left")


def conversation_trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The prefix trie of conversations (conv_id, turn, role, text) as they are."""
    rows = turns_of(conversations).withColumn("phase", F.lit(1))
    return prefix_trie(sequences(rows), conversations.count(), p)


def regrown_trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """The prefix trie of the rebuilt conversations; see regrown."""
    return prefix_trie(sequences(regrown(turns_of(conversations))), 2 * conversations.count(), p)
