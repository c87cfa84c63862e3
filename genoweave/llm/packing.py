"""Best-fit packing of tokenised documents into fixed-length sequences (operator 10).

Pieces of equal length are interchangeable, so the plan is made on their histogram, which has at most one row for each
length up to the capacity, whatever the input's size: bin completion by branch and bound. A node fills the sequence of
the longest remaining piece; its branches are all undominated fillings, enumerated lazily, least waste first. A branch is cut
when the waste so far cannot lead below the best solution found (at first the best-fit decreasing one), and the search
ends at the lower bound or after a stated amount of work, first over all pieces, then over choices of the incumbent's
sequences. What the work did not settle is logged: sequences and lower bound. Pieces then take the plan's places by
their rank among the pieces of their length.
"""

from __future__ import annotations

import logging
import random
import unicodedata
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import cut

LOG = logging.getLogger(__name__)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class PackParams:
    capacity: int = 4_096
    end_id: int = 1
    tokenizer: str = ""  # path of the vocabulary file; empty: the public word_bpe_49k.json
    cache_words: int = 400_000  # words of each of the two generations whose ids a worker keeps
    work: int = 4_000_000  # steps of the search: lengths looked at and fillings tried
    part: int = 40_000  # steps spent on one choice of sequences
    per_bucket: int = 20_000  # pieces

    def path(self) -> str:
        if self.tokenizer:
            return self.tokenizer
        import public_tokenizers

        return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """The ids of white-space divided words, as little-endian bytes. The vocabulary drops white space, and no rule of it
    looks across it, so a text's ids are those of its words in turn; it lower-cases, so A-Z may be lowered first, but for
    words that may hold a special token; and a letter ends a run, so a full stop or comma behind one adds its own id, if
    neither lower-casing nor normalisation changes the word. A word of lower-case letters alone is one run, which goes to
    the model directly.

    Words are kept in two generations of `most` each: when the young one is full it becomes the old one, and words that
    are met again move back.
    """

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.run, self.most, self.old = tokenizer.encode, tokenizer.model.tokenize, most, {}
        self.letters = _byte_letters()
        self.marks = {ord(m): self.encoded(m) for m in ".,"}

    @staticmethod
    def settled(word: str) -> bool:
        return word == word.lower() and unicodedata.is_normalized("NFC", word)

    def encoded(self, word: str) -> bytes:
        if word.isalpha() and self.settled(word):
            return array("I", [t.id for t in self.run(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))]).tobytes()
        return array("I", self.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            s = word.decode("utf-8", "replace")
            ids = self[word[:-1]] + self.marks[word[-1]] if word[-1] in self.marks and s[-2:-1].isalpha() and self.settled(s) else self.encoded(s)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def of(self, text: bytes) -> bytes:
        if b"<|" in text:  # special tokens are matched before anything is lowered
            return b"".join(self[w if b"<|" in w else w.lower()] for w in text.split())
        return b"".join(map(self.__getitem__, text.lower().split()))


_ENCODERS: dict[str, WordIds] = {}


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """piece, start, length, crc32 of each capacity-long part."""
    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at : at + 4 * capacity]
        yield k, at // 4, len(part) // 4, zlib.crc32(part)


def tokenised_pieces(docs: DataFrame, params: PackParams = PackParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32. Only documents longer than the capacity are cut."""
    path, end = params.path(), np.array([params.end_id], "<u4").tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = _ENCODERS.setdefault(path, None) or WordIds(path, params.cache_words)
        _ENCODERS[path] = ids
        for batch in batches:
            rows = [(i, *p) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for p in pieces_of(ids.of(t.as_py() or b"") + end, params.capacity)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, PIECES)


# --- the plan ---------------------------------------------------------------------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, times), longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by volume; by the pieces too long to share, for every threshold; and by dual
    feasible functions, which round lengths to k-ths of a sequence so that what fits still weighs at most one."""
    lengths = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(x)] for x in lengths], np.int64)
    small = np.unique(np.concatenate([[0], lengths[2 * lengths <= capacity]]))  # thresholds; shorter pieces weigh nothing
    low, high = np.searchsorted(lengths, small, "left"), np.searchsorted(lengths, capacity - small, "right")
    number, best = np.concatenate([[0], np.cumsum(n)]), 0
    for k in range(1, 65):
        parts = (k + 1) * lengths
        weight = np.concatenate([[0], np.cumsum(n * np.where(parts % capacity, parts // capacity * capacity, k * lengths))])
        whole = weight[high] - weight[low] + (number[-1] - number[high]) * k * capacity
        best = max(best, int(-(-whole.max() // (k * capacity))))
    mass = np.concatenate([[0], np.cumsum(lengths * n)])
    half = int(np.searchsorted(lengths, capacity // 2, "right"))
    apart, paired = number[-1] - number[high], number[high] - number[half]
    rest = mass[half] - mass[low] - (paired * capacity - (mass[high] - mass[half]))
    return max(best, int((apart + paired + np.maximum(0, -(-rest // capacity))).max()))


class Work:
    """Steps that the search may still take."""

    def __init__(self, left: int):
        self.left = left


class Stock:
    """What is left: counts by length, and the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.lengths = sorted(self.counts)

    def take(self, filling: Filling, times: int = 0) -> int:
        """Uses a filling so often, or as often as the counts allow; how often that was."""
        times = times or min(self.counts[x] // k for x, k in filling)
        for x, k in filling:
            self.counts[x] -= k * times
            if not self.counts[x]:
                del self.counts[x]
                self.lengths.pop(bisect_right(self.lengths, x) - 1)
        return times

    def put(self, filling: Filling, times: int) -> None:
        for x, k in filling:
            if x not in self.counts:
                insort(self.lengths, x)
            self.counts[x] = self.counts.get(x, 0) + k * times


def best_fit(stock: Stock, room: int, used: dict[int, int]) -> dict[int, int]:
    """used and, again and again, the longest piece that still fits in room."""
    used = dict(used)
    at = bisect_right(stock.lengths, room)
    while at and room > 0:
        x = stock.lengths[at - 1]
        n = min(stock.counts[x] - used.get(x, 0), room // x)
        if n > 0:
            used[x] = used.get(x, 0) + n
            room -= n * x
        at = min(at - 1, bisect_right(stock.lengths, room))
    return used


def _with(longest: int, others: Filling) -> Filling:
    if others and others[0][0] == longest:
        return ((longest, others[0][1] + 1), *others[1:])
    return ((longest, 1), *others)


def fillings(stock: Stock, capacity: int, most_waste: int, work: Work) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) around the longest piece, lazily: all undominated ones of at most most_waste, least waste first.

    A piece that fills the room alone dominates all else. Otherwise the sums that can be made are found for every prefix
    of the lengths by bounded subset sums (bit sets), so the enumeration meets no dead end. A filling is dominated where
    a piece left over could replace one of its pieces, or two, and leave no more room.
    """
    longest = stock.lengths[-1]
    room = capacity - longest
    lengths = stock.lengths[: bisect_right(stock.lengths, room)]
    have = stock.counts if longest > room else stock.counts | {longest: stock.counts[longest] - 1}
    if lengths and not have[lengths[-1]]:
        lengths.pop()
    if not lengths:
        if room <= most_waste:
            yield room, ((longest, 1),)
        return
    if lengths[-1] == room:
        yield 0, _with(longest, ((room, 1),))
        return
    first: Filling = ()
    for x in reversed(lengths):  # the exact pair of most unlike pieces needs no bit sets
        y = room - x
        if y > x:
            break
        if have.get(y, 0) > (x == y):
            first = ((x, 2),) if x == y else ((x, 1), (y, 1))
            yield 0, _with(longest, first)
            break
    full = (1 << (room + 1)) - 1
    reach = [1]
    for x in lengths:
        sums, n, step = reach[-1], min(have[x], room // x), 1
        while n > 0:
            sums |= (sums << (min(step, n) * x)) & full
            n, step = n - step, 2 * step
        reach.append(sums)
    work.left -= len(lengths)

    def exactly(t: int, j: int) -> Iterator[Filling]:
        if not t:
            yield ()
            return
        for i in range(min(j, bisect_right(lengths, t)), 0, -1):
            if work.left <= 0 or not reach[i] >> t & 1:
                return
            work.left -= 1
            x = lengths[i - 1]
            for k in range(min(have[x], t // x), 0, -1):
                if reach[i - 1] >> (t - k * x) & 1:
                    for rest in exactly(t - k * x, i - 1):
                        yield ((x, k), *rest)

    def between(low: int, high: int, used: dict[int, int]) -> bool:
        """Whether a piece of such a length is left over."""
        at = bisect_left(lengths, low)
        while at < len(lengths) and lengths[at] <= high:
            if have[lengths[at]] > used.get(lengths[at], 0):
                return True
            at += 1
        return False

    def dominated(filling: Filling, waste: int) -> bool:
        used = dict(filling)
        if waste and any(between(x + 1, x + waste, used) for x, _ in filling):
            return True
        return any(between(x + y, x + y + waste, used) for a, (x, n) in enumerate(filling) for y, _ in filling[a + (n == 1) :])

    for waste in range(min(room, most_waste) + 1):
        if reach[-1] >> (room - waste) & 1:
            for filling in exactly(room - waste, len(lengths)):
                if filling and filling != first and not dominated(filling, waste):
                    yield waste, _with(longest, filling)
        if work.left <= 0:
            return


Plan = list[tuple[int, Filling]]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    stock, out = Stock(counts), []
    while stock.lengths:
        longest = stock.lengths[-1]
        filling = tuple(sorted(best_fit(stock, capacity - longest, {longest: 1}).items(), reverse=True))
        out.append((stock.take(filling), filling))
    return out


def least_waste(counts: dict[int, int], capacity: int, work: Work, skip: Callable[[], bool] = lambda: False) -> Plan | None:
    """The first descent of the search: each sequence gets the first filling, or a later one where skip says so. None if
    the work is spent on the way."""
    stock, out = Stock(counts), []
    while stock.lengths:
        chosen = None
        for _, filling in fillings(stock, capacity, capacity, work):
            chosen = filling
            if not skip():
                break
        if chosen is None:
            return None
        out.append((stock.take(chosen), chosen))
        work.left -= 1
    return out


def branch_and_bound(counts: dict[int, int], capacity: int, most: int, work: Work) -> Plan | None:
    """A packing into at most so many sequences, or None if there is none or the work is spent. Depth first; every open
    node keeps its own enumeration of fillings, so none is lost. A node may waste what the bound leaves of all waste; stocks
    that failed are not tried again with as many sequences used."""
    slack = most * capacity - sum(x * n for x, n in counts.items())
    if slack < 0:
        return None
    stock, path, failed = Stock(counts), [], {}
    open_nodes = [(fillings(stock, capacity, slack, work), slack)]
    while open_nodes and work.left > 0:
        branches, slack = open_nodes[-1]
        step = next(branches, None)
        if step is None:
            open_nodes.pop()
            if path:
                stock.put(path.pop(), 1)
            continue
        waste, filling = step
        stock.take(filling, 1)
        path.append(filling)
        work.left -= 1
        if not stock.lengths:
            return [(1, f) for f in path]
        state = hash(frozenset(stock.counts.items()))
        if failed.get(state, capacity * most) <= len(path):
            stock.put(path.pop(), 1)
            continue
        failed[state] = len(path)
        open_nodes.append((fillings(stock, capacity, slack - waste, work), slack - waste))
    return None


def _counts_of(planned: Plan) -> dict[int, int]:
    out: dict[int, int] = {}
    for times, filling in planned:
        for x, k in filling:
            out[x] = out.get(x, 0) + k * times
    return out


def _waste(filling: Filling, capacity: int) -> int:
    return capacity - sum(x * k for x, k in filling)


def sequences(planned: Plan) -> int:
    return sum(times for times, _ in planned)


def plan(counts: dict[int, int], params: PackParams = PackParams()) -> Plan:
    """(times, filling) that use every piece, in as few sequences as the search finds within its work.

    Incumbents are best fit decreasing and the first descent. If they miss the lower bound, the whole is searched for a
    packing with one sequence fewer; then, again and again, some sequences of the incumbent, wasteful ones first, are
    searched for a packing of theirs with one fewer. Where there is none, another packing of them, as good by the squares of
    its fills, may take their place, so that waste gathers. All ends at the lower bound or when the work is spent.
    """
    capacity = params.capacity
    if not counts:
        return []
    least, total, rng = lower_bound(counts, capacity), Work(params.work), random.Random(0)
    best = best_fit_decreasing(counts, capacity)
    if sequences(best) > least:
        other = least_waste(counts, capacity, total)
        if other and sequences(other) < sequences(best):
            best = other
    n = sequences(best)
    if n > least:
        part = Work(total.left // 4)
        total.left -= part.left
        best = branch_and_bound(counts, capacity, n - 1, part) or best
        total.left += part.left
    bins: Counter[Filling] = Counter()
    for times, filling in best:
        bins[filling] += times
    n = bins.total()
    while n > least and total.left > 0:
        ordered = sorted(bins, key=lambda f: (-_waste(f, capacity), f))
        total.left -= len(ordered)
        size, chosen, spare = rng.randint(3, 24), Counter(), 0
        while chosen.total() < size or spare < capacity:  # wasteful ones are likelier
            if chosen.total() >= n:
                break
            filling = ordered[int(len(ordered) * rng.random() ** (4 if spare < capacity else 2))]
            if chosen[filling] < bins[filling]:
                chosen[filling] += 1
                spare += _waste(filling, capacity)
            total.left -= 1
        old = [(k, f) for f, k in chosen.items()]
        own, size = _counts_of(old), sequences(old)
        part = Work(min(total.left, params.part))
        total.left -= part.left
        new = branch_and_bound(own, capacity, size - 1, part) if spare >= capacity else None
        total.left += max(part.left, 0)
        if new is None:
            part = Work(max(total.left, 0))
            new = least_waste(own, capacity, part, lambda: rng.random() < 0.3)
            total.left = part.left
            square = lambda p: sum(t * (capacity - _waste(f, capacity)) ** 2 for t, f in p)
            if new is None or sequences(new) > size or (sequences(new) == size and square(new) < square(old)):
                continue
        bins -= chosen
        for times, filling in new:
            bins[filling] += times
        n = bins.total()
    return [(times, filling) for filling, times in sorted(bins.items(), reverse=True)]


def places(planned: Plan) -> np.ndarray:
    """Rows length, first rank, times, per sequence, first sequence, offset: where the pieces of a length go, by rank."""
    rows, ranks, sequence = [], {}, 0
    for times, filling in planned:
        offset = 0
        for x, k in filling:
            rows.append((x, ranks.get(x, 0), times, k, sequence, offset))
            ranks[x] = ranks.get(x, 0) + times * k
            offset += k * x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def assign(spots: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sequence and offset of pieces by length and rank."""
    big = int(max(spots[:, 1].max(), rank.max(initial=0))) + 1
    at = np.searchsorted(spots[:, 0] * big + spots[:, 1], length * big + rank, "right") - 1
    _, first, _, k, sequence, offset = spots[at].T
    return sequence + (rank - first) // k, offset + (rank - first) % k * length


def pack(docs: DataFrame, params: PackParams = PackParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Defined edge cases: a null or empty text is a piece of one token, the end id; texts of any length are cut into
    capacity-long pieces and a rest; rows that repeat an id are packed each; an empty table gives no rows; only the two
    columns are read. Ties are ordered by id, so reruns agree.
    """
    pieces = cut(tokenised_pieces(docs, params, id_col, text_col))  # small rows; texts are tokenised once
    # the histogram has at most `capacity` rows
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    planned = plan(counts, params)
    if counts:
        LOG.info("%d sequences, at least %d are needed", sequences(planned), lower_bound(counts, params.capacity))
    spots = places(planned)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sum(counts.values()) // params.per_bucket))
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = keyed.withColumn("within", F.row_number().over(own)).join(firsts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("within") - 1).alias("rank"))

    def run(batches):
        for b in batches:
            sequence, offset = assign(spots, b.column("length").to_numpy(zero_copy_only=False), b.column("rank").to_numpy(zero_copy_only=False)) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")
