"""Exact substring deduplication by recompression (operator 2).

Every text is parsed by recompression: a first round names runs of one token, the next ones split the symbols into left
and right ones and name each left-right pair. A name is a 64-bit hash of what it stands for, so names agree over the
whole corpus without a dictionary, and equal substrings get equal symbols inside. Along with each symbol goes its
context, the span of words that alone fixes it: a window which holds a symbol's context has that symbol wherever it
occurs. Each window is judged by the symbols of the highest round that it holds; if one of them occurs once in the
corpus, so does the window.

Rounds of Spark: count the symbols' names over the corpus; find the windows whose symbols all repeat, verify them by
128-bit hashes of their word sequences and find each one's first place; cut out the words that later places cover.
Texts are dealt to buckets by a hash of their id; a name or a window leaves a bucket once, however often it is there, so
a passage that a third of the corpus shares is no hot group.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import buckets_for, packed, with_text

_U = np.uint64
_SPACE = re.compile(rb"[\x09-\x0D\x20]+")


@dataclass(frozen=True)
class RepeatParams:
    window: int = 20  # words
    rounds: int = 6  # of pair naming
    bucket_bytes: int = 4_000_000  # of text


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of 64-bit numbers (the finaliser of a well-known generator)."""
    x = x + _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word) | 1  # never 0, the mark between texts
        return h


_HASHES = _WordHashes()


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of all words, with a 0 before each text and at the end; each text's first place and number of words."""
    parts, sizes, zero = [], [], np.zeros(1, _U)
    for text in texts:
        words = text.split()
        parts += [zero, np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))]
        sizes.append(len(words))
    n = np.array(sizes, np.int64)
    return np.concatenate([*parts, zero]), np.cumsum(n + 1) - n, n


@dataclass
class Level:
    name: np.ndarray
    lo: np.ndarray  # the context: words lo .. hi-1
    hi: np.ndarray


def parse(word: np.ndarray, rounds: int) -> list[Level]:
    """The levels of the recompression: after the runs, and after each round of pairs."""
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    length = np.diff(np.append(first, len(word)))
    name = np.where(length > 1, mix(word[first] ^ mix(length.astype(_U), 1), 2), word[first])
    name[word[first] == 0] = 0
    levels = [Level(name, first - 1, first + length + 1)]
    for r in range(1, rounds + 1):
        at = levels[-1]
        side = mix(at.name, 2 * r + 1) & _U(1)
        real = at.name != 0
        left, right = real & (side == 0), real & (side == 1)
        pair = np.append(left[:-1] & right[1:], False)
        second = np.append(False, pair[:-1])
        lo, hi = at.lo.copy(), at.hi.copy()
        # what stayed alone rests on the neighbour it could have joined
        alone_left, alone_right = np.flatnonzero(left & ~pair), np.flatnonzero(right & ~second)
        hi[alone_left] = np.maximum(hi[alone_left], at.hi[np.minimum(alone_left + 1, len(hi) - 1)])
        lo[alone_right] = np.minimum(lo[alone_right], at.lo[np.maximum(alone_right - 1, 0)])
        i = np.flatnonzero(pair)
        name = at.name.copy()
        name[i] = mix(at.name[i] ^ mix(at.name[i + 1], 2 * r), 2 * r + 2) | _U(1)
        hi[i] = at.hi[i + 1]
        keep = ~second
        levels.append(Level(name[keep], lo[keep], hi[keep]))
    return levels


def range_min(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of x[begin:end] for each (non-empty) range."""
    n = end - begin
    out = np.zeros(len(n), _U)
    table, k = x, 0
    while len(n):
        mine = np.flatnonzero((n >= 1 << k) & (n < 2 << k))
        out[mine] = np.minimum(table[begin[mine]], table[end[mine] - (1 << k)])
        if not (n >= 2 << k).any():
            break
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1
    return out


_INDEX = 28  # low bits that number symbols while the least is sought


def anchors(levels: list[Level], valid: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window the least name among the symbols of the highest level that it holds, the first of equal ones; 0
    where it holds none. Where that symbol's context begins. And the names of the symbols chosen, once for each place.

    Which symbols a window holds, and in which order, follows from its words alone, so equal windows have equal anchors.
    """
    out, where, chosen = np.zeros(len(valid), _U), np.zeros(len(valid), np.int64), []
    low = _U((1 << _INDEX) - 1)
    open_ = np.flatnonzero(valid)
    for r in range(len(levels) - 1, -1, -1):
        at = levels[r]
        fit = np.flatnonzero((at.hi - at.lo <= w) & (at.name != 0))
        begin = np.searchsorted(at.lo[fit], open_, "left")  # contexts are in order
        end = np.searchsorted(at.hi[fit], open_ + w, "right")
        some = end > begin
        name = mix(at.name[fit], 1000 + r) | _U(1)
        least = range_min((name & ~low) | np.arange(len(name), dtype=_U), begin[some], end[some]) & low
        out[open_[some]], where[open_[some]] = name[least], at.lo[fit][least]
        chosen.append(name[np.unique(least)])
        open_ = open_[~some]
        if not len(open_):
            break
    return out, where, np.concatenate(chosen)


def window_places(start: np.ndarray, size: np.ndarray, total: int, w: int) -> np.ndarray:
    """Which places begin a window within one text."""
    edge = np.zeros(total + 1, np.int64)
    long = size >= w
    np.add.at(edge, start[long], 1)
    np.add.at(edge, start[long] + size[long] - w + 1, -1)
    return np.cumsum(edge)[:total] > 0


def window_hashes(word: np.ndarray, at: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of the word sequences of the windows at `at`."""
    out = []
    for base, salt in ((0x2545F4914F6CDD1D, 5001), (0xD1342543DE82EF95, 5003)):
        inverse = pow(base, -1, 1 << 64)
        powers = np.concatenate([[_U(1)], np.cumprod(np.full(len(word) - 1, base, _U))]) if len(word) > 1 else np.ones(len(word), _U)
        back = np.concatenate([[_U(1)], np.cumprod(np.full(len(word) - 1, inverse, _U))]) if len(word) > 1 else np.ones(len(word), _U)
        sums = np.concatenate([[_U(0)], np.cumsum(mix(word, salt) * powers, dtype=_U)])
        out.append(mix((sums[at + w] - sums[at]) * back[at], salt + 1))
    return out[0], out[1]


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of True."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def text_spans(text: bytes, drop: np.ndarray) -> bytes:
    """The text without the words marked in drop. Between two words that stay next to each other the white space stays;
    where words were cut out, what stood before the next kept word stands."""
    ends = [m.span() for m in re.finditer(rb"[^\x09-\x0D\x20]+", text)]
    if not drop.any():
        return text
    kept = np.flatnonzero(~drop)
    if not len(kept):
        return b""
    first, last = runs_of(~drop)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        begin = ends[a][0] if not out else (ends[a - 1][1] if a else 0)
        out.append(text[begin : ends[b][1]])
    return b"".join(out)


# --- the kernels, each over the texts of one bucket -------------------------------------------------------------------


def _order(ids: list[int | None], texts: list[bytes]) -> list[int]:
    """The rows in order of id (nulls last), then text."""
    return sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))


def _rows(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """ids and texts of a bucket, in order."""
    ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
    key = _order(ids, texts)
    return [ids[i] for i in key], [texts[i] for i in key]


_NAMES = "bucket long, name long, own int"


def _names(table: pa.Table, p: RepeatParams) -> pa.Table:
    """bucket, name, own: the anchors of the bucket's windows, once each; own: 2 if it stands at several places."""
    word, start, size = tokens(_rows(table)[1])
    _, _, chosen = anchors(parse(word, p.rounds), window_places(start, size, len(word), p.window), p.window)
    name, n = np.unique(chosen, return_counts=True)
    bucket = np.full(len(name), table["bucket"][0].as_py(), np.int64)
    return pa.table({"bucket": bucket, "name": name.view(np.int64), "own": np.minimum(n, 2).astype(np.int32)})


_WINDOWS = "bucket long, name long, off int, doc long, place long, hashes array<long>, spans binary"
_PLACE = 36  # low bits of a place: the word; above: the row of the bucket


def _windows(table: pa.Table, repeated: pa.Table, p: RepeatParams) -> pa.Table:
    """The windows that may repeat. Of those whose anchor is in other buckets too, the bucket's first of each: windows side
    by side with one anchor in a row, by the anchor's name and its offset from the first, with a hash for each window. As
    `spans` in one row more: the places that a window of the bucket repeats, for certain."""
    names = [x.split()[0] for x in _WINDOWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    if not table.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    ids, texts = _rows(table)
    word, start, size = tokens(texts)
    valid = window_places(start, size, len(word), p.window)
    found, where, _ = anchors(parse(word, p.rounds), valid, p.window)
    name, is_wide = repeated["name"].to_numpy().view(_U), repeated["wide"].to_numpy(zero_copy_only=False).astype(bool)
    wide_at, none_at = np.isin(found, name[is_wide]), valid & (found == 0)
    at = np.flatnonzero((valid & (wide_at | np.isin(found, name[~is_wide]))) | none_at)
    h1, h2 = window_hashes(word, at, p.window)
    order = np.lexsort((at, h2, h1))
    new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))[: len(at)]
    later = np.sort(at[order[~new]])
    first = np.sort(order[new])
    first = first[wide_at[at[first]] | none_at[at[first]]]
    spot, hashed = at[first], h1[first]
    bare = found[spot] == 0  # a window without an anchor stands for itself
    key = np.where(bare, h2[first], found[spot])
    offset = np.where(bare, 0, where[spot] - spot)
    head = np.append(True, (spot[1:] != spot[:-1] + 1) | (key[1:] != key[:-1]) | (where[spot][1:] != where[spot][:-1]) | bare[1:])[: len(spot)]
    begin = np.flatnonzero(head)
    row = np.searchsorted(start, spot[begin], "right") - 1
    doc = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
    flags = np.zeros(len(word) + 1, bool)
    flags[later] = True
    spans = np.stack(runs_of(flags), axis=1).astype("<i8").tobytes()
    bucket, n = table["bucket"][0].as_py(), len(begin)
    columns = [
        np.full(n + 1, bucket, np.int64), np.append(key[begin], mix(np.array([bucket], _U), 77)).view(np.int64), np.append(offset[begin], 0).astype(np.int32),
        np.append(doc[row], 0), np.append((row << _PLACE) | (spot[begin] - start[row]), 0),
    ]
    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, [len(spot), len(spot) + 1]), pa.int32()), pa.array(np.append(hashed, _U(0)).view(np.int64)))
    marks = pa.array([None] * n + [spans], pa.binary())
    return pa.table([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=False)), lists, marks], names=names)


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<first: long, last: long>>"


def _cut(table: pa.Table, later: pa.Table, p: RepeatParams, whole: bool) -> pa.Table:
    """The result of each row: later has the places of windows that occur before."""
    ids, texts = _rows(table)
    split = [t.split() for t in texts]
    size = np.array([len(w) for w in split], np.int64)
    start = np.cumsum(size + 1) - size
    edge = np.zeros(int((size + 1).sum()) + p.window + 2, np.int64)
    for packed in later["spans"].drop_null().to_pylist():
        a, b = np.frombuffer(packed, "<i8").reshape(-1, 2).T
        np.add.at(edge, a, 1)
        np.add.at(edge, b + p.window, -1)
    place = later["place"].to_numpy()[later["spans"].is_null().to_numpy(zero_copy_only=False).astype(bool)]
    if len(place):
        at = start[place >> _PLACE] + (place & ((1 << _PLACE) - 1))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + p.window, -1)
    dropped = np.cumsum(edge) > 0
    out: dict[str, list] = {"doc_id": ids, "n_words": size.tolist(), "n_removed": [], "kept_sha256": [], "removed": []} | ({"text": [], "mark": [], "nth": []} if whole else {})
    for k, words in enumerate(split):
        drop = dropped[start[k] : start[k] + size[k]]
        first, last = runs_of(drop)
        kept = [w for w, d in zip(words, drop.tolist(), strict=True) if not d] if len(first) else words
        out["n_removed"].append(len(words) - len(kept))
        out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        out["removed"].append([{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        if whole:
            out["text"].append(text_spans(texts[k], drop).decode("utf-8", "surrogatepass"))
            out["mark"].append(xxhash.xxh64_intdigest(texts[k], 42))
            out["nth"].append(out["nth"][-1] + 1 if k and (ids[k - 1], texts[k - 1]) == (ids[k], texts[k]) else 1)
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "removed": pa.list_(span), "text": pa.string(), "nth": pa.int32()}
    return pa.table({c: pa.array(np.array(v, _U).view(np.int64)) if c == "mark" else pa.array(v, kinds[c]) for c, v in out.items()})


def repeats(docs: DataFrame, params: RepeatParams = RepeatParams(), id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the kept words joined by a space, removed (spans of word numbers from 0)
    and, if asked for, text, the original with those words cut out, mark, Spark's xxhash64 of the original, and nth, the
    row's number among those with its id and text: one row per input row.

    A word goes if a window of `window` words that covers it has its word sequence at an earlier start as well: in a
    document with a smaller id, or before it in the same one. Windows are judged on the input.
    Defined edge cases: null and blank texts have no words, and texts shorter than a window lose none; null ids come after
    all others; rows that repeat an id are documents of their own, in order of their text; an empty table gives no rows;
    only the two columns are read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = buckets_for(docs.sparkSession, total, params.bucket_bytes)
    dealt = own.select(F.pmod(F.xxhash64("doc_id", F.lit("bucket")), F.lit(buckets)).alias("bucket"), "doc_id", "text")
    # the same exchange of the texts serves all three passes
    names = dealt.groupBy("bucket").applyInArrow(lambda t: _names(t, params), _NAMES)
    by_name = Window.partitionBy("name")  # at most a row for each bucket
    counted = names.select("bucket", "name", (F.count(F.lit(1)).over(by_name) > 1).alias("wide"), "own").filter("wide OR own > 1").select("bucket", "name", "wide")
    windows = dealt.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(lambda t, r: _windows(t, r, params), _WINDOWS)
    # a row for each window only after the shuffle by its anchor
    each = windows.repartition(F.col("name")).select("bucket", "name", "off", "doc", "place", "spans", F.posexplode("hashes").alias("k", "hash"))
    in_order = Window.partitionBy("name", F.col("off") - F.col("k"), "hash").orderBy("doc", "place")  # at most a row for each bucket
    later = each.withColumn("nth", F.row_number().over(in_order)).filter("spans IS NOT NULL OR nth > 1").select("bucket", (F.col("place") + F.col("k")).alias("place"), "spans")
    schema = _RESULT + (", text string, mark long, nth int" if texts else "")
    return dealt.groupBy("bucket").cogroup(later.groupBy("bucket")).applyInArrow(lambda t, x: _cut(t, x, params, texts), schema)


def without_repeats(docs: DataFrame, params: RepeatParams = RepeatParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the repeated words cut out of the texts; rows that lose all their words go.

    A row meets its own cut text by id, null ids too, hash of its text and number among rows that have both in common, so
    of rows that are repeated the first stays, and rows that share an id keep their own texts.
    """
    found = repeats(docs, params, id_col, text_col, texts=True).filter("n_removed > 0")
    changed = found.select(F.col("doc_id").alias("changed_id"), F.col("mark").alias("changed_mark"), F.col("nth").alias("changed_nth"), (F.col("n_words") == F.col("n_removed")).alias("gone"), F.col("text").alias("rest"))
    # as repeats() reads ids; the clash-free names stand beside `row`, the whole row
    rows = packed(docs, id_col, text_col).withColumn("key", F.col("id").cast("long")).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    if rows.groupBy("key", "mark").count().filter("count > 1").limit(1).count():
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key", "mark").orderBy(F.xxhash64("row"))))
    else:
        rows = rows.withColumn("nth", F.lit(1))
    own = F.col("key").eqNullSafe(F.col("changed_id")) & (F.col("mark") == F.col("changed_mark")) & (F.col("nth") == F.col("changed_nth"))
    joined = rows.join(changed, own, "left").filter("gone IS NULL OR NOT gone")
    return with_text(joined, text_col, F.coalesce("rest", "text"))
