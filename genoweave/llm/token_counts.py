"""Edit-aware token counts (operator 1).

A document keeps a segment tree over its pre-tokens: leaves are short runs of pre-tokens with their characters and token
counts, inner nodes the sums of their children. An edit finds its place by descending through the character sums, splits
anew only from shortly before the edit to the first place behind it where old and new pre-tokens end together, counts
the tokens of those alone, and updates the sums above.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pre-token depends on no character further behind its end (contractions look two ahead, white space one).
CONTEXT = 3
LEAF = 64  # pre-tokens


@dataclass(frozen=True)
class CountParams:
    vocabulary: str = ""  # path of the rank file; empty: the public byte_bpe_50k.tiktoken
    pattern: str = ""  # of the pre-tokens; empty: the vocabulary's own
    cache: int = 500_000  # pre-tokens whose counts a worker keeps

    def resolved(self) -> tuple[str, str]:
        if self.vocabulary and self.pattern:
            return self.vocabulary, self.pattern
        import public_tokenizers

        return self.vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), self.pattern or public_tokenizers.PATTERN


class Counter(dict):
    """Token counts of pre-tokens."""

    def __init__(self, path: str, pattern: str, most: int):
        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.split, self.most, self.ranks = regex.compile(pattern), most, ranks

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n

    def pieces(self, text: str) -> list[str]:
        return self.split.findall(text)

    def counts(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))


class TokenTree:
    """The segment tree of one text. sums[0] has the leaves' (characters, tokens), sums[k + 1] the pairs of sums[k]."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.recounted = text, counter, 0
        pieces = counter.pieces(text)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = counter.counts(pieces)
        cuts = range(0, len(pieces), LEAF)
        self.leaves: list[tuple[np.ndarray, np.ndarray]] = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in cuts]
        self._build(0)

    def _build(self, changed_from: int) -> None:
        """Sums of every level from the leaf changed_from on; what lies before stays."""
        first = changed_from
        if not changed_from or not hasattr(self, "sums"):
            self.sums = [np.zeros((0, 2), np.int64)]
            first = 0
        fresh = np.array([(a.sum(), c.sum()) for a, c in self.leaves[first:]], np.int64).reshape(-1, 2)
        self.sums[0] = np.concatenate([self.sums[0][:first], fresh])
        level = 0
        while len(self.sums[level]) > 1:
            below = self.sums[level]
            first //= 2
            part = below[2 * first :]
            if len(part) % 2:
                part = np.concatenate([part, np.zeros((1, 2), np.int64)])
            above = self.sums[level + 1][:first] if level + 1 < len(self.sums) else np.zeros((0, 2), np.int64)
            merged = np.concatenate([above, part[0::2] + part[1::2]])
            self.sums[level + 1 : level + 2] = [merged]
            level += 1
        del self.sums[level + 1 :]

    def _update(self, leaf: int) -> None:
        """The sums above one leaf whose neighbours stay."""
        lengths, counts = self.leaves[leaf]
        self.sums[0][leaf] = lengths.sum(), counts.sum()
        for level in range(len(self.sums) - 1):
            leaf //= 2
            self.sums[level + 1][leaf] = self.sums[level][2 * leaf : 2 * leaf + 2].sum(axis=0)

    @property
    def tokens(self) -> int:
        return int(self.sums[-1][:, 1].sum()) if len(self.sums[-1]) else 0

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the place of its first one."""
        leaf = begin = 0
        for level in range(len(self.sums) - 1, -1, -1):
            leaf *= 2 if level < len(self.sums) - 1 else 1
            sums = self.sums[level]
            if leaf + 1 < len(sums) and place >= begin + sums[leaf, 0] and level < len(self.sums) - 1:
                begin += int(sums[leaf, 0])
                leaf += 1
        return min(leaf, max(len(self.leaves) - 1, 0)), begin

    def edit(self, start: int, stop: int, new: str) -> int:
        """text[start:stop] becomes new (bounds are clipped); the new count of tokens."""
        start = min(max(start, 0), len(self.text))
        stop = min(max(stop, start), len(self.text))
        old_length = len(self.text)
        self.text = self.text[:start] + new + self.text[stop:]
        if not self.leaves or not self.text:
            self.__init__(self.text, self.counter)
            return self.tokens
        leaf, begin = self.find(max(0, start - CONTEXT - 1))
        lengths = self.leaves[leaf][0]
        ends = begin + np.cumsum(lengths)
        kept = int(np.searchsorted(ends, start - CONTEXT, "left"))  # those end before the context
        at = int(ends[kept - 1]) if kept else begin
        if kept == 0 and leaf and begin > start - CONTEXT:  # the context reaches into the leaf before
            leaf -= 1
            lengths = self.leaves[leaf][0]
            begin -= int(lengths.sum())
            ends = begin + np.cumsum(lengths)
            kept = int(np.searchsorted(ends, start - CONTEXT, "left"))
            at = int(ends[kept - 1]) if kept else begin
        shift = len(self.text) - old_length
        # walk new pre-tokens until one ends where an old one ended, behind the edit
        last, last_end = leaf, begin + int(lengths.sum())
        fresh: list[str] = []
        rest = None
        for m in self.counter.split.finditer(self.text, at):
            fresh.append(m[0])
            end = m.end() - shift  # in the old text
            if end < stop + CONTEXT and m.end() < len(self.text):
                continue
            while last_end < end and last + 1 < len(self.leaves):
                last += 1
                last_end += int(self.leaves[last][0].sum())
            olds = last_end - int(self.leaves[last][0].sum()) + np.cumsum(self.leaves[last][0])
            k = int(np.searchsorted(olds, end))
            if k < len(olds) and olds[k] == end:
                rest = k + 1
                break
        tail = (self.leaves[last][0][rest:], self.leaves[last][1][rest:]) if rest is not None else (np.empty(0, np.int64),) * 2
        after = last + 1 if rest is not None else len(self.leaves)
        self.recounted += len(fresh)
        joined = (
            np.concatenate([self.leaves[leaf][0][:kept], np.fromiter(map(len, fresh), np.int64, len(fresh)), tail[0]]),
            np.concatenate([self.leaves[leaf][1][:kept], self.counter.counts(fresh), tail[1]]),
        )
        parts = [(joined[0][i : i + LEAF], joined[1][i : i + LEAF]) for i in range(0, len(joined[0]), LEAF)] if len(joined[0]) > 2 * LEAF else [joined] if len(joined[0]) else []
        same = len(parts) == after - leaf == 1
        self.leaves[leaf:after] = parts
        if same:
            self._update(leaf)
        elif self.leaves:
            self._build(leaf)
        else:
            self.sums = [np.zeros((0, 2), np.int64)]
        return self.tokens


_COUNTERS: dict[tuple[str, str], Counter] = {}


def count_with_edits(docs: DataFrame, edits: Column, params: CountParams = CountParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_pretokens, edited_tokens, recounted (pre-tokens that the edits counted anew), one row per input row.

    edits: for each row an array<struct<start: int, stop: int, text: string>> in code points, applied one after another.
    Defined edge cases: null and empty texts have no tokens, and edits may fill them; null edits change nothing, a null
    text in an edit is empty, places beyond the text are clipped; texts of any length are counted whole; repeated rows are
    counted each; an empty table gives no rows; only the named columns and those of edits are read.
    """
    path, pattern = params.resolved()

    def run(batches):
        counter = _COUNTERS.get((path, pattern)) or _COUNTERS.setdefault((path, pattern), Counter(path, pattern, params.cache))
        for b in batches:
            rows = []
            for text, changes in zip(b.column("text"), b.column("edits"), strict=True):
                tree = TokenTree(text.as_py() or "", counter)
                before, pieces = tree.tokens, sum(len(a) for a, _ in tree.leaves)
                for e in changes.as_py() or ():
                    tree.edit(e["start"] or 0, e["stop"] if e["stop"] is not None else e["start"] or 0, e["text"] or "")
                rows.append((before, pieces, tree.tokens, tree.recounted))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_tokens", "n_pretokens", "edited_tokens", "recounted"])

    kind = docs.select(F.col(id_col)).dtypes[0][1]
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), edits.cast("array<struct<start:int,stop:int,text:string>>").alias("edits"))
    return chosen.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_pretokens long, edited_tokens long, recounted long")


def sample_edits(text: Column) -> Column:
    """Three edits of a text of n code points: 16 at n div 4 go, 16 at n div 2 are written backwards, and its first 32 are
    put in at 3n div 4 of what it was."""
    n = F.length(text)
    spot = lambda k: F.floor(n * k / 4).cast("int")
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), new.alias("text"))
    return F.array(
        edit(spot(3), spot(3), F.substr(text, F.lit(1), F.lit(32))),
        edit(spot(2), spot(2) + 16, F.reverse(F.substr(text, spot(2) + 1, F.lit(16)))),
        edit(spot(1), spot(1) + 16, F.lit("")),
    )
