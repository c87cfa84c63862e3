"""Lists of an item's holders on their way to the lots that need them: columns of numbers as compressed byte planes, a block a
lot. Sorted genes are told by their differences, so a holder takes some three bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, LongType, StructField, StructType

_CODEC = pa.Codec("zstd", 1)
#: Holders that a task packs at once, and entries of a block (one list more at most).
_ROWS, _ENTRIES = 2_000_000, 1_000_000


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers as one string; a byte plane of zeros takes no room."""
    head, body = [len(columns)], []
    for c in columns:
        head += [ord(c.dtype.char), len(c)]
        for plane in np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T):
            body.append(_CODEC.compress(plane, asbytes=True) if plane.any() else b"")
            head.append(len(body[-1]))
    return np.array([len(head), *head], np.int64).tobytes() + b"".join(body)


def unpacked(block: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(block, np.int64, 1)[0])
    head, at, columns = np.frombuffer(block, np.int64, size, 8).tolist(), 8 + 8 * size, []
    i = 1
    for _ in range(head[0]):
        kind, n = np.dtype(chr(head[i])), head[i + 1]
        planes = np.zeros((kind.itemsize, n), np.uint8)
        for k, length in enumerate(head[i + 2 : i + 2 + kind.itemsize]):
            if length:
                planes[k] = np.frombuffer(_CODEC.decompress(block[at : at + length], n, asbytes=True), np.uint8)
                at += length
        columns.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        i += 2 + kind.itemsize
    return columns


def _steps(genes: np.ndarray) -> np.ndarray:
    """Differences of genes, in both directions small numbers without a sign."""
    d = np.diff(genes, prepend=np.int64(0))
    return ((d << 1) ^ (d >> 63)).view(np.uint64)


def _genes(steps: np.ndarray) -> np.ndarray:
    d = (steps >> np.uint64(1)).view(np.int64) ^ -(steps & np.uint64(1)).view(np.int64)
    return np.cumsum(d)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, ranges one after another."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before, the first row included."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _whole_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of items, some millions at a time; an item's rows stay together."""
    held: list[pa.RecordBatch] = []
    rows, most = 0, _ROWS
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            item = table["item"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            last = int(_changes(item)[-1])
            if last:
                yield table.slice(0, last)
            held, rows = table.slice(last).to_batches(), len(item) - last
            most = max(_ROWS, 2 * rows)  # an item with more rows waits for its end
    if held:
        yield pa.Table.from_batches(held)


def _amounts(x: pa.Array) -> list[np.ndarray]:
    """Amounts as a column of the least width, or as numbers and whether they are known."""
    v = x.to_numpy(zero_copy_only=False)
    if not x.null_count:
        for kind in (np.uint8, np.int16):
            with np.errstate(invalid="ignore"):
                small = v.astype(kind)
            if (small == v).all() and not np.signbit(v[v == 0]).any():
                return [small]
    return [v, x.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)]


def dealt(once: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow, from gene, item, g, x, lot in order of item and gene: lot, packed, kinds (values of g), a row a block. A
    block has runs of a lot's own genes of an item, and with each run all holders of the item; once: those behind its first gene."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_items(batches):
            rows = rows.combine_chunks()
            column = lambda c: rows[c].combine_chunks()  # noqa: E731, B023
            number = lambda c: column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            gene, lot, item = number("gene"), number("lot"), column("item").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(column("g"), null_encoding="encode")
            kinds, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            amounts = _amounts(column("x"))
            firsts = _changes(item)
            ends = np.append(firsts[1:], len(item))
            a = _changes(item, lot)
            own = np.diff(np.append(a, len(item)))
            of = np.searchsorted(firsts, a, "right") - 1
            start = a + 1 if once else firsts[of]
            size = ends[of] - start
            some = np.flatnonzero(size > (0 if once else 1))
            some = some[np.lexsort((gene[a[some]], lot[a[some]]))]
            bounds, till = [0], 0
            for r, (new, n) in enumerate(zip(np.diff(lot[a[some]], prepend=-1) != 0, size[some].tolist(), strict=True)):
                if r and (new or till >= _ENTRIES):
                    bounds.append(r)
                    till = 0
                till += n
            lots, blocks, named, there = [], [], [], 0
            for b, e in zip(bounds, [*bounds[1:], len(some)], strict=True):
                runs = some[b:e]
                if not len(runs):
                    continue
                q, s = spread(a[runs], own[runs]), spread(start[runs], size[runs])
                cq, cs, names = code[q], code[s], kinds
                if len(kinds) > 64:
                    used, c = np.unique(np.concatenate([cq, cs]), return_inverse=True)
                    cq, cs, names = c[: len(q)], c[len(q) :], kinds.take(pa.array(used))
                width = np.uint8 if len(names) <= 256 else np.uint32
                blocks.append(packed([
                    own[runs].astype(np.uint32), size[runs].astype(np.uint32), _steps(gene[q]), cq.astype(width), _steps(gene[s]), cs.astype(width), *(x[q] for x in amounts), *(x[s] for x in amounts),
                ]))
                lots.append(int(lot[a[runs[0]]]))
                named.append(names)
                there += len(blocks[-1])
                if there > 16_000_000:
                    yield _blocks(lots, blocks, named)
                    lots, blocks, named, there = [], [], [], 0
            if blocks:
                yield _blocks(lots, blocks, named)

    return deal


def _blocks(lots: list[int], blocks: list[bytes], named: list[pa.Array]) -> pa.RecordBatch:
    offsets = pa.array(np.cumsum([0, *map(len, named)]), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(lots, pa.int32()), pa.array(blocks, pa.binary()), pa.ListArray.from_arrays(offsets, pa.concat_arrays(named))], ["lot", "packed", "kinds"])


def _plain(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers as one string, as they are."""
    head = [len(columns), *(v for c in columns for v in (ord(c.dtype.char), len(c)))]
    return np.array(head, np.int64).tobytes() + b"".join(c.tobytes() for c in columns)


def _columns(part: bytes) -> list[np.ndarray]:
    many = int(np.frombuffer(part, np.int64, 1)[0])
    head, at, columns = np.frombuffer(part, np.int64, 2 * many, 8).tolist(), 8 + 16 * many, []
    for kind, n in zip(head[::2], head[1::2], strict=True):
        columns.append(np.frombuffer(part, np.dtype(chr(kind)), n, at))
        at += columns[-1].nbytes
    return columns


def _joined(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Blocks' or parts' columns one after another; where only some tell whether amounts are known, those of the others are."""
    most = max(map(len, columns))
    columns = [c if len(c) == most else [*c[:-2], c[-2], np.ones(len(c[-2]), np.uint8), c[-1], np.ones(len(c[-1]), np.uint8)] for c in columns]
    return [np.concatenate(c) for c in zip(*columns, strict=True)]


def _named(codes: list[np.ndarray], kinds: pa.Array) -> list[np.ndarray]:
    """Codes of each block or part as places in all of their lists of kinds."""
    before = np.cumsum([0, *pc.list_value_length(kinds).to_pylist()])
    return [c.astype(np.int64) + b for c, b in zip(codes, before, strict=False)]


def parted(g: DataType, together: int, wide: int):
    """Arrow aggregate of a lot's blocks (packed, kinds): few, base, part, kinds as lists, a part for each `together` own genes
    (few) and holders in a range of `wide` genes (base)."""

    def parts(blocks: pa.Array, kinds: pa.Array) -> dict:
        columns = [unpacked(b) for b in blocks.to_pylist()]
        for c in columns:
            c[2], c[4] = _genes(c[2]), _genes(c[4])
        coded = pc.dictionary_encode(kinds.flatten(), null_encoding="encode")
        names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        for i in (3, 5):
            for c, n in zip(columns, _named([c[i] for c in columns], kinds), strict=True):
                c[i] = code[n].astype(np.uint8 if len(names) <= 256 else np.uint32)
        own_n, n, q, cq, s, cs, *x = _joined(columns)
        own_n, n = own_n.astype(np.int64), n.astype(np.int64)
        few, base = q // together, s // wide
        run_q, run_s = np.repeat(np.arange(len(n)), own_n), np.repeat(np.arange(len(n)), n)
        us, ps = _changes(run_q, few), _changes(run_s, base)
        u_size, p_size = np.diff(np.append(us, len(q))), np.diff(np.append(ps, len(s)))
        first_p, many_p = np.searchsorted(run_s[ps], np.arange(len(n))), np.bincount(run_s[ps], minlength=len(n))
        # a run's own genes, so many together, meet each range of its holders
        u, p = np.repeat(np.arange(len(us)), many_p[run_q[us]]), spread(first_p[run_q[us]], many_p[run_q[us]])
        order = np.lexsort((base[ps[p]], few[us[u]]))
        u, p = u[order], p[order]
        new = _changes(few[us[u]], base[ps[p]])
        at_q, at_s = spread(us[u], u_size[u]), spread(ps[p], p_size[p])
        half = len(x) // 2
        by_run, by_q, by_s = [u_size[u].astype(np.uint32), p_size[p].astype(np.uint32)], [c[at_q] for c in (q, cq, *x[:half])], [c[at_s] for c in (s, cs, *x[half:])]
        ends = [np.append(new, len(u)), *(np.append(0, np.cumsum(np.add.reduceat(size, new))) for size in (u_size[u], p_size[p]))]
        found, told, every = [], [], names.to_pylist()
        for i in range(len(new)):
            runs, (oq, gq, *xq), (os, gs, *xs) = ([c[e[i] : e[i + 1]] for c in cs] for cs, e in zip((by_run, by_q, by_s), ends, strict=True))
            if len(names) > 64:
                used, c = np.unique(np.concatenate([gq, gs]), return_inverse=True)
                gq, gs, of = c[: len(gq)], c[len(gq) :], [every[k] for k in used.tolist()]
            else:
                of = every
            found.append(_plain([*runs, oq, gq, os, gs, *xq, *xs]))
            told.append(of)
        return {"few": few[us[u[new]]], "base": base[ps[p[new]]], "part": found, "kinds": told}

    fields = {"few": LongType(), "base": LongType(), "part": BinaryType(), "kinds": ArrayType(g)}
    return F.arrow_udf(parts, StructType([StructField(k, ArrayType(v)) for k, v in fields.items()]))


def met(parts: pa.Array, kinds: pa.Array) -> tuple[np.ndarray, ...]:
    """Each own gene with each holder of its run, of parts with the same few and base: q, s, the lesser amount, whether it is
    known (as in SQL, the lesser of an amount and null is the amount), the codes of their g; and what g the codes are."""
    columns = [_columns(p) for p in parts.to_pylist()]
    for i in (3, 5):
        for c, n in zip(columns, _named([c[i] for c in columns], kinds), strict=True):
            c[i] = n
    own_n, n, q, cq, s, cs, *x = _joined(columns)
    own_n, n = own_n.astype(np.int64), n.astype(np.int64)
    (xq, *known_q), (xs, *known_s) = x[: len(x) // 2], x[len(x) // 2 :]
    size = np.repeat(n, own_n)
    row, at = np.repeat(np.arange(len(q)), size), spread(np.repeat(np.cumsum(n) - n, own_n), size)
    known = known_q[0][row].astype(bool) | known_s[0][at].astype(bool) if known_q else np.ones(len(at), bool)
    coded = pc.dictionary_encode(kinds.flatten(), null_encoding="encode")
    code = coded.indices.to_numpy(zero_copy_only=False)
    return q[row], s[at], np.fmin(xq[row], xs[at]), known, code[cq][row], code[cs][at], coded.dictionary
