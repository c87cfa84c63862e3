"""Conversation structure repair (operator 13), by signature deduplication.

A conversation's rows, in order, become a signature: a character a row, for its role (system, user, assistant, another) and
its fault (blank or repeated, which has to go, or truncated, which may stay at a price). What edits are the cheapest depends
on the signature alone, so each distinct signature is solved once, by a memoised recursion over (row, what was said last);
the audits, a letter an edit, are joined back, and a stream over each conversation's rows replays the edits.

Edits: K keeps a row, R gives it the role of the user or the assistant (2), D deletes it (3, the only one for blank and
repeated rows), I inserts an empty turn of the user or the assistant (2); a truncated row that is not deleted costs 1. The
result reads s?(ua)+ in the initials of roles, or is empty. Of the cheapest audits the one that is least in ASCII stands.
As what is said next is fixed by what was said last, an audit alone says which role R and I give.

Scale: one shuffle by conversation gives order, faults and signatures; the signatures alone shuffle to be told apart, and
the join back counts the solved ones and spreads the frequent. A second shuffle by conversation streams the rows, sorted
behind their audit, to the replay, so a conversation's texts are never held together; its signature, a character a row, is.

Edge cases: null roles and texts are one space, so a null text is blank; turns go up with nulls first, ties by role, then
text (as they are after damage), and repeated rows follow each other; rows without a conversation id are one conversation, without an id; a
conversation all of whose rows were dropped has zeros, an empty audit and the hash of nothing; no rows give no rows. Extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import BLANKS, cut, join_groups

KEEP, REROLE, DELETE, INSERT = "KRDI"


@dataclass(frozen=True)
class RepairParams:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1
    #: Rows that the recursion goes down at once; the costs behind them are there already.
    stride: int = 100


# --- rows, faults, signatures ---


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, with one space for null roles and texts; live and copy as damage would set them."""
    return conversations.select("conv_id", "turn", _text(F.col("role")).alias("role"), _text(F.col("text")).alias("text"), F.lit(True).alias("live"), F.lit(0).alias("copy"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of turns() after damage by the CRC-32 of conv_id:turn, modulo 20: 0 drops a row (it stays, not live), 1
    empties its text, 2 takes the marks .!? out, 3 repeats it, 4 makes the user say it."""
    name = F.concat_ws(":", _text(F.col("conv_id")), _text(F.col("turn")))
    k = F.crc32(name.cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (k != 0).alias("live"), copies.alias("copy"))


def marked(rows: DataFrame) -> DataFrame:
    """conv_id, seq (a live row's place from 0, null for others), turn, role, text, fault, illegal, fresh (the first row of
    its turn), mark (its character of the signature)."""
    line = Window.partitionBy("conv_id").orderBy(F.col("live").desc(), F.col("turn").asc_nulls_first(), "role", "text")
    first = F.substring("role", 1, 1)
    placed = rows.select(
        "conv_id", "live", "turn", "role", "text", (F.row_number().over(line) - 1).alias("seq"), first.alias("initial"), F.lag(first).over(line).alias("before"),
        (F.lag("turn").over(line).eqNullSafe(F.col("turn")) & (F.row_number().over(line) > 1)).alias("again"),
    )
    same = Window.partitionBy("conv_id", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).orderBy("seq")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(~F.col("live"), None).when(F.btrim("text", F.lit(BLANKS)) == "", "blank").when(F.row_number().over(same) > 1, "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    told = placed.withColumn("fault", fault)
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    mark = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    pair = F.concat("before", "initial")
    return told.select(
        "conv_id", F.when(F.col("live"), F.col("seq").cast("long")).alias("seq"), "turn", "role", "text", "fault", (F.col("live") & F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        (F.col("live") & F.col("turn").isNotNull() & ~F.col("again")).alias("fresh"), F.when(F.col("live"), mark).alias("mark"),
    )


def signatures(rows: DataFrame) -> DataFrame:
    """A row for each conversation of marked(): gaps, counts of faults and of illegal neighbours, and its signature."""
    turn = F.when(F.col("seq").isNotNull(), F.col("turn"))
    char = F.when(F.col("seq").isNotNull(), F.struct("seq", "mark"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_if("fresh"), F.lit(0)).cast("long")
    faults = [F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")]
    listed = rows.groupBy("conv_id").agg(gaps.alias("gaps"), *faults, F.count_if("illegal").alias("illegal"), F.array_sort(F.collect_list(char)).alias("m"))
    return listed.withColumn("signature", F.array_join(F.transform("m", lambda x: x["mark"]), "")).drop("m")


# --- one signature ---

#: What was said last: nothing, the system, the user, the assistant. What R and I give next, and where that leads.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ENDS = (_NOTHING, _ASSISTANT)
_KEPT = {"u": ((_NOTHING, _SYSTEM, _ASSISTANT), _USER), "a": ((_USER,), _ASSISTANT), "s": ((_NOTHING,), _SYSTEM)}
_NEVER = 1 << 60


def solve(signature: str, p: RepairParams = RepairParams()) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, the least audit in ASCII of equally cheap ones."""
    n = len(signature)

    def moves(i: int, said: int, inserts: int) -> Iterator[tuple[str, int, tuple[int, int, int]]]:
        """(letter, cost, where it leads) in ASCII order. More than two inserts in a row come back to where they began."""
        if i < n:
            yield DELETE, p.delete, (i + 1, said, 0)
        if inserts < 2:
            yield INSERT, p.insert, (i, _NEXT[said], inserts + 1)
        if i < n and (mark := signature[i]) != "d":
            kept, more = _KEPT.get(mark.lower(), ((), 0)), p.truncated * mark.isupper()
            if said in kept[0]:
                yield KEEP, more, (i + 1, kept[1], 0)
            yield REROLE, p.rerole + more, (i + 1, _NEXT[said], 0)

    edge: dict[tuple[int, int, int], int] = {}

    @cache
    def cost(i: int, said: int, inserts: int) -> int:
        if (known := edge.get((i, said, inserts))) is not None:
            return known
        best = 0 if i == n and said in _ENDS else _NEVER
        for _, price, state in moves(i, said, inserts):
            best = min(best, price + cost(*state))
        return best

    # The memo is kept for a stride alone; of the others their edges' costs stay.
    for i in range(n - p.stride, 0, -p.stride):
        edge |= {(i, said, 0): cost(i, said, 0) for said in range(4)}
        cost.cache_clear()
    audit, state, left = [], (0, _NOTHING, 0), cost(0, _NOTHING, 0)
    total = left
    while left or state[0] < n:
        if state in edge:
            cost.cache_clear()
        letter, price, state = next(m for m in moves(*state) if m[1] + cost(*m[2]) == left)
        audit.append(letter)
        left -= price
    return total, "".join(audit)


def solved(marks: DataFrame, p: RepairParams = RepairParams()) -> DataFrame:
    """signature, cost, audit of each distinct signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [solve(s.as_py(), p) for s in batch.column("signature")]
            yield pa.RecordBatch.from_arrays([batch.column("signature").cast(pa.string()), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])

    return marks.select("signature").distinct().mapInArrow(run, "signature string, cost long, audit string")


# --- replay ---


def _said(initials: int) -> str:
    return "user" if initials == _USER else "assistant"


def replay(stream: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, position, edit, role, text) of repaired conversations, with a row without a position before each, from rows
    (conv_id, seq, role, text): one with seq -1 and the audit as text before the live rows of a conversation in order."""
    audit, at, said, n, conv = "", 0, _NOTHING, 0, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, said, n
        while at < len(audit) and audit[at] == INSERT:
            said = _NEXT[said]
            yield conv, n, INSERT, _said(said), ""
            at, n = at + 1, n + 1

    for c, seq, role, text in stream:
        if seq < 0:
            yield from inserted()
            audit, at, said, n, conv = text, 0, _NOTHING, 0, c
            yield conv, None, None, None, None
            continue
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit == DELETE:
            continue
        if edit == REROLE:
            said = _NEXT[said]
            role = _said(said)
        else:
            said = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
        yield conv, n, edit, role, text
        n += 1
    yield from inserted()


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*((x.as_py() for x in batch.column(c)) for c in columns), strict=True)


_REPORT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    schema = pa.schema(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], schema=schema)


def _stream(rows: DataFrame, p: RepairParams) -> DataFrame:
    """conv_id, seq (-1 or null), role, text, report: audits with their conversations' report, each before the live rows of
    its conversation in order."""
    told = cut(signatures(marked(rows)))
    joined = cut(join_groups(told, cut(solved(told, p)), ["signature"], ["conv_id"]))
    report = F.struct(*(F.col(c) for c, _ in _REPORT)).alias("report")
    heads = joined.select("conv_id", F.lit(-1).alias("seq"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), report)
    live = rows.filter("live").select("conv_id", F.lit(0).alias("seq"), "turn", "role", "text", F.lit(None).cast(heads.schema["report"].dataType).alias("report"))
    order = [F.col("conv_id"), F.col("seq"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return heads.unionByName(live).repartition("conv_id").sortWithinPartitions(*order).drop("turn")


def _id_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return kind, {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())


def repair_report(rows: DataFrame, p: RepairParams = RepairParams()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of role:text of the repaired turns,
    joined by newlines) of each conversation of rows as turns() or damaged() make them."""
    kind, id_type = _id_type(rows)
    fields = [("conv_id", id_type), *_REPORT, ("repaired_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reports: list[dict] = []

        def heads() -> Iterator[tuple]:
            for conv, seq, role, text, report in _rows(batches, ["conv_id", "seq", "role", "text", "report"]):
                if seq < 0:
                    reports.append(report)
                yield conv, seq, role, text

        out, now, sha, first = [], None, hashlib.sha256(), True
        for conv, n, _, role, text in replay(heads()):
            if n is not None:
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
                continue
            if now:
                out.append((*now, sha.hexdigest()))
            if len(out) >= 5_000:
                yield _batch(out, fields)
                out = []
            report = reports.pop()
            now, sha, first = (conv, *(report[c] for c, _ in _REPORT)), hashlib.sha256(), True
        if now:
            out.append((*now, sha.hexdigest()))
        if out:
            yield _batch(out, fields)

    schema = f"conv_id {kind}, " + ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in fields[1:])
    return _stream(rows, p).mapInArrow(run, schema)


def repaired(rows: DataFrame, p: RepairParams = RepairParams()) -> DataFrame:
    """conv_id, position, edit, role, text: the turns of the repaired conversations, of rows as turns() or damaged() make them."""
    kind, id_type = _id_type(rows)
    fields = [("conv_id", id_type), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in replay(_rows(batches, ["conv_id", "seq", "role", "text"])):
            if row[1] is not None:
                out.append(row)
            if len(out) >= 1_000:
                yield _batch(out, fields)
                out = []
        if out:
            yield _batch(out, fields)

    return _stream(rows, p).select("conv_id", "seq", "role", "text").mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")
