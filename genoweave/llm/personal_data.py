"""Personal data in texts (operator 12).

Regular expressions propose spans, checksums confirm them, words nearby move the score:

- The base rules are plain: e-mail addresses, IPv4 addresses with parts up to 255, card numbers of 16 to 19 digits that pass
  Luhn's check, telephone numbers with a plus sign and 8 to 15 digits. Of each kind the leftmost matches that do not
  overlap are taken; a match that fails its check is dropped, and nothing within it is tried again. These spans stay.
- The scored rules add what the base rules miss: account numbers (IBAN, modulo 97), card numbers of 12 to 19 digits within
  a longer row of digit groups or of fewer digits (Luhn), telephone numbers without a plus sign, social security numbers,
  e-mail addresses with a written (at). Each proposal has a prior, a confirmed checksum adds to it, words of its kind
  nearby add and words of other kinds of numbers subtract. What reaches `threshold` and overlaps neither a base span nor a
  better one is added.

Each text is one row's work, whole and in one pass for each rule; the patterns never step back over a run of characters,
so time is linear in a text's length. Nothing is shuffled.

Edge cases: a null or empty text has no spans; positions are code points, the end is exclusive; repeated rows and rows
without an id are rows of their own; an empty table gives no rows; extra columns, whatever their names, are not touched.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The order of kinds in lists of spans.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

# Runs are taken whole (++): a match can only begin at the start of its run, so nothing is lost by not stepping back.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?:@(?:[A-Za-z0-9-]++)(?:\.[A-Za-z0-9-]++)++)?")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+.,-])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,7}){1,4}(?![0-9])")
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,8}")
_GROUP = re.compile(r"[0-9]++")
_WORD = re.compile(r"[^\W\d_]+")

#: Words near a span: those of its kind, and those that number other things.
NEAR = {
    "email": {"mail", "email", "address", "contact", "correo", "courriel"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "kreditkarte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "telefono", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "ip": {"ip", "host", "server", "address"},
}
OTHER = {"order", "invoice", "version", "isbn", "issn", "serial", "page", "pages", "part", "item", "ref", "doi", "rechnung", "factura", "facture"}


@dataclass(frozen=True)
class PiiParams:
    threshold: float = 0.7
    window: int = 40
    near: float = 0.3
    other: float = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, first four characters last and letters as 10 to 35, leaves 1 by 97."""
    rest = 0
    for c in account[4:] + account[:4]:
        rest = int(f"{rest}{int(c, 36)}") % 97
    return rest == 1


def digits_of(s: str) -> str:
    return "".join(_GROUP.findall(s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" in text:
        yield from (m.span() for m in _EMAIL.finditer(text) if "@" in m.group())


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        if len(parts) == 4 and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in parts):
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base rules, by kind, then start; and the digit rows that are no card."""
    return _base(text)[0]


def _base(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    found, rows = [("email", *s) for s in _emails(text)] + [("ip", *s) for s in _addresses(text)], []
    for m in _CARD.finditer(text):
        d = digits_of(m.group()) if m.end() - m.start() >= 12 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            found.append(("card", *m.span()))
        elif len(d) >= 12:
            rows.append(m.span())
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found, rows


#: What a proposed card number scores without words nearby.
_CARD_PRIOR = 0.5


def _cards_within(text: str, start: int, end: int, p: PiiParams) -> Iterator[tuple[int, int]]:
    """Rows of whole digit groups of 12 to 19 digits that pass Luhn's check, within a row of groups. A row of groups has no
    words in it, so where a number needs a word nearby only those at the row's ends can have one."""
    groups = [(start + m.start(), start + m.end()) for m in _GROUP.finditer(text[start:end])]
    anywhere = p.threshold <= _CARD_PRIOR
    for i, (a, _) in enumerate(groups):
        if not anywhere and p.window <= a - start and a < end - p.window // 2 - 38:  # 19 digits and as many marks at most
            continue
        for n, (_, b) in zip(accumulate(y - x for x, y in groups[i : i + 19]), groups[i : i + 19], strict=False):
            if n > 19:
                break
            if n >= 12 and luhn(digits_of(text[a:b])):
                yield a, b


def proposals(text: str, rows: list[tuple[int, int]], p: PiiParams) -> Iterator[tuple[str, int, int, float]]:
    """(kind, start, end, score before words nearby) of the scored rules."""
    for m in _IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            yield "iban", *m.span(), 0.8
    for a, b in rows:
        for s in _cards_within(text, a, b, p):
            yield "card", *s, _CARD_PRIOR
    for m in _SSN.finditer(text):
        yield "ssn", *m.span(), 0.5
    for m in _LOCAL.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            yield "phone", *m.span(), 0.4
    if "at)" in text or "at]" in text:
        yield from (("email", *m.span(), 0.8) for m in _WRITTEN.finditer(text))


def words_near(text: str, start: int, end: int, window: int) -> set[str]:
    return {w.lower() for part in (text[max(0, start - window) : start], text[end : end + window // 2]) for w in _WORD.findall(part)}


def find(text: str | None, p: PiiParams = PiiParams()) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of a text, by kind, then start."""
    if not text:
        return []

    def moved(kind: str, start: int, end: int, score: float) -> float:
        near = words_near(text, start, end, p.window)
        return round(min(1.0, score + p.near * bool(near & NEAR[kind]) - p.other * bool(near & OTHER)), 6)

    base, rows = _base(text)
    out = [(k, s, e, moved(k, s, e, 0.9), True) for k, s, e in base]
    scored = [(moved(*x), x) for x in proposals(text, rows, p)]
    added = sorted((-score, KINDS.index(k), s, e, k) for score, (k, s, e, _) in scored if score >= p.threshold)
    if added:
        taken = sorted((s, e) for _, s, e in base)
        for score, _, s, e, k in added:
            if _free(taken, s, e):
                out.append((k, s, e, -score, False))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def _free(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span overlaps none of the base spans and of those taken since; if so it is taken. Base spans of different
    kinds may overlap each other, so a few neighbours to the left are looked at until they end before the span."""
    i = bisect_left(taken, (start, start))
    if i < len(taken) and taken[i][0] < end:
        return False
    for s, e in reversed(taken[max(0, i - len(BASE)) : i]):
        if e > start:
            return False
    insort(taken, (start, end))
    return True


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double, base: boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))


def spans_of(text: Column, p: PiiParams = PiiParams()) -> Column:
    """The spans of a text as an array column."""
    names = [f.name for f in _SPAN_TYPE.value_type]

    @F.arrow_udf(_SPANS)
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(names, s, strict=True)) for s in find(t.as_py(), p)] for t in texts], _SPAN_TYPE)

    return each(text)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: PiiParams = PiiParams()) -> DataFrame:
    """id and spans (kind, start, end, score, base) of every document."""
    return docs.select(F.col(f"`{id_col}`"), spans_of(F.col(f"`{text_col}`").cast("string"), p).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the SHA-256 of their list, and the list of all spans."""
    base = F.filter("spans", lambda x: x["base"])
    of = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(k) for k in BASE]
    others = [c for c in found.columns if c != "spans"]
    return found.select(*others, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", p: PiiParams = PiiParams()) -> DataFrame:
    """The documents with each span of their text replaced by its kind in brackets; of overlapping ones the first, then
    longest, is replaced whole with what it overlaps."""

    @F.arrow_udf("string")
    def each(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text, parts, at = t.as_py(), [], 0
            if text is None:
                out.append(None)
                continue
            for k, s, e, _, _ in sorted(find(text, p), key=lambda x: (x[1], -x[2])):
                if s >= at:
                    parts += [text[at:s], f"[{k.upper()}]"]
                at = max(at, e)
            out.append("".join(parts) + text[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, each(F.col(f"`{text_col}`").cast("string")))
