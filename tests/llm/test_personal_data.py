"""Personal data against the plain patterns, and the scored rules by example."""

import hashlib
import random
import re
import time

from genoweave.llm import personal_data as pii
from genoweave.llm import registry


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    """The base spans by the patterns as they are given."""
    text, out = text or "", []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choice("a1@.+- ()255é4111%_") for _ in range(r.randint(0, 60)))
        if r.random() < 0.3:
            d = "".join(r.choice("0123456789") for _ in range(r.choice([15, 16, 18])))
            t += d + next(c for c in "0123456789" if luhn(d + c))
        assert pii.base_spans(t) == plain(t), t


def test_query_on_whole_documents(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = registry.queries()["op12_personal_data"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        spans = plain(texts[r["doc_id"]])
        said = [":".join(map(str, s)) for s in spans]
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(","))


def spans(text, **p):
    return [(k, text[s:e]) for k, s, e, _, base in pii.find(text, pii.PiiParams(**p)) if not base]


def test_checksums():
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_scored_rules():
    assert spans("to DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert spans("to DE89 3704 0044 0532 0130 01.") == []  # modulo 97
    assert spans("card 2023 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")]
    assert spans("2023 4111 1111 1111 1111") == []  # no word of its kind nearby
    assert spans("amex 378282246310005") == [("card", "378282246310005")]
    assert spans("order 378282246310005, card") == []  # a word of another kind of number
    assert spans("phone 030 1234567") == [("phone", "030 1234567")] and spans("030 1234567") == []
    assert spans("ssn 123-45-6789") == [("ssn", "123-45-6789")] and spans("ssn 000-45-6789") == []
    assert spans("a.b (at) c (dot) de") == [("email", "a.b (at) c (dot) de")]
    assert spans("030 1234567", threshold=0.4) == [("phone", "030 1234567")]


def test_base_spans_stay_and_are_not_overlapped():
    text = "phone +49 30 1234 5678 card 4111 1111 1111 1111 mail a@b.de ip 10.0.0.1"
    assert [(k, text[s:e], base) for k, s, e, _, base in pii.find(text)] == [("email", "a@b.de", True), ("ip", "10.0.0.1", True), ("card", "4111 1111 1111 1111", True), ("phone", "+49 30 1234 5678", True)]


def test_time_is_linear_in_the_text():
    for piece in ("1", "a.", "1 ", "1.", "+1(", "AB12", "a@", "12-", "(at)", "1-", "x@y."):
        began = time.time()
        pii.find(piece * (300_000 // len(piece)))
        assert time.time() - began < 10, piece


def test_odd_documents(spark, odd_docs, no_docs):
    got = pii.report(pii.find_personal_data(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    assert all(r["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in pii.find(t)) for r, t in zip(got, [x["text"] for x in odd_docs.collect()], strict=True))
    assert pii.find_personal_data(no_docs).collect() == [] and pii.redacted(no_docs).columns == no_docs.columns


def test_redaction(spark):
    d = spark.createDataFrame([(1, "mail a@b.de, call +49 30 1234 5678!"), (2, None), (3, "")], "doc_id long, text string")
    assert [r["text"] for r in pii.redacted(d).collect()] == ["mail [EMAIL], call [PHONE]!", None, ""]
