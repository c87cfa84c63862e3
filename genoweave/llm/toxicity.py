"""Toxicity by compression distance (operator 6).

Two zstandard dictionaries are trained, one on toxic and one on ordinary text: a shared background of ordinary text, and
after it the strings that set the class apart, chosen as in the COVER method by covering d-mers, here those d-mers (of
six bytes, within a word) whose document frequency is far higher in the class than in the other. A text is cut into
windows of a few words; each is compressed with either dictionary, and what the toxic one saves is the window's gain.
A text's score is a calibrated logistic of its largest gains.

Training sees a bounded sample of labelled rows (TrainParams) on the driver. Repeated passages count once: of five-word
shingles that an earlier row of the sample had, the words are left out, so that groups of copies with one label do not
look like the language of a class.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TrainParams:
    toxic_docs: int = 2_000  # rows of the sample, at most, and of each class; a third of them calibrate
    ordinary_docs: int = 6_000
    doc_chars: int = 20_000  # longer rows are not in the sample
    window: int = 8  # words
    dmer: int = 6  # bytes
    shingle: int = 5  # words; repeated ones count once
    z: float = 6.0  # of a d-mer's frequency in the class against the other
    ratio: float = 5.0
    least: int = 8  # documents of the class with the d-mer
    special_bytes: int = 16_000  # of a dictionary, at most
    background_bytes: int = 100_000
    background_each: int = 600  # bytes of a document
    level: int = 3
    min_match: int = 5
    cut: float = 0.7  # the score at which the calibrated threshold lies


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    params: TrainParams


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


class Gains:
    """The gains of a text's windows."""

    def __init__(self, model: Model):
        p = model.params
        options = zstandard.ZstdCompressionParameters.from_level(p.level, write_content_size=0, write_checksum=0, write_dict_id=0, min_match=p.min_match)
        self.window = p.window
        self.sizes = [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=options).compress
            for d in (model.ordinary, model.toxic)
        ]

    def of(self, text: str | None) -> np.ndarray:
        words, w = _words(text), self.window
        ordinary, toxic = self.sizes
        parts = [b" " + b" ".join(words[i : i + w]) + b" " for i in range(0, len(words), w)]
        return np.array([len(ordinary(x)) - len(toxic(x)) for x in parts] or [0], np.float64)


def features(gains: np.ndarray) -> np.ndarray:
    """Of a text: intercept, its largest and second gain, what lies above 3 in all (damped), the log of its windows."""
    top = np.sort(gains)[::-1][:2]
    return np.array([1.0, top[0], top[1] if len(top) > 1 else 0.0, math.log1p(np.maximum(gains - 3, 0).sum()), math.log(len(gains))])


def novel(texts: list[str | None], k: int) -> list[list[bytes]]:
    """Of each text the runs of words that no k-word shingle of an earlier one covers."""
    seen: set[int] = set()
    out = []
    for text in texts:
        words = _words(text)
        hashes = [hash(tuple(words[i : i + k])) for i in range(max(len(words) - k + 1, 1))]
        old = np.zeros(len(words) + k, bool)
        for i in [i for i, h in enumerate(hashes) if h in seen]:
            old[i : i + k] = True
        seen.update(hashes)
        runs: list[list[bytes]] = [[]]
        for word, o in zip(words, old, strict=False):
            if o:
                runs.append([])
            else:
                runs[-1].append(word)
        out.append([b" " + b" ".join(r) + b" " for r in runs if r])
    return out


def dmers(text: bytes, d: int) -> np.ndarray:
    """The d-mers of a text as numbers, by place; 0 for those with a space inside."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(a) - d + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    number, inner = np.zeros(n, np.uint64), np.zeros(n, bool)
    for i in range(d):
        number = (number << np.uint64(8)) | a[i : n + i]
        if 0 < i < d - 1:
            inner |= a[i : n + i] == 32
    number[inner] = 0
    return number


def document_frequency(docs: list[list[bytes]], d: int) -> tuple[np.ndarray, np.ndarray]:
    found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for at in range(0, len(docs), 500):  # merged now and then to bound memory
        part = [np.unique(np.concatenate([dmers(r, d) for r in runs])) for runs in docs[at : at + 500] if runs]
        if part:
            u, c = np.unique(np.concatenate(part), return_counts=True)
            found, where = np.unique(np.concatenate([found, u]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, c]), len(found)).astype(np.int64)
    return found[found != 0], counts[found != 0]


def specific(docs: list[list[bytes]], own: tuple, other: tuple, n: int, n_other: int, p: TrainParams) -> bytes:
    """The class' strings, the most telling last (nearest to what is compressed)."""
    found, c = own
    at = np.minimum(np.searchsorted(other[0], found), max(len(other[0]) - 1, 0))
    o = np.where(other[0][at] == found, other[1][at], 0) if len(other[0]) else np.zeros(len(found), np.int64)
    mean = (c + o) / (n + n_other)
    score = (c / n - o / n_other) / np.sqrt(mean * (1 - mean) * (1 / n + 1 / n_other) + 1e-12)
    good = (score >= p.z) & (c >= p.least) & (c / n > p.ratio * (o + 0.5) / n_other)
    keys, worth = found[good], dict(zip(found[good].tolist(), score[good].tolist(), strict=True))
    spans: Counter[bytes] = Counter()
    for run in (r for runs in docs for r in runs):
        hit = np.flatnonzero(np.isin(dmers(run, p.dmer), keys))
        if len(hit):
            for part in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
                spans[run[part[0] : part[-1] + p.dmer]] += 1
    inside = {s: set(dmers(s, p.dmer).tolist()) - {0} for s, k in spans.items() if k > 1}
    ordered = sorted(inside, key=lambda s: (-sum(worth.get(k, 0.0) for k in inside[s]) * min(spans[s], 3) / len(s), s))
    chosen, total = [], 0
    for s in ordered:
        new = [k for k in inside[s] if k in worth]
        if 2 * len(new) >= len(inside[s]):
            if total + len(s) > p.special_bytes:
                break
            chosen.append(s)
            total += len(s)
            for k in new:
                del worth[k]
    return b"".join(reversed(chosen))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - q) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[str | None], toxic: list[int], params: TrainParams = TrainParams()) -> Model | None:
    """The model of a sample; None if it lacks a class."""
    y = np.array(toxic, bool)
    teach = np.zeros(len(y), bool)
    for label in (False, True):  # of each class two thirds train the dictionaries, in the order given
        teach[np.flatnonzero(y == label)[: max(1, int((y == label).sum()) * 2 // 3)]] = True
    calibrate = ~teach if 0 < y[~teach].sum() < (~teach).sum() else teach
    if not 0 < y[teach].sum() < teach.sum():
        return None
    chosen = np.flatnonzero(teach)
    docs = novel([texts[i] for i in chosen], params.shingle)
    split = {c: [d for d, i in zip(docs, chosen, strict=True) if y[i] == c] for c in (True, False)}
    df = {c: document_frequency(split[c], params.dmer) for c in split}
    n = {c: max(1, sum(map(bool, split[c]))) for c in split}
    special = {c: specific(split[c], df[c], df[not c], n[c], n[not c], params) for c in split}
    background = b"".join(b"".join(runs)[: params.background_each] for runs in split[False])[: params.background_bytes]
    longest = max(map(len, special.values()), default=0)
    toxic_dict, ordinary_dict = (background + b"\0" * (longest - len(special[c])) + special[c] + b" " * 8 for c in (True, False))
    model = Model(toxic_dict, ordinary_dict, (), params)
    gains = Gains(model)
    at = np.flatnonzero(calibrate)
    x = np.array([features(gains.of(texts[i])) for i in at])
    w = fit_logistic(x, y[at].astype(float))
    # the threshold with the best F1 on these rows becomes the score `cut`
    raw = x @ w
    order = np.argsort(-raw, kind="stable")
    hits = np.cumsum(y[at][order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + y[at].sum())
    k = int(np.argmax(np.where(np.append(np.diff(raw[order]) != 0, True), f1, -1)))
    threshold = (raw[order][k] + raw[order][min(k + 1, len(order) - 1)]) / 2
    w[0] += math.log(params.cut / (1 - params.cut)) - threshold
    return Model(toxic_dict, ordinary_dict, tuple(w.tolist()), params)


def sample(docs: DataFrame, labels: DataFrame, params: TrainParams = TrainParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list, list]:
    """Texts and labels of a bounded sample, the same for the same rows: of either class the ids that come first by a hash,
    chosen from the labels alone; then their texts, those within doc_chars.

    A first cut by the hash leaves about half as many again as are wanted, so tasks return few rows. Labels that are
    neither 0 nor 1 are left out, an id with both labels too.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_toxic")).filter("_toxic IN (0, 1) AND _id IS NOT NULL")
    marked = marked.withColumn("_hash", F.xxhash64("_id", F.lit("sample")))
    counts = {r["_toxic"]: r["n"] for r in marked.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen: dict[int, int] = {}
    for label, most in ((1, params.toxic_docs), (0, params.ordinary_docs)):
        share = min(1.0, (1.5 * most + 100) / max(counts.get(label, 0), 1))
        within = marked.filter((F.col("_toxic") == label) & (F.col("_hash") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)))
        for r in within.orderBy("_hash", "_id").select("_id").limit(most).collect():
            chosen[r["_id"]] = label if chosen.get(r["_id"], label) == label else -1
    ids = docs.sparkSession.createDataFrame([(i, y) for i, y in chosen.items() if y >= 0], "_id long, _toxic int")  # at most toxic_docs + ordinary_docs
    found = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(ids), F.col("_doc") == F.col("_id"))
    rows = found.filter(F.length("_text").between(1, params.doc_chars)).select("_toxic", "_id", "_text").limit(params.toxic_docs + params.ordinary_docs).collect()
    rows = sorted(rows, key=lambda r: (-r["_toxic"], zlib.crc32(str(r["_id"]).encode()), r["_id"], r["_text"]))
    return [r["_text"] for r in rows], [r["_toxic"] for r in rows]


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted: one row per input row, from the whole text and nothing else.

    Defined edge cases: null and empty texts have one window without gain; without a model every score is 0; texts of any
    length are cut into windows; repeated rows are scored each; an empty table gives no rows; only the two columns are read.
    """
    cut_at = model.params.cut if model else 1.0

    def run(batches):
        gains, w = (Gains(model), np.array(model.weights)) if model else (None, None)
        for b in batches:
            found = np.array([features(gains.of(t.as_py())) @ w if model else -np.inf for t in b.column(1)], np.float64)
            scores = 1 / (1 + np.exp(-np.clip(found, -500, 500))) if model else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores), pa.array((scores >= cut_at).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, params: TrainParams = TrainParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all their columns, less those that the model rejects. The texts travel with their rows: no join."""
    model = fit(*sample(docs, labels, params, id_col, text_col), params)
    if model is None:
        return docs
    names, spot = docs.columns, docs.columns.index(text_col)

    def run(batches):
        gains, w = Gains(model), np.array(model.weights)
        for b in batches:
            found = np.array([features(gains.of(t.as_py())) @ w for t in b.column(spot)], np.float64)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(found, -500, 500))) < params.cut))

    return docs.select(*names).mapInArrow(run, docs.schema)
