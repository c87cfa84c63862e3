"""Document fingerprints as Merkle trees over sections and paragraphs (operator 9, native).

Sections are divided by blank lines, paragraphs by line ends. A paragraph's digest is the SHA-256 of its text, a
section's that of its paragraphs' digests, the root that of the sections' digests; nothing of the text is left out, so
roots are equal if and only if texts are. Below each paragraph hang leaves, short runs of words with 24-bit digests, by
which two trees that differ can be compared. A fingerprint carries the whole tree: the root in full, of each section and
paragraph the first 32 bits, and the leaves; so edits are located from two fingerprints alone, by descending where
branches differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import let, words

#: Words in a leaf; paragraphs of fewer than SHORT words have a leaf for each word.
RUN, SHORT = 4, 16
LEAF_MASK = 0xFFFFFF
#: Hexadecimal digits of a branch and of a leaf in a fingerprint.
BRANCH, LEAF = 8, 6


def _leaves_of(paragraph: Column) -> Column:
    def of(ws: Column) -> Column:
        width = F.when(F.size(ws) < SHORT, F.lit(1)).otherwise(F.lit(RUN))
        runs = F.sequence(F.lit(0), F.floor((F.size(ws) - 1) / width).cast("int"))
        digest = lambda i: F.xxhash64(F.slice(ws, i * width + 1, width)).bitwiseAND(F.lit(LEAF_MASK)).cast("int")
        return F.when(F.size(ws) == 0, F.array().cast("array<int>")).otherwise(F.transform(runs, digest))

    return let(words(paragraph), of)


def tree(text: Column) -> Column:
    """struct(root, sections: array of struct(digest, paragraphs: array of struct(digest, leaves)))."""
    paragraph = lambda p: F.struct(F.sha2(p, 256).alias("digest"), _leaves_of(p).alias("leaves"))
    whole = lambda parts: F.sha2(F.array_join(F.transform(parts, lambda x: x["digest"]), ""), 256)
    short = lambda p: F.struct(F.substr(p["digest"], F.lit(1), F.lit(BRANCH)).alias("digest"), p["leaves"].alias("leaves"))
    section = lambda s: let(F.transform(F.split(s, "\n"), paragraph), lambda ps: F.struct(whole(ps).alias("digest"), F.transform(ps, short).alias("paragraphs")))
    branch = lambda s: F.struct(F.substr(s["digest"], F.lit(1), F.lit(BRANCH)).alias("digest"), s["paragraphs"].alias("paragraphs"))
    return let(F.transform(F.split(text, "\n\n"), section), lambda ss: F.struct(whole(ss).alias("root"), F.transform(ss, branch).alias("sections")))


def leaves(node: Column) -> Column:
    """The leaf digests of a tree, paragraph by paragraph."""
    return F.flatten(F.flatten(F.transform(node["sections"], lambda s: F.transform(s["paragraphs"], lambda p: p["leaves"]))))


def fingerprint(node: Column) -> Column:
    """A tree as text: the root, a colon, and sections divided by slashes; of a section its digest, then for each paragraph
    a full stop, its digest and six hexadecimal digits for each leaf."""
    digits = lambda p: F.array_join(F.transform(p["leaves"], lambda x: F.lower(F.lpad(F.hex(x), LEAF, "0"))), "")
    paragraph = lambda p: F.concat(F.lit("."), p["digest"], digits(p))
    section = lambda s: F.concat(s["digest"], F.array_join(F.transform(s["paragraphs"], paragraph), ""))
    return F.concat(node["root"], F.lit(":"), F.array_join(F.transform(node["sections"], section), "/"))


def from_fingerprint(value: Column) -> Column:
    """The tree that fingerprint() wrote."""

    def paragraph(p: Column) -> Column:
        at = F.sequence(F.lit(BRANCH + 1), F.length(p), F.lit(LEAF))
        found = F.transform(at, lambda i: F.conv(F.substr(p, i, F.lit(LEAF)), 16, 10).cast("int"))
        none = F.array().cast("array<int>")
        return F.struct(F.substr(p, F.lit(1), F.lit(BRANCH)).alias("digest"), F.when(F.length(p) <= BRANCH, none).otherwise(found).alias("leaves"))

    def section(s: Column) -> Column:
        return let(F.split(s, "\\."), lambda x: F.struct(x[0].alias("digest"), F.transform(F.slice(x, F.lit(2), F.size(x) - 1), paragraph).alias("paragraphs")))

    return F.struct(F.substring_index(value, ":", 1).alias("root"), F.transform(F.split(F.substring_index(value, ":", -1), "/"), section).alias("sections"))


def likeness(a: Column, b: Column) -> Column:
    """Of two trees, 0 to 1: 1 for equal roots, else twice the shared distinct leaves over those of either."""

    def of(x: Column) -> Column:
        total = F.size(x["a"]) + F.size(x["b"])
        return F.when(total == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(x["a"], x["b"])) / total)

    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(let(F.struct(F.array_distinct(leaves(a)).alias("a"), F.array_distinct(leaves(b)).alias("b")), of))


def edits(a: Column, b: Column) -> Column:
    """Where two trees differ: array<struct<section, paragraph>> (from 0), found by descending into branches whose digests
    differ; a branch that only one side has differs."""

    def below(p: Column, q: Column, s: Column) -> Column:
        digests = lambda x: F.transform(F.coalesce(x["paragraphs"], F.array().cast("array<struct<digest:string,leaves:array<int>>>")), lambda y: y["digest"])
        flags = F.zip_with(digests(p), digests(q), lambda x, y: x.eqNullSafe(y))
        spots = F.transform(flags, lambda same, i: F.when(~same, F.struct(s.alias("section"), i.alias("paragraph"))))
        return F.filter(spots, lambda x: x.isNotNull())

    pairs = F.zip_with(a["sections"], b["sections"], lambda x, y: F.struct(x.alias("a"), y.alias("b")))
    found = F.transform(pairs, lambda z, s: F.when(~z["a"]["digest"].eqNullSafe(z["b"]["digest"]), below(z["a"], z["b"], s)))
    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    return F.when(a["root"] == b["root"], none).otherwise(F.flatten(F.filter(found, lambda x: x.isNotNull())))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint of every whole text. Null texts count as empty; repeated rows have a row each."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("n_chars"), fingerprint(tree(text)).alias("fingerprint"))


def _block(docs: DataFrame, per_block: int, most: int) -> Column:
    """The number of the id range of a row. Ranges hold about as many rows each: their ends come from a quantile sketch
    of the ids, and are at most `most` numbers."""
    levels = min(max(docs.count() // per_block, 1).bit_length(), most.bit_length() - 1)
    ends = docs.agg(F.percentile_approx("doc_id", [i / 2**levels for i in range(1, 2**levels)], 100_000).alias("e")).first()["e"]
    if not ends:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, ends))), ",").cast("array<bigint>")  # folded to a constant
    step = lambda lo, s: lo + F.when(F.get(bounds, lo + s - 1) < F.col("doc_id"), s).otherwise(F.lit(0))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.aggregate(F.array(*(F.lit(2**k) for k in reversed(range(levels)))), F.lit(0), step))


def with_next_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_block: int = 2_000, most_blocks: int = 8_192) -> DataFrame:
    """Fingerprints of every text and of its edited form, in which the last third of the code points gives way to the
    first as many of the next document's, by descending id (after the last: the first).

    Rows: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_paragraphs.
    Texts are shuffled once, to id ranges in whose windows the neighbour is the row before; the last row of each range is
    also sent to the next range. The ends of ranges are at most most_blocks ids.
    Defined edge cases: null texts are empty; a single row is its own neighbour; equal ids are ordered by their text; rows
    without an id have each other as neighbours, by text, the first of them itself; an empty table gives no rows; only the
    two columns are read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    block = _block(own, per_block, most_blocks)
    tops = sorted((r["block"], r["top"]) for r in own.filter("doc_id IS NOT NULL").groupBy(block.alias("block")).agg(F.max("doc_id").alias("top")).collect())
    guests = own.sparkSession.createDataFrame([(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)], "top long, upper int")
    sent = own.withColumn("block", block).join(F.broadcast(guests), F.col("doc_id") == F.col("top"), "left")
    stays = F.struct(F.col("block").alias("block"), F.lit(1).alias("own"))
    goes = F.struct(F.col("upper").alias("block"), F.lit(0).alias("own"))
    sent = sent.select("doc_id", "text", F.explode(F.when(F.col("upper").isNull(), F.array(stays)).otherwise(F.array(stays, goes))).alias("to")).select("doc_id", "text", "to.*")
    order = Window.partitionBy("block").orderBy("own", "doc_id", "text")
    both = sent.withColumn("next", F.coalesce(F.lag("text").over(order), F.col("text"))).filter("own = 1")
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    edited = both.select("doc_id", "text", "next", n.cast("long").alias("n_chars"), F.concat(F.substr("text", F.lit(1), n - k), F.substr("next", F.lit(1), k)).alias("edited"))
    trees = F.struct(tree(F.col("text")).alias("own"), tree(F.col("edited")).alias("edited"), tree(F.col("next")).alias("next"))
    compared = lambda t: F.struct(
        fingerprint(t["own"]).alias("fingerprint"), fingerprint(t["edited"]).alias("edited_fingerprint"),
        likeness(t["own"], t["edited"]).alias("near_edited"), likeness(t["own"], t["next"]).alias("near_next"),
        F.size(edits(t["own"], t["edited"])).cast("long").alias("edited_paragraphs"),
    )
    found = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), let(trees, compared).alias("t"))
    return found.select("doc_id", "n_chars", "edited_sha256", "t.*")
