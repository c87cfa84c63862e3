"""Quality rules with adaptive thresholds (operator 3, native).

Every document gets exact base counts. Mergeable quantile sketches (percentile_approx) of four ratios, kept for each
language and source, for each language, and for all documents, give the fences; a document is kept if its ratios lie
within the fences of its own group. A group's quantiles are means of its own and its language's, and those of its language's
and the corpus', weighted by their documents against a prior weight, so a group moves from its language's quantiles to its
own as it grows, without a switch. A fence lies beyond a quantile in the group's tail, by a multiple of what parts that
quantile from the median, and never inside the same quantile of the language. Shares are measured by -log(1 - share), so a
fence stays below one. No ratio has a fixed cutoff: beyond the base rule all that is fixed are shares of documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import BLANKS, cut, join_groups, let, words

#: Ratio -> the share of a group's documents that lie below its tail.
TAILS = {"symbol_ratio": 0.95, "dup_line_ratio": 0.99, "repeat_ratio": 0.99, "mean_word": 0.95}
SPREAD = 1.5
PRIOR = 100
SHARES = ("dup_line_ratio", "repeat_ratio")  # at most one
SLACK = 1e-9  # relative, for the rounding of means


@dataclass(frozen=True)
class QualityParams:
    tails: dict[str, float] = field(default_factory=lambda: dict(TAILS))
    spread: float = SPREAD  # fences lie so many times the way from the median to the tail beyond the tail
    accuracy: int = 10_000  # of the sketches
    prior: float = PRIOR  # documents that the language's quantiles weigh in a group's, the corpus' in a language's
    max_broadcast_groups: int = 5_000  # above it the thresholds are joined by a salted shuffle
    salts: int = 64


def repeated_words(ws: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.

    Where two window hashes are equal, they are sorted with their positions, so equal windows lie side by side: O(n log n)
    a text.
    """

    def covered(at: Column) -> Column:
        gap = F.transform(at, lambda p, k: F.least(F.lit(3), F.get(at, k + 1) - p))
        return F.aggregate(gap, F.lit(0).cast("long"), lambda a, g: a + F.coalesce(g, F.lit(3)).cast("long"))

    def in_windows(h: Column) -> Column:
        def marked(order: Column) -> Column:
            value = lambda k: F.get(order, k)["h"]
            same = F.filter(order, lambda p, k: (value(k - 1) == p["h"]) | (value(k + 1) == p["h"]))
            return F.sort_array(F.transform(same, lambda p: p["i"]))

        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(order, lambda s: let(marked(s), covered)))

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    windows = let(hashed, lambda x: F.transform(F.slice(x, 1, F.greatest(F.size(x) - 2, F.lit(0))), lambda a, i: F.xxhash64(a, F.get(x, i + 1), F.get(x, i + 2))))
    return F.when(F.size(ws) < 4, F.lit(0).cast("long")).otherwise(let(windows, in_windows))


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the exact base counts of every whole text. Null texts count as empty; null
    languages and sources are values of their own; repeated rows are counted each."""
    text = F.coalesce(F.col("t"), F.lit(""))
    blank = F.regexp_count(text, F.lit("[\\x20\\x09-\\x0D]"))

    def lines(x: Column) -> Column:
        return F.filter(F.split(x, "\n"), lambda y: F.btrim(y, F.lit(BLANKS)) != "")

    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("t"),
    ).select(
        "doc_id", "lang", "source",
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        (F.length(text) - blank).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines(text), lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counted.select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines").select(
        "*",
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")).alias("dup_line_ratio"),
        (F.col("n_repeat_words") / n).alias("repeat_ratio"),
        (F.col("word_chars") / n).alias("mean_word"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )


def _beyond(tail: Column, median: Column, spread: float, share: bool) -> Column:
    """The fence above a tail."""
    if not share:
        return tail + spread * (tail - median)
    rest = F.lit(1.0) - tail
    return F.greatest(tail, F.lit(1.0) - rest * F.pow(rest / F.greatest(F.lit(1.0) - median, F.lit(1e-12)), F.lit(spread)))


def fences(stats: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """lang, source, limits (n, each ratio's high, mean_word_low) of every group; from the sketches of documents that pass
    the base rule. A group without such documents has its language's quantiles; if none passes at all, limits are null."""
    grouped = stats.filter(~F.col("base_failed")).select(F.struct("lang", "source").alias("own"), F.struct(F.col("lang")).alias("lang"), *params.tails)
    sketch = [F.percentile_approx(m, F.array(*map(F.lit, (round(1 - q, 9), 0.5, q))), params.accuracy).alias(m) for m, q in params.tails.items()]

    def of(frame: DataFrame, name: str, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sketch).select(*keys, F.struct("n", *params.tails).alias(name))

    own, lang, corpus = of(grouped, "at_own", "own"), of(grouped, "at_lang", "lang"), of(grouped, "at_all")
    groups = stats.select("lang", "source").distinct().select("lang", "source", F.struct("lang", "source").alias("own"), F.struct(F.col("lang")).alias("by"))
    joined = groups.join(own, groups["own"].eqNullSafe(own["own"]), "left").join(lang.withColumnRenamed("lang", "l"), F.col("by").eqNullSafe(F.col("l")), "left").join(F.broadcast(corpus), F.lit(True), "left")

    def shrunk(level: str, m: str, k: int, towards: Column) -> Column:
        n = F.coalesce(F.col(level)["n"], F.lit(0))
        return (n * F.coalesce(F.col(level)[m][k], F.lit(0.0)) + params.prior * towards) / (n + F.lit(float(params.prior)))

    by_lang = {(m, k): shrunk("at_lang", m, k, F.col("at_all")[m][k]) for m in params.tails for k in range(3)}
    by_own = {(m, k): shrunk("at_own", m, k, q) for (m, k), q in by_lang.items()}
    high = {m: F.greatest(_beyond(by_own[m, 2], by_own[m, 1], params.spread, m in SHARES), by_lang[m, 2]) for m in params.tails}
    low = F.least(_beyond(by_own["mean_word", 0], by_own["mean_word", 1], params.spread, False), by_lang["mean_word", 0])
    limits = F.struct(F.coalesce(F.col("at_own")["n"], F.lit(0)).alias("n"), *((x * (1 + SLACK)).alias(f"{m}_high") for m, x in high.items()), (low * (1 - SLACK)).alias("mean_word_low"))
    return joined.select(groups["lang"], groups["source"], F.when(F.col("at_all")["n"] > 0, limits).alias("limits"))


def quality_rules(docs: DataFrame, params: QualityParams = QualityParams(), **columns: str) -> DataFrame:
    """One row per document: base counts, ratios, its group's limits, base_failed and kept.

    Defined edge cases: null or empty texts have zero counts and fail the base rule; an empty table gives no rows;
    ties at a fence are kept; repeated rows are judged alike; other columns of docs are not read.
    """
    stats = cut(text_stats(docs, **columns))  # small rows; texts are scanned once
    limits = cut(fences(stats, params))
    joined = join_groups(stats, limits, ["lang", "source"], ["doc_id"], params.max_broadcast_groups, params.salts)
    within = F.col("mean_word") >= F.col("limits.mean_word_low")
    for m in params.tails:
        within = within & (F.col(m) <= F.col(f"limits.{m}_high"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True)))
