"""Mixing sources to target weights (operator 8, native).

The words of each source, document after document, are cut into blocks of a fixed length. Every source gets as many
slots as its target needs. The mix is one line of all slots, cut into output shards of a fixed number of slots; which slot
stands where is a pseudorandom permutation of the line, so the source counts of a shard are a multinomial draw given the
sources' totals, and every source meets its target. Slot j of a source takes block perm(j mod blocks) of pass j div
blocks, perm being a permutation of the source's block numbers for that pass, so that no block is taken more often than
another by more than one. Blocks are joined to slots by their numbers, and the mix comes out by shard and place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import WORD, cut, join_groups, let, packed, with_text, words


@dataclass(frozen=True)
class MixParams:
    block: int = 256  # words
    shard_slots: int = 4_096  # slots of an output shard
    most_passes: int = 3  # a source's target stops at so many times its size
    weights: tuple[int, ...] = (1, 2, 3)  # of the sources by code point, repeating
    rounds: int = 16  # of the permutations
    docs_per_bucket: int = 5_000
    seed: int = 7


def permuted(x: Column, n: Column, rounds: int, *key: Column) -> Column:
    """x moved by a keyed permutation of 0 .. n-1: the swap-or-not shuffle, which holds for any n."""

    def step(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, *key), n) - at, n)
        return let(partner, lambda p: F.when(F.xxhash64(F.greatest(at, p), F.lit("swap"), r, *key).bitwiseAND(F.lit(1)) == 1, p).otherwise(at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), step)


def source_targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """source, sid, source_size, target: shares by weight, capped; what is above a cap is shared anew by weight.

    The capped sources are the first by cap over weight; one running sum finds where they end.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    weighed = ordered.withColumn("weight", F.element_at(F.array(*map(F.lit, params.weights)), (F.col("sid") % len(params.weights) + 1).cast("int")).cast("double"))
    weighed = weighed.withColumn("cap", (params.most_passes * F.col("source_size")).cast("double"))
    line = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, rest, every = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = weighed.withColumn("level", level).withColumn("free", F.col("level") <= F.col("cap") / F.col("weight"))
    settled = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(every)["level"]
    return levelled.withColumn("settled", settled).select(
        "source", "sid", "source_size", F.when(F.col("settled").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("settled") * F.col("weight"))).alias("target")
    )


def slots(targets: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """sid, shard, place (in the shard), pass, block, take (words): one row per slot of the mix."""
    b = params.block
    planned = targets.filter("source_size > 0").select(
        "sid", "source_size", F.ceil(F.col("source_size") / b).alias("blocks"), F.round("target").cast("long").alias("words")
    ).select(
        "sid", "blocks", F.expr("words div source_size").alias("passes"), (F.col("words") % F.col("source_size")).alias("rest")
    ).withColumn("n", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / b))
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    planned = planned.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")).withColumn("total", F.sum("n").over(Window.partitionBy()))
    chunk = 4_096  # a hot source's slots are made by many tasks
    chunks = planned.filter("n > 0").withColumn("c", F.explode(F.expr(f"sequence(0L, (n - 1) div {chunk})")))
    # a stated number of partitions: a few rows here become many below, and are not to meet in one task
    chunks = chunks.repartition(max(8, int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.xxhash64("sid", "c"))
    each = chunks.withColumn("j", F.explode(F.expr(f"sequence(c * {chunk}, least(n, (c + 1) * {chunk}) - 1)")))
    seed = F.lit(params.seed)
    drawn = each.withColumn("at", permuted(F.col("first") + F.col("j"), F.col("total"), params.rounds, seed, F.lit("shard")))
    return drawn.select(
        "sid",
        F.expr(f"at div {params.shard_slots}").alias("shard"),
        (F.col("at") % params.shard_slots).alias("place"),
        F.expr("j div blocks").alias("pass"),
        permuted(F.col("j") % F.col("blocks"), F.col("blocks"), params.rounds, seed, F.col("sid"), F.expr("j div blocks")).alias("block"),
        F.when((F.col("rest") > 0) & (F.col("j") == F.col("n") - 1), F.col("rest") - F.expr(f"((rest - 1) div {b}) * {b}")).otherwise(F.lit(b)).cast("long").alias("take"),
    )


def shard_counts(slot_rows: DataFrame) -> DataFrame:
    """shard, sid, n: the draw of each output shard."""
    return slot_rows.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))


def placed(sizes: DataFrame, params: MixParams) -> tuple[DataFrame, DataFrame]:
    """Documents with sid, bucket, rn (their key) and start, their first word's place in the source; and the targets.

    Places are running sums within small buckets on top of running sums over the buckets, so a hot source is no group.
    """
    targets = cut(source_targets(sizes, params))
    n = max(sizes.count(), 1)
    buckets = max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // params.docs_per_bucket))
    keyed = join_groups(sizes, targets, ["source"], ["doc_id"]).withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit("bucket")), F.lit(buckets)))
    own = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", "mark")
    keyed = keyed.withColumn("rn", F.row_number().over(own)).withColumn("within", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    over = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("s")).select("sid", "bucket", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("base"))
    return keyed.join(firsts, ["sid", "bucket"]).withColumn("start", F.col("base") + F.col("within")).drop("base", "within"), targets


def used_segments(places: DataFrame, slot_rows: DataFrame, params: MixParams) -> DataFrame:
    """sid, bucket, rn, pass, shard, place, lo, hi: word ranges (within the document) that the slots of the mix take."""
    b = params.block
    segments = places.filter("size > 0").select("sid", "bucket", "rn", "start", "size", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block"))
    # both sides grow with the corpus: neither is broadcast
    joined = segments.join(slot_rows.hint("merge"), ["sid", "block"])
    lo = F.greatest(F.col("start"), F.col("block") * b)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("take"))
    return joined.select("sid", "bucket", "rn", "pass", "shard", "place", (lo - F.col("start")).alias("lo"), (hi - F.col("start")).alias("hi")).filter("hi > lo")


def word_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mark: Column | None = None) -> DataFrame:
    """doc_id, source, size (words of the whole text; null: 0) and mark, which tells rows with one id apart (a hash of the
    text, unless given)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    mark = F.xxhash64(text) if mark is None else mark
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), mark.alias("mark"))


def mix_sources(docs: DataFrame, params: MixParams = MixParams(), **columns: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shards (output shards that have words of it), first_shard (null if
    none has): one row per input row.

    Defined edge cases: a null or blank text has size 0 and is never taken; a null source is a source of its own and the
    last; rows that repeat an id are documents of their own; an empty table gives no rows; only the named columns are read.
    The same rows and seed give the same mix, however they are partitioned.
    """
    sizes = cut(word_sizes(docs, **columns))
    places, targets = placed(sizes, params)
    places = cut(places)
    used = used_segments(places, slots(targets, params), params).groupBy("sid", "bucket", "rn")
    taken = used.agg(F.sum(F.col("hi") - F.col("lo")).cast("long").alias("taken"), F.size(F.collect_set("shard")).cast("long").alias("shards"), F.min("shard").alias("first_shard"))
    none = F.lit(0).cast("long")
    return places.join(taken, ["sid", "bucket", "rn"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), F.coalesce("shards", none).alias("shards"), "first_shard"
    )


def mixed_documents(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of docs: a document for each pass that takes words of it, in the shard and at the
    place of the first of its blocks. A partition holds whole shards, in order.

    A pass that takes the whole document leaves its text as it is; one that takes a part has those words, joined by a
    space. Edge cases as in mix_sources; texts without words are not in the mix; rows are told apart by all their columns,
    so those that share an id keep their own, and equal rows are taken each. Columns must be such that can be hashed.
    """

    def mark(of: Callable[[str], Column]) -> Column:  # hashes skip nulls, so those are said besides
        return F.xxhash64(*(x for c in docs.columns for x in (of(c), of(c).isNull())))

    sizes = cut(word_sizes(docs, id_col, text_col, source_col, mark(lambda c: F.col(f"`{c}`"))))
    places, targets = placed(sizes, params)
    places = cut(places)
    used = used_segments(places, slots(targets, params), params).groupBy("sid", "bucket", "rn", "pass")
    ranges = used.agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_parts"), F.min(F.struct("shard", "place")).alias("_first"))
    parts = places.join(ranges, ["sid", "bucket", "rn"]).select(F.col("doc_id").alias("part_id"), "mark", "size", F.col("_parts").alias("parts"), F.col("_first").alias("first"))
    rows = packed(docs, id_col, text_col).withColumn("hash", mark(lambda c: F.col("row").getField(c)))
    if sizes.groupBy("doc_id", "mark").count().filter("count > 1").limit(1).count():  # each of equal rows has parts of its own
        rows = rows.dropDuplicates(["id", "hash"])
    joined = rows.join(parts, F.col("id").eqNullSafe(F.col("part_id")) & (F.col("hash") == F.col("mark")))
    picked = let(words(F.col("text")), lambda w: F.concat_ws(" ", F.flatten(F.transform("parts", lambda p: F.slice(w, (p["lo"] + 1).cast("int"), (p["hi"] - p["lo"]).cast("int"))))))
    whole = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["hi"] - p["lo"]) == F.col("size")
    dealt = joined.withColumn("picked", F.when(whole, F.col("text")).otherwise(picked)).select("row", "text", "picked", "first").repartition("first.shard")
    return with_text(dealt.sortWithinPartitions("first"), text_col, F.col("picked"))
