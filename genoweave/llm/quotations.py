"""Quotation linking in conversations (operator 7, native).

Lines are told apart by their depth of quotation; runs of one depth are passages. Passages, their lines and their
sentences are normalised and hashed, quoted ones are joined to the first message of the conversation that says the same
unquoted, and a message replies to the one that most of its outermost quoted text comes from, or else to the message
before it. So messages of a conversation are a tree; it is returned in reply order, depth first and answers by turn, one
row per message, without quotes. A quotation that was wrapped anew, or is a part of what was said, links by its sentences.

Reply order is found by ranking the walk around each tree: every step of the walk knows the next, and rounds of joins
double how far it sees, so a conversation of any length takes a logarithmic number of rounds and is no group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import BLANKS, cut, let

#: The marks of quotation before a line.
QUOTE = "^[ \\t]*(?:>[ \\t]?)+"


@dataclass(frozen=True)
class QuoteParams:
    turns_per_block: int = 256


def normalised(x: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(x, "[ \\t\\n\\x0B\\f\\r]+", " "), F.lit(" ")))


def parsed_lines(text: Column) -> Column:
    """array<struct<level, body>> of the lines of a text."""
    mark = lambda x: F.regexp_extract(x, QUOTE, 0)
    return F.transform(F.split(text, "\n"), lambda x: F.struct(F.regexp_count(mark(x), F.lit(">")).alias("level"), F.regexp_replace(x, QUOTE, "").alias("body")))


def passages(lines: Column) -> Column:
    """array<struct<level, bodies>>: runs of lines of one level."""
    numbered = F.transform(lines, lambda x, i: F.struct(x["level"].alias("level"), i.alias("i")))
    return let(
        F.filter(numbered, lambda x: (x["i"] == 0) | (x["level"] != F.get(lines, x["i"] - 1)["level"])),
        lambda starts: F.transform(
            starts,
            lambda s, k: F.struct(
                s["level"].alias("level"),
                F.transform(F.slice(lines, s["i"] + 1, F.coalesce(F.get(starts, k + 1)["i"], F.size(lines)) - s["i"]), lambda y: y["body"]).alias("bodies"),
            ),
        ),
    )


def units_of(bodies: Column) -> Column:
    """What a passage can be known by: all of it, its lines, and its sentences, normalised."""

    def of(whole: Column) -> Column:
        sentences = F.split(F.regexp_replace(whole, "([.!?]) ", "$1\n"), "\n")
        return F.filter(F.array_distinct(F.concat(F.array(whole), F.transform(bodies, normalised), sentences)), lambda u: u != "")

    return let(normalised(F.array_join(bodies, " ")), of)


def beside(frame: DataFrame, keys: list[str], size: int, back: bool) -> DataFrame:
    """frame (keys, o: unique) with `beside`, the o before (back) or after it among its keys. Blocks of `size` turns are
    ordered, then their ends, so that a large group is ordered by many tasks."""
    step = F.lag if back else F.lead
    end = F.max if back else F.min
    blocked = frame.withColumn("block", F.expr(f"o div {size}"))
    ends = blocked.groupBy(*keys, "block").agg(end("o").alias("end"))
    over = ends.select(*(F.col(k).alias(f"{k}_") for k in keys), F.col("block").alias("block_"), step("end").over(Window.partitionBy(*keys).orderBy("block")).alias("over"))
    on = F.col("block") == F.col("block_")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_"))
    near = blocked.withColumn("near", step("o").over(Window.partitionBy(*keys, "block").orderBy("o")))
    return near.join(over, on).withColumn("beside", F.coalesce("near", "over")).drop("block", "near", "over", "block_", *(f"{k}_" for k in keys))


def running(frame: DataFrame, size: int) -> DataFrame:
    """frame (c, o: unique, k) with `rows` and `turns`, the sum of k and the number of rows before in c; by blocks too."""
    blocked = frame.withColumn("block", F.expr(f"o div {size}"))
    before = Window.partitionBy("c", "block").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = blocked.groupBy("c", "block").agg(F.sum("k").alias("s"), F.count(F.lit(1)).alias("n")).select("c", "block", F.coalesce(F.sum("s").over(over), none).alias("s"), F.coalesce(F.sum("n").over(over), none).alias("n"))
    within = blocked.withColumn("rows", F.coalesce(F.sum("k").over(before), none)).withColumn("turns", F.count(F.lit(1)).over(before))
    return within.join(sums, ["c", "block"]).withColumn("rows", F.col("rows") + F.col("s")).withColumn("turns", F.col("turns") + F.col("n")).drop("s", "n", "block")


def reply_order(nodes: DataFrame, params: QuoteParams = QuoteParams()) -> DataFrame:
    """c, o, rows (of messages before it), depth, thread of nodes c, o, parent (an earlier o; null for the first), k (rows):
    the place of each in a walk of the tree, depth first, answers in order of o. A thread begins at each answer but the
    first to a message."""
    answers = nodes.filter("parent IS NOT NULL").select("c", "parent", "o")
    sibling = beside(answers, ["c", "parent"], params.turns_per_block, back=False).select("c", "o", F.col("beside").alias("sibling"))
    eldest = answers.groupBy("c", "parent").agg(F.min("o").alias("eldest")).withColumnRenamed("parent", "o")
    told = nodes.join(sibling, ["c", "o"], "left").join(eldest, ["c", "o"], "left")
    first = eldest.select("c", F.col("eldest").alias("o"), F.lit(0).alias("start"))
    told = told.join(first, ["c", "o"], "left").withColumn("start", F.coalesce("start", F.lit(1)))
    # steps of the walk: into a message (side 0) and out of it (1)
    step = lambda o, side: F.struct(o.alias("o"), F.lit(side).alias("side"))
    o, child, after, up = (F.col(x) for x in ("o", "eldest", "sibling", "parent"))
    into = F.struct(F.lit(0).alias("side"), F.when(child.isNotNull(), step(child, 0)).otherwise(step(o, 1)).alias("next"), F.col("k").alias("rows"), F.lit(1).alias("depth"), F.col("start").alias("thread"))
    out_to = F.when(after.isNotNull(), step(after, 0)).when(up.isNotNull(), step(up, 1))
    out = F.struct(F.lit(1).alias("side"), out_to.alias("next"), F.lit(0).cast("long").alias("rows"), F.lit(-1).alias("depth"), F.lit(0).alias("thread"))
    sums = ("rows", "depth", "thread")
    state = cut(told.select("c", "o", F.explode(F.array(into, out)).alias("s")).select("c", F.struct("o", F.col("s.side").alias("side")).alias("at"), "s.next", *(F.col(f"s.{x}").cast("long").alias(x) for x in sums)))
    while state.filter("next IS NOT NULL").limit(1).count():
        ahead = state.select(F.col("c").alias("c2"), F.col("at").alias("at2"), F.col("next").alias("next2"), *(F.col(x).alias(f"{x}2") for x in sums))
        moved = state.filter("next IS NOT NULL").join(ahead, (F.col("c") == F.col("c2")) & (F.col("next") == F.col("at2")))
        moved = moved.select("c", "at", F.col("next2").alias("next"), *((F.col(x) + F.col(f"{x}2")).alias(x) for x in sums))
        state = cut(moved.unionByName(state.filter("next IS NULL")))
    # sums from a step to the end of the walk; of the first step they are those of the whole
    own = state.filter("at.side = 0").select("c", F.col("at.o").alias("o"), *(F.col(x).alias(f"{x}2") for x in sums))
    whole = own.groupBy("c").agg(F.max("rows2").alias("all_rows"), F.max("thread2").alias("all_threads"))
    ranked = own.join(whole, "c").join(told.select("c", "o", "start"), ["c", "o"])
    return ranked.select("c", "o", (F.col("all_rows") - F.col("rows2")).alias("rows"), (-F.col("depth2")).alias("depth"), (F.col("all_threads") - F.col("thread2") + F.col("start") - 1).alias("thread"))


def link_quotes(messages: DataFrame, params: QuoteParams = QuoteParams(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, position (from 0, in reply order), reply_to (a turn; null for the first message), depth (of the
    reply), thread (from 0), quoted (whether reply_to comes from a quotation), n_passages and n_linked (quoted passages;
    those of which something was found), max_level, text.

    Defined edge cases: a null text is empty; null conversations are one conversation, null turns come last in it; rows that
    repeat a turn stand next to each other, by role and text, and share their links; blank passages link to nothing; a
    passage said only later or in the quoting message itself has no original; an empty table gives no rows; only the four
    columns are read.
    """
    last = 2**63 - 1
    own = messages.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    ).withColumn("c", F.struct("conv_id")).withColumn("o", F.coalesce("turn", F.lit(last)))
    told = own.withColumn("lines", parsed_lines(F.col("t"))).withColumn("passages", passages(F.col("lines")))
    unquoted = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    told = told.select(
        "c", "o", "conv_id", "turn", "role", "t", "passages",
        F.btrim(unquoted, F.lit(BLANKS)).alias("text"),
        F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_passages"),
        F.array_max(F.transform("lines", lambda x: x["level"])).cast("long").alias("max_level"),
    )
    each = told.select("c", "o", F.posexplode("passages").alias("n", "p"))
    units = each.select("c", "o", "n", F.col("p.level").alias("level"), F.explode(units_of(F.col("p.bodies"))).alias("unit")).select("c", "o", "n", "level", F.sha2("unit", 256).alias("hash"), F.length("unit").alias("chars"))
    # the first to say something is its original: one row for each text of a conversation, so no quotation meets many
    first = units.filter("level = 0").groupBy("c", "hash").agg(F.min("o").alias("ref"))
    linked = cut(units.filter("level > 0").join(first, ["c", "hash"]).filter("ref < o"))
    votes = linked.filter("level = 1").groupBy("c", "o", "ref").agg(F.sum("chars").alias("chars"))
    said = votes.groupBy("c", "o").agg(F.max_by("ref", F.struct("chars", "ref")).alias("said"))
    found = linked.groupBy("c", "o").agg(F.count_distinct("n").alias("n_linked"))
    turns = own.groupBy("c", "o").agg(F.count(F.lit(1)).alias("k"))
    nodes = beside(turns, ["c"], params.turns_per_block, back=True).join(said, ["c", "o"], "left")
    nodes = cut(nodes.select("c", "o", "k", "said", F.col("beside").alias("previous"), F.coalesce("said", "beside").alias("parent")))
    # a conversation in which each message answers the one before is in reply order as it is
    branched = nodes.filter("parent < previous").select("c").distinct()
    plain = running(nodes.join(branched, "c", "left_anti"), params.turns_per_block).select("c", "o", "rows", F.col("turns").alias("depth"), F.lit(0).cast("long").alias("thread"))
    ordered = plain.unionByName(reply_order(cut(nodes.join(branched, "c", "left_semi")), params)) if branched.limit(1).count() else plain
    placed = nodes.join(ordered, ["c", "o"]).join(found, ["c", "o"], "left")
    joined = told.drop("passages").withColumn("nth", F.row_number().over(Window.partitionBy("c", "o").orderBy("role", "t"))).join(placed, ["c", "o"])
    return joined.select(
        "conv_id", "turn", "role", (F.col("rows") + F.col("nth") - 1).cast("long").alias("position"), F.when(F.col("parent") != last, F.col("parent")).alias("reply_to"), "depth", "thread",
        F.col("said").isNotNull().alias("quoted"), "n_passages", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "max_level", "text",
    )
