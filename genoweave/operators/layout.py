"""Layout of genomes, contigs, spans and genes as drawable primitives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the figure.
TICK, LABEL_RISE, MIN_LABEL = 0.03, 0.3, 400_000
COLOURS = ("azure4", "red", "blue")
GENE_COLOURS = ("cornflowerblue", "coral3", "darkcyan")
PX_HEIGHT, PX_EACH, PX_PER_HIGH, PX_PER_WIDE = 400, 100, 94, 96


def contig_offsets(contigs: DataFrame, order: str = "contig_idx") -> DataFrame:
    """offset: the length of the contigs before, within the genome."""
    w = Window.partitionBy("genome").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return contigs.withColumn("offset", F.coalesce(F.sum("len").over(w), F.lit(0)).cast("long"))


def genome_lengths(contigs: DataFrame) -> DataFrame:
    """genome, total; and the greatest of all in every row."""
    total = contigs.groupBy("genome").agg(F.sum("len").cast("long").alias("total"))
    return total.withColumn("longest", F.max("total").over(Window.partitionBy()))


def segments(offsets: DataFrame, level: str = "level") -> DataFrame:
    """An axis segment for each contig, its ticks and the place of its label."""
    end = F.col("offset") + F.col("len")
    return offsets.select(
        "genome", "contig", F.col("offset").alias("x0"), end.alias("x1"), (end - F.col("len") / 2).alias("label_x"),
        (F.col(level) - TICK).alias("tick_down"), (F.col(level) + TICK).alias("tick_up"), (F.col(level) + LABEL_RISE).alias("label_y"),
    )


def polygon(start_a: Column, stop_a: Column, start_b: Column, stop_b: Column, level: Column) -> Column:
    """struct(x, y): the four corners between two levels, the first again at the end."""
    up = level + 1
    return F.struct(F.array(start_a, start_b, stop_b, stop_a, start_a).alias("x"), F.array(level, up, up, level, level).alias("y"))


def shifted(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """rows with both sides' coordinates (left_a, right_a, left_b, right_b) moved by their contigs' offsets."""
    o = offsets.select("genome", "contig", "offset")
    both = rows.join(o.toDF("genome_a", "contig_a", "off_a"), ["genome_a", "contig_a"]).join(o.toDF("genome_b", "contig_b", "off_b"), ["genome_b", "contig_b"])
    for c in ("left", "right"):
        for s in "ab":
            both = both.withColumn(f"{c}_{s}", F.col(f"{c}_{s}") + F.col(f"off_{s}"))
    return both.drop("off_a", "off_b")


def gene_glyphs(genes: DataFrame, offsets: DataFrame, boxes: bool = True) -> DataFrame:
    """gene, x, y: boxes, or points at the starts."""
    o = genes.join(offsets.select("genome", "contig", "offset", "level"), ["genome", "contig"])
    x0, x1 = F.col("lend") + F.col("offset"), F.col("rend") + F.col("offset")
    if not boxes:
        return o.select("gene", F.array(x0).alias("x"), F.array("level").alias("y"))
    down, up = F.col("level") - 1, F.col("level")
    return o.select("gene", F.array(x0, x0, x1, x1, x0).alias("x"), F.array(down, up, up, down, down).alias("y"))


def stacked_y(level: Column, half_way: float, lists: int) -> Column:
    """array of struct(up, down), the genes' own first, then one for each gene list: upwards up to the half-way genome,
    else downwards."""
    up, out = level.cast("double"), []
    for k in range(lists + 1):
        rise, high = (0.03, 0.01) if k == 0 else (0.12, 0.03)
        fall, low = (0.02, 0.01) if k == 0 else (0.12, 0.03)
        upper = up <= half_way
        down = F.when(upper, up + rise - high).otherwise(up - fall - low)
        up = F.when(upper, up + rise).otherwise(up - fall)
        out.append(F.struct(up.alias("up"), down.alias("down")))
    return F.array(*out)


def labels(contigs: DataFrame, replace: list[tuple[str, str]], reversed_contigs: DataFrame, least: int = MIN_LABEL) -> DataFrame:
    """genome, contig, label of contigs long enough: prefixes replaced, then - for reversed ones and + for others."""
    name = F.col("contig")
    for old, new in replace:
        name = F.regexp_replace(name, f"^{old}", new)
    marks = reversed_contigs.select("genome", "contig").distinct().withColumn("_r", F.lit(True))
    kept = contigs.filter(F.col("len") >= least).join(marks, ["genome", "contig"], "left")
    return kept.select("genome", "contig", F.concat(name, F.when(F.col("_r"), "-").otherwise("+")).alias("label"))


def colour(in_second: Column, in_third: Column) -> Column:
    return F.when(in_third, COLOURS[2]).when(in_second, COLOURS[1]).otherwise(COLOURS[0])


def flipped(rows: DataFrame, reversed_contigs: DataFrame) -> DataFrame:
    """rows with start and stop of each side mirrored on contigs (genome, contig, len) that are to be reversed."""
    r = reversed_contigs.select("genome", "contig", "len")
    both = rows.join(r.toDF("genome_a", "contig_a", "_la"), ["genome_a", "contig_a"], "left").join(r.toDF("genome_b", "contig_b", "_lb"), ["genome_b", "contig_b"], "left")
    for s in "ab":
        length, start, stop = F.col(f"_l{s}"), F.col(f"start_{s}"), F.col(f"stop_{s}")
        both = both.withColumn(f"_new_{s}", F.when(length.isNull(), start).otherwise(length - stop)).withColumn(f"stop_{s}", F.when(length.isNull(), stop).otherwise(length - start)).withColumn(f"start_{s}", F.col(f"_new_{s}")).drop(f"_new_{s}")
    return both.select(*rows.columns)


def adjacent_genomes(order: DataFrame) -> DataFrame:
    """genome, next_genome, drawn: the neighbour in order, the first behind the last, to which nothing is drawn."""
    line, every = Window.orderBy("idx"), Window.partitionBy()
    after = F.lead("genome").over(line)
    return order.select("genome", F.coalesce(after, F.min_by("genome", "idx").over(every)).alias("next_genome"), after.isNotNull().alias("drawn"))


def axis_ticks(longest: int, parts: int = 9) -> tuple[list[int], list[str], str]:
    """Places, labels and unit of the axis: equal parts, rounded to the leading decade of one part."""
    part = longest // parts
    decade = int(str(part)[0] + "0" * (len(str(part)) - 1)) if part else 1
    places = [int((int(longest / parts * i) + decade / 2) // decade * decade) for i in range(1, parts + 1)]
    zeros = str(decade).count("0")
    unit, cut_off = next((u, z) for u, z in (("Gb", 9), ("Mb", 6), ("Kb", 3), ("nt", 0)) if zeros >= z)
    return places, [str(p).replace("0" * cut_off, "", 1) if cut_off else str(p) for p in places], unit


def axis_tick_rows(lengths: DataFrame, parts: int = 9) -> DataFrame:
    """i, place: axis_ticks for the greatest total of lengths, as rows."""
    longest = lengths.agg(F.max("total").alias("n"))
    part = F.expr(f"n div {parts}")
    decade = F.substring(part.cast("string"), 1, 1).cast("long") * F.pow(F.lit(10), F.length(part.cast("string")) - 1).cast("long")
    each = longest.select("n", decade.alias("d"), F.explode(F.sequence(F.lit(1), F.lit(parts))).alias("i"))
    return each.select("i", (F.floor((F.floor(F.col("n") / parts * F.col("i")) + F.col("d") / 2) / F.col("d")) * F.col("d")).cast("long").alias("place"))


def figure_size(genomes: int) -> dict[str, float]:
    """Inches, top of the vertical axis and the half-way genome."""
    high = max(PX_HEIGHT, PX_EACH * genomes)
    return {"height": high / PX_PER_HIGH, "ymax": genomes - 0.8, "half_way": genomes / 2 - 1}
