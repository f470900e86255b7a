"""Mixing sources to target weights by Pareto order sampling.

A source's target divided by its size is the number of copies expected of its
words. The whole part is certain for every document. The rest is drawn with
unequal probability: a document's inclusion probability p follows its ``favour``,
by which longer documents are likelier. The documents of lowest Pareto rank
``(u / (1 - u)) / (p / (1 - p))`` are included once more, as many as fit the words
that are left; u is uniform and comes from the document. The cut is found on the
rank, mapped to (0, 1): first the cell in which it lies among equal cells, then a
cell in that cell, then the row. No task sees more of a source than its cells and
the rows of the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.shared import fresh, stored, word_count

UNIT = 1 << 52
#: Right shifts that give the cells: 4096 of them, then 4096 in the one that holds the cut.
CELLS = (40, 28)


def draw(id_column: str, text_column: str) -> Column:
    """A document's u, as an integer below ``UNIT``: from its id and text, the same in each run."""
    name = F.concat_ws("|", F.col(id_column).cast("string"), F.col(text_column))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")


def favour(size: Column, documents: Column, source_size: Column) -> Column:
    """2 below the mean size of its source, 3 from the mean on, 4 from twice the mean on: whole
    numbers, whose sums do not depend on their order."""
    steps = F.least(F.lit(2), F.floor(size * documents / F.greatest(source_size, F.lit(1))))
    return F.lit(2) + steps.cast("long")


def inclusion(rest: Column, favoured: Column, weighted: Column) -> Column:
    """Probability of one more copy: in proportion to favour, so that ``rest`` words are expected.

    ``weighted`` is the sum of favour times size over the source.
    """
    return F.when(weighted > 0, F.least(F.lit(1.0), rest * favoured / weighted)).otherwise(0.0)


def pareto_rank(u: Column, p: Column) -> Column:
    """odds(u) / odds(p), mapped to (0, 1) by x / (1 + x), as an integer below ``UNIT``."""
    drawn = (u + F.lit(0.5)) / F.lit(float(UNIT))
    over, under = drawn * (F.lit(1.0) - p), (F.lit(1.0) - drawn) * p
    return F.least(F.floor(over / (over + under) * F.lit(float(UNIT))), F.lit(UNIT - 1)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0
) -> DataFrame:
    """(source, source_size, documents, target) from (source, size), one row per source.

    Sources by code point, null last, have ``weights`` in turn and share all
    words; none gets more than ``most`` times what it has, and what is over
    goes to the others by weight. Filled like vessels: at level L a source
    holds ``min(most * size, L * weight)``, and L is the greatest level that
    any set of full sources implies. The windows see one row per source.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turns = F.array(*(F.lit(float(w)) for w in weights))
    cap = F.col("source_size") * most
    full_first = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    every = full_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    onward = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) - full) / F.sum("weight").over(onward)
    return (
        by_source.withColumn("weight", F.get(turns, rank % len(weights)))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(every))
        .select("source", "source_size", "documents", F.least(cap, F.col("level") * F.col("weight")).alias("target"))
    )


def copies_by_source(rows: DataFrame, targets: DataFrame, most: float = 3.0) -> DataFrame:
    """What each source takes: its target with documents, weighted, rest, whole, cut and extra.

    A row (source, size, u) is taken ``whole`` times, and once more if its
    Pareto rank is at most ``cut`` or is ``extra``: the document behind the cut
    whose size comes closest to the words still missing, if it brings them nearer.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(ratio + 1e-9), F.lit(int(most)))
    cuts = (
        targets.withColumn("whole", whole)
        .withColumn(
            "rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))
        )
        .withColumns({"low": F.lit(0), "high": F.lit(UNIT), "below": F.lit(0)})
        .withColumns({c: F.col(c).cast("long") for c in ("low", "high", "below")})
    )
    # A table of known size, so that Spark broadcasts it if it is small, and else
    # can split a source that holds most rows.
    cuts = stored(cuts, "mix-targets")
    plan = cuts.select(F.col("source").alias("of"), "documents", "source_size", "rest")
    ranked = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    favoured = favour(F.col("size"), F.col("documents"), F.col("source_size"))
    weighted = ranked.groupBy("of").agg(F.sum(favoured * F.col("size")).alias("weighted"))
    cuts = stored(
        cuts.join(weighted, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mix-weights"
    )
    plan = cuts.select(F.col("source").alias("of"), "documents", "source_size", "rest", "weighted")
    ranked = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    p = inclusion(F.col("rest"), favoured, F.col("weighted"))
    rows = ranked.select("source", "size", pareto_rank(F.col("u"), p).alias("u"))
    in_order = Window.partitionBy("source").orderBy("u")
    through = in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def inside(cuts: DataFrame) -> DataFrame:
        limits = cuts.select(F.col("source").alias("of"), "rest", "low", "high", "below")
        match = F.col("source").eqNullSafe(F.col("of"))
        within = (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))
        return rows.join(limits, match & within)

    for shift in CELLS:
        cells = (
            inside(cuts)
            .groupBy("source", "rest", "below", F.shiftright("u", shift).alias("u"))
            .agg(F.sum("size").alias("size"))
            .withColumn("end", F.col("below") + F.sum("size").over(through))
            .where(F.col("end") > F.col("rest"))
            .groupBy(F.col("source").alias("of"))
            .agg(F.min_by(F.struct("u", (F.col("end") - F.col("size")).alias("end")), "u").alias("c"))
        )
        cuts = (
            cuts.join(cells, F.col("source").eqNullSafe(F.col("of")), "left")
            .withColumn("low", F.coalesce(F.shiftleft("c.u", shift), "high"))
            .withColumn("high", F.coalesce(F.shiftleft(F.col("c.u") + 1, shift), "high"))
            .withColumn("below", F.coalesce("c.end", "source_size"))
            .drop("of", "c")
        )
        cuts = stored(cuts, "mix-cells")
    last = (
        inside(cuts)
        .withColumn("end", F.col("below") + F.sum("size").over(through))
        .where(F.col("end") <= F.col("rest"))
        .groupBy(F.col("source").alias("of"))
        .agg(F.max("u").alias("cut"), F.max("end").alias("end"))
    )
    cuts = stored(
        cuts.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("cut", F.coalesce("cut", F.col("low") - 1))
        .withColumn("gap", F.col("rest") - F.coalesce("end", "below"))
        .select(
            "source", "source_size", "documents", "target", "rest", "weighted", "whole", "cut", "gap"
        ),
        "mix-cuts",
    )
    behind = cuts.select(F.col("source").alias("of"), "cut", "gap")
    miss = F.abs(F.col("size") - F.col("gap"))
    extra = (
        rows.join(behind, F.col("source").eqNullSafe(F.col("of")) & (F.col("u") > F.col("cut")))
        .where(miss < F.col("gap"))
        .groupBy("of")
        .agg(F.min(F.struct(miss, "u"))["u"].alias("extra"))
    )
    return cuts.join(extra, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "gap")


def copies(size: Column, u: Column, plan: Column) -> Column:
    favoured = favour(size, plan["documents"], plan["source_size"])
    rank = pareto_rank(u, inclusion(plan["rest"], favoured, plan["weighted"]))
    more = (rank <= plan["cut"]) | F.coalesce(rank == plan["extra"], F.lit(False))
    return plan["whole"] + more.cast("long")


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    id_column: str = "doc_id",
) -> DataFrame:
    """``documents`` with five more columns, underscored if taken: size, source_size, target,
    copies and taken (words, repeats counted); one row per row.

    Null texts have size 0, a null source is a source; sources without words
    have target 0. Repeated rows (same id and text) have the same u and are
    taken or left together. No rows: no rows. Texts do not move: what a source
    takes is a row per source, joined to the documents as they lie.
    """
    u, of, *added = fresh(
        documents, "u", "of", "size", "source_size", "target", "copies", "taken"
    )
    size, source_size, target, copies_column, taken = added
    source = F.col("source").cast("string")
    measures = {size: word_count(F.col("text")), u: draw(id_column, "text")}
    rows = documents.select(
        source.alias("source"), measures[size].alias("size"), measures[u].alias("u")
    )
    rows = stored(rows, "mix-sizes")
    found = copies_by_source(rows, source_targets(rows, weights, most), most)
    found = stored(found, "mix-sources").select(
        F.col("source").alias(of),
        F.struct(
            "source_size", "documents", "target", "rest", "weighted", "whole", "cut", "extra"
        ).alias(target),
    )
    plan = F.col(target)
    times = copies(F.col(size), F.col(u), plan)
    return (
        documents.withColumns(measures)
        .join(found, source.eqNullSafe(F.col(of)))
        .withColumn(copies_column, times)
        .select(
            *documents.columns,
            size,
            plan["source_size"].alias(source_size),
            plan["target"].alias(target),
            copies_column,
            (F.col(size) * F.col(copies_column)).alias(taken),
        )
    )
