"""Mixtures of sources at target weights by Pareto order sampling.

How often a document is expected in the mix is a level of its source times a weight of its own, two times at most. The
weight is the number of binary digits of its size: a text of a thousand words counts three times one of ten, since short
ones say little. The level makes the expected words of the source its target. The whole part of the expectation are
copies that are certain. The rest is the inclusion probability of one more copy: documents are ranked by the odds of a
random number of their own (a hash of the id) divided by the odds of inclusion, and the first ones are taken until the
source's remaining words are reached. The sample's size is thus fixed, to within half of one document, and documents are
in it with nearly their own probabilities.

The place where a ranking is cut is found by digits of the rank: words are summed by source and digit, the digit where
the sum passes the rest is chosen, and only rows with that digit go on to the next. No source is ever sorted or gathered.

Defined cases: null texts and texts of white space have no words; a null source is a source, the last one; rows of one
id share a rank and are told apart by a number of their own; a source without words has target zero; an empty table
gives an empty result; a long text is a document like others, at most half of one is the error of its source; other columns
stay as they are. Sources themselves are one row each, with one for each weight, and fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import SPACE, free_name, small, whole, written

WEIGHTS = (3, 1, 2)
SHARE, MOST_COPIES = 1.5, 2
SEED = "mix-1"
RANK_BITS, DIGIT_BITS = 52, 13
#: Expected copies this near to a whole number are that number.
ROUNDING = 1e-9
_WHITE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    trimmed = F.btrim(whole(text), F.lit(_WHITE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("bigint")


def random_bits(id_: Column) -> Column:
    """52 bits that depend on the id alone."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, RANK_BITS // 4), 16, 10).cast("bigint")


def rank_of(bits: Column, chance: Column) -> Column:
    """Pareto's rank, the quotient q of the odds, as a whole number that rises with it: q / (1 + q) in 52 bits."""
    u = (bits + 0.5) / float(1 << RANK_BITS)
    q = (u / (1 - u)) / (chance / (1 - chance))
    return F.floor(q / (1 + q) * float(1 << RANK_BITS)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes``: source, source_size. Adds target.

    Weights share the budget; a source stops at its cap. With the sources in the order of cap by weight, let the first
    ones be at their caps and the others share what is left: the level per weight rises with every source that is
    rightly counted as capped and falls after that, so the highest level is the right one.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    at = F.pmod(F.row_number().over(named) - 1, F.lit(len(WEIGHTS)))
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), at + 1))
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * MOST_COPIES)
    rows = rows.withColumn("line", F.col("cap") / F.col("weight"))
    order = Window.orderBy("line", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * SHARE
    left = budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    rows = rows.withColumn("level", F.max("level").over(everything))
    rows = rows.withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    return rows.select("source", "source_size", "target")


def expected(level: Column, weight: Column) -> Column:
    """Copies of a document of this weight that its source's level asks for. What is a whole number but for rounding is
    one."""
    times = F.least(F.lit(float(MOST_COPIES)), level * weight)
    return F.when(F.abs(times - F.round(times)) < ROUNDING, F.round(times)).otherwise(times)


def weight_of(size: Column) -> Column:
    return F.length(F.bin(size))


def levels(classes: DataFrame, sources: DataFrame) -> DataFrame:
    """``classes``: source, weight, words (of its documents of that weight). Adds to the sources the level, and rest: the
    words that are to be drawn beside the certain copies.

    With the weights of a source in falling order, let the first ones be at the most copies and the others share what is
    left of the target: as above, the highest level is the right one.
    """
    named = sources.withColumnRenamed("source", "of")
    rows = classes.where("words > 0").join(small(named), _same_source("source", "of")).drop("of")
    order = Window.partitionBy("source").orderBy(F.desc("weight"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("target") - MOST_COPIES * F.coalesce(F.sum("words").over(before), F.lit(0)).cast("double")
    rows = rows.withColumn("level", left / F.sum(F.col("words") * F.col("weight")).over(after).cast("double"))
    rows = rows.withColumn("level", F.max("level").over(Window.partitionBy("source")))
    certain = F.floor(expected(F.col("level"), F.col("weight"))) * F.col("words")
    rows = rows.groupBy(F.col("source").alias("of")).agg(F.max("level").alias("level"), F.sum(certain).alias("certain"))
    told = sources.join(rows, _same_source("source", "of"), "left").drop("of")
    rest = F.coalesce(F.col("target") - F.col("certain"), F.lit(0.0))
    rest = F.when(rest > ROUNDING * F.col("target"), rest).otherwise(0.0)
    return told.select("source", "source_size", "target", F.coalesce("level", F.lit(0.0)).alias("level"), rest.alias("rest"))


def _same_source(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _cut(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """``ranked``: source, rank, row, size, rest (of the source). Where each source's ranking is cut.

    Columns: source, shift (bits of the rank that are not looked at), cut (first rank, without these bits, that is not
    all taken), row_shift and row_cut (the same for rows of just that rank, null if there is no need), more (whether
    the row at the cut is taken).
    """
    state = sources.select("source", "rest").where("rest > 0").withColumns(
        {"cut": F.lit(0).cast("bigint"), "row_cut": F.lit(0).cast("bigint"), "below": F.lit(0).cast("bigint")}
    )
    rank_shift, row_shift = RANK_BITS, 63
    pending = ranked.select("source", "rank", "row", "size")
    while True:
        by_row = rank_shift == 0
        if by_row:
            row_shift = max(0, row_shift - DIGIT_BITS)
        else:
            rank_shift -= DIGIT_BITS
        column, shift, cut = ("row", row_shift, "row_cut") if by_row else ("rank", rank_shift, "cut")
        digit = F.shiftright(column, shift)
        sums = pending.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        bounds = state.select(F.col("source").alias("of"), "rest", "cut", "row_cut", "below")
        rows = sums.join(small(bounds), _same_source("source", "of"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit")) + F.col("below")
        rows = rows.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        first = F.min(F.struct("digit", "upto", "words", "n", "rest", "cut", "row_cut")).alias("f")
        rows = rows.groupBy("source").agg(first).select("source", "f.*")
        state = written(
            rows.withColumn(cut, F.col("digit")).select(
                "source", "rest", "cut", "row_cut", (F.col("upto") - F.col("words")).alias("below"), "words", "n"
            ),
            "cuts",
        )
        most = state.agg(F.max("n")).first()[0] or 0
        if most <= 1 or (by_row and row_shift == 0):
            break
        held = small(state.select(F.col("source").alias("of"), "cut", "row_cut"))
        here = F.shiftright("rank", rank_shift) == F.col("cut")
        if by_row:
            here &= F.shiftright("row", row_shift) == F.col("row_cut")
        pending = written(pending.join(held, _same_source("source", "of")).where(here).drop("of", "cut", "row_cut"), "cut-rows")
    nearer = F.col("below") + F.col("words") - F.col("rest") <= F.col("rest") - F.col("below")
    return state.select(
        "source", F.lit(rank_shift).alias("shift"), "cut", F.lit(row_shift if by_row else None).cast("int").alias("row_shift"),
        "row_cut", nearer.alias("more"),
    )


def decisions(rows: DataFrame) -> DataFrame:
    """``rows``: doc_id, source, size, row (a number of the row). Returns one row per source with all that a row needs
    to know how often it is taken. A source whose ranking is not cut (nothing or everything is taken) has a null cut."""
    classes = rows.groupBy("source", weight_of(F.col("size")).alias("weight")).agg(F.sum("size").alias("words"))
    classes = written(classes, "source-classes")
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = written(levels(classes, targets(sizes)), "targets")
    ranked = with_chance(rows, sources).where("chance > 0 AND size > 0 AND rest > 0")
    ranked = ranked.withColumn("rank", rank_of(random_bits(F.col("doc_id")), F.col("chance")))
    cuts = _cut(written(ranked.select("source", "rank", "row", "size"), "ranked"), sources)
    cuts = cuts.withColumnRenamed("source", "of")
    return written(sources.join(cuts, _same_source("source", "of"), "left").drop("of"), "decisions")


def with_chance(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows``: source, size. Adds what their source decided, whole (certain copies) and chance (of one more)."""
    named = sources.withColumnRenamed("source", "of")
    rows = rows.join(small(named), _same_source("source", "of"), "left").drop("of")
    times = expected(F.col("level"), weight_of(F.col("size")))
    return rows.withColumn("whole", F.floor(times)).withColumn("chance", times - F.floor(times))


def copies(doc_id: Column, row: Column) -> Column:
    """How often a row with its source's decision is taken."""
    rank = rank_of(random_bits(doc_id), F.col("chance"))
    at = F.call_function("shiftright", rank, F.col("shift"))
    row_at = F.call_function("shiftright", row, F.col("row_shift"))
    at_cut = F.when(F.col("row_shift").isNull(), F.col("more")).otherwise(
        (row_at < F.col("row_cut")) | ((row_at == F.col("row_cut")) & F.col("more"))
    )
    one_more = F.when((F.col("chance") <= 0) | (F.col("rest") <= 0), False).when(F.col("cut").isNull(), True)
    one_more = one_more.when(at < F.col("cut"), True).when(at == F.col("cut"), at_cut).otherwise(False)
    return F.coalesce(F.col("whole"), F.lit(0)) + one_more.cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "sized")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = sized(docs)
    rows = with_chance(rows, decisions(rows))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("doc_id"), F.col("row"))).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with.

    Whether a row is taken follows from its id and its source's decision. Only where rows of one id stand at a cut, row
    numbers decide, and the documents are written down with them first.
    """
    columns = list(docs.columns)
    decided = decisions(sized(docs))
    number = free_name(docs, "number")
    if decided.where("row_shift IS NOT NULL").isEmpty():
        numbered = docs.withColumn(number, F.lit(0).cast("bigint"))
    else:
        numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        rows = numbered.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.col(number).alias("row"))
        decided = decisions(rows)
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")
    size = n_words(F.col("text")).alias("size")
    rows = with_chance(numbered.select(row, "doc_id", "source", size, F.col(number).alias("row_number")), decided)
    times = copies(F.col("doc_id"), F.col("row_number"))
    rows = rows.select("doc", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return rows.select(*[F.col("doc")[c].alias(c) for c in columns])
