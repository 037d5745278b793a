"""Quality rules whose cutoffs are chosen under a guaranteed limit of false rejections.

Measures of a text are plain column expressions. Cutoffs come from labelled documents that serve as holdout: within
each stratum every candidate cutoff of every rule is tested with the exact binomial distribution, and only a cutoff
whose rate of rejected good documents is below the limit with confidence may be used (Clopper and Pearson's upper bound
is below the limit exactly if the binomial probability of so few rejections is below the error). The error is divided
by the number of tests (Bonferroni) and the limit by the number of rules, so that all rules together stay below it.

Defined cases: null text has no words; a null stratum is a stratum of its own; a stratum with too few labels gets no
cutoff and keeps its documents; labels that are null are left out, and of contradicting labels of a document the worse
counts; repeated rows are judged each for itself; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import NOT_SPACE, free_name, let, small, whole, words, written

WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Good documents that all rules together may reject, the error of the guarantee, and how many per cent of the bad
#: documents a cutoff must reject more for one per cent of the good ones.
RISK, ERROR, PRICE = 0.04, 0.05, 5.0
#: Candidate cutoffs; a document above the chosen one is rejected.
GRID = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0),
    "duplicate_lines": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8),
    "repeated_words": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.45),
    "word_length": (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0),
}


def _repeated(w: Column) -> Column:
    """Words inside of a window of three words that the text has twice or more."""
    at = lambda i: [F.get(w, i + k) for k in range(WINDOW)]
    places = F.sequence(F.lit(0), F.size(w) - WINDOW)

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
        step = lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n")
        )
        return F.aggregate(p, start, step, lambda acc: acc["n"])

    def places_of_repeats(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["s"] == x["s"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    # Equal hashes only say that a repeat may exist; what is counted are equal words.
    by_words = F.sort_array(
        F.transform(places, lambda i: F.struct(F.xxhash64(*at(i)), F.concat_ws(" ", *at(i)).alias("s"), i.alias("i")))
    )
    hashes = F.transform(places, lambda i: F.xxhash64(*at(i)))
    slow = let(by_words, lambda s: let(places_of_repeats(s), covered))
    none = F.lit(0).cast("bigint")
    return F.when(F.size(w) < WINDOW, none).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(slow))
    )


def measures(text: Column) -> Column:
    """One struct: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    t = whole(text)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    by_lines = let(
        lines,
        lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")),
    )
    by_words = let(
        words(t),
        lambda w: F.struct(
            F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _repeated(w).alias("repeated")
        ),
    )
    symbols = F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))
    of = F.struct(by_words.alias("w"), by_lines.alias("l"), symbols.alias("symbols"))
    return let(
        of,
        lambda m: F.struct(
            m["w"]["n"].cast("bigint").alias("n_words"),
            m["w"]["chars"].cast("bigint").alias("word_chars"),
            m["symbols"].cast("bigint").alias("n_symbols"),
            m["l"]["n"].cast("bigint").alias("n_lines"),
            m["l"]["dup"].cast("bigint").alias("n_dup_lines"),
            m["w"]["repeated"].alias("n_repeat_words"),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])


def rule_values(m: Column) -> dict[str, Column]:
    """What each rule compares with its cutoff; null without words or lines."""
    per = lambda a, b: F.when(m[b] > 0, m[a] / m[b])
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "duplicate_lines": per("n_dup_lines", "n_lines"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(at most k of n), summed in logarithms; 1 where k is above the mean, which no test accepts anyway."""
    odds = math.log(p / (1 - p))
    start = F.struct((n * math.log1p(-p)).alias("log"), F.exp(n * math.log1p(-p)).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["log"] + F.log((n - i + 1).cast("double") / i) + odds
        return F.struct(term.alias("log"), (acc["sum"] + F.exp(term)).alias("sum"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(upto, start, step, lambda acc: acc["sum"]))


def choose_cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR, price: float = PRICE) -> DataFrame:
    """``holdout``: stratum, good (boolean), m (measures), without documents that fail the base rules.

    Returns one row per stratum that has a cutoff: stratum, cutoffs (map from rule to cutoff).
    """
    values = rule_values(F.col("m"))
    tests = [(rule, cutoff) for rule, grid in GRID.items() for cutoff in grid]
    hit = lambda good, rule, cutoff: F.count_if((F.col("good") == good) & (values[rule] > cutoff))
    rejected = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(cutoff).alias("cutoff"),
            hit(True, rule, cutoff).alias("good"),
            hit(False, rule, cutoff).alias("bad"),
        )
        for rule, cutoff in tests
    ]
    # Sums per task come first, so that a stratum with most of the rows is one row per task.
    counts = written(
        holdout.groupBy("stratum").agg(
            F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"), F.array(*rejected).alias("t")
        ),
        "quality-counts",
    )
    strata = counts.count()
    limit, level = risk / len(GRID), error / max(1, strata * len(tests))
    tail = binomial_tail(F.col("n_good"), F.col("t.good"), limit)
    gain = F.col("t.bad") / F.greatest(F.col("n_bad"), F.lit(1)) - price * F.col("t.good") / F.col("n_good")
    return (
        counts.select("stratum", "n_good", "n_bad", F.explode("t").alias("t"))
        .where((F.col("n_good") > 0) & (tail <= level))
        .select("stratum", "t.rule", "t.cutoff", gain.alias("gain"))
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )


def holdout_of(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``measured``: id, stratum, m; ``labels``: doc_id, quality (1: good)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rows = measured.where(~base_failed(F.col("m")))
    return rows.join(known, rows["id"] == known["doc_id"]).select("stratum", (F.col("q") == 1).alias("good"), "m")


def judged(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` (stratum, m, ...) with base_failed, rejected_by (first failing rule) and kept."""
    cutoffs = small(cutoffs.withColumnRenamed("stratum", "cut_stratum"))
    rows = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    above = [F.when(v > F.col("cutoffs")[rule], F.lit(rule)) for rule, v in rule_values(F.col("m")).items()]
    rows = rows.withColumn("base_failed", base_failed(F.col("m")))
    rows = rows.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(F.coalesce(*above)))
    return rows.withColumn("kept", F.col("rejected_by").isNull()).drop("cut_stratum", "cutoffs")


def score(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, rejected_by, kept. Texts are read once."""
    measured = written(
        docs.select(F.col("doc_id").alias("id"), F.col(stratum).alias("stratum"), measures(F.col("text")).alias("m")),
        "quality",
    )
    cutoffs = written(choose_cutoffs(holdout_of(measured, labels)), "quality-cutoffs")
    rows = judged(measured, cutoffs)
    return rows.select(F.col("id").alias("doc_id"), "m.*", "base_failed", "rejected_by", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they came with. Texts are measured twice rather than shuffled."""
    columns = list(docs.columns)
    seen = docs.select(F.col("doc_id").alias("id"), F.col(stratum).alias("stratum"), measures(F.col("text")).alias("m"))
    cutoffs = written(choose_cutoffs(holdout_of(written(seen, "quality"), labels)), "quality-cutoffs")
    row = free_name(docs, "row")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias(row),
        F.col(stratum).alias("stratum"),
        measures(F.col("text")).alias("m"),
    )
    return judged(packed, cutoffs).where("kept").select(*[F.col(row)[c].alias(c) for c in columns])
