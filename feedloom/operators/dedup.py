"""One row per key. Winners are picked by aggregation, so that a hot key shrinks to one row per task before a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.text import name_column
from feedloom.plans.columns import REASON

SEQUENCE_CHUNK = 1 << 18


def mark_missing_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``missing_key:<column>`` as the reject reason of rows without a unique value."""
    checks = [F.col(REASON)] if REASON in rows.columns else []
    checks += [F.when(name_column(key).isNull(), F.lit(f"missing_key:{key}")) for key in keys]
    return rows.withColumn(REASON, F.coalesce(*checks)) if checks else rows.withColumn(REASON, F.lit(None).cast("string"))


def _winner(rows: DataFrame, keys: Sequence[str], order: Column, last: bool) -> DataFrame:
    others = [name for name in rows.columns if name not in keys]
    if not others:
        return rows.select(*map(name_column, keys)).distinct()
    pick = F.max_by if last else F.min_by
    won = rows.groupBy(*map(name_column, keys)).agg(pick(F.struct(*map(name_column, others)), order).alias("won"))
    unpacked = {name: F.col("won").getField(name) for name in others}
    return won.select(*[unpacked[n].alias(n) if n in unpacked else name_column(n) for n in rows.columns])


def dedup_first(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], keep: str = "first"
) -> DataFrame:
    """The first (or ``last``) row of each key in the given order. Without keys nothing is removed."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    if not keys:
        return rows
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    return _winner(rows, list(keys), order, keep == "last")


def number_rows(
    rows: DataFrame, source: str, position: Sequence[Column], name: str = "_sequence", chunk: int = SEQUENCE_CHUNK
) -> DataFrame:
    """Row number from 0 within each source, in the order of an integer position.

    A plain window over the source would put a large source into one task. Here positions are cut into ranges; only
    the row counts of the ranges are summed up per source, and rows are numbered within their range.
    ``position`` is (..., integer): leading parts select a range together with the cut last part.
    """
    ranges = [*position[:-1], F.floor(position[-1] / chunk)]
    range_names = [f"_range{i}" for i in range(len(ranges))]
    cut = rows.select("*", *[c.alias(n) for c, n in zip(ranges, range_names, strict=True)], position[-1].alias("_at"))
    group = [name_column(source), *map(F.col, range_names)]
    counts = cut.groupBy(*group).agg(F.count("*").alias("_n"))
    before = W.partitionBy(name_column(source)).orderBy(*range_names).rowsBetween(W.unboundedPreceding, -1)
    sums = F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    offsets = counts.select(*[name_column(n).alias(f"_in_{i}") for i, n in enumerate((source, *range_names))], sums)
    condition = F.lit(True)
    for i, name_ in enumerate((source, *range_names)):
        condition = condition & name_column(name_).eqNullSafe(F.col(f"_in_{i}"))
    joined = cut.join(offsets, condition).select(*map(name_column, cut.columns), "_before")
    within = W.partitionBy(*group).orderBy("_at")
    numbered = joined.withColumn(name, F.col("_before") + F.row_number().over(within) - 1)
    return numbered.drop("_before", "_at", *range_names)


def batch_winner(
    rows: DataFrame, keys: Sequence[str], source: str, position: Sequence[Column], batch_size: int
) -> DataFrame:
    """The row left after loading in batches: the latest source, in it the latest batch, in that the first row."""
    numbered = number_rows(rows, source, position)
    batch = F.floor(F.col("_sequence") / batch_size)
    order = F.struct(name_column(source), batch, -F.col("_sequence"))
    return _winner(numbered, list(keys), order, last=True).drop("_sequence")
