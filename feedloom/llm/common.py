"""Small helpers that several corpus operators use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sinks.tables import scratch_dir

#: White space between words, for Java's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Rows of a table that may be broadcast. Larger ones are joined by shuffling.
BROADCAST_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once. A lambda's variable is a value; a column may be inlined again."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, purpose: str, parts: int | None = None) -> DataFrame:
    """The rows as Parquet in the shared folder, read again: lineage ends there and executors may be lost."""
    spark = df.sparkSession
    location = scratch_dir(spark, purpose)
    (df if parts is None else df.coalesce(parts)).write.parquet(location)
    return spark.read.schema(df.schema).parquet(location)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A hint to broadcast, if the table was counted and is within the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
