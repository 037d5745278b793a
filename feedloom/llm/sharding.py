"""Shards by extendible hashing: a directory over hash prefixes, in which only buckets that are too large split.

A row's hash is made from its id and text. A bucket is a prefix of the hash; its depth is the number of bits. Bytes are
summed for the prefixes of one depth, deep enough that buckets there are a small part of the limit on average, and from
these sums for all shorter prefixes: a shard is the shortest prefix that fits. What is still too large at that depth
goes on with more bits, for the rows concerned alone. The directory has an entry for each prefix of a depth, which
names the shard, so a row finds its shard by one equality.

Rows that nothing tells apart have one hash and can't be split by bits. If they are too large together they fill
overflow pages one after the other. A single row above the limit has a shard of its own.

Defined cases: null texts have no bytes, a null id counts as an empty one; rows of one id and different texts may go to
different shards; with no rows there are no shards; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, small, whole, written

LIMIT = 64 * 1024 * 1024
#: Of the registered query: buckets split at every size of the tables, to several depths.
QUERY_LIMIT = 256 * 1024
HASH_BITS = 60
#: Buckets per expected shard at the first depth, and bits by which buckets that are too large go on, as powers of two.
FINER = 4
#: Directory entries that may be broadcast; some 40 MB at most.
ENTRIES = 1 << 20


def row_hash() -> Column:
    """The first 60 bits of MD5 over id and text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), whole("text"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def row_bytes() -> Column:
    return F.octet_length(whole("text")).cast("bigint")


def _prefix(hash_: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", hash_, F.lit(HASH_BITS) - depth)


@dataclass
class Directory:
    """``levels``: per depth a table of entry, depth, prefix, shard_bytes, shard_rows; an entry leads to one shard."""

    levels: list[tuple[int, DataFrame]]
    limit: int
    crowded: bool  # whether a shard has more than fits, in rows of one hash

    def route(self, rows: DataFrame, hash_: str) -> DataFrame:
        """``rows`` with depth, prefix, shard_bytes and shard_rows of their shard."""
        found = ("depth", "prefix", "shard_bytes", "shard_rows")
        for n, (depth, table) in enumerate(self.levels):
            entries = small(table.select(F.col("entry").alias(f"entry{n}"), *[F.col(c).alias(f"{c}{n}") for c in found]), ENTRIES)
            rows = rows.join(entries, _prefix(F.col(hash_), depth) == F.col(f"entry{n}"), "left").drop(f"entry{n}")
        for c in found:
            rows = rows.withColumn(c, F.coalesce(*[f"{c}{n}" for n in range(len(self.levels))]))
        return rows.drop(*[f"{c}{n}" for c in found for n in range(len(self.levels))])


def shard_name(depth: Column, prefix: Column) -> Column:
    """The prefix in bits; the shard of all rows is called ``all``."""
    return F.when(depth == 0, F.lit("all")).otherwise(F.lpad(F.conv(prefix.cast("string"), 10, 2), depth, F.lit("0")))


def directory(hashed: DataFrame, limit: int = LIMIT) -> Directory:
    """``hashed``: hash, bytes. Every table here is of buckets, but for one pass over ``hashed`` per level."""
    total = hashed.agg(F.sum("bytes")).first()[0] or 0
    depth = min(HASH_BITS, max(0, -(-total // limit) - 1).bit_length() + FINER)
    above, pending, levels = 0, hashed, []  # shards have a depth above ``above`` - 1
    while True:
        leaves = pending.groupBy(_prefix(F.col("hash"), depth).alias("leaf"))
        leaves = written(leaves.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "leaves")
        every = leaves.select(F.explode(F.sequence(F.lit(above), F.lit(depth))).alias("depth"), "leaf", "bytes", "n")
        prefix = F.call_function("shiftright", F.col("leaf"), F.lit(depth) - F.col("depth"))
        buckets = every.groupBy("depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        fits = (F.col("bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == HASH_BITS)
        buckets = written(buckets.withColumn("fits", fits), "buckets")
        full = buckets.where(~F.col("fits"))
        parents = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        shards = buckets.where("fits").withColumn("parent", F.call_function("shiftright", F.col("prefix"), F.lit(1)))
        if above:
            top = shards.where(F.col("depth") == above)
            shards = top.unionByName(shards.where(F.col("depth") > above).join(parents, ["depth", "parent"], "left_semi"))
        else:
            top = shards.where("depth = 0")
            shards = top.unionByName(shards.where("depth > 0").join(parents, ["depth", "parent"], "left_semi"))
        wide = F.lit(depth) - F.col("depth")
        first = F.call_function("shiftleft", F.col("prefix"), wide)
        last = F.call_function("shiftleft", F.col("prefix") + 1, wide) - 1
        entries = shards.select(
            F.explode(F.sequence(first, last)).alias("entry"), "depth", "prefix",
            F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"),
        )
        levels.append((depth, written(entries, "directory")))
        rest = full.where(F.col("depth") == depth).select(F.col("prefix").alias("leaf"))
        if rest.isEmpty():
            over = entries.where(_crowded(limit)) if depth == HASH_BITS else None
            return Directory(levels, limit, over is not None and not over.isEmpty())
        pending = written(pending.join(rest, _prefix(F.col("hash"), depth) == rest["leaf"], "left_semi"), "pending")
        above, depth = depth + 1, min(HASH_BITS, depth + 2 * FINER)


def _crowded(limit: int) -> Column:
    return (F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)


def _paged(rows: DataFrame, found: Directory) -> DataFrame:
    """Overflow pages of shards whose rows share one hash. Rows are numbered in their task; tasks are counted for offsets."""
    limit = found.limit
    if not found.crowded:
        return rows.withColumn("page", F.lit(0).cast("bigint"))
    plain = rows.where(~_crowded(limit)).withColumn("page", F.lit(0).cast("bigint"))
    # Places are written, so that counts and numbers are of the same tasks.
    crowded = written(rows.where(_crowded(limit)).withColumn("place", F.monotonically_increasing_id()), "crowded")
    crowded = crowded.withColumn("task", F.shiftright("place", 33))
    tasks = Window.partitionBy("prefix").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counted = crowded.groupBy("prefix", "task").agg(F.count("*").alias("copies"))
    offsets = counted.select("prefix", "task", F.coalesce(F.sum("copies").over(tasks), F.lit(0)).alias("before"))
    at = F.row_number().over(Window.partitionBy("prefix", "task").orderBy("place"))
    dealt = crowded.withColumn("at", at).join(offsets, ["prefix", "task"])
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) * F.col("shard_rows") / F.col("shard_bytes")))
    dealt = dealt.withColumn("page", F.floor((F.col("before") + F.col("at") - 1) / room))
    return plain.unionByName(dealt.drop("task", "place", "at", "before"))


def shard(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard, depth, page."""
    hashed = written(docs.select("doc_id", row_hash().alias("hash"), row_bytes().alias("bytes")), "hashed")
    found = directory(hashed, limit)
    rows = _paged(found.route(hashed, "hash"), found)
    name = shard_name(F.col("depth"), F.col("prefix"))
    return rows.select("doc_id", F.col("bytes").alias("n_bytes"), name.alias("shard"), F.col("depth").cast("int"), "page")


def with_shard(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The documents with the columns they came with, and shard (name and overflow page)."""
    columns = list(docs.columns)
    hashed = docs.select(row_hash().alias("hash"), row_bytes().alias("bytes"))
    row, name = free_name(docs, "row"), free_name(docs, "shard")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(row), row_hash().alias("hash"))
    found = directory(written(hashed, "hashed"), limit)
    rows = _paged(found.route(packed, "hash"), found)
    label = F.concat_ws("-", shard_name(F.col("depth"), F.col("prefix")), F.col("page"))
    return rows.select(*[F.col(row)[c].alias(c) for c in columns], label.alias(name))


def write(sharded: DataFrame, location: str, column: str = "shard") -> None:
    """One folder per shard. A task writes whole shards, each of which is within the limit."""
    sharded.repartition(column).write.partitionBy(column).parquet(location)
