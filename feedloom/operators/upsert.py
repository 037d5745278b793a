"""Target + new rows -> new target. Sources are unique per key (see ``dedup``); nothing here writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import default_value
from feedloom.functions.text import name_column

# Size on disk up to which a written source may be sent to all executors, and its size as rows, which is counted then:
# repeated values take next to nothing on disk.
BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_ROW_BYTES = 128 * 1024 * 1024


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    schema: T.StructType | None = None,
    source_bytes: int | None = None,
) -> DataFrame:
    """Insert new keys, overwrite known ones.

    Source columns outside the keys overwrite, also with NULL. Target columns that the source lacks keep their old
    value, and new rows get their literal default from ``schema``. Without keys all rows are appended; when the source
    holds key columns only, known keys stay untouched. ``source_bytes`` is the measured size of a written source: one
    that is small on disk and as rows is broadcast, and the target is then not shuffled at all.
    """
    schema = schema or target.schema
    names = {name.lower(): name for name in source.columns}
    if not keys:
        return target.unionByName(_new_rows(source, target, schema, names))
    key_set = {key.lower() for key in keys}
    updated = [name for name in names if name not in key_set]
    small = source_bytes is not None and source_bytes <= BROADCAST_BYTES and row_bytes(source) <= BROADCAST_ROW_BYTES
    if not updated:
        return target.unionByName(_new_rows(_unknown(source, target, keys, small), target, schema, names))
    marked = source.select(*[name_column(n).alias(f"_new_{n.lower()}") for n in source.columns], F.lit(True).alias("_hit"))
    if small:
        merged = _merge(target, F.broadcast(marked), keys, key_set, schema, names, "left")
        return merged.unionByName(_new_rows(_unknown(source, target, keys, True), target, schema, names))
    return _merge(target, marked, keys, key_set, schema, names, "full_outer")


def row_bytes(df: DataFrame) -> int:
    """The size of all rows in Spark's memory, by one sum: a word for each column and what texts, bytes and nested
    values hold."""
    size = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for field in df.schema.fields:
        column = name_column(field.name)
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType | T.VariantType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            size = size + F.lit(16 if isinstance(field.dataType, T.DecimalType) else 0)
    return df.agg(F.sum(size)).first()[0] or 0


def _on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str):
    condition = F.lit(True)
    for key in keys:
        condition = condition & (left[f"`{key}`"] == right[f"`{prefix}{key.lower() if prefix else key}`"])
    return condition


def _merge(target, marked, keys, key_set, schema, names, how) -> DataFrame:
    by_name = {field.name: field for field in schema.fields}
    old = target.withColumn("_known", F.lit(True))
    # Rows with a NULL key never match, and all hash alike: a salt spreads them. Keys declared NOT NULL need none, and
    # a source that is already partitioned by the keys is then not shuffled again.
    declared = {field.name.lower(): field.nullable for field in schema.fields}
    nullable = [name_column(key).isNull() for key in keys if declared.get(key.lower(), True)]
    if how == "full_outer" and nullable:
        no_key = nullable[0]
        for condition in nullable[1:]:
            no_key = no_key | condition
        spread = F.pmod(F.xxhash64(*map(name_column, target.columns)), F.lit(1024)) + 1
        old = old.withColumn("_salt", F.when(no_key, spread).otherwise(F.lit(0)).cast("long"))
        marked = marked.withColumn("_new_salt", F.lit(0).cast("long"))
        joined = old.join(marked, _on_keys(old, marked, keys, "_new_") & (old["_salt"] == marked["_new_salt"]), how)
    else:
        joined = old.join(marked, _on_keys(old, marked, keys, "_new_"), how)
    columns = []
    for name in target.columns:
        new = F.col(f"`_new_{name.lower()}`")
        if name.lower() in key_set:
            column = F.coalesce(name_column(name), new)
        elif name.lower() in names:
            column = F.when(F.col("_hit"), new).otherwise(name_column(name))
        else:
            field = by_name.get(name, target.schema[name])
            column = F.when(F.col("_known"), name_column(name)).otherwise(default_value(field))
        columns.append(column.alias(name))
    return joined.select(*columns)


def _unknown(source: DataFrame, target: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Source rows whose key the target does not have; reads the key columns of the target only."""
    known = target.select(*[name_column(key).alias(f"_known_{key.lower()}") for key in keys])
    if small:
        # First cut the target keys down to those in question, so that the second join is as small as the source.
        asked = source.select(*[name_column(key).alias(f"_asked_{key.lower()}") for key in keys])
        match = F.lit(True)
        for key in keys:
            match = match & (known[f"`_known_{key.lower()}`"] == asked[f"`_asked_{key.lower()}`"])
        known = known.join(F.broadcast(asked), match, "left_semi")
    condition = F.lit(True)
    for key in keys:
        condition = condition & (source[f"`{key}`"] == known[f"`_known_{key.lower()}`"])
    return source.join(known, condition, "left_anti")


def _new_rows(source: DataFrame, target: DataFrame, schema: T.StructType, names: dict[str, str]) -> DataFrame:
    by_name = {field.name: field for field in schema.fields}
    columns = []
    for name in target.columns:
        if name.lower() in names:
            column = name_column(names[name.lower()])
        else:
            column = default_value(by_name.get(name, target.schema[name]))
        columns.append(column.alias(name))
    return source.select(*columns)
