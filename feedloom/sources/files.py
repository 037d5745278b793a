"""Finding files, choosing the mapping of each and taking values from file names. Nothing here opens a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.plans.mapping import Mapping, named_groups

XML_GLOB = "{*.[xX][mM][lL],*.[xX][mM][lL].gz,*.[xX][mM][lL].bz2}"


def list_files(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = XML_GLOB, wanted: Column | None = None
) -> DataFrame:
    """Non-empty files below ``path`` as (file_path, file_name, file_size, modified); contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path if isinstance(path, str) else list(path)).where(F.col("_metadata.file_size") > 0)
    return (files if wanted is None else files.where(wanted)).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def source_name(file_name: Column) -> Column:
    """The name patterns see: a compressed ``x.xml.gz`` is the file ``x.xml``."""
    return F.regexp_replace(file_name, r"(?i)(\.xml)\.(gz|bz2)$", "$1")


def mapping_index(name: Column, mappings: Sequence[Mapping]) -> Column:
    """Index of the first mapping with a pattern found somewhere in the name; NULL when there is none."""
    choice = F.lit(None).cast("int")
    for index, mapping in reversed(list(enumerate(mappings))):
        hit = F.lit(False)
        for pattern in mapping.xml.files:
            hit = hit | name.rlike(pattern)
        choice = F.when(hit, F.lit(index)).otherwise(choice)
    return choice


def route(files: DataFrame, mappings: Sequence[Mapping], name_column: str = "file_name") -> DataFrame:
    """Adds ``mapping_index``. Rows with NULL are the files no mapping wants."""
    return files.withColumn("mapping_index", mapping_index(source_name(F.col(name_column)), mappings))


def filename_value(name: Column, patterns: Sequence[str], group: str) -> Column:
    """The named group of the first pattern found in the name; NULL when that pattern lacks it or it took no part."""
    value = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        number = named_groups(pattern).get(group)
        found = F.lit(None).cast("string")
        if number is not None:
            found = F.nullif(F.regexp_extract(name, pattern, number), F.lit(""))
        value = F.when(name.rlike(pattern), found).otherwise(value)
    return value
