"""Load reports. Partial aggregation makes them safe for a source that holds most of the rows."""

from __future__ import annotations

from collections.abc import Mapping as MappingABC
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.validate import MALFORMED_DOCUMENT
from feedloom.plans.columns import REASON, SOURCE
from feedloom.plans.mapping import TableId


def file_counts(annotated: DataFrame) -> DataFrame:
    """Per source: records processed and skipped, and whether the document was read to its end."""
    valid, malformed = F.col(REASON).isNull(), F.coalesce(F.col(REASON) == MALFORMED_DOCUMENT, F.lit(False))
    return annotated.groupBy(F.col(SOURCE).alias("source")).agg(
        F.count_if(valid).alias("processed"),
        F.count_if(~valid & ~malformed).alias("skipped"),
        F.bool_or(malformed).alias("malformed"),
    )


def table_counts(rows: MappingABC[TableId, DataFrame], batch_sizes: MappingABC[TableId, int]) -> DataFrame:
    """Per source and table: rows before de-duplication and the batches they make."""
    parts = []
    for table, frame in rows.items():
        counted = frame.groupBy(F.col(SOURCE).alias("source")).agg(F.count("*").alias("rows"))
        batches = F.ceil(F.col("rows") / batch_sizes[table])
        parts.append(counted.select("source", F.lit(str(table)).alias("table_name"), batches.alias("batches"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def run_summary(files: DataFrame) -> DataFrame:
    """One row over a frame with a boolean ``failed`` per file: found, loaded and failed files."""
    return files.agg(
        F.count("*").alias("files_found"),
        F.count_if(~F.col("failed")).alias("files_loaded"),
        F.count_if(F.col("failed")).alias("files_failed"),
    )
