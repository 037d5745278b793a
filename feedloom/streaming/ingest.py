"""Continuous ingestion: new files are picked up once each and upserted batch by batch."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans.ledger import escaped
from feedloom.plans.load import run
from feedloom.plans.mapping import Mapping, TableId
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.archives import ARCHIVE_GLOB, archive_kind, is_compressed_xml
from feedloom.sources.files import XML_GLOB, mapping_index, source_name

CLEAN_UP = ("off", "delete", "archive")
#: Files of a batch, unless told otherwise; their names are on the driver while the batch is loaded.
MAX_FILES = 10_000


def source_options(clean_up: str = "off", archive_dir: str | None = None, max_files: int | None = None) -> dict[str, str]:
    """File stream options. Files are cleaned up by Spark after the batch that read them is committed."""
    if clean_up not in CLEAN_UP:
        raise ValueError(f"clean_up must be one of {CLEAN_UP}, got {clean_up!r}")
    if (clean_up == "archive") != (archive_dir is not None):
        raise ValueError("archive_dir belongs to clean_up='archive'")
    options = {"cleanSource": clean_up}
    if archive_dir:
        options["sourceArchiveDir"] = archive_dir
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    return options


def run_stream(
    spark: SparkSession,
    path: str,
    mappings: Mapping | Sequence[Mapping],
    store,
    targets: dict[TableId, T.StructType],
    checkpoint: str,
    *,
    scan: str = "auto",
    on_error: str = "quarantine",
    winner: str = "batch",
    archives: bool = True,
    clean_up: str = "off",
    archive_dir: str | None = None,
    max_files: int | None = MAX_FILES,
    available_now: bool = True,
    work_dir: str | None = None,
) -> StreamingQuery:
    """Start loading. The stream is of file names; each batch of them is a whole ``run``, with all its mappings,
    archives, encodings and reports, so a bad file is quarantined and the others are loaded.

    Batches are numbered by the checkpoint. A batch that is repeated after a failure is skipped for the tables that
    already have it, so that appends are not doubled, and writes the same report again: below ``work_dir`` there are
    ``rejected``, ``files`` and ``tables``, each with one folder per batch.
    """
    mappings = [mappings] if isinstance(mappings, Mapping) else list(mappings)
    work_dir = work_dir or scratch_dir(spark, "stream")
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{{{XML_GLOB[1:-1]},{ARCHIVE_GLOB}}}" if archives else XML_GLOB)
        .options(**source_options(clean_up, archive_dir, max_files))
        .load(path)
        .select("path", F.col("_metadata.file_name").alias("name"))  # contents are not read here
    )
    archive = archive_kind(F.col("name")).isNotNull() & ~is_compressed_xml(F.col("name"))
    names = names.where(archive | mapping_index(source_name(F.col("name")), mappings).isNotNull())
    # Batch numbers are unique within one checkpoint only.
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [escaped(row.path) for row in batch.select("path").collect()]  # names of new files, as Spark lists them
        if not files:
            return
        # A repeated batch must not meet the files of its first attempt.
        folder = f"{work_dir}/batch{batch_id}-{uuid.uuid4().hex}"
        report = run(
            batch.sparkSession, files, mappings, store, targets, scan=scan, on_error=on_error, winner=winner,
            archives=archives, work_dir=folder, token=f"{stream_id}-{batch_id}",
        )
        for name, frame in (("rejected", report.rejected), ("files", report.files), ("tables", report.tables)):
            frame.write.mode("overwrite").parquet(f"{work_dir}/{name}/batch={batch_id}")
        report.clean()

    writer = names.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

