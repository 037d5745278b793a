"""Archives: S6, S7. The archives are written from the customer table by many tasks, a bounded number of rows each."""

from __future__ import annotations

import bz2
import gzip
import io
import sys
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.load import run
from feedloom.plans.mapping import Mapping, TableId, TableSpec, XmlSpec
from feedloom.sinks.tables import ParquetTables, _hadoop_path, scratch_dir
from feedloom.sources.archives import ARCHIVE_GLOB, expand_archives, extract_archives, is_compressed_xml
from feedloom.sources.documents import decode_content, spread_tasks
from feedloom.sources.files import list_files
from feedloom.sources.xml import parse_column, read_records
from feedloom_queries.common import as_type, attribute, content, element, table, text_of

# Executors get these functions with the task and need no installation of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUSTOMERS = XmlSpec(("customers", "customer"), {"c_custkey": attribute("id"), "c_name": content("name")})
_FORMATS = (".zip", ".tar", ".tar.gz", ".tar.bz2", ".tgz", ".tbz2")


def _pack(suffix: str, members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    if suffix == ".zip":
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.mkdir("deep")
            for name, data in members.items():
                archive.writestr(name, data)
        return out.getvalue()
    mode = {".tar": "w", ".tar.gz": "w:gz", ".tgz": "w:gz"}.get(suffix, "w:bz2")
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def _write_archives(spark: SparkSession, sf_dir: str) -> str:
    """One archive per Arrow batch of customers with a member per market segment, plus decoys; some single files. Packing is
    slow and the table's file is small, so rows are spread first; a repeated task writes the same files again."""
    location = scratch_dir(spark, "archives")
    row = element("customer", element("name", text_of(F.col("c_name"))), attributes={"id": F.col("c_custkey")})
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", row.alias("xml"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        uri = location if "://" in location else "file://" + location.removeprefix("file:")
        system, base = fs.FileSystem.from_uri(uri)
        system.create_dir(base, recursive=True)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            documents = {
                segment: ("<customers>" + "".join(group["xml"]) + "</customers>").encode()
                for segment, group in batch.groupby("c_mktsegment")
            }
            single = documents.pop("FURNITURE", None)
            members = {f"deep/seg_{segment}_{number}.xml": data for segment, data in documents.items()}
            members |= {"deep/readme.txt": b"<customers/>", "hollow.xml": b"", "huge.xml": b" " * 5_000_000}
            name = f"{task:05d}-{number:05d}"
            suffix = _FORMATS[(task + number) % len(_FORMATS)]
            # Without compression=None Arrow would compress by the suffix once more.
            with system.open_output_stream(f"{base}/{name}{suffix}", compression=None) as out:
                out.write(_pack(suffix, members))
            if single:
                pack, ending = ((gzip.compress, "gz"), (bz2.compress, "bz2"))[(task + number) % 2]
                with system.open_output_stream(f"{base}/seg_FURNITURE_{name}.xml.{ending}", compression=None) as out:
                    out.write(pack(single))
            yield pd.DataFrame({"written": [len(members)]})

    # Small batches, so that every format occurs; the action runs all tasks.
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        rows.repartition(spread_tasks(spark)).mapInPandas(write, "written long").agg(F.sum("written")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    return location


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of all members below the size limit, parsed from the member contents."""
    members = expand_archives(spark, _write_archives(spark, sf_dir), max_member_bytes=4_000_000)
    documents = members.select(decode_content(F.col("content")).alias("doc"))
    return parse_column(documents, "doc", CUSTOMERS).select(as_type("c_custkey", "bigint"), "c_name")


def archive_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through extracted files, read by the record scan."""
    out = scratch_dir(spark, "extracted")
    manifest = extract_archives(spark, _write_archives(spark, sf_dir), out, max_member_bytes=4_000_000)
    manifest.write.parquet(scratch_dir(spark, "manifest"))
    return read_records(spark, out, CUSTOMERS, scan="record").select(as_type("c_custkey", "bigint"), "c_name")


def archive_mask_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask has to match the whole name: seg_BUILD matches nothing, and two segments are read."""
    masks = ["seg_BUILD", r"seg_(AUTOMOBILE|HOUSEHOLD)_\d+\.xml", r"eg_MACHINERY.*"]
    members = expand_archives(spark, _write_archives(spark, sf_dir), masks)
    documents = members.select(decode_content(F.col("content")).alias("doc"))
    return parse_column(documents, "doc", CUSTOMERS).select(as_type("c_custkey", "bigint"), "c_name")


_TABLE = TableId("customers")
_MAPPING = Mapping(
    XmlSpec(CUSTOMERS.root_path, {f"customers.{name}": value for name, value in CUSTOMERS.values.items()}, files=(r"seg_.*\.xml", r"huge\.xml")),
    {_TABLE: TableSpec(("c_custkey",))},
)
_TARGETS = {_TABLE: T.StructType([T.StructField("c_custkey", T.LongType(), False), T.StructField("c_name", T.StringType())])}


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run tells of archives that hold a member above the limit, and of one that is none."""
    base = _write_archives(spark, sf_dir)
    spark.range(1, numPartitions=1).select(F.lit("no archive").alias("value")).write.text(f"{base}/broken")
    system, source = _hadoop_path(spark, f"{base}/broken")
    part = next(s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-"))
    system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{base}/broken.zip"))
    store = ParquetTables(spark, scratch_dir(spark, "store"), _TARGETS)
    report = run(spark, base, [_MAPPING], store, _TARGETS, max_member_bytes=4_000_000)
    archives = list_files(spark, base, ARCHIVE_GLOB).where(~is_compressed_xml(F.col("file_name")))
    told = report.rejected.groupBy("source").agg(F.max("reason").alias("reason"))
    # All sides are single rows.
    files = report.files.agg(F.sum("processed").alias("records"), F.count_if("failed").alias("failed"))
    counted = archives.join(told, F.col("file_path") == F.col("source"), "left").agg(
        F.count_if(F.col("reason").startswith("archive:too_large:")).alias("with_large_member"),
        F.count_if(F.col("reason").startswith("archive:") & ~F.col("reason").contains("too_large")).alias("broken"),
        F.count("*").alias("archives"),
    )
    one = lambda frame: frame.withColumn("one", F.lit(1))
    rows = one(files).join(one(counted), "one").join(one(report.summary), "one").join(one(store.read(_TABLE).agg(F.count("*").alias("loaded"))), "one")
    return rows.select(
        "loaded",
        "records",
        "broken",
        (F.col("archives") - F.col("with_large_member") - F.col("broken")).alias("archives_not_told"),
        (F.col("files_failed") - F.col("archives")).alias("failed_beside_archives"),
        (F.col("files_found") - F.col("files_loaded") - F.col("files_failed")).alias("files_not_told"),
        "files_unrouted",
    )


QUERIES = {
    "run_report": run_report,
    "archive_members": archive_members,
    "archive_extract": archive_extract,
    "archive_mask_prune": archive_mask_prune,
}

ORACLES = {
    "run_report": """
        SELECT count(*) AS loaded, count(*) AS records, 1 AS broken, 0 AS archives_not_told, 0 AS failed_beside_archives,
               0 AS files_not_told, 0 AS files_unrouted FROM customer""",
    "archive_members": "SELECT c_custkey, c_name FROM customer",
    "archive_extract": "SELECT c_custkey, c_name FROM customer",
    "archive_mask_prune": """
        SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD')""",
}
