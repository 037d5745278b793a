"""Batch runs over a folder that grows: a ledger of loaded files, so that each file is opened once.

The ledger is a folder of batches. A batch is a table of files (path, size, time of change), named by the token of its
load. It is written as ``pending-<token>`` before anything is loaded and renamed to ``done-<token>`` after that. A file is
new unless a batch has it with its present size and time. A run that died leaves its batch pending: the next one repeats
just these files under the same token first, so tables that already have them skip them, and appends are not doubled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedloom.plans.load import LoadReport, run
from feedloom.plans.mapping import Mapping, TableId
from feedloom.sinks.tables import _hadoop_path
from feedloom.sources.archives import ARCHIVE_GLOB
from feedloom.sources.files import XML_GLOB, list_files

_FILES = "file_path string, file_name string, file_size bigint, modified timestamp"
_IDENTITY = ["file_path", "file_size", "modified"]


def escaped(path: str) -> str:
    """A path whose characters stand for themselves where a pattern may stand."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


class FileLedger:
    def __init__(self, spark: SparkSession, location: str) -> None:
        self.spark, self.location = spark, location.rstrip("/")

    def _batches(self, state: str) -> list[str]:
        """Tokens of the batches that were written as a whole."""
        system, path = _hadoop_path(self.spark, self.location)
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        whole = self.spark._jvm.org.apache.hadoop.fs.Path
        found = [n for n in names if n.startswith(f"{state}-") and system.exists(whole(f"{self.location}/{n}/_SUCCESS"))]
        return sorted(n.removeprefix(f"{state}-") for n in found)

    def files(self) -> DataFrame:
        """Files of all batches that are done."""
        done = [f"{self.location}/done-{token}" for token in self._batches("done")]
        return self.spark.read.schema(_FILES).parquet(*done) if done else self.spark.createDataFrame([], _FILES)

    def new(self, listed: DataFrame) -> DataFrame:
        return listed.join(self.files().select(*_IDENTITY), _IDENTITY, "left_anti")

    def pending(self) -> list[str]:
        return self._batches("pending")

    def begin(self, files: DataFrame) -> str:
        token = uuid.uuid4().hex
        files.select("file_path", "file_name", "file_size", "modified").write.parquet(f"{self.location}/pending-{token}")
        return token

    def batch(self, token: str) -> list[str]:
        """Names of a pending batch; they go to Spark's listing, which keeps all names of a scan on the driver anyway."""
        rows = self.spark.read.schema(_FILES).parquet(f"{self.location}/pending-{token}")
        return sorted(escaped(unquote(row[0])) for row in rows.select("file_path").collect())

    def end(self, token: str) -> None:
        system, path = _hadoop_path(self.spark, f"{self.location}/pending-{token}")
        if not system.rename(path, self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/done-{token}")):
            raise RuntimeError(f"batch {token} of {self.location} is loaded but could not be marked as done")


def run_new(
    spark: SparkSession,
    path: str | Sequence[str],
    mappings: str | list | Sequence[Mapping],
    store,
    targets: dict[TableId, T.StructType],
    ledger: str,
    *,
    archives: bool = True,
    **options,
) -> list[LoadReport]:
    """Load what is new or changed below ``path`` since the last such run with this ledger; other files are not opened.

    A report for each batch: those that an earlier run left pending, then the new files. Nothing new gives none. A file
    that was rejected in part is done; put it right and its time of change makes it new. A pending batch whose files
    are gone fails; delete its folder to give it up. Options are those of ``run``.
    """
    book, reports = FileLedger(spark, ledger), []

    def load(token: str) -> None:
        reports.append(run(spark, book.batch(token), mappings, store, targets, archives=archives, token=token, **options))
        book.end(token)

    for token in book.pending():
        load(token)
    glob = f"{{{XML_GLOB[1:-1]},{ARCHIVE_GLOB}}}" if archives else XML_GLOB
    fresh = book.new(list_files(spark, path, glob))
    if not fresh.isEmpty():
        load(book.begin(fresh))
    return reports
