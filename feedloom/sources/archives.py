"""Members of archives, read by many tasks.

An archive is listed first and its members are then spread over the cluster, so that one archive with most of the data
does not end in one task. Zip and plain tar members are read by seeking. A compressed tar can only be read from the
start: its members stay together, in order, and are streamed in one pass. Name masks and size limits are applied
between listing and reading; members they refuse are not read.
"""

from __future__ import annotations

import sys
import tarfile
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from itertools import chain

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sinks.tables import qualified
from feedloom.sources.documents import decompressor, local_uri, open_file, spread_tasks

# Executors get these functions with the task and need no installation of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_MAX_MEMBER_BYTES = 1024**3
CHUNK_BYTES = 1 << 20
ARCHIVE_GLOB = "*.{[zZ][iI][pP],[tT][aA][rR],[tT][gG][zZ],[tT][bB][zZ]2,[gG][zZ],[bB][zZ]2}"

# Suffix -> kind, longest first. The archive names that are understood.
_KINDS = {
    ".tar.bz2": "tar_compressed",
    ".tar.gz": "tar_compressed",
    ".tbz2": "tar_compressed",
    ".tgz": "tar_compressed",
    ".zip": "zip",
    ".tar": "tar",
    ".bz2": "single",
    ".gz": "single",
}

_LISTED = "archive_path string, kind string, member string, ordinal long, declared_size long, is_file boolean"
_MEMBERS = "archive_path string, member string, size long, content binary, error string"
_EXTRACTED = "archive_path string, member string, size long, extracted_path string, error string"


def archive_kind(path: Column) -> Column:
    kind = F.lit(None).cast("string")
    for suffix, name in reversed(_KINDS.items()):
        kind = F.when(F.lower(path).endswith(suffix), F.lit(name)).otherwise(kind)
    return kind


def is_compressed_xml(name: Column) -> Column:
    """``x.xml.gz`` and ``x.xml.bz2`` need no expansion: Spark's reader takes them as they are."""
    return name.rlike(r"(?i)\.xml\.(gz|bz2)$")


def _single_name(path: str) -> str:
    name = path.rpartition("/")[2]
    return name[: name.rindex(".")]


def _list_one(path: str, kind: str) -> Iterator[tuple]:
    with ExitStack() as stack:
        raw = open_file(path, stack)
        if kind == "zip":
            for i, info in enumerate(zipfile.ZipFile(raw).infolist()):
                yield path, kind, info.filename, i, info.file_size, not info.is_dir()
        elif kind == "single":
            yield path, kind, _single_name(path), 0, None, True
        else:
            stream = raw if kind == "tar" else stack.enter_context(decompressor(path, raw))
            with tarfile.open(fileobj=stream, mode="r:" if kind == "tar" else "r|") as tar:
                for i, info in enumerate(tar):
                    tar.members = []  # the listing of a huge archive is not kept in memory
                    yield path, kind, info.name, i, info.size, info.isreg()


def _list_archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["archive_path", "kind", "member", "ordinal", "declared_size", "is_file"]
    for batch in batches:
        for path, kind in zip(batch["archive_path"], batch["kind"], strict=True):
            rows = []
            try:
                for row in _list_one(path, kind):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            except (OSError, EOFError, ValueError, tarfile.TarError, zipfile.BadZipFile) as error:
                rows.append((path, f"error:{error}", None, -1, None, False))
            yield pd.DataFrame(rows, columns=names)


def list_members(spark: SparkSession, path: str | Sequence[str], compressed_xml: bool = True) -> DataFrame:
    """(archive_path, kind, member, ordinal, declared_size, is_file); an unreadable archive is one ``error:`` row."""
    archives = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path if isinstance(path, str) else list(path))
        .where(F.col("_metadata.file_size") > 0)
        .select(F.col("_metadata.file_path").alias("archive_path"), archive_kind(F.col("_metadata.file_name")).alias("kind"))
        .where(F.col("kind").isNotNull())
    )
    if not compressed_xml:
        archives = archives.where(~is_compressed_xml(F.col("archive_path")))
    # Listing reads whole compressed tars, so archives are spread first; only their paths move.
    return archives.repartition(spread_tasks(spark), "archive_path").mapInPandas(_list_archives, _LISTED)


def select_members(
    members: DataFrame, masks: Sequence[str] = (), max_member_bytes: int = DEFAULT_MAX_MEMBER_BYTES, xml_only: bool = False
) -> DataFrame:
    """The members to read. A mask has to match the whole base name; without masks ``.xml`` members are taken."""
    base = F.element_at(F.split("member", "/"), -1)
    is_xml = F.lower(base).endswith(".xml")
    wanted = F.lit(False) if masks else is_xml
    for mask in masks:
        wanted = wanted | base.rlike(f"^(?:{mask})$")
    if xml_only:
        wanted = wanted & is_xml
    size = F.col("declared_size")
    too_large = (size > max_member_bytes) & F.lit(max_member_bytes > 0)
    broken = F.col("kind").startswith("error:")
    chosen = members.where(broken | (F.col("is_file") & wanted & (size.isNull() | (size > 0))))
    # A member that is too large is not read, but it is told.
    error = F.concat(F.lit("error:too_large:"), size.cast("string"))
    return chosen.withColumn("kind", F.when(too_large & ~broken, error).otherwise(F.col("kind")))


def _spread(members: DataFrame) -> DataFrame:
    """Seekable members anywhere, the members of one compressed tar together and in order."""
    alone = F.when(F.col("kind") == "tar_compressed", F.lit("")).otherwise(F.col("member"))
    spread = members.repartition(spread_tasks(members.sparkSession), "archive_path", alone)
    return spread.sortWithinPartitions("archive_path", "ordinal")


def _chunks(stream, limit: int) -> Iterator[bytes]:
    """A member chunk by chunk, or an error once an undeclared size turns out to be over the limit."""
    total = 0
    while chunk := stream.read(CHUNK_BYTES):
        total += len(chunk)
        if 0 < limit < total:
            raise ValueError(f"member is larger than {limit} bytes")
        yield chunk


class _Reader:
    """Opens chosen members in (archive, ordinal) order, keeping one archive open."""

    def __init__(self) -> None:
        self.stack = ExitStack()
        self.path: str | None = None

    def _switch(self, path: str, kind: str) -> None:
        self.close()
        self.path = path
        raw = open_file(path, self.stack)
        if kind == "zip":
            self.archive = self.stack.enter_context(zipfile.ZipFile(raw))
        elif kind == "single":
            self.archive = self.stack.enter_context(decompressor(path, raw))
        else:
            stream = raw if kind == "tar" else self.stack.enter_context(decompressor(path, raw))
            self.archive = self.stack.enter_context(tarfile.open(fileobj=stream, mode="r:" if kind == "tar" else "r|"))
            self.entries = enumerate(self.archive)

    def open(self, path: str, kind: str, member: str, ordinal: int):
        if path != self.path:
            self._switch(path, kind)
        if kind == "zip":
            return self.archive.open(self.archive.infolist()[ordinal])
        if kind == "single":
            return self.archive
        for i, info in self.entries:
            self.archive.members = []
            if i == ordinal:
                return self.archive.extractfile(info)
        raise EOFError(f"{member} not found")

    def close(self) -> None:
        self.path = None
        self.stack.close()
        self.stack = ExitStack()


def _each_member(batches: Iterator[pd.DataFrame], take) -> Iterator[tuple]:
    """(archive, member, what ``take`` makes of the opened member, error); members without content are left out."""
    reader = _Reader()
    try:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.kind.startswith("error:"):
                    yield row.archive_path, row.member, None, row.kind.removeprefix("error:")
                    continue
                try:
                    taken = take(row, reader.open(row.archive_path, row.kind, row.member, row.ordinal))
                except (OSError, EOFError, ValueError, tarfile.TarError, zipfile.BadZipFile, RuntimeError) as error:
                    reader.close()
                    yield row.archive_path, row.member, None, f"{type(error).__name__}: {error}"
                else:
                    if taken:
                        yield row.archive_path, row.member, taken, None
    finally:
        reader.close()


def expand_archives(
    spark: SparkSession,
    path: str | Sequence[str],
    masks: Sequence[str] = (),
    max_member_bytes: int = DEFAULT_MAX_MEMBER_BYTES,
    xml_only: bool = False,
    on_error: str = "quarantine",
) -> DataFrame:
    """One row per member: (archive_path, member, size, content, error). ``max_member_bytes`` <= 0 means no limit.

    A member above the limit is an error; one that is declared so is not read. With ``fail`` an error ends the job, else
    it is a row without content.
    """
    chosen = _spread(select_members(list_members(spark, path), masks, max_member_bytes, xml_only))

    def take(row, stream) -> bytes:
        return b"".join(_chunks(stream, max_member_bytes))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive, member, content, error in _each_member(batches, take):
            if error and on_error == "fail":
                raise OSError(f"{archive}: {member}: {error}")
            size = None if content is None else len(content)
            # One member per frame, so that memory holds one member at a time.
            yield pd.DataFrame(
                {"archive_path": [archive], "member": [member], "size": [size], "content": [content], "error": [error]}
            )

    return chosen.mapInPandas(read, _MEMBERS)


def extract_archives(
    spark: SparkSession,
    path: str | Sequence[str],
    out_dir: str,
    masks: Sequence[str] = (),
    max_member_bytes: int = DEFAULT_MAX_MEMBER_BYTES,
    xml_only: bool = False,
    on_error: str = "quarantine",
    compressed_xml: bool = True,
) -> DataFrame:
    """Writes members as files below ``out_dir``, a folder all executors share, for scans that stream large files.

    Returns (archive_path, member, size, extracted_path, error). A file appears under its name only when complete, and
    a repeated task writes the same file again, so lost executors do no harm. Member paths never leave ``out_dir``.
    """
    listed = list_members(spark, path, compressed_xml)
    chosen = _spread(select_members(listed, masks, max_member_bytes, xml_only))

    # Without a scheme a path means one place to Spark and another one to a task.
    place = qualified(spark, out_dir)

    def take(row, stream) -> tuple[str, int] | None:
        return _write_member(place, row.archive_path, row.member, _chunks(stream, max_member_bytes))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive, member, taken, error in _each_member(batches, take):
            if error and on_error == "fail":
                raise OSError(f"{archive}: {member}: {error}")
            inner, size = taken or (None, None)
            target = None if inner is None else f"{out_dir.rstrip('/')}/{inner}"
            yield pd.DataFrame(
                {"archive_path": [archive], "member": [member], "size": [size], "extracted_path": [target], "error": [error]}
            )

    return chosen.mapInPandas(write, _EXTRACTED)


def _write_member(place: str, archive: str, member: str, chunks: Iterator[bytes]) -> tuple[str, int] | None:
    """Writes a member below ``place``; (path there, size), or nothing for a member without content."""
    import hashlib
    import uuid

    from pyarrow import fs

    # Archives of one name in different folders, and members of one name in different folders, must not collide. Members
    # of one folder share one, because listing takes time for each folder.
    name = member.replace("\\", "/").rpartition("/")[2]
    inside = member[: len(member) - len(name)]
    folder = hashlib.sha256(f"{archive}\0{inside}".encode()).hexdigest()[:32]
    uri = local_uri(place)
    if uri.startswith("file:"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    system, base = fs.FileSystem.from_uri(uri)
    directory = f"{base.rstrip('/')}/{folder}"
    unfinished = f"{directory}/_{uuid.uuid4().hex}"
    size = 0
    first = next(chunks, None)
    if first is None:
        return None
    system.create_dir(directory, recursive=True)
    try:
        with system.open_output_stream(unfinished, compression=None) as out:
            for chunk in chain([first], chunks):
                out.write(chunk)
                size += len(chunk)
    except BaseException:
        system.delete_file(unfinished)
        raise
    system.move(unfinished, f"{directory}/{name}")
    return f"{folder}/{name}", size
