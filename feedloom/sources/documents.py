"""Opening and decoding files in tasks, for what Spark's readers do not do."""

from __future__ import annotations

import bz2
import codecs
import gzip
import re
import sys
from contextlib import ExitStack
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Executors get these functions with the task and need no installation of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Byte order marks and the encodings they stand for, longest first.
_MARKS = (
    (b"\x00\x00\xfe\xff", "utf-32-be"),
    (b"\xff\xfe\x00\x00", "utf-32-le"),
    (b"\xef\xbb\xbf", "utf-8"),
    (b"\xfe\xff", "utf-16-be"),
    (b"\xff\xfe", "utf-16-le"),
)
# Schemes of Hadoop's connectors, and what Arrow or the local mount calls them.
_SCHEMES = {
    "s3a://": "s3://",
    "s3n://": "s3://",
    "wasbs://": "abfss://",
    "wasb://": "abfs://",
    "dbfs:/": "file:///dbfs/",
}
_DECLARED = re.compile(rb"""<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""")
_DECLARATION_BYTES = 1024


def spread_tasks(spark: SparkSession) -> int:
    """Tasks for rows that are only names, while the work behind them is large. The number is always given to
    ``repartition``: without one adaptive execution would see tiny partitions and put them all into one task."""
    return 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def open_file(path: str, stack: ExitStack):
    """Open for seeking reads: a local path by Python, any other scheme by Arrow's file systems.

    Paths are percent-encoded URIs, as in Spark's ``_metadata.file_path``.
    """
    path = local_uri(unquote(path))
    if path.startswith("file:"):
        return stack.enter_context(open("/" + path.removeprefix("file:").lstrip("/"), "rb"))
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return stack.enter_context(system.open_input_file(inner))


def local_uri(uri: str) -> str:
    """Spark's name for a place in the words that Python's readers know."""
    for scheme, known in _SCHEMES.items():
        if uri.startswith(scheme):
            return known + uri.removeprefix(scheme).lstrip("/")
    return uri


def decompressor(path: str, raw):
    return bz2.open(raw) if path.lower().endswith("bz2") else gzip.open(raw)


def encoding_of(beginning: bytes, encoding: str | None = None) -> tuple[str, int]:
    """(name of the encoding, length of the byte order mark): the given one, else by mark, declaration, or UTF-8."""
    found, length = None, 0
    for mark, marked in _MARKS:
        if beginning.startswith(mark):
            found, length = marked, len(mark)
            break
    if found is None and (declared := _DECLARED.search(beginning[:_DECLARATION_BYTES])):
        found = declared.group(1).decode("ascii")
    for name in (encoding, found, "utf-8"):
        if name:
            try:
                return codecs.lookup(name).name, length
            except LookupError:
                continue
    return "utf-8", length


def decode_content(content: Column, encoding: str | None = None) -> Column:
    """Whole contents as text; wrong bytes are replaced."""

    def text(data: bytes | None) -> str | None:
        if data is None:
            return None
        name, mark = encoding_of(data, encoding)
        return data[mark:].decode(name, errors="replace")

    @F.pandas_udf("string")
    def decode(contents: pd.Series) -> pd.Series:
        return contents.map(text)

    return decode(content)
