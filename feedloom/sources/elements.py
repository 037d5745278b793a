"""Elements at one exact path, streamed out of files of any size and layout.

For files that cannot be cut into pieces: another encoding, records inside of other elements, wrong bytes, an error in
the middle. A task reads a file chunk by chunk and holds one record at a time; Spark parses the records' markup.
"""

from __future__ import annotations

import codecs
import sys
from collections.abc import Iterator
from contextlib import ExitStack
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from feedloom.sources.documents import decompressor, encoding_of, open_file, spread_tasks

# Executors get these functions with the task and need no installation of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 20
# The declaration and the byte order mark are in these.
HEAD_BYTES = 1024
# Rows of a frame that a task hands over; a long record makes a frame of its own.
_FRAME_ROWS, _FRAME_CHARS = 1_000, 1 << 20
_ELEMENTS = "file_path string, file_name string, number bigint, markup string, error string"


class ElementReader:
    """Takes text in chunks and gives the markup of the elements at exactly ``path``, without prefixes in names."""

    def __init__(self, path: tuple[str, ...]) -> None:
        self.path, self.other_root = list(path), False
        self.found: list[str] = []
        self.names: list[str] = []
        self.pieces: list[str] = []
        self.matched = 0  # leading names that are on the path
        parser = expat.ParserCreate(encoding="utf-8")
        parser.StartElementHandler, parser.EndElementHandler = self._start, self._end
        parser.CharacterDataHandler, parser.CommentHandler = self._text, self._comment
        self.parser = parser

    def feed(self, text: str, last: bool = False) -> list[str]:
        """Elements that the text completes. An error is raised by the next call, after what came before it."""
        self.parser.Parse(text.encode("utf-8"), last)
        return self.taken()

    def taken(self) -> list[str]:
        found, self.found = self.found, []
        return found

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        local = name.rpartition(":")[2]
        depth = len(self.names)
        if self.matched == depth < len(self.path) and local == self.path[depth]:
            self.matched += 1
        elif depth == 0:
            self.other_root = True
        self.names.append(local)
        if self.matched == len(self.path):
            rendered = {k.rpartition(":")[2]: v for k, v in attributes.items()}
            self.pieces.append("<" + local + "".join(f" {k}={quoteattr(v)}" for k, v in rendered.items()) + ">")

    def _text(self, text: str) -> None:
        if self.matched == len(self.path):
            self.pieces.append(escape(text))

    def _comment(self, _: str) -> None:
        if self.matched == len(self.path):
            self.pieces.append("<!---->")

    def _end(self, name: str) -> None:
        if self.matched == len(self.path):
            self.pieces.append(f"</{self.names[-1]}>")
            if len(self.names) == len(self.path):
                self.found.append("".join(self.pieces))
                self.pieces.clear()
        self.names.pop()
        self.matched = min(self.matched, len(self.names))


def complete_elements(document: str, path: tuple[str, ...]) -> list[str]:
    """Markup of the elements at exactly ``path`` that end before the first error of a document."""
    reader = ElementReader(path)
    try:
        return reader.feed(document, True)
    except expat.ExpatError:
        return reader.taken()


def _texts(path: str, name: str, encoding: str | None, stack: ExitStack) -> Iterator[str]:
    """A file's text in chunks; wrong bytes are replaced."""
    stream = open_file(path, stack)
    if name.lower().endswith((".gz", ".bz2")):
        stream = stack.enter_context(decompressor(name, stream))
    chunk = stream.read(CHUNK_BYTES)
    found, mark = encoding_of(chunk, encoding)
    decoder = codecs.getincrementaldecoder(found)(errors="replace")
    chunk = chunk[mark:]
    while chunk:
        yield decoder.decode(chunk)
        chunk = stream.read(CHUNK_BYTES)
    yield decoder.decode(b"", True)


def _elements(path: str, name: str, wanted: tuple[str, ...], encoding: str | None) -> Iterator[tuple[str | None, str | None]]:
    reader, is_empty = ElementReader(wanted), True
    try:
        with ExitStack() as stack:
            for text in _texts(path, name, encoding, stack):
                is_empty = is_empty and not text
                for markup in reader.feed(text):
                    yield markup, None
                if reader.other_root:
                    return
            if is_empty:  # a compressed file of nothing is as empty as a file of no bytes
                return
            for markup in reader.feed("", True):
                yield markup, None
    except (expat.ExpatError, OSError, EOFError, ValueError) as error:
        for markup in reader.taken():
            yield markup, None
        yield None, f"{type(error).__name__}: {error}"


def read_elements(files: DataFrame, path: tuple[str, ...], encoding: str | None = None) -> DataFrame:
    """(file_path, file_name) -> (file_path, file_name, number, markup, error): one row per element, in order.

    A document with an error, and a file that cannot be opened, has one more row with the error after the elements
    before it. A document with another root, and one of no characters, has no rows. ``encoding`` overrides what files say.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["file_path", "file_name", "number", "markup", "error"]
        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            for file, name in zip(batch["file_path"], batch["file_name"], strict=True):
                for number, (markup, error) in enumerate(_elements(file, name, path, encoding)):
                    rows.append((file, name, number, markup, error))
                    chars += len(markup or "")
                    if len(rows) >= _FRAME_ROWS or chars >= _FRAME_CHARS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, chars = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    spread = files.select("file_path", "file_name").repartition(spread_tasks(files.sparkSession), "file_path")
    return spread.mapInPandas(read, _ELEMENTS)


def read_piece_elements(pieces: DataFrame, path: tuple[str, ...]) -> DataFrame:
    """(file_path, file_name, at, text, is_last) -> (file_path, file_name, at, number, markup, error): the elements at
    ``path`` in each text, and its error in one more row. A text that is not the last of its file need not be complete."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for piece in batch.rename(columns={"index": "place"}).itertuples(index=False):
                reader, found, error = ElementReader(path), [], None
                try:
                    found = reader.feed(piece.text, bool(piece.is_last))
                except expat.ExpatError as raised:
                    found, error = reader.taken(), f"{type(raised).__name__}: {raised}"
                told = [(markup, None) for markup in found] + ([(None, error)] if error else [])
                rows += [(piece.file_path, piece.file_name, piece.block, piece.place, n, *t) for n, t in enumerate(told)]
            yield pd.DataFrame(rows, columns=["file_path", "file_name", "block", "index", "number", "markup", "error"])

    flat = pieces.selectExpr("file_path", "file_name", "at.block AS block", "at.index AS `index`", "text", "is_last")
    schema = "file_path string, file_name string, block bigint, index bigint, number bigint, markup string, error string"
    found = flat.mapInPandas(read, schema)
    return found.selectExpr("file_path", "file_name", "struct(block, `index`) AS at", "number", "markup", "error")


def other_roots(files: DataFrame, root: str, encoding: str | None = None) -> DataFrame:
    """The files (file_path) whose root element is another one; of each only the beginning is read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for file, name in zip(batch["file_path"], batch["file_name"], strict=True):
                reader = ElementReader((root,))
                try:
                    with ExitStack() as stack:
                        for text in _texts(file, name, encoding, stack):
                            reader.feed(text)
                            if reader.names or reader.found or reader.other_root:
                                break
                except (expat.ExpatError, OSError, EOFError, ValueError):
                    pass  # the scan itself tells what is wrong with the file
                if reader.other_root:
                    found.append(file)
            yield pd.DataFrame({"file_path": found}, dtype=object)

    spread = files.select("file_path", "file_name").repartition(spread_tasks(files.sparkSession), "file_path")
    return spread.mapInPandas(read, "file_path string")


def charsets(files: DataFrame) -> DataFrame:
    """(file_path, file_name) -> (file_path, file_name, charset): what the first bytes of each file say of its encoding,
    by Python's name. Files that cannot be opened have none."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file, name in zip(batch["file_path"], batch["file_name"], strict=True):
                try:
                    with ExitStack() as stack:
                        stream = open_file(file, stack)
                        if name.lower().endswith((".gz", ".bz2")):
                            stream = stack.enter_context(decompressor(name, stream))
                        rows.append((file, name, encoding_of(stream.read(HEAD_BYTES))[0]))
                except (OSError, EOFError, ValueError):
                    rows.append((file, name, None))
            yield pd.DataFrame(rows, columns=["file_path", "file_name", "charset"], dtype=object)

    spread = files.select("file_path", "file_name").repartition(spread_tasks(files.sparkSession), "file_path")
    return spread.mapInPandas(read, "file_path string, file_name string, charset string")
