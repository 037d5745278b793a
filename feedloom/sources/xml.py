"""Records from XML files and from XML held in a column.

Ways to scan files, all giving the same columns:

``auto``      Files are cut at the records' ends, so a large file is the work of many tasks and no task holds more than
(``split``)   some records. Each piece is parsed by itself and shows whether it is records and nothing else; what the
              pieces of a file add up to tells whether the cuts were right. The other files, of whatever layout or
              encoding, are streamed record by record. Right for every document, and bounded in memory.
``document``  One parsed row per file, exploded into records at exactly the root path. Right for every document. Files
              longer than ``LONGEST_DOCUMENT`` would not fit into one task and are read at once as by ``auto``, unless
              ``skip_unreadable`` asks for the reader's own verdict on their bytes.
``record``    Records are streamed one by one by tag name at any depth. A file of any size is one task with little
              memory; right when the tag occurs at the root path only (``tag_report`` tells).

Files whose root element is not the first name of the root path have no records.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import name_column
from feedloom.plans.columns import MALFORMED, POSITION, RESERVED, SOURCE, SOURCE_NAME
from feedloom.plans.compiler import (
    ATTRIBUTE_PREFIX,
    TEXT,
    document_records,
    document_schema,
    extract,
    record_schema,
)
from feedloom.plans.mapping import MappingError, ValueType, XmlSpec
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.cuts import cut_options, decoded, depth_change, is_cuttable, joined_groups, known_charset, mark_bytes
from feedloom.sources.elements import charsets, other_roots, read_elements, read_piece_elements
from feedloom.sources.files import XML_GLOB, list_files, source_name

SCANS = ("document", "record", "split", "auto")
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
# Longer pieces are passed over by the reader. The bytes of such a file do not add up, so it is streamed instead.
LONGEST_PIECE = 64 * 1024 * 1024
# A ``document`` scan cuts longer files like an ``auto`` scan, which gives the same records in little memory.
LONGEST_DOCUMENT = 64 * 1024 * 1024

_CORRUPT = "_corrupt_document"
_PARSER_OPTIONS = {
    "ignoreNamespace": "true",
    "attributePrefix": ATTRIBUTE_PREFIX,
    "valueTag": TEXT,
    "ignoreSurroundingSpaces": "true",
    "columnNameOfCorruptRecord": _CORRUPT,
}
# Byte order mark, declaration, comments, instructions and document type.
_PROLOG = r"^\x{FEFF}?(?:\s+|<\?(?s:.*?)\?>|<!--(?s:.*?)-->|<!DOCTYPE[^\[>]*(?:\[(?s:.*?)\]\s*)?>)*+"
_PREFIX = r"(?:[^\s/<>:]+:)*"
_ROOT_NAME = rf"{_PROLOG}<{_PREFIX}([^\s/<>:]+)"
_ATTRIBUTES = r"(?:\s+[^\s=<>/]+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*+\s*"
_MISC = r"(?:\s+|<\?(?s:.*?)\?>|<!--(?s:.*?)-->)*+"
_COMPRESSED = r"(?i)\.(gz|bz2)$"
_OTHER_ENCODING = r"^\x{FEFF}?<\?xml[^>]*encoding\s*=\s*[\"'](?!(?i:utf-8|us-ascii)[\"'])"


def _is_case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false") == "true"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _check(spec: XmlSpec, scan: str, mode: str) -> None:
    if scan not in SCANS:
        raise ValueError(f"scan must be one of {SCANS}, got {scan!r}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    clash = set(spec.values) & set(RESERVED)
    if clash:
        raise MappingError(f"reserved output keys: {sorted(clash)}")


def configure_reader(
    reader, spark: SparkSession, spec: XmlSpec, scan: str, mode: str, glob: str | None
):
    """Set up a batch or stream reader for the ``document`` or ``record`` scan of a spec."""
    case_sensitive = _is_case_sensitive(spark)
    whole = scan == "document"
    schema = (document_schema if whole else record_schema)(spec, case_sensitive)
    reader = (
        reader.format("xml")
        .schema(_with_corrupt(schema))
        .options(**_PARSER_OPTIONS)
        .option("rowTag", spec.root_path[0] if whole else spec.root_path[-1])
        .option("mode", "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE")
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def records_of_raw(raw: DataFrame, spec: XmlSpec, scan: str, mode: str, on_repeat: str = "first") -> DataFrame:
    """Rows of a configured reader -> records. Separate from reading, so that a stream can apply it per batch."""
    case_sensitive = _is_case_sensitive(raw.sparkSession)
    fields = (document_schema if scan == "document" else record_schema)(spec, case_sensitive).fieldNames()
    node = F.struct(*[name_column(name) for name in fields]).alias("node")
    # Always together with a data column: Spark refuses plans that read the corrupt record column alone.
    corrupt = F.when(name_column(fields[0]).isNull(), F.col(_CORRUPT))
    carried = [
        F.col("_metadata.file_path").alias(SOURCE),
        source_name(F.col("_metadata.file_name")).alias(SOURCE_NAME),
    ]
    if scan == "document":
        documents = raw.select(*carried, node, corrupt.alias("corrupt"))
        return _explode_documents(documents, spec, mode, on_repeat, [SOURCE, SOURCE_NAME], from_files=True)
    rows = raw.select(
        *carried,
        _position(F.lit(0), F.monotonically_increasing_id()),
        corrupt.isNotNull().alias(MALFORMED),
        node,
    )
    return _extract_values(rows, spec, mode, on_repeat, [SOURCE, SOURCE_NAME])


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: XmlSpec,
    *,
    scan: str = "document",
    mode: str = "PERMISSIVE",
    encoding: str | None = None,
    on_repeat: str = "first",
    files: Column | None = None,
    glob: str | None = XML_GLOB,
    skip_unreadable: bool = False,
    work_dir: str | None = None,
) -> DataFrame:
    """One row per record: the values of ``spec`` as text columns, and ``_source _source_name _position _malformed``.

    ``files`` is a condition on ``_metadata`` (name, path, size); files it refuses are not opened. ``mode`` decides on
    malformed documents: PERMISSIVE keeps the records before the error and adds one marker row, DROPMALFORMED leaves
    the marker out, FAILFAST ends the job.

    Encodings are found by Spark. One given by ``encoding`` overrides what a file says; such files are streamed, or cut by
    an ``auto`` scan. Bytes that are wrong in a file's encoding end the job in a ``document`` or ``record`` scan, and
    are replaced elsewhere: ``skip_unreadable`` leaves such files out of a ``document`` scan, for ``read_decoded``.

    ``auto`` and ``split`` read at once and give what they wrote to ``work_dir``.
    """
    _check(spec, scan, mode)
    paths = path if isinstance(path, str) else list(path)
    wanted = F.col("_metadata.file_size") > 0
    if files is not None:
        wanted = wanted & files
    if scan in ("auto", "split"):
        return cut_records(spark, paths, spec, wanted, glob, mode, on_repeat, work_dir, encoding)[0]
    if encoding:
        found = list_files(spark, paths, glob, wanted)
        return read_decoded(found, spec, mode=mode, encoding=encoding, on_repeat=on_repeat)
    long = F.col("_metadata.file_size") > LONGEST_DOCUMENT
    if scan == "document" and not skip_unreadable and not list_files(spark, paths, glob, wanted & long).isEmpty():
        cut = cut_records(spark, paths, spec, wanted & long, glob, mode, on_repeat, work_dir)[0]
        short = F.col("_metadata.file_size") <= LONGEST_DOCUMENT
        short = short if files is None else short & files
        return cut.unionByName(read_records(spark, paths, spec, mode=mode, on_repeat=on_repeat, files=short, glob=glob))
    reader = configure_reader(spark.read, spark, spec, scan, mode, glob)
    if skip_unreadable:
        if scan != "document":
            raise ValueError("a record scan would keep the first part of an unreadable file")
        reader = reader.option("ignoreCorruptFiles", "true")
    records = records_of_raw(reader.load(paths).where(wanted), spec, scan, mode, on_repeat)
    others = other_roots(list_files(spark, paths, glob, wanted), spec.root_path[0])
    return records.join(others, F.col(SOURCE) == F.col("file_path"), "left_anti")


def parse_column(
    df: DataFrame,
    xml_column: str,
    spec: XmlSpec,
    *,
    source_column: str | None = None,
    keep: Sequence[str] = (),
    mode: str = "PERMISSIVE",
    on_repeat: str = "first",
) -> DataFrame:
    """Records of XML documents held in a column; same columns as ``read_records`` plus the ``keep`` columns.

    ``source_column`` names the document (a file name or an id) and becomes ``_source`` and ``_source_name``.
    """
    _check(spec, "document", mode)
    source = F.col(source_column).cast("string") if source_column else F.lit(None).cast("string")
    documents = df.select(
        *keep, source.alias(SOURCE), source.alias(SOURCE_NAME), F.col(xml_column).alias("document")
    )
    return _parse_documents(documents, spec, mode, on_repeat, [*keep, SOURCE, SOURCE_NAME])


def read_decoded(
    files: DataFrame, spec: XmlSpec, *, mode: str = "PERMISSIVE", encoding: str | None = None, on_repeat: str = "first"
) -> DataFrame:
    """Records of the files in a frame (file_path, file_name), streamed with replacement of wrong bytes. A document with
    an error, or a file that cannot be opened, gives a marker row after the records before it."""
    _check(spec, "document", mode)
    elements = read_elements(files, spec.root_path, encoding)
    if mode == "FAILFAST":
        failure = F.raise_error(F.concat(F.lit("malformed document: "), "file_path", F.lit(": "), "error"))
        elements = elements.where(F.when(F.col("error").isNotNull(), failure.cast("boolean")).otherwise(F.lit(True)))
    return _element_records(elements, source_name(F.col("file_name")), _position(F.lit(0), F.col("number")), spec, mode, on_repeat)


def _element_records(elements: DataFrame, name: Column, position: Column, spec: XmlSpec, mode: str, on_repeat: str) -> DataFrame:
    """Streamed elements (file_path, markup, error) -> records."""
    schema = record_schema(spec, _is_case_sensitive(elements.sparkSession))
    rows = elements.select(
        F.col("file_path").alias(SOURCE),
        name.alias(SOURCE_NAME),
        position,
        F.col("error").isNotNull().alias(MALFORMED),
        F.from_xml("markup", schema, {**_PARSER_OPTIONS, "mode": "PERMISSIVE"}).alias("node"),
    )
    return _extract_values(rows, spec, mode, on_repeat, [SOURCE, SOURCE_NAME])


def _parse_documents(
    documents: DataFrame, spec: XmlSpec, mode: str, on_repeat: str, carried: Sequence[str]
) -> DataFrame:
    schema = document_schema(spec, _is_case_sensitive(documents.sparkSession))
    options = {**_PARSER_OPTIONS, "mode": "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE"}
    plain = F.startswith("document", F.lit(f"<{spec.root_path[0]}>"))  # told without a regular expression
    parsed = documents.select(
        *carried,
        (plain | (F.regexp_extract("document", _ROOT_NAME, 1) == spec.root_path[0])).alias("root_fits"),
        F.from_xml("document", _with_corrupt(schema), options).alias("parsed"),
    )
    node = F.struct(*[F.col("parsed").getField(name).alias(name) for name in schema.fieldNames()])
    nodes = parsed.select(
        *carried,
        F.when(F.col("root_fits"), node).alias("node"),
        F.col("parsed").getField(_CORRUPT).alias("corrupt"),
    )
    return _explode_documents(nodes, spec, mode, on_repeat, carried)


def _explode_documents(
    documents: DataFrame, spec: XmlSpec, mode: str, on_repeat: str, carried: Sequence[str], from_files: bool = False
) -> DataFrame:
    """``from_files``: a file's reader gives the row of a root element that was closed before the error, and then the row
    of the error, which has to give no record again."""
    schema = record_schema(spec, _is_case_sensitive(documents.sparkSession))
    corrupt = F.col("corrupt")
    no_node = F.lit(None).cast(schema)
    found = F.when(corrupt.isNull() & F.col("node").isNotNull(), document_records(F.col("node"), spec))
    if len(spec.root_path) > 1 and mode != "FAILFAST":
        marked = F.concat(_before_error(corrupt, spec, schema, from_files), F.array(no_node))
    else:
        marked = F.array(no_node)
    nodes = F.when(corrupt.isNotNull(), marked).otherwise(found)
    rows = documents.select(*carried, F.posexplode(nodes).alias("index", "node")).select(
        *carried,
        _position(F.lit(0), F.col("index")),
        F.col("node").isNull().alias(MALFORMED),
        "node",
    )
    return _extract_values(rows, spec, mode, on_repeat, carried)


def _before_error(document: Column, spec: XmlSpec, record: T.StructType, unless_closed: bool = False) -> Column:
    """Record nodes of a malformed document before its error, as an array.

    The document is cut like a file by the ``auto`` scan, up to the first piece that is not whole. An end tag in a text
    section or a record inside of a record ends the search early; the marker row tells that the document is broken.
    """
    mark = _cut_mark(spec)
    first, lead, ending = _layout(spec)
    closing = ending.removesuffix("$")
    schema = _with_corrupt(T.StructType([T.StructField(spec.root_path[-1], T.ArrayType(record))]))
    options = {**_PARSER_OPTIONS, "mode": "PERMISSIVE"}
    cut = F.split(document, re.escape(mark), -1)
    whole = F.transform(
        F.slice(cut, 1, F.size(cut) - 1),  # what follows the last mark holds no whole record
        lambda p: F.from_xml(F.concat(F.lit("<piece>"), F.regexp_replace(p, lead, ""), F.lit(mark + "</piece>")), schema, options),
    )

    def good(pieces: Column) -> Column:
        broken = F.array_position(F.transform(pieces, lambda x: x.getField(_CORRUPT).isNotNull()), True)
        kept = F.when(broken == 0, pieces).otherwise(F.slice(pieces, 1, F.greatest(F.lit(0), broken.cast("int") - 1)))
        nodes = F.transform(kept, lambda x: x.getField(spec.root_path[-1]))
        return F.flatten(F.filter(nodes, lambda n: n.isNotNull()))

    def good_of_open(pieces: Column) -> Column:
        """Nothing where the first piece that is not whole, or else the last, begins with the parents' end tags."""
        broken = F.array_position(F.transform(pieces, lambda x: x.getField(_CORRUPT).isNotNull()), True).cast("int")
        at = F.get(cut, F.when(broken == 0, F.size(cut)).otherwise(broken) - 1)
        return F.when(at.rlike("^" + _MISC + closing), F.array().cast(T.ArrayType(record))).otherwise(good(pieces))

    # A lambda's variable is computed once.
    found = F.transform(F.array(whole), good_of_open if unless_closed else good)[0]
    return F.when(document.rlike("^" + first) & (F.size(cut) > 1), found).otherwise(F.array().cast(T.ArrayType(record)))


def _layout(spec: XmlSpec) -> tuple[str, str, str]:
    """Patterns: the beginning of a file, what a piece begins with beside elements, and the end of a file."""
    parents = spec.root_path[:-1]
    opening = [f"<{_PREFIX}{re.escape(name)}{_ATTRIBUTES}>{_MISC}" for name in parents]
    closing = [rf"</{_PREFIX}{re.escape(name)}\s*>{_MISC}" for name in parents]
    first = _PROLOG + "".join(opening)
    again = [_MISC + "".join(reversed(closing[k:])) + "".join(opening[k:]) for k in range(1, len(parents))]
    return first, "^(?:" + "|".join([first, *again]) + ")", "".join(reversed(closing)) + "$"


def _cut_mark(spec: XmlSpec) -> str:
    """Where files are cut: the record's end tag, which begins no other tag. Records that are read for nothing but
    their own attributes are mostly written without an end tag."""
    bare = all(value.type is ValueType.ATTRIBUTE and len(value.path) == 1 for value in spec.values.values())
    return "/>" if bare else f"</{spec.root_path[-1]}>"


def _pieces(
    spark: SparkSession, paths: str | list[str], wanted: Column, glob: str | None, mark: str, charset: str = "utf-8"
) -> DataFrame:
    """Bytes of files between the marks, as a string; a splittable scan that gives pieces of one file to many tasks."""
    name = F.col("_metadata.file_name")
    parts = []
    # How long a file is when it is not compressed is known.
    known, unknown = F.col("_metadata.file_size"), F.lit(None).cast("long")
    for chosen, size, options in (
        (~name.rlike(_COMPRESSED), known, {"mapreduce.input.linerecordreader.line.maxlength": str(LONGEST_PIECE)}),
        (name.rlike(_COMPRESSED), unknown, {}),
    ):
        reader = spark.read.options(recursiveFileLookup="true", **cut_options(mark, charset), **options)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        parts.append(
            reader.text(paths)
            .where(wanted & chosen)
            .select(
                F.col("_metadata.file_path").alias(SOURCE),
                source_name(name).alias(SOURCE_NAME),
                size.alias("file_size"),
                F.col("_metadata.file_block_start").alias("block"),
                "value",
            )
        )
    return parts[0].unionByName(parts[1])


def _cut_rows(
    spark: SparkSession,
    paths: str | list[str],
    spec: XmlSpec,
    wanted: Column,
    glob: str | None,
    mode: str,
    on_repeat: str,
    charset: str | None = None,
) -> DataFrame:
    """Records of all pieces, with a column ``_cut`` that says of each piece what it is. Without a charset files are
    UTF-8 and must not say otherwise; with one they are read in it.

    A file is cut rightly if its first piece opens the parents, its last one closes them, every piece between holds
    records and other whole elements at the parents' level (or closes some parents and opens them again), and no bytes
    are missing. Each piece is parsed inside of an element made for it, so what is not whole does not parse.
    """
    tag, mark = spec.root_path[-1], _cut_mark(spec)
    first, lead, ending = _layout(spec)
    value = F.col("value")
    # Most pieces lie between the parents' tags, and whether a name occurs in them is told without a regular expression.
    parents = spec.root_path[:-1]
    outer = F.contains(value, F.lit(parents[0])) if parents else F.lit(True)
    inner = F.contains(value, F.lit(parents[-1])) if parents else F.lit(True)
    body = F.when(outer | inner, F.regexp_replace(value, lead, "")).otherwise(value)
    ends = outer & value.rlike(ending)
    text = F.concat(
        F.lit("<piece>"),
        F.when(ends, F.regexp_replace(body, ending, "")).otherwise(F.concat(body, F.lit(mark))),
        F.lit("</piece>"),
    )
    record = record_schema(spec, _is_case_sensitive(spark))
    schema = _with_corrupt(T.StructType([T.StructField(tag, T.ArrayType(record))]))
    begins = outer & value.rlike("^" + first)
    pieces = _pieces(spark, paths, wanted, glob, mark, charset or "utf-8")
    octets = F.octet_length(value).alias("octets")
    if charset is None:
        odd = ~F.is_valid_utf8(value) | (begins & value.rlike(_OTHER_ENCODING))
        pieces = pieces.select(SOURCE, SOURCE_NAME, "block", "file_size", octets, "value", odd.alias("odd"))
    else:
        pieces = pieces.select(SOURCE, SOURCE_NAME, "block", "file_size", octets, decoded(value, charset).alias("value"))
        pieces = pieces.withColumn("odd", value.isNull()).withColumn("value", F.coalesce(value, F.lit("")))
    parsed = pieces.select(
        SOURCE, SOURCE_NAME, "block", "file_size",
        begins.alias("begins"),
        ends.alias("ends"),
        "octets",
        "odd",
        F.when(begins, F.regexp_extract(value, "^" + first, 0)).alias("head"),
        F.when(~F.col("odd"), value).alias("value"),
        # Pieces in another encoding are in files that are not exact, and so are parsed in that encoding only.
        F.from_xml(F.when(~F.col("odd"), text), schema, {**_PARSER_OPTIONS, "mode": "PERMISSIVE"}).alias("parsed"),
    )
    nodes = F.col("parsed").getField(tag)
    return _marked_rows(parsed.withColumn("nodes", nodes).withColumn("marks", F.lit(1)), spec, mode, on_repeat)


def _marked_rows(parsed: DataFrame, spec: XmlSpec, mode: str, on_repeat: str) -> DataFrame:
    """Pieces with their record nodes -> records with ``_cut``. The first row of a piece tells about the piece."""
    bad = F.col("odd") | F.col("parsed").getField(_CORRUPT).isNotNull()
    none = F.lit(None).cast("string")
    rows = parsed.select(
        SOURCE, SOURCE_NAME, "block", "file_size", "begins", "ends", "octets", "marks",
        bad.alias("bad"),
        (F.col("head") if "head" in parsed.columns else none).alias("head"),
        (F.when(bad, F.col("value")) if "value" in parsed.columns else none).alias("text"),
        F.posexplode_outer("nodes").alias("at", "node"),
    )
    is_head = F.coalesce(F.col("at"), F.lit(0)) == 0
    piece = F.when(is_head, F.struct("begins", "ends", "bad", "octets", "marks", "file_size", "head", "text"))
    rows = rows.select(
        SOURCE,
        SOURCE_NAME,
        _position(F.col("block"), F.monotonically_increasing_id()),
        F.lit(False).alias(MALFORMED),
        F.struct(F.col("node").isNotNull().alias("is_record"), piece.alias("piece")).alias("_cut"),
        "node",
    )
    return _extract_values(rows, spec, mode, on_repeat, [SOURCE, SOURCE_NAME, "_cut"], written=True)


def _nested_rows(
    spark: SparkSession,
    paths: str | list[str],
    spec: XmlSpec,
    wanted: Column,
    glob: str | None,
    charset: str,
    mode: str,
    on_repeat: str,
    folder: str,
) -> DataFrame:
    """Like ``_cut_rows`` for files some of whose cuts are inside of records: pieces are put together up to the next cut
    between records. Each group of them is parsed as a document of its own, between the parents that are open there.
    A parent of another name would have to be closed somewhere, where it does not fit, and so the file is not exact."""
    mark, parents = _cut_mark(spec), spec.root_path[:-1]
    value = F.col("value")
    pieces = _pieces(spark, paths, wanted, glob, mark, charset)
    pieces = pieces.withColumn("at", F.monotonically_increasing_id()).withColumn("octets", F.octet_length(value))
    pieces = pieces.withColumn("value", F.coalesce(decoded(value, charset), F.lit("</wrong bytes>")))
    pieces.withColumn("change", depth_change(F.concat(value, F.lit(mark)))).write.parquet(folder)
    groups = joined_groups(spark.read.parquet(folder), len(parents), mark, LONGEST_PIECE)
    first = F.col("block") == 0
    opened, closed = "".join(f"<{p}>" for p in parents), "".join(f"</{p}>" for p in reversed(parents))
    text = F.concat(
        F.lit("<piece>"),
        F.when(first, F.regexp_replace(value, _PROLOG, "")).otherwise(F.concat(F.lit(opened), value)),
        F.when(F.col("is_last"), F.lit("")).otherwise(F.lit(mark + closed)),
        F.lit("</piece>"),
    )
    root = F.regexp_extract(value, _ROOT_NAME, 1) == parents[0]
    document = document_schema(spec, _is_case_sensitive(spark))
    schema = _with_corrupt(T.StructType([T.StructField(parents[0], T.ArrayType(document))]))
    parsed = groups.select(
        SOURCE, SOURCE_NAME, "block", "file_size",
        (first & root).alias("begins"),
        (F.col("is_last") & value.rlike(_layout(spec)[2])).alias("ends"),
        "octets",
        F.col("n_pieces").alias("marks"),
        F.from_xml(text, schema, {**_PARSER_OPTIONS, "mode": "PERMISSIVE"}).alias("parsed"),
    )
    # A root that is closed and opened again within a group would be two.
    one = F.coalesce(F.size(F.col("parsed").getField(parents[0])) == 1, F.lit(False))
    node = F.get(F.col("parsed").getField(parents[0]), F.lit(0))
    nodes = F.when(one & F.col("parsed").getField(_CORRUPT).isNull(), document_records(node, spec))
    return _marked_rows(parsed.withColumn("odd", ~one).withColumn("nodes", nodes), spec, mode, on_repeat)


def _cut_rightly(rows: DataFrame, mark: str, charset: str = "utf-8") -> DataFrame:
    """(file, exact) of the files in ``_cut_rows``."""
    piece, width = F.col("_cut.piece"), len(mark_bytes(mark, charset))
    octets = F.sum(piece["octets"] + piece["marks"] * width) - width  # no mark after the last piece
    missing = F.max(piece["file_size"]) - octets
    exact = (
        (F.count_if(piece["begins"]) == 1)
        & (F.count_if(piece["ends"]) == 1)
        & (F.count_if(piece["bad"]) == 0)
        & F.coalesce(missing.isin(0, 3), F.lit(True))  # the reader takes a byte order mark away
    )
    return rows.where(piece.isNotNull()).groupBy(F.col(SOURCE).alias("file")).agg(exact.alias("exact"))


def _broken(rows: DataFrame, verdicts: DataFrame, spec: XmlSpec) -> DataFrame:
    """(file_path, file_name, at, text, is_last) of files in ``_cut_rows`` that are cut rightly up to one piece: its place,
    and a document of the file's beginning and that piece. If that has an error, so does the file, and there."""
    piece, width = F.col("_cut.piece"), len(_cut_mark(spec))
    heads = rows.where(piece.isNotNull()).select(SOURCE, SOURCE_NAME, POSITION, piece.alias("piece"))
    heads = heads.join(verdicts.where("NOT exact"), F.col(SOURCE) == F.col("file"), "left_semi")
    at, piece = F.col(POSITION), F.col("piece")
    known = heads.groupBy(SOURCE, SOURCE_NAME).agg(
        F.min(F.when(piece["bad"], F.struct(at.alias("at"), piece["text"].alias("text")))).alias("bad"),
        F.max(at).alias("last"),
        F.min(F.when(piece["begins"], F.struct(at.alias("at"), piece["head"].alias("head")))).alias("first"),
        F.max(F.when(piece["begins"], at)).alias("last_beginning"),
        F.min(F.when(piece["ends"], at)).alias("first_end"),
        F.min(at).alias("start"),
        (F.max(piece["file_size"]) - F.sum(piece["octets"] + piece["marks"] * width) + width).alias("missing"),
    )
    once = (F.col("first.at") == F.col("start")) & (F.col("last_beginning") == F.col("start")) & (F.col("start") < F.col("bad.at"))
    whole = F.coalesce(F.col("missing").isin(0, 3), F.lit(True)) & F.coalesce(F.col("first_end") >= F.col("bad.at"), F.lit(True))
    text = F.concat("first.head", "bad.text", F.when(F.col("bad.at") < F.col("last"), F.lit(_cut_mark(spec))).otherwise(F.lit("")))
    return known.where(once & whole & F.col("bad.text").isNotNull()).select(
        F.col(SOURCE).alias("file_path"),
        F.col(SOURCE_NAME).alias("file_name"),
        F.col("bad.at").alias("at"),
        text.alias("text"),
        (F.col("bad.at") == F.col("last")).alias("is_last"),
    )


def cut_records(
    spark: SparkSession,
    paths: str | list[str],
    spec: XmlSpec,
    wanted: Column,
    glob: str | None = XML_GLOB,
    mode: str = "PERMISSIVE",
    on_repeat: str = "first",
    work_dir: str | None = None,
    encoding: str | None = None,
    listed: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """The ``auto`` scan: (records, folders they are written to). Files are cut and parsed as UTF-8; those for which that
    was not right are cut in the encoding their first bytes tell, then with pieces put together where records hold
    elements of their own name; what is left is streamed. A file that is one record (a root path of one name) is always
    streamed. ``encoding`` overrides what files say; ``listed`` are the wanted files (file_path, file_name), if known."""
    work_dir = work_dir or scratch_dir(spark, "cut")
    left = list_files(spark, paths, glob, wanted).select("file_path", "file_name") if listed is None else listed
    found, folders = [], []

    def kept(rows: DataFrame, name: str, charset: str) -> DataFrame:
        """Writes rows of cut files, keeps the records of those that were cut rightly, and returns these files."""
        rows.write.parquet(f"{work_dir}/{name}")
        rows = spark.read.parquet(f"{work_dir}/{name}")
        _cut_rightly(rows, _cut_mark(spec), charset).write.parquet(f"{work_dir}/{name}-verdicts")
        verdicts = spark.read.parquet(f"{work_dir}/{name}-verdicts")
        wrong = verdicts.where("NOT exact")
        if name == "cut" and len(spec.root_path) == 2 and mode != "FAILFAST" and not wrong.isEmpty():
            verdicts = verdicts.select("file", F.col("exact") | F.col("file").isin(before_error(rows, verdicts)))
            verdicts = verdicts.toDF("file", "exact")
        records = rows.where("_cut.is_record").join(wrong, F.col(SOURCE) == F.col("file"), "left_anti").drop("_cut")
        found.append(records)
        folders.append(f"{work_dir}/{name}")
        return verdicts.where("exact")

    def before_error(rows: DataFrame, verdicts: DataFrame) -> list[str]:
        """Keeps the records before the error of broken documents that are cut rightly up to it, with the marker, and
        returns these files. Only the piece with the error is streamed."""
        folder = f"{work_dir}/broken"
        read_piece_elements(_broken(rows, verdicts, spec), spec.root_path).write.parquet(folder)
        elements = spark.read.parquet(folder)
        broken = elements.where("error IS NOT NULL").select("file_path", "at")
        whole = rows.where("_cut.is_record").join(broken, F.col(SOURCE) == F.col("file_path"))
        found.append(whole.where(F.col(POSITION) < F.col("at")).drop("_cut", "file_path", "at"))
        last = elements.join(broken.select("file_path"), "file_path", "left_semi")
        index = F.col("at.index") + F.col("number")
        found.append(_element_records(last, F.col("file_name"), _position(F.col("at.block"), index), spec, mode, on_repeat))
        # Broken documents are few.
        return [row[0] for row in broken.select("file_path").collect()]

    def remaining(exact: DataFrame) -> DataFrame:
        return left.join(exact, F.col("file_path") == F.col("file"), "left_anti")

    if len(spec.root_path) > 1:
        if encoding is None:
            left = remaining(kept(_cut_rows(spark, paths, spec, wanted, glob, mode, on_repeat), "cut", "utf-8"))
        told = charsets(left) if encoding is None else left.withColumn("charset", F.lit(known_charset(encoding)))
        told.write.parquet(f"{work_dir}/charsets")
        left = spark.read.parquet(f"{work_dir}/charsets")
        for nested in (False, True):
            # Encodings are few, and files that are neither UTF-8 nor flat are known by name.
            for charset in sorted(r[0] for r in left.select("charset").distinct().collect() if r[0]):
                if not is_cuttable(charset) or (not nested and encoding is None and charset in ("utf-8", "ascii")):
                    continue
                names = [r[0] for r in left.where(F.col("charset") == charset).select("file_path").collect()]
                chosen = wanted & F.col("_metadata.file_path").isin(names)
                name = f"{'nested' if nested else 'coded'}-{charset}"
                if nested:
                    folder = f"{work_dir}/{name}-pieces"
                    rows = _nested_rows(spark, paths, spec, chosen, glob, charset, mode, on_repeat, folder)
                else:
                    rows = _cut_rows(spark, paths, spec, chosen, glob, mode, on_repeat, charset)
                left = remaining(kept(rows, name, charset))
    read_decoded(left, spec, mode=mode, encoding=encoding, on_repeat=on_repeat).write.parquet(f"{work_dir}/streamed")
    found.append(spark.read.parquet(f"{work_dir}/streamed"))
    folders.append(f"{work_dir}/streamed")
    return reduce(DataFrame.unionByName, found), folders


def cut_exactly(spark: SparkSession, path: str | Sequence[str], spec: XmlSpec, *, glob: str | None = XML_GLOB) -> DataFrame:
    """Which files the ``auto`` scan cuts: (file, exact)."""
    paths = path if isinstance(path, str) else list(path)
    rows = _cut_rows(spark, paths, spec, F.col("_metadata.file_size") > 0, glob, "PERMISSIVE", "first")
    return _cut_rightly(rows, _cut_mark(spec))


def _position(block: Column, index: Column) -> Column:
    return F.struct(block.cast("long").alias("block"), index.cast("long").alias("index")).alias(POSITION)


def _extract_values(
    rows: DataFrame, spec: XmlSpec, mode: str, on_repeat: str, carried: Sequence[str], written: bool = False
) -> DataFrame:
    """``written``: the rows are written as they are. Conditions on rows that are not would otherwise be moved before the
    values, and each of them would take the values out of the node once more."""
    if mode == "DROPMALFORMED":
        rows = rows.where(~F.col(MALFORMED))
    values = []
    for key, value in spec.values.items():
        column = extract(F.col("node"), value, on_repeat)
        # An object over no node would be {}; the other kinds are NULL by themselves.
        values.append((F.when(~F.col(MALFORMED), column) if value.type.is_json else column).alias(key))
    if written:
        return rows.select(*carried, POSITION, MALFORMED, *values)
    held = rows.select(*carried, POSITION, MALFORMED, F.struct(*values).alias("_values"))
    # No condition is moved before a generator that makes its columns.
    return held.select(*carried, POSITION, MALFORMED, F.inline(F.array("_values")))


def tag_report(spark: SparkSession, path: str | Sequence[str], spec: XmlSpec, *, glob: str | None = XML_GLOB) -> DataFrame:
    """Files whose record tag also occurs outside the root path: (file_path, at_root_path, by_tag).

    No rows mean that the ``record`` scan is exact for these files. Both counts read markup without keeping values.
    """
    key = next(iter(spec.values))
    bare = XmlSpec(root_path=spec.root_path, values={key: spec.values[key]})
    exact = read_records(spark, path, bare, scan="document", glob=glob)
    by_tag = read_records(spark, path, bare, scan="record", glob=glob)
    counts = [
        frame.where(~F.col(MALFORMED)).groupBy(SOURCE).agg(F.count("*").alias(name))
        for frame, name in ((exact, "at_root_path"), (by_tag, "by_tag"))
    ]
    joined = counts[0].join(counts[1], SOURCE, "full_outer").na.fill(0, ["at_root_path", "by_tag"])
    return joined.where(F.col("at_root_path") != F.col("by_tag")).withColumnRenamed(SOURCE, "file_path")

