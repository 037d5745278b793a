"""Whole runs: files (and archives) -> records -> table rows -> upsert, with reports and quarantined rows.

Records are written to the work folder once they are parsed and checked. So every file is parsed once whatever the
number of tables, a bound for the size of what is to be upserted is known before the join is planned, and a lost
executor costs a re-read of a Parquet file and not a re-parse of XML.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import cast_reason, logical_type, parse_text, resolve_null
from feedloom.functions.text import name_column
from feedloom.operators.dedup import dedup_first, number_rows
from feedloom.operators.fanout import check_target, table_texts, target_fields
from feedloom.operators.reports import file_counts, run_summary, table_counts
from feedloom.operators.validate import MALFORMED_DOCUMENT, annotate
from feedloom.plans.columns import POSITION, REASON, SOURCE
from feedloom.plans.mapping import Mapping, MappingError, TableId, load_mappings
from feedloom.sinks.tables import delete, directory_bytes, is_file, scratch_dir
from feedloom.sources.archives import (
    ARCHIVE_GLOB,
    DEFAULT_MAX_MEMBER_BYTES,
    archive_kind,
    extract_archives,
    is_compressed_xml,
)
from feedloom.sources.files import XML_GLOB, list_files, mapping_index, route, source_name
from feedloom.sources.xml import cut_records, read_decoded, read_records

PARALLEL_TABLES = 4
REJECTED = "source string, table_name string, reason string, row string"


class LoadError(RuntimeError):
    """A run with ``on_error='fail'`` met something that cannot be loaded."""


@dataclass
class LoadReport:
    """What a run did. All frames are read from the work folder, so looking at them repeats no work."""

    files: DataFrame  # source, mapping_index, processed, skipped, failed
    tables: DataFrame  # source, table_name, batches, rows
    rejected: DataFrame  # source, table_name, reason, row (JSON)
    summary: DataFrame  # files_found, files_loaded, files_failed, files_unrouted
    work_dir: str

    def clean(self) -> None:
        """Delete the report itself; the frames cannot be read any more."""
        delete(self.summary.sparkSession, self.work_dir)


def checked_records(annotated: DataFrame, mapping: Mapping, targets: dict[TableId, T.StructType]) -> DataFrame:
    """One row per record: its reject reason with its values as JSON, and for the table of number ``i`` whether it has a row
    there (``_has<i>``), typed columns in target order (``_values<i>``), the reject reason (``_reason<i>``), whether a key is
    written in another way than its value, such as 01 for 1 (``_odd<i>``), and the texts of rejected and of odd rows
    (``_text<i>``). So records are read and checked once whatever the number of tables. Each projection looks at columns of
    the one before, so that nothing is cast twice.
    """
    tables = list(enumerate(mapping.loaded_tables))
    fields = {i: target_fields(targets[t], mapping.target_columns(t), mapping.db[t].unique_columns) for i, t in tables}
    keys = {i: {key.lower() for key in mapping.db[t].unique_columns} for i, t in tables}
    texts, values = ({i: [f"_{kind}{i}_{at}" for at in range(len(fields[i]))] for i, _ in tables} for kind in ("text", "value"))
    all_values = F.to_json(F.struct(*map(name_column, mapping.xml.values)))
    rows = [SOURCE, POSITION, F.col(REASON), F.when(F.col(REASON).isNotNull(), all_values).alias("_row")]
    for i, table in tables:
        by_lower = {name.lower(): text for name, text in table_texts(mapping, table).items()}
        rows += [by_lower[field.name.lower()].alias(name) for field, name in zip(fields[i], texts[i], strict=True)]
    frame = annotated.select(*rows)
    more = {}
    for i, _ in tables:
        given = F.coalesce(*map(F.col, texts[i])).isNotNull()
        more[f"_has{i}"] = F.when(F.col(REASON).isNull() & given, F.lit(True))
        for field, text, value in zip(fields[i], texts[i], values[i], strict=True):
            more[value] = parse_text(resolve_null(F.col(text), field), field)
    frame, more = frame.withColumns(more), {}
    for i, table in tables:
        named = list(zip(fields[i], texts[i], values[i], strict=True))
        order = {key.lower(): at for at, key in enumerate(mapping.db[table].unique_columns)}
        of_key = sorted((n for n in named if n[0].name.lower() in keys[i]), key=lambda n: order[n[0].name.lower()])
        reasons = [F.when(F.col(text).isNull(), F.lit(f"missing_key:{f.name}")) for f, text, _ in of_key]
        reasons += [cast_reason(F.col(text), F.col(value), f) for f, text, value in named]
        more[f"_reason{i}"] = F.when(F.col(f"_has{i}"), F.coalesce(*reasons))
        written = [F.col(t) != F.col(v).cast("string") for f, t, v in of_key if not _is_as_written(f)]
        differs = F.coalesce(reduce(lambda a, b: a | b, written, F.lit(False)), F.lit(False))
        more[f"_odd{i}"] = F.coalesce(F.col(f"_has{i}"), F.lit(False)) & differs
    frame = frame.withColumns(more)
    kept = [SOURCE, POSITION, REASON, "_row"]
    for i, _ in tables:
        row = F.struct(*[F.col(v).alias(f.name) for f, v in zip(fields[i], values[i], strict=True)])
        text = F.struct(*[F.col(t).alias(f.name) for f, t in zip(fields[i], texts[i], strict=True)])
        needed = F.col(f"_reason{i}").isNotNull() | F.col(f"_odd{i}")
        kept += [f"_has{i}", f"_reason{i}", F.when(F.col(f"_has{i}"), row).alias(f"_values{i}"), F.when(needed, text).alias(f"_text{i}")]
    return frame.select(*kept, *[f"_odd{i}" for i, _ in tables])


def _is_as_written(field: T.StructField) -> bool:
    """Whether the value of a column is its text."""
    return isinstance(field.dataType, T.StringType) and not logical_type(field)


def typed_rows(checked: DataFrame, mapping: Mapping, table: TableId, target: T.StructType) -> DataFrame:
    """Typed columns of a table in target order, ``_text`` and a reject reason, from written ``checked_records``."""
    i = list(mapping.loaded_tables).index(table)
    row = F.col(f"_values{i}")
    columns = [row.getField(f.name).alias(f.name) for f in target_fields(target, mapping.target_columns(table))]
    rows = checked.where(F.col(f"_has{i}"))
    return rows.select(SOURCE, POSITION, *columns, F.col(f"_text{i}").alias("_text"), F.col(f"_reason{i}").alias(REASON))


def unique_rows(
    typed: DataFrame,
    mapping: Mapping,
    table: TableId,
    target: T.StructType,
    winner: str = "first",
    has_variants: bool = True,
) -> DataFrame:
    """One row per key: the first of equal key texts, the last of texts that mean one typed key; a later file wins.

    With ``winner="batch"`` a later batch (of the mapping's ``batch_size`` rows of one file) wins over an earlier one,
    as when batches are written one after the other; this costs a numbering of the rows of each file.
    ``has_variants=False`` says that no key is written in two ways, and one pass does.
    """
    if winner not in ("first", "batch"):
        raise ValueError(f"winner must be 'first' or 'batch', got {winner!r}")
    by_lower = {field.name.lower(): field for field in target.fields}
    keys = [by_lower[key.lower()].name for key in mapping.db[table].unique_columns]
    names = [field.name for field in target_fields(target, mapping.target_columns(table))]
    if not keys:
        return typed.select(*map(name_column, names))
    block, index = F.col(POSITION).getField("block"), F.col(POSITION).getField("index")
    rows = typed
    if winner == "batch":
        rows = number_rows(rows, SOURCE, [block, index])
        batch = F.floor(F.col("_sequence") / mapping.db[table].batch_size)
        order = F.struct(F.col(SOURCE), batch, -F.col("_sequence"))
    else:
        order = F.struct(F.col(SOURCE), -block, -index)
    columns = list(map(name_column, names))
    if not has_variants:
        return dedup_first(rows.select(*columns, order.alias("_order")), keys, ["_order"], keep="last").drop("_order")
    key_texts = [f"_key{i}" for i in range(len(keys))]
    # A key without its text is written like its value.
    written = [F.coalesce(F.col("_text").getField(key), name_column(key).cast("string")) for key in keys]
    texts = [text.alias(name) for text, name in zip(written, key_texts, strict=True)]
    by_text = dedup_first(
        rows.select(SOURCE, POSITION, *columns, *texts, order.alias("_order")), key_texts, ["_order"], keep="last"
    )
    return dedup_first(by_text, keys, [SOURCE, POSITION], keep="last").select(*columns)


def repeated_keys(typed: DataFrame, keys: Sequence[str]) -> tuple[bool, bool]:
    """Whether a key is in several rows, and whether it is in several rows of one source. Told by counts."""
    file = F.xxhash64(SOURCE)
    by_key = typed.groupBy(*map(name_column, keys)).agg(
        F.count("*").alias("_n"), F.min(file).alias("_low"), F.max(file).alias("_high")
    )
    # Two rows are of two sources or of one; more have to be counted by source.
    apart = (F.col("_n") == 1) | ((F.col("_n") == 2) & (F.col("_low") != F.col("_high")))
    most, clear = by_key.agg(F.max("_n"), F.bool_and(apart)).first()
    if (most or 0) <= 1 or clear:
        return (most or 0) > 1, False
    by_source = typed.groupBy(*map(name_column, keys), SOURCE).agg(F.count("*").alias("_n"))
    return True, by_source.agg(F.max("_n")).first()[0] > 1


def _rejected_rows(frame: DataFrame, table: str, row) -> DataFrame:
    return frame.where(F.col(REASON).isNotNull()).select(
        F.col(SOURCE).alias("source"), F.lit(table).alias("table_name"), F.col(REASON).alias("reason"), row.alias("row")
    )


@dataclass
class Prepared:
    """Records of one mapping, checked and cast, before anything is loaded."""

    mapping: Mapping
    checked: DataFrame
    typed: dict[TableId, DataFrame]
    rejected: DataFrame
    has_variants: dict[TableId, bool]
    staged_bytes: int

    def first_error(self) -> str | None:
        first = self.rejected.where((F.col("table_name") != "") | (F.col("reason") == MALFORMED_DOCUMENT)).first()
        return None if first is None else f"{first.source}: {first.table_name or 'document'}: {first.reason}"


def prepare_records(
    spark: SparkSession,
    records: DataFrame,
    mapping: Mapping,
    targets: dict[TableId, T.StructType],
    work_dir: str,
    *,
    expected: DataFrame | None = None,
    written: Sequence[str] = (),
) -> Prepared:
    """Checks and casts the records of one mapping in one pass for all tables, and writes what it found.

    ``written`` are the folders of records that were read from Parquet; others are written here first. ``expected``
    (file_path, file_name) names the files the records are from: those that gave none are read once more, decoded with
    replacement of wrong bytes. Most of them are just empty.
    """
    if not written:
        staged = f"{work_dir}/records"
        written = [staged]
        records.write.parquet(staged)
        records = spark.read.parquet(staged)
        if expected is not None:
            silent = expected.join(records.select(SOURCE).distinct(), F.col("file_path") == F.col(SOURCE), "left_anti")
            if not silent.isEmpty():
                # The frame reads the staged folder as it was listed before this append.
                read_decoded(silent, mapping.xml).write.mode("append").parquet(staged)
                records = spark.read.parquet(staged)
    tables, seen = mapping.loaded_tables, Observation()
    found = checked_records(annotate(records, mapping.xml), mapping, targets)
    odd = [f"_odd{i}" for i in range(len(tables))]
    found.observe(seen, *[F.bool_or(name).alias(name) for name in odd]).drop(*odd).write.parquet(f"{work_dir}/checked")
    checked = spark.read.parquet(f"{work_dir}/checked")
    typed = {table: typed_rows(checked, mapping, table, targets[table]) for table in tables}
    parts = [_rejected_rows(checked, "", F.col("_row"))]
    parts += [_rejected_rows(frame, str(table), F.to_json("_text")) for table, frame in typed.items()]
    reduce(DataFrame.unionByName, parts).write.parquet(f"{work_dir}/rejected")
    return Prepared(
        mapping,
        checked,
        typed,
        spark.read.parquet(f"{work_dir}/rejected"),
        {table: bool(seen.get[name]) for table, name in zip(tables, odd, strict=True)},
        sum(directory_bytes(spark, folder) for folder in written),
    )


def _in_parallel(spark: SparkSession, work, items) -> None:
    """Independent jobs: of tables over the same staged records, or of mappings."""
    with ThreadPoolExecutor(max_workers=PARALLEL_TABLES) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]:
            done.result()


def load_prepared(
    spark: SparkSession,
    prepared: Prepared,
    store,
    targets: dict[TableId, T.StructType],
    *,
    winner: str = "batch",
    token: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loads what was prepared; returns (file counts, table counts, rejected rows)."""
    mapping = prepared.mapping

    def load(table: TableId) -> None:
        loadable = prepared.typed[table].where(F.col(REASON).isNull())
        by_lower = {field.name.lower(): field.name for field in targets[table].fields}
        keys = [by_lower[key.lower()] for key in mapping.db[table].unique_columns]
        repeats, within_source = repeated_keys(loadable, keys) if keys else (False, False)
        if repeats:
            # Where no file repeats a key, its batches need not be known.
            by = winner if within_source else "first"
            unique = unique_rows(loadable, mapping, table, targets[table], by, prepared.has_variants[table])
        else:
            fields = target_fields(targets[table], mapping.target_columns(table))
            unique = loadable.select(*[name_column(field.name) for field in fields])
        # The rows of a table are at most as large as all records.
        store.load(table, unique, keys, token, prepared.staged_bytes)

    _in_parallel(spark, load, prepared.typed)
    batch_sizes = {table: mapping.db[table].batch_size for table in prepared.typed}
    return file_counts(prepared.checked), table_counts(prepared.typed, batch_sizes), prepared.rejected


def load_records(
    spark: SparkSession,
    records: DataFrame,
    mapping: Mapping,
    store,
    targets: dict[TableId, T.StructType],
    work_dir: str,
    *,
    on_error: str = "quarantine",
    winner: str = "batch",
    token: str | None = None,
    expected: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prepares and loads the records of one mapping; returns (file counts, table counts, rejected rows)."""
    _check_policy(on_error)
    prepared = prepare_records(spark, records, mapping, targets, work_dir, expected=expected)
    if on_error == "fail" and (error := prepared.first_error()):
        raise LoadError(error)
    with _together(store, token) as sink:
        return load_prepared(spark, prepared, sink, targets, winner=winner, token=token)


@contextmanager
def _together(store, token: str | None):
    """All tables of a load or none, where the store knows transactions; else each table for itself."""
    if not hasattr(store, "transaction"):
        yield store
        return
    changes = store.transaction(token)
    try:
        yield changes
        changes.commit()
    except BaseException:
        changes.abort()
        raise


def _check_policy(on_error: str) -> None:
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', got {on_error!r}")


def run(
    spark: SparkSession,
    path: str | Sequence[str],
    mappings: str | list | Sequence[Mapping],
    store,
    targets: dict[TableId, T.StructType],
    *,
    scan: str = "auto",
    on_error: str = "quarantine",
    winner: str = "batch",
    encoding: str | None = None,
    archives: bool = True,
    max_member_bytes: int = DEFAULT_MAX_MEMBER_BYTES,
    work_dir: str | None = None,
    keep_work: bool = False,
    token: str | None = None,
) -> LoadReport:
    """Load everything below ``path`` into the tables of the mappings.

    A ``path`` that is one archive gives every member that a mapping's patterns name; of archives found in a folder
    only ``.xml`` members are taken. With ``on_error="fail"`` all mappings are checked before the first row is loaded.
    Rows are deduplicated as if batches of the mapping's size were written one after the other, or with
    ``winner="first"`` so that the first row of a key in a file stays. A ``token`` names the load: a table that has it
    is not loaded again. In a store with transactions (``BucketTables``) all tables of the run become visible together or
    stay as they are; other stores take each table for itself. Work data is deleted at the end, the report stays until
    ``LoadReport.clean``.
    """
    _check_policy(on_error)
    if not (isinstance(mappings, (list, tuple)) and all(isinstance(m, Mapping) for m in mappings)):
        mappings = load_mappings(mappings)
    for mapping in mappings:
        for table in mapping.loaded_tables:
            if table not in targets:
                raise MappingError(f"no target schema for table {table}")
            check_target(mapping, table, targets[table])
    work_dir = work_dir or scratch_dir(spark, "run")
    paths = [path] if isinstance(path, str) else list(path)
    archive_errors, glob = None, XML_GLOB
    alone = archives and isinstance(path, str) and is_file(spark, path) and _is_archive(spark, path)
    if archives and not list_files(spark, paths, ARCHIVE_GLOB).where(~is_compressed_xml(F.col("file_name"))).isEmpty():
        masks = list(dict.fromkeys(p for m in mappings for p in m.xml.files))
        manifest = extract_archives(
            spark,
            paths,
            f"{work_dir}/extracted",
            masks,
            max_member_bytes,
            xml_only=not alone,
            on_error=on_error,
            compressed_xml=False,
        )
        manifest.write.parquet(f"{work_dir}/manifest")
        manifest = spark.read.parquet(f"{work_dir}/manifest")
        archive_errors = manifest.where(F.col("error").isNotNull())
        extracted = not manifest.where(F.col("error").isNull()).isEmpty()
        if alone:
            # Members need not be called .xml; the archive itself is no document.
            paths, glob = ([f"{work_dir}/extracted"], None) if extracted else (paths, XML_GLOB)
        elif extracted:
            paths = [*paths, f"{work_dir}/extracted"]

    routed = route(list_files(spark, paths, glob), mappings)
    routed.select("file_path", "file_name", "file_size", "mapping_index").write.parquet(f"{work_dir}/files")
    routed = spark.read.parquet(f"{work_dir}/files")
    used = sorted(row[0] for row in routed.select("mapping_index").distinct().collect() if row[0] is not None)

    parts: dict[int, Prepared] = {}

    def prepare(index: int) -> None:
        spec, folder = mappings[index].xml, f"{work_dir}/mapping{index}"
        chosen = mapping_index(source_name(F.col("_metadata.file_name")), mappings) == index
        listed = routed.where(F.col("mapping_index") == index).select("file_path", "file_name")
        expected, written = None, ()
        if scan in ("auto", "split"):
            wanted = (F.col("_metadata.file_size") > 0) & chosen
            records, written = cut_records(
                spark, paths, spec, wanted, glob, work_dir=folder, encoding=encoding, listed=listed
            )
        else:
            whole = scan == "document" and encoding is None
            records = read_records(
                spark, paths, spec, scan=scan, encoding=encoding, files=chosen, glob=glob, skip_unreadable=whole
            )
            if whole:
                expected = listed
        parts[index] = prepare_records(
            spark, records, mappings[index], targets, folder, expected=expected, written=written
        )

    # Mappings have files of their own, and their jobs do not wait for each other.
    _in_parallel(spark, prepare, used)
    prepared = [parts[index] for index in used]
    if on_error == "fail":
        for error in filter(None, (part.first_error() for part in prepared)):
            raise LoadError(error)
    counts, tables, rejected = [], [], []
    with _together(store, token) as sink:
        for index, part in zip(used, prepared, strict=True):
            # Several mappings may load one table.
            loaded = load_prepared(spark, part, sink, targets, winner=winner, token=token and f"{token}-{index}")
            for collected, frame in zip((counts, tables, rejected), loaded, strict=True):
                collected.append(frame)

    empty_counts = spark.createDataFrame([], "source string, processed long, skipped long, malformed boolean")
    per_file = reduce(DataFrame.unionByName, counts, empty_counts)
    bad_rows = reduce(DataFrame.unionByName, rejected, spark.createDataFrame([], REJECTED))
    if archive_errors is not None:
        bad_rows = bad_rows.unionByName(
            archive_errors.select(
                F.col("archive_path").alias("source"),
                F.lit("").alias("table_name"),
                F.concat(F.lit("archive:"), "error").alias("reason"),
                F.to_json(F.struct("member")).alias("row"),
            )
        )
    read_files = routed.select(F.col("file_path").alias("source"), "mapping_index").where("mapping_index IS NOT NULL")
    if archive_errors is not None:
        # An archive that could not be read, or not in full, is a file that failed.
        broken = archive_errors.select(F.col("archive_path").alias("source"), F.lit(None).cast("int").alias("mapping_index"))
        read_files = read_files.unionByName(broken.distinct())
    failed_rows = bad_rows.where("table_name <> '' OR reason LIKE 'archive:%'").groupBy("source").agg(F.count("*").alias("bad_rows"))
    files = (
        read_files.join(per_file, "source", "left")
        .join(failed_rows, "source", "left")
        .select(
            "source",
            "mapping_index",
            F.coalesce("processed", F.lit(0)).alias("processed"),
            F.coalesce("skipped", F.lit(0)).alias("skipped"),
            (F.coalesce("malformed", F.lit(False)) | F.col("bad_rows").isNotNull()).alias("failed"),
        )
    )
    empty_tables = spark.createDataFrame([], "source string, table_name string, batches long, rows long")
    files.write.parquet(f"{work_dir}/report/files")
    reduce(DataFrame.unionByName, tables, empty_tables).write.parquet(f"{work_dir}/report/tables")
    bad_rows.write.parquet(f"{work_dir}/report/rejected")
    files = spark.read.parquet(f"{work_dir}/report/files")
    if not keep_work:
        for folder in ("extracted", *[f"mapping{index}" for index in used]):
            delete(spark, f"{work_dir}/{folder}")
    unrouted = routed.agg(F.count_if(F.col("mapping_index").isNull()).alias("files_unrouted"))
    # Both sides are single rows.
    summary = run_summary(files).withColumn("one", F.lit(1)).join(unrouted.withColumn("one", F.lit(1)), "one").drop("one")
    return LoadReport(
        files=files,
        tables=spark.read.parquet(f"{work_dir}/report/tables"),
        rejected=spark.read.parquet(f"{work_dir}/report/rejected"),
        summary=summary,
        work_dir=work_dir,
    )


def _is_archive(spark: SparkSession, path: str) -> bool:
    name = path.rstrip("/").rpartition("/")[2]
    kind, compressed = spark.range(1).select(archive_kind(F.lit(name)), is_compressed_xml(F.lit(name))).first()
    return kind is not None and not compressed
