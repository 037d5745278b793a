"""Scans: S1-S5, S8, S9. Files are written from the tables by Spark, a bounded number of records per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.plans.mapping import Mapping, TableId, TableSpec, XmlSpec
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.files import filename_value, list_files, route
from feedloom.sources.xml import cut_records, parse_column, read_records
from feedloom_queries.common import (
    ORDER_TYPES,
    ORDER_VALUES,
    as_type,
    attribute,
    content,
    order_documents,
    order_element,
    order_rows_for_xml,
    table,
    typed_orders,
)

RECORDS_PER_FILE = 50_000
ORDERS = XmlSpec(("orders", "order"), ORDER_VALUES)
_ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def write_xml(rows: DataFrame, location: str, root: str, row: str, **options: str) -> None:
    writer = rows.write.format("xml").option("rootTag", root).option("rowTag", row)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).options(**options).save(location)


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    location = scratch_dir(spark, "orders")
    write_xml(order_rows_for_xml(spark, sf_dir), location, "orders", "order")
    return location


def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_orders(read_records(spark, _order_files(spark, sf_dir), ORDERS, scan="record"))


def xml_scan_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_orders(read_records(spark, _order_files(spark, sf_dir), ORDERS, scan="document"))


#: Least bytes of a partition in the queries that cut files.
SMALL_PART = 64 * 1024


def _small_part(spark: SparkSession, location: str) -> int:
    """Bytes of partitions so small that the files below a folder are really cut, whatever the size of the tables: a
    quarter of the longest file. So a file is the work of a few tasks, and their number grows no faster than the input."""
    longest = list_files(spark, location).agg(F.max("file_size")).first()[0]
    return max(SMALL_PART, -(-(longest or 0) // 4))


def _cut_small(spark: SparkSession, location: str, spec: XmlSpec, scan: str = "split") -> DataFrame:
    """A scan with partitions so small that files are really cut at any size of the tables."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, _small_part(spark, location))
    try:
        return read_records(spark, location, spec, scan=scan)
    finally:
        spark.conf.set(name, before)


def xml_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_orders(_cut_small(spark, _order_files(spark, sf_dir), ORDERS))


def xml_scan_auto_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed of files that can be cut and files that cannot: children named alike, another encoding, compressed files,
    prefixed records, and records that hold an element of their own name."""
    rows, base = order_rows_for_xml(spark, sf_dir), scratch_dir(spark, "mixed")
    share = lambda n: rows.where(F.col("_id") % 5 == n)
    alike = share(0).withColumn("orderdate", F.struct(F.col("_id").alias("_order")))
    write_xml(alike, f"{base}/alike", "orders", "order")
    declared = {"encoding": "windows-1251", "declaration": "version='1.0' encoding='windows-1251'"}
    write_xml(share(1).withColumn("note", F.lit("Привет")), f"{base}/encoded", "orders", "order", **declared)
    write_xml(share(2), f"{base}/packed", "orders", "order", compression="gzip")
    write_xml(share(3), f"{base}/prefixed", "p:orders xmlns:p='urn:p'", "p:order", validateName="false")
    write_xml(share(4).withColumn("order", F.struct(F.lit(-1).alias("_id"))), f"{base}/nested", "orders", "order")
    return typed_orders(_cut_small(spark, base, ORDERS, "auto"))


def xml_scan_other_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files have another root element; their orders are at another path."""
    rows, base = order_rows_for_xml(spark, sf_dir), scratch_dir(spark, "roots")
    write_xml(rows.where(F.col("_id") % 2 == 0), f"{base}/orders", "orders", "order")
    below = rows.where(F.col("_id") % 2 == 1).select(F.struct("*").alias("order"))
    write_xml(below, f"{base}/others", "archive", "orders")
    scans = [typed_orders(read_records(spark, base, ORDERS, scan=scan)) for scan in ("auto", "document", "record")]
    return scans[0].union(scans[1]).union(scans[2])


def scan_split_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in which every record holds another one of its name: none of them can be cut."""
    rows = order_rows_for_xml(spark, sf_dir).withColumn("order", F.struct((-F.col("_id")).alias("_id")))
    location = scratch_dir(spark, "fallback")
    write_xml(rows, location, "orders", "order")
    return typed_orders(_cut_small(spark, location, ORDERS))


def xml_scan_strict_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders at feed/batch/order; the orders at feed/batch/archive/order and inside an order are none."""
    rows = order_rows_for_xml(spark, sf_dir).select(
        F.struct("*", F.struct(F.col("_id")).alias("order")).alias("order"),
        F.struct(F.struct((-F.col("_id")).alias("_id")).alias("order")).alias("archive"),
    )
    location = scratch_dir(spark, "strict")
    write_xml(rows, location, "feed", "batch")
    spec = XmlSpec(("feed", "batch", "order"), ORDER_VALUES)
    return typed_orders(read_records(spark, location, spec))


def xml_scan_namespaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_rows_for_xml(spark, sf_dir)
    prefixed = rows.select(
        F.col("_id").alias("_s:id"),
        F.col("_status"),
        F.col("price").alias("s:price"),
        F.col("priority").alias("t:priority"),
    )
    location = scratch_dir(spark, "namespaced")
    root = "s:orders xmlns:s='urn:example:s' xmlns:t='urn:example:t'"
    write_xml(prefixed, location, root, "s:order", validateName="false")
    return typed_orders(read_records(spark, location, ORDERS))


# Encoding -> a prefix whose letters need it.
_ENCODINGS = {"UTF-8": "Привет €", "UTF-16": "Привет €", "windows-1251": "Привет", "ISO-8859-1": "Grüße"}


def xml_scan_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files of four encodings, read back in one scan that is told none of them."""
    customers = table(spark, sf_dir, "customer")
    base = scratch_dir(spark, "encodings")
    for number, (encoding, prefix) in enumerate(_ENCODINGS.items()):
        share = customers.where(F.col("c_custkey") % len(_ENCODINGS) == number).select(
            F.col("c_custkey").alias("_id"), F.concat(F.lit(prefix + " "), "c_name").alias("name")
        )
        declaration = f"version='1.0' encoding='{encoding}'"
        write_xml(share, f"{base}/{number}", "customers", "customer", encoding=encoding, declaration=declaration)
    spec = XmlSpec(("customers", "customer"), {"c_custkey": attribute("id"), "label": content("name")})
    return read_records(spark, base, spec).select(as_type("c_custkey", "bigint"), "label")


def _cut_natively(spark: SparkSession, location: str, spec: XmlSpec) -> DataFrame:
    """Records of an ``auto`` scan in small splits, with whether none of the files had to be streamed."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, _small_part(spark, location))
    try:
        rows, folders = cut_records(spark, location, spec, F.col("_metadata.file_size") > 0)
    finally:
        spark.conf.set(name, before)
    return rows.withColumn("cut", F.lit(spark.read.parquet(folders[-1]).isEmpty()))


_CUT_ENCODINGS = ("windows-1251", "koi8-r", "UTF-16", "ISO-8859-5")


def xml_scan_split_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in files of four encodings, of single bytes and of pairs; each file is cut in its own."""
    rows, base = order_rows_for_xml(spark, sf_dir), scratch_dir(spark, "coded")
    rows = rows.withColumn("note", F.concat(F.lit("Заказ "), "priority"))
    for number, encoding in enumerate(_CUT_ENCODINGS):
        share = rows.where(F.col("_id") % len(_CUT_ENCODINGS) == number)
        declaration = f"version='1.0' encoding='{encoding}'"
        write_xml(share, f"{base}/{number}", "orders", "order", encoding=encoding, declaration=declaration)
    spec = XmlSpec(("orders", "order"), {**ORDER_VALUES, "note": content("note")})
    found = _cut_natively(spark, base, spec)
    return found.select(*[as_type(name, type_) for name, type_ in ORDER_TYPES.items()], "note", "cut")


def xml_scan_nested_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders at feed/batch/order that hold orders, beside archived orders, in batches that end and begin within a file.
    Pieces of a file are put together to whole records in many tasks; no file is streamed."""
    rows = order_rows_for_xml(spark, sf_dir).select(
        F.struct("*", F.struct(F.col("_id"), F.struct((-F.col("_id")).alias("_id")).alias("order")).alias("order")).alias("order"),
        F.struct(F.struct((-F.col("_id")).alias("_id")).alias("order")).alias("archive"),
    )
    location = scratch_dir(spark, "nested")
    write_xml(rows, location, "feed", "batch")
    found = _cut_natively(spark, location, XmlSpec(("feed", "batch", "order"), ORDER_VALUES))
    return found.select(*[as_type(name, type_) for name, type_ in ORDER_TYPES.items()], "cut")


def xml_scan_second_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that go on after their root was closed, every third with another root of orders: the records before the
    error once, and one marker for each document, in both scans."""
    base = scratch_dir(spark, "roots")
    part = F.pmod("o_orderkey", F.lit(7)).alias("part")
    orders = table(spark, sf_dir, "orders").select(part, F.lit(1).alias("step"), "o_orderkey", order_element().alias("value"))
    tail = F.when(F.col("part") % 3 == 0, "<orders><order id='-1'/></orders>").when(F.col("part") % 3 == 1, "<x/>").otherwise("text")
    parts = orders.select("part").distinct()
    none = F.lit(0).cast("long").alias("o_orderkey")
    heads = parts.select("part", F.lit(0).alias("step"), none, F.lit("<orders>").alias("value"))
    tails = parts.select("part", F.lit(2).alias("step"), none, F.concat(F.lit("</orders>"), tail).alias("value"))
    # A document is one file, and its rows are streamed into it.
    rows = orders.unionByName(heads).unionByName(tails).repartition(7, "part").sortWithinPartitions("part", "step", "o_orderkey")
    rows.select("part", "value").write.partitionBy("part").option("lineSep", " ").text(base)
    out = []
    for scan in ("auto", "document"):
        rows = read_records(spark, base, ORDERS, scan=scan, glob=None)
        typed = [as_type("o_orderkey", "bigint"), F.col("_malformed").alias("malformed"), F.lit(scan).alias("scan")]
        out.append(rows.select(*typed))
    return out[0].unionByName(out[1])


def xml_dir_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in nested folders beside files that are no XML by their name."""
    rows = order_rows_for_xml(spark, sf_dir)
    base = scratch_dir(spark, "dirs")
    folders = rows.withColumn("region", F.col("_id") % 3).withColumn("part", F.col("_status"))
    folders.write.format("xml").options(rootTag="orders", rowTag="order", maxRecordsPerFile=str(RECORDS_PER_FILE)).partitionBy(
        "region", "part"
    ).save(f"{base}/xml")
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/xml_but_text")
    return typed_orders(read_records(spark, base, ORDERS))


def _named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("orders_"), day, F.lit("_F.xml")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("new-orders_"), day, F.lit(".xml.gz")))
        .otherwise(F.concat(F.lit("misc_"), day, F.lit(".txt")))
    )
    return table(spark, sf_dir, "orders").withColumn("file_name", name)


_ID_VALUES = {"id": attribute("id")}
_ROUTES = [
    Mapping(XmlSpec(("a",), _ID_VALUES, files=("^orders_199[0-4]", r"^orders_\d+_X")), {TableId("t0"): TableSpec()}),
    Mapping(XmlSpec(("a",), _ID_VALUES, files=(r"orders_\d{8}(_[A-Z])?\.xml$",)), {TableId("t1"): TableSpec()}),
    Mapping(XmlSpec(("a",), _ID_VALUES, files=("orders",)), {TableId("t2"): TableSpec()}),
]


def file_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_named_orders(spark, sf_dir), _ROUTES).select("o_orderkey", "mapping_index")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a directory scan finds, and that every file found has records."""
    location = _order_files(spark, sf_dir)
    files = list_files(spark, location)
    records = read_records(spark, location, ORDERS, scan="record").groupBy("_source").count()
    found = files.join(records, F.col("_source") == F.col("file_path"), "left")
    return found.agg(
        F.sum("count").alias("records"), F.count_if(F.col("count").isNull()).alias("files_without_records")
    )


_NAME_PATTERNS = (r"^(?<kind>orders)_(?<day>\d{8})_(?<status>[A-Z])", r"^(\w+)-(orders)_(?<day>\d{4})")


def filename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.col("file_name")
    return _named_orders(spark, sf_dir).select(
        "o_orderkey", *[filename_value(names, _NAME_PATTERNS, group).alias(group) for group in ("kind", "day", "status")]
    )


def xml_column_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents held in a table column."""
    return typed_orders(parse_column(order_documents(spark, sf_dir), "doc", ORDERS))


QUERIES = {
    "xml_scan": xml_scan,
    "xml_scan_document": xml_scan_document,
    "xml_scan_split": xml_scan_split,
    "xml_scan_auto_mixed": xml_scan_auto_mixed,
    "xml_scan_other_root": xml_scan_other_root,
    "scan_split_fallback": scan_split_fallback,
    "xml_scan_strict_path": xml_scan_strict_path,
    "xml_scan_namespaced": xml_scan_namespaced,
    "xml_scan_encodings": xml_scan_encodings,
    "xml_scan_split_encodings": xml_scan_split_encodings,
    "xml_scan_nested_split": xml_scan_nested_split,
    "xml_scan_second_root": xml_scan_second_root,
    "xml_dir_scan": xml_dir_scan,
    "xml_column_scan": xml_column_scan,
    "file_listing": file_listing,
    "file_routing": file_routing,
    "filename_columns": filename_columns,
}

_PREFIX_SQL = " ".join(
    f"WHEN {number} THEN '{prefix} '" for number, prefix in enumerate(_ENCODINGS.values())
)

ORACLES = {
    **{
        name: _ORDERS_SQL
        for name in (
            "xml_scan",
            "xml_scan_document",
            "xml_scan_split",
            "xml_scan_auto_mixed",
            "scan_split_fallback",
            "xml_scan_strict_path",
            "xml_scan_namespaced",
            "xml_dir_scan",
            "xml_column_scan",
        )
    },
    "xml_scan_other_root": f"{_ORDERS_SQL}, range(3) WHERE o_orderkey % 2 = 0",
    "xml_scan_encodings": f"""
        SELECT c_custkey, CASE c_custkey % {len(_ENCODINGS)} {_PREFIX_SQL} END || c_name AS label FROM customer""",
    "xml_scan_split_encodings": f"SELECT *, 'Заказ ' || o_orderpriority AS note, true AS cut FROM ({_ORDERS_SQL})",
    "xml_scan_nested_split": f"SELECT *, true AS cut FROM ({_ORDERS_SQL})",
    "xml_scan_second_root": """
        SELECT o_orderkey, false AS malformed, scan FROM orders, (VALUES ('auto'), ('document')) AS s(scan)
        UNION ALL
        SELECT NULL, true, scan FROM (SELECT DISTINCT o_orderkey % 7 FROM orders), (VALUES ('auto'), ('document')) AS s(scan)""",
    "file_listing": "SELECT count(*) AS records, CAST(0 AS BIGINT) AS files_without_records FROM orders",
    "file_routing": """
        SELECT o_orderkey,
               CAST(CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) BETWEEN 1990 AND 1994 THEN 0
                         WHEN o_orderstatus IN ('F', 'O') THEN 1 END AS INTEGER) AS mapping_index
        FROM orders""",
    "filename_columns": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN 'orders' END AS kind,
               CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
                                  WHEN 'O' THEN strftime(o_orderdate, '%Y') END AS day,
               CASE WHEN o_orderstatus = 'F' THEN 'F' END AS status
        FROM orders""",
}
