"""De-duplication, upsert, sinks, reports and streaming: U1-U8, R1-R3, ST1."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import cast_to
from feedloom.operators.dedup import batch_winner, dedup_first, mark_missing_key, number_rows
from feedloom.operators.reports import file_counts, run_summary, table_counts
from feedloom.operators.upsert import upsert
from feedloom.operators.validate import annotate, validate
from feedloom.plans.columns import REASON
from feedloom.plans.load import run
from feedloom.plans.mapping import Mapping, TableId, TableSpec, XmlSpec
from feedloom.sinks.tables import ParquetTables, _hadoop_path, scratch_dir
from feedloom.sources.xml import parse_column
from feedloom.streaming.ingest import run_stream
from feedloom_queries.common import attribute, content, order_documents, order_rows_for_xml, table
from feedloom_queries.fanout import MAPPING, line_documents, materialised
from feedloom_queries.scans import write_xml


def dedup_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"])


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    return dedup_first(lines, ["l_partkey"], order, keep="last")


def missing_key_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("event_id") % 6 != 0, F.col("user_id"))
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", user.alias("user_id"), kind.alias("event_type"))
    return mark_missing_key(rows, ["user_id", "event_type"]).withColumnRenamed(REASON, "reason")


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each source numbered without bringing a source into one task."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    return number_rows(events, "event_type", [F.col("event_id")], name="sequence", chunk=512)


BATCH = 50


def batch_winner_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "value")
    return batch_winner(events, ["user_id"], "event_type", [F.col("event_id")], BATCH)


CUSTOMER = TableId("customer")
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType(), False),
        T.StructField("c_name", T.StringType(), True, {"default": "unknown"}),
        T.StructField("c_nationkey", T.IntegerType(), True, {"default": "-1"}),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType(), True, {"default": "never used"}),
    ]
)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New balances and segments from the last order of each customer; half of the keys are no customers."""
    orders = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 2).alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        "o_orderkey",
    )
    return dedup_first(orders, ["c_custkey"], ["o_orderkey"], keep="last").drop("o_orderkey")


def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(table(spark, sf_dir, "customer"), _changes(spark, sf_dir), ["c_custkey"], CUSTOMER_SCHEMA)


def upsert_update_small_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a source that was written and measured: it is broadcast if it is small, and not otherwise."""
    from feedloom.sinks.tables import directory_bytes

    location = scratch_dir(spark, "changes")
    _changes(spark, sf_dir).write.parquet(location)
    written, size = spark.read.parquet(location), directory_bytes(spark, location)
    return upsert(table(spark, sf_dir, "customer"), written, ["c_custkey"], CUSTOMER_SCHEMA, size)


def upsert_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _changes(spark, sf_dir).select("c_custkey")
    return upsert(table(spark, sf_dir, "customer"), keys, ["c_custkey"], CUSTOMER_SCHEMA)


def append_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(table(spark, sf_dir, "customer"), _changes(spark, sf_dir), [], CUSTOMER_SCHEMA)


def table_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into a filled table, and an append that is repeated and must not count twice."""
    store = ParquetTables(spark, scratch_dir(spark, "store"), {CUSTOMER: CUSTOMER_SCHEMA})
    store.load(CUSTOMER, table(spark, sf_dir, "customer"), ["c_custkey"], token="first")
    store.load(CUSTOMER, _changes(spark, sf_dir), ["c_custkey"], token="second")
    for _ in range(2):
        store.load(CUSTOMER, _changes(spark, sf_dir), [], token="third")
    return store.read(CUSTOMER)


ORDERS, PRICES = TableId("orders", "shop"), TableId("prices", "shop")
LOAD_MAPPING = Mapping(
    XmlSpec(
        ("orders", "order"),
        {
            "shop.orders.id": attribute("id", required=True),
            "shop.orders.status": attribute("status"),
            "shop.prices.order_id": attribute("id"),
            "shop.prices.amount": content("price"),
            "shop.prices.currency": content("currency", default_value="EUR"),
        },
        enums={"shop.orders.status": frozenset({"O", "F"})},
    ),
    {ORDERS: TableSpec(("id",)), PRICES: TableSpec()},
)
LOAD_TARGETS = {
    ORDERS: T.StructType([T.StructField("id", T.LongType(), False), T.StructField("status", T.StringType())]),
    PRICES: T.StructType(
        [
            T.StructField("order_id", T.LongType()),
            T.StructField("amount", T.DecimalType(12, 2)),
            T.StructField("currency", T.StringType(), False),
        ]
    ),
}


def _loaded(store: ParquetTables) -> DataFrame:
    orders = store.read(ORDERS).select(F.lit("orders").alias("table_name"), F.col("id"), F.col("status").alias("text"),
                                       F.lit(None).cast("decimal(12,2)").alias("amount"))
    prices = store.read(PRICES).select(F.lit("prices"), "order_id", "currency", "amount")
    return orders.union(prices)


def multi_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders through a whole run into two tables; every order is in two files."""
    base = scratch_dir(spark, "feed")
    rows = order_rows_for_xml(spark, sf_dir)
    write_xml(rows, f"{base}/a", "orders", "order")
    write_xml(rows.withColumn("price", -F.col("price")), f"{base}/b", "orders", "order")
    store = ParquetTables(spark, scratch_dir(spark, "store"), LOAD_TARGETS)
    run(spark, base, [LOAD_MAPPING], store, LOAD_TARGETS)
    return _loaded(store)


NOTES = TableId("notes", "shop")
NOTES_MAPPING = Mapping(
    XmlSpec(("notes", "note"), {"shop.notes.of": attribute("of")}, files=("notes",)), {NOTES: TableSpec()}
)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a stream of two mappings in two rounds: the second round picks up only what is new. A file with
    wrong bytes and a broken one are among them, and the last batch is run twice, as after a failure."""
    base, checkpoint = scratch_dir(spark, "feed"), scratch_dir(spark, "checkpoint")
    rows = order_rows_for_xml(spark, sf_dir)
    targets = LOAD_TARGETS | {NOTES: T.StructType([T.StructField("of", T.LongType())])}
    store = ParquetTables(spark, scratch_dir(spark, "store"), targets)
    orders = Mapping(replace(LOAD_MAPPING.xml, files=("part",)), LOAD_MAPPING.db)
    for name, part in (("a", rows), ("b", rows.withColumn("price", -F.col("price")))):
        write_xml(part, f"{base}/{name}", "orders", "order")
        notes = part.agg(F.min("_id").alias("id")).select(F.lit("<notes><note of='").alias("x"), "id")
        wrong = notes.select(F.concat("x", F.col("id").cast("string"), F.lit("'>"), F.lit("</note><note>")).alias("value"))
        wrong.coalesce(1).write.option("lineSep", " ").text(f"{base}/{name}-notes")
        _renamed(spark, f"{base}/{name}-notes", f"{base}/notes_{name}.xml")
        work = scratch_dir(spark, "stream")
        for _ in range(2 if name == "b" else 1):
            run_stream(spark, base, [orders, NOTES_MAPPING], store, targets, checkpoint, work_dir=work).awaitTermination()
            if name == "b":
                _forget_last_commit(spark, checkpoint)
    told = store.read(NOTES).select(F.lit("notes").alias("table_name"), F.lit(None).cast("long").alias("id"),
                                    F.lit("kept before the error").alias("text"), F.lit(None).cast("decimal(12,2)").alias("amount"))
    return _loaded(store).union(told)


def _renamed(spark: SparkSession, folder: str, target: str) -> None:
    """The one part file of a folder as a file of another name."""
    system, path = _hadoop_path(spark, folder)
    part = next(s.getPath() for s in system.listStatus(path) if s.getPath().getName().startswith("part-"))
    system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(target))


def _forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    system, path = _hadoop_path(spark, f"{checkpoint}/commits")
    last = max((s.getPath() for s in system.listStatus(path) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    system.delete(last, False)


def order_upsert_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From documents in a column to the upserted orders table, in one lazy plan."""
    spec = LOAD_MAPPING.xml
    records = parse_column(order_documents(spark, sf_dir), "doc", spec, source_column="o_orderkey")
    valid, _ = validate(records, spec)
    rows = valid.select(F.col("`shop.orders.id`").alias("id"), F.col("`shop.orders.status`").alias("status"), "_position")
    typed, _ = cast_to(rows, LOAD_TARGETS[ORDERS], carried=["_position"])
    unique = dedup_first(typed, ["id"], ["_position"]).drop("_position")
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("status"))
    return upsert(known, unique, ["id"], LOAD_TARGETS[ORDERS])


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders documents, one name for all orders of a year."""
    named = order_documents(spark, sf_dir).withColumn("name", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit(".xml")))
    broken = F.when(F.col("o_orderkey") % 100 == 7, F.replace("doc", F.lit("</order>"), F.lit(""))).otherwise(F.col("doc"))
    spec = LOAD_MAPPING.xml
    return annotate(parse_column(named.withColumn("doc", broken), "doc", spec, source_column="name"), spec)


def report_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_counts(_annotated(spark, sf_dir))


def report_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedloom.operators.fanout import fan_out

    named = line_documents(spark, sf_dir).withColumn("name", F.concat(F.date_format("l_shipdate", "yyyy"), F.lit(".xml")))
    records = parse_column(named, "doc", MAPPING.xml, source_column="name")
    tables = fan_out(materialised(validate(records, MAPPING.xml)[0]), MAPPING)
    return table_counts(tables, {identifier: 100 for identifier in tables})


def report_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(file_counts(_annotated(spark, sf_dir)).withColumn("failed", F.col("malformed")))


QUERIES = {
    "dedup_first": dedup_first_query,
    "dedup_last": dedup_last,
    "missing_key_reject": missing_key_reject,
    "row_numbers": row_numbers,
    "batch_winner": batch_winner_query,
    "upsert_update": upsert_update,
    "upsert_update_small_source": upsert_update_small_source,
    "upsert_nothing": upsert_nothing,
    "append_insert": append_insert,
    "table_sink_roundtrip": table_sink_roundtrip,
    "multi_table_load": multi_table_load,
    "stream_upsert": stream_upsert,
    "order_upsert_flow": order_upsert_flow,
    "report_file_counts": report_file_counts,
    "report_table_rows": report_table_rows,
    "report_run_summary": report_run_summary,
}

_CHANGES_SQL = """
    (SELECT o_custkey * 2 AS c_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS c_acctbal,
            o_orderpriority AS c_mktsegment
     FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)"""

_UPSERT_SQL = f"""
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
           CASE WHEN t.c_custkey IS NULL THEN 'unknown' ELSE t.c_name END AS c_name,
           CASE WHEN t.c_custkey IS NULL THEN -1 ELSE t.c_nationkey END AS c_nationkey,
           CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
           CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
    FROM customer t FULL JOIN {_CHANGES_SQL} s ON t.c_custkey = s.c_custkey"""

_APPEND_SQL = f"""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT c_custkey, 'unknown', -1, c_acctbal, c_mktsegment FROM {_CHANGES_SQL}"""


def _loaded_sql(price: str) -> str:
    kept = "FROM orders WHERE o_orderstatus IN ('O', 'F')"
    amount = "CAST({} AS DECIMAL(12, 2)) AS amount"
    return f"""
        SELECT 'orders' AS table_name, o_orderkey AS id, o_orderstatus AS text, CAST(NULL AS DECIMAL(12, 2)) AS amount {kept}
        UNION ALL
        SELECT 'prices', o_orderkey, 'EUR', {amount.format('o_totalprice')} {kept}
        UNION ALL
        SELECT 'prices', o_orderkey, 'EUR', {amount.format(price)} {kept}"""


_YEARS_SQL = """
    (SELECT strftime(o_orderdate, '%Y') || '.xml' AS source, o_orderkey % 100 = 7 AS broken, o_orderstatus <> 'P' AS good
     FROM orders)"""

_FILE_COUNTS_SQL = f"""
    SELECT source, count(*) FILTER (good AND NOT broken) AS processed,
           count(*) FILTER (NOT good AND NOT broken) AS skipped, bool_or(broken) AS malformed
    FROM {_YEARS_SQL} GROUP BY source"""

ORACLES = {
    "dedup_first": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "dedup_last": """
        SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1""",
    "missing_key_reject": """
        SELECT event_id, user_id, event_type,
               CASE WHEN user_id IS NULL THEN 'missing_key:user_id'
                    WHEN event_type IS NULL THEN 'missing_key:event_type' END AS reason
        FROM (SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN user_id END AS user_id,
                     CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events)""",
    "row_numbers": """
        SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS sequence
        FROM events""",
    "batch_winner": f"""
        SELECT event_type, event_id, user_id, value FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS seq FROM events)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, seq // {BATCH} DESC, seq) = 1""",
    "upsert_update": _UPSERT_SQL,
    "upsert_update_small_source": _UPSERT_SQL,
    "upsert_nothing": f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
        UNION ALL
        SELECT c_custkey, 'unknown', -1, NULL, 'never used' FROM {_CHANGES_SQL}
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
    "append_insert": _APPEND_SQL,
    "table_sink_roundtrip": f"""{_UPSERT_SQL}
        UNION ALL SELECT c_custkey, 'unknown', -1, c_acctbal, c_mktsegment FROM {_CHANGES_SQL}""",
    "multi_table_load": _loaded_sql("-o_totalprice"),
    "stream_upsert": _loaded_sql("-o_totalprice")
    + """
        UNION ALL SELECT 'notes', CAST(NULL AS BIGINT), 'kept before the error', CAST(NULL AS DECIMAL(12, 2)) FROM range(2)""",
    "order_upsert_flow": """
        SELECT coalesce(s.id, t.c_custkey) AS id, CASE WHEN s.id IS NULL THEN c_mktsegment ELSE s.status END AS status
        FROM customer t FULL JOIN (
            SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus IN ('O', 'F')) s
        ON t.c_custkey = s.id""",
    "report_file_counts": _FILE_COUNTS_SQL,
    "report_table_rows": """
        SELECT source, table_name, CAST(ceil(count(*) / 100.0) AS BIGINT) AS batches, count(*) AS "rows" FROM (
            SELECT strftime(l_shipdate, '%Y') || '.xml' AS source, 'shop.lines' AS table_name FROM lineitem
            UNION ALL
            SELECT strftime(l_shipdate, '%Y') || '.xml', 'shop.shipments' FROM lineitem WHERE l_linenumber <> 3)
        GROUP BY source, table_name""",
    "report_run_summary": f"""
        SELECT count(*) AS files_found, count(*) FILTER (NOT malformed) AS files_loaded,
               count(*) FILTER (malformed) AS files_failed
        FROM ({_FILE_COUNTS_SQL})""",
}
