"""Bucketed tables: upserts that touch some buckets, loads of several tables at once, merged appends (U4, U6, U7, U8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.ledger import FileLedger, run_new
from feedloom.plans.load import run
from feedloom.plans.mapping import Mapping, TableId, TableSpec, XmlSpec
from feedloom.sinks.buckets import BucketTables
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.files import list_files
from feedloom_queries.common import attribute, content, order_rows_for_xml, table
from feedloom_queries.scans import write_xml

ORDERS = TableId("orders")
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType(), True, {"default": "-1"}),
        T.StructField("o_orderstatus", T.StringType(), True, {"default": "N"}),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)
NAMES = [field.name for field in ORDER_SCHEMA.fields]
ROWS_PER_BUCKET = 2_048


def upsert_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then the changes of one day: its orders are doubled in price, and each gets a new one beside it.
    Files of buckets without a change have to be the same ones afterwards; ``untouched`` says whether some are. A day is
    a part of the orders, so buckets become more with the orders; with a fixed number a day of many orders touches all."""
    store = BucketTables(spark, scratch_dir(spark, "store"), {ORDERS: ORDER_SCHEMA}, buckets=256, rows_per_bucket=ROWS_PER_BUCKET)
    orders = table(spark, sf_dir, "orders")
    store.load(ORDERS, orders.select(NAMES), ["o_orderkey"])
    before = set(store.files(ORDERS))
    last = orders.join(F.broadcast(orders.agg(F.max("o_orderdate").alias("o_orderdate"))), "o_orderdate")
    price = (2 * F.col("o_totalprice")).alias("o_totalprice")
    changed = last.select("o_orderkey", price).unionByName(last.select((-F.col("o_orderkey")).alias("o_orderkey"), price))
    store.load(ORDERS, changed, ["o_orderkey"])
    kept = before & set(store.files(ORDERS))
    return store.read(ORDERS).withColumn("untouched", F.lit(0 < len(kept) < len(before)))


FEED = TableId("orders", "shop"), TableId("prices", "shop"), TableId("priorities", "shop")
FEED_MAPPING = Mapping(
    XmlSpec(
        ("orders", "order"),
        {
            "shop.orders.id": attribute("id", required=True),
            "shop.orders.status": attribute("status"),
            "shop.prices.order_id": attribute("id"),
            "shop.prices.amount": content("price"),
            "shop.priorities.order_id": attribute("id"),
            "shop.priorities.priority": content("priority"),
        },
    ),
    {FEED[0]: TableSpec(("id",)), FEED[1]: TableSpec(("order_id",)), FEED[2]: TableSpec()},
)
FEED_TARGETS = {
    FEED[0]: T.StructType([T.StructField("id", T.LongType(), False), T.StructField("status", T.StringType())]),
    FEED[1]: T.StructType([T.StructField("order_id", T.LongType(), False), T.StructField("amount", T.DecimalType(12, 2))]),
    FEED[2]: T.StructType([T.StructField("order_id", T.LongType()), T.StructField("priority", T.StringType())]),
}


class _Broken(BucketTables):
    """A store whose third table cannot be written, from some moment on."""

    broken = False

    def transaction(self, token=None):
        changes = super().transaction(token)
        load = changes.load

        def failing(table, rows, keys, token=None, source_bytes=None):
            if self.broken and table == FEED[2]:
                rows = rows.withColumn("order_id", F.raise_error(F.lit("no space left")).cast("long"))
            load(table, rows, keys, token, source_bytes)

        changes.load = failing
        return changes


def load_all_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over feeds of all orders into three tables. The second one changes every price and fails at its third
    table, so nothing of it is there; the third one negates prices and is there as a whole."""
    base = scratch_dir(spark, "feed")
    rows = order_rows_for_xml(spark, sf_dir)
    for name, factor in (("a", 1), ("b", 2), ("c", -1)):
        write_xml(rows.withColumn("price", factor * F.col("price")), f"{base}/{name}", "orders", "order")
    store = _Broken(spark, scratch_dir(spark, "store"), FEED_TARGETS, buckets=16)
    load = lambda name: run(spark, f"{base}/{name}", [FEED_MAPPING], store, FEED_TARGETS).clean()
    load("a")
    store.broken = True
    try:
        load("b")
        failed = False
    except Exception:
        failed = True
    between = {t: store.read(t) for t in FEED}  # a reader that stays open during the third run
    store.broken = False
    load("c")
    tables = []
    for at, read in (("failed", between), ("loaded", {t: store.read(t) for t in FEED})):
        for t, (key, value) in zip(FEED, (("id", "status"), ("order_id", "amount"), ("order_id", "priority")), strict=True):
            tables.append(
                read[t].select(
                    F.lit(at).alias("after"), F.lit(t.name).alias("table_name"), F.col(key).alias("id"),
                    F.col(value).cast("string").alias("value"), F.lit(failed).alias("told"),
                )
            )
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


PRIORITIES = TableId("by_day")


def append_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append for every month of the orders. Chains of versions stay short, and a reader from before the last append
    and its merge still reads what it saw."""
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("month", T.StringType())])
    store = BucketTables(spark, scratch_dir(spark, "store"), {PRIORITIES: schema}, chain=4)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM").alias("month"))
    reader, longest = None, 0
    for month in range(1, 13):
        if month == 12:
            reader = store.read(PRIORITIES)
        store.load(PRIORITIES, orders.where(F.col("month") == f"{month:02d}"), [])
        longest = max(longest, len({p.rpartition("/")[0] for p in store.files(PRIORITIES)}))
    rows = store.read(PRIORITIES).withColumn("seen", F.lit("at the end"))
    return rows.unionByName(reader.withColumn("seen", F.lit("before"))).withColumn("short", F.lit(longest <= 4))


def run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of order feeds that grows: every run appends what is new, and opens nothing else. Between the runs files
    are added; before the third one a run dies after its load, and its batch is repeated without doubling a row."""
    base, ledger = scratch_dir(spark, "feed"), scratch_dir(spark, "ledger")
    rows = order_rows_for_xml(spark, sf_dir)
    store = BucketTables(spark, scratch_dir(spark, "store"), FEED_TARGETS, buckets=16)
    mapping = Mapping(FEED_MAPPING.xml, {t: TableSpec() for t in FEED})
    opened = []

    def loaded(written: int) -> None:
        reports = run_new(spark, base, [mapping], store, FEED_TARGETS, ledger)
        opened.append(sum(report.files.count() for report in reports) == written)

    for number in range(3):
        write_xml(rows.where(F.pmod("_id", F.lit(3)) == number).coalesce(1), f"{base}/{number}", "orders", "order")
        written = list_files(spark, f"{base}/{number}").count()
        if number == 2:
            end, FileLedger.end = FileLedger.end, _dies
            try:
                loaded(written)
            except InterruptedError:
                pass
            finally:
                FileLedger.end = end
        loaded(written)
    loaded(0)
    prices = store.read(FEED[1]).select("order_id", F.col("amount").cast("string").alias("amount"))
    return prices.withColumn("opened", F.lit(all(opened)))


def _dies(ledger: FileLedger, token: str) -> None:
    raise InterruptedError(token)


QUERIES = {
    "run_twice": run_twice,
    "upsert_touched_buckets": upsert_touched_buckets,
    "load_all_or_none": load_all_or_none,
    "append_merged": append_merged,
}

_LAST = "(SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders))"


def _feed_sql(after: str, price: str) -> str:
    return f"""
        SELECT '{after}' AS after, 'orders' AS table_name, o_orderkey AS id, o_orderstatus AS value, true AS told FROM orders
        UNION ALL SELECT '{after}', 'prices', o_orderkey, CAST(CAST({price} AS DECIMAL(12, 2)) AS VARCHAR), true FROM orders
        UNION ALL SELECT '{after}', 'priorities', o_orderkey, o_orderpriority, true FROM orders"""


ORACLES = {
    "run_twice": """
        SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS amount, true AS opened
        FROM orders""",
    "upsert_touched_buckets": f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CASE WHEN l.o_orderkey IS NULL THEN 1 ELSE 2 END * o.o_totalprice AS o_totalprice,
               true AS untouched
        FROM orders o LEFT JOIN {_LAST} l USING (o_orderkey)
        UNION ALL SELECT -o_orderkey, -1, 'N', 2 * o_totalprice, true FROM {_LAST}""",
    "load_all_or_none": _feed_sql("failed", "o_totalprice")
    + " UNION ALL "
    + _feed_sql("loaded", "-o_totalprice")
    + """
        UNION ALL SELECT 'loaded', 'priorities', o_orderkey, o_orderpriority, true FROM orders""",
    "append_merged": """
        SELECT o_orderkey, strftime(o_orderdate, '%m') AS month, 'at the end' AS seen, true AS short FROM orders
        UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%m'), 'before', true FROM orders WHERE month(o_orderdate) < 12""",
}
