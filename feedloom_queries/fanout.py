"""Fan-out to tables: M1-M5."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.fanout import fan_out, project_to_target
from feedloom.operators.validate import validate
from feedloom.plans.mapping import Mapping, TableId, TableSpec, XmlSpec
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.xml import parse_column
from feedloom_queries.common import as_type, attribute, content, element, table, text_of

_ROOT = ("lines", "line")
LINES, SHIPMENTS = TableId("lines", "shop"), TableId("shipments", "shop")


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line item, named like a file. Discounts of 0 and the flag N are left blank."""
    day = F.date_format("l_shipdate", "yyyyMMdd")
    discount = F.when(F.col("l_discount") == 0, F.lit(" ")).otherwise(F.col("l_discount").cast("string"))
    flag = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag"))
    shipped = F.when(
        F.col("l_linenumber") != 3,
        element("shipment", text_of(F.col("l_shipdate")), attributes={"state": F.col("l_linestatus")}),
    ).otherwise(F.lit(""))
    line = element(
        "line",
        element("quantity", text_of(F.col("l_quantity"))),
        element("discount", text_of(discount)),
        shipped,
        attributes={"order": F.col("l_orderkey"), "number": F.col("l_linenumber"), "flag": flag},
    )
    name = F.concat(
        F.lit("lines_"), F.when(F.col("l_linestatus") == "O", day).otherwise(F.lit("undated")), F.lit(".xml")
    )
    return table(spark, sf_dir, "lineitem").withColumn("doc", element("lines", line)).withColumn("file_name", name)


MAPPING = Mapping(
    XmlSpec(
        _ROOT,
        {
            "shop.lines.order_id": attribute("order", required=True),
            "shop.lines.line_no": attribute("number"),
            "shop.lines.quantity": content("quantity"),
            "shop.lines.discount": content("discount", default_value="-1"),
            "shop.lines.flag": attribute("flag"),
            "shop.lines.day": attribute("flag"),
            "shop.shipments.state": attribute("shipment", "state"),
            "shop.shipments.shipped_at": content("shipment"),
            "check": attribute("flag", not_for_save=True, default_value="unused"),
        },
        files=(r"^lines_(?:(?<day>\d{8})|undated)",),
    ),
    {LINES: TableSpec(("order_id", "line_no"), filename_groups_to_columns={"day": "day"}), SHIPMENTS: TableSpec()},
)


def materialised(records: DataFrame) -> DataFrame:
    """Records that several tables read, parsed once and written."""
    location = scratch_dir(records.sparkSession, "records")
    records.write.parquet(location)
    return records.sparkSession.read.schema(records.schema).parquet(location)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_column(line_documents(spark, sf_dir), "doc", MAPPING.xml, source_column="file_name")
    return validate(records, MAPPING.xml)[0]


def _tables(spark: SparkSession, sf_dir: str) -> dict[TableId, DataFrame]:
    return fan_out(_valid(spark, sf_dir), MAPPING)


def fan_out_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both tables in one shape."""
    frames = []
    for identifier, rows in fan_out(materialised(_valid(spark, sf_dir)), MAPPING).items():
        columns = MAPPING.target_columns(identifier)
        frames.append(rows.select(F.lit(str(identifier)).alias("table_name"), F.to_json(F.struct(*columns)).alias("row")))
    united = reduce(DataFrame.unionByName, frames)
    return united.groupBy("table_name", "row").agg(F.count("*").alias("n"))


def mapping_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tables(spark, sf_dir)[LINES]
    return rows.select(as_type("order_id", "bigint"), as_type("line_no", "int"), as_type("discount", "double"), "flag")


def filename_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of the file name wins; files without one keep the value of the record."""
    rows = _tables(spark, sf_dir)[LINES]
    return rows.select(as_type("order_id", "bigint"), as_type("line_no", "int"), "day")


def table_empty_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that were not shipped give no row for the shipments table."""
    rows = _tables(spark, sf_dir)[SHIPMENTS]
    return rows.select("state", as_type("shipped_at", "timestamp_ntz"))


TARGET = T.StructType(
    [
        T.StructField("ID", T.LongType(), False),
        T.StructField("Quantity", T.DoubleType()),
        T.StructField("LINE_NO", T.IntegerType()),
        T.StructField("Order_Id", T.LongType()),
        T.StructField("unmapped", T.StringType()),
    ]
)


def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project_to_target(_tables(spark, sf_dir)[LINES], TARGET, ["order_id", "line_no", "quantity"])
    return rows.select(as_type("Quantity", "double"), as_type("LINE_NO", "int"), as_type("Order_Id", "bigint"))


QUERIES = {
    "fan_out_tables": fan_out_tables,
    "mapping_default": mapping_default,
    "filename_override": filename_override,
    "table_empty_filter": table_empty_filter,
    "target_projection": target_projection,
}

_FLAG_SQL = "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END"
_DAY_SQL = f"CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y%m%d') ELSE {_FLAG_SQL} END"

ORACLES = {
    "fan_out_tables": f"""
        SELECT table_name, "row", count(*) AS n FROM (
            SELECT 'shop.lines' AS table_name,
                   '{{"order_id":"' || l_orderkey || '","line_no":"' || l_linenumber || '","quantity":"' || l_quantity
                   || '","discount":"' || CASE WHEN l_discount = 0 THEN '-1' ELSE CAST(l_discount AS VARCHAR) END || '"'
                   || coalesce(',"flag":"' || {_FLAG_SQL} || '"', '') || coalesce(',"day":"' || {_DAY_SQL} || '"', '')
                   || '}}' AS "row"
            FROM lineitem
            UNION ALL
            SELECT 'shop.shipments',
                   '{{"state":"' || l_linestatus || '","shipped_at":"' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '"}}'
            FROM lineitem WHERE l_linenumber <> 3)
        GROUP BY table_name, "row" """,
    "mapping_default": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line_no,
               CASE WHEN l_discount = 0 THEN -1 ELSE l_discount END AS discount, {_FLAG_SQL} AS flag
        FROM lineitem""",
    "filename_override": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, {_DAY_SQL} AS "day" FROM lineitem""",
    "table_empty_filter": """
        SELECT l_linestatus AS state, l_shipdate AS shipped_at FROM lineitem WHERE l_linenumber <> 3""",
    "target_projection": """
        SELECT l_quantity AS "Quantity", l_linenumber AS "LINE_NO", l_orderkey AS "Order_Id" FROM lineitem""",
}
