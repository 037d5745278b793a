"""Record checks and error handling: F1-F5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.validate import annotate, apply_error_policy, enum_filter, required_filter, validate
from feedloom.plans.columns import MALFORMED, REASON
from feedloom.plans.mapping import XmlSpec
from feedloom.sources.xml import parse_column
from feedloom_queries.common import as_type, attribute, content, element, table, text_of

_ROOT = ("orders", "order")


def _blanked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is blank for every third key and whose priority element is missing for every fourth."""
    key = F.col("o_orderkey")
    status = F.when(key % 3 == 0, F.lit(" ")).otherwise(F.col("o_orderstatus"))
    priority = F.when(key % 4 == 0, F.lit("")).otherwise(element("priority", text_of(F.col("o_orderpriority"))))
    order = element("order", priority, attributes={"id": key, "status": status})
    return table(spark, sf_dir, "orders").withColumn("doc", element("orders", order))


_VALUES = {"o_orderkey": attribute("id"), "status": attribute("status"), "priority": content("priority")}


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_column(_blanked_orders(spark, sf_dir), "doc", XmlSpec(_ROOT, _VALUES))


def _columns(df: DataFrame) -> DataFrame:
    return df.select(as_type("o_orderkey", "bigint"), "status", "priority")


def required_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(required_filter(_parsed(spark, sf_dir), "status", "priority"))


def enum_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = enum_filter(_parsed(spark, sf_dir), "status", {"O", "f"})
    return _columns(enum_filter(kept, "priority", set()))


def empty_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record without saved values is dropped, although a validation-only value is there."""
    values = {
        "o_orderkey": attribute("id", not_for_save=True),
        "status": attribute("status", default_value="X"),
        "priority": content("priority"),
    }
    spec = XmlSpec(_ROOT, values)
    records = parse_column(_blanked_orders(spark, sf_dir), "doc", spec, source_column="o_orderkey")
    valid, _ = validate(records, spec)
    return valid.select(as_type("_source", "bigint", "source_key"), "status", "priority")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected record with the first reason."""
    values = {**_VALUES, "status": attribute("status", required=True)}
    spec = XmlSpec(_ROOT, values, enums={"status": frozenset({"O", "F"}), "priority": frozenset({"1-URGENT", "5-LOW"})})
    _, rejected = validate(parse_column(_blanked_orders(spark, sf_dir), "doc", spec), spec)
    return rejected.select(as_type("o_orderkey", "bigint"), F.col(REASON).alias("reason"))


def _broken_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records per order; for every fifth key the document breaks off in a third one."""
    key = F.col("o_orderkey")
    records = [element("order", element("price", text_of(F.col("o_totalprice"))), attributes={"id": key, "n": n}) for n in map(F.lit, (1, 2))]
    whole = F.concat(F.lit("<orders>"), *records, F.lit("</orders>"))
    broken = F.concat(F.lit("<orders>"), *records, F.lit('<order id="0" n="3"><price>1</orders>'))
    return table(spark, sf_dir, "orders").withColumn("doc", F.when(key % 5 == 0, broken).otherwise(whole))


_BROKEN = XmlSpec(_ROOT, {"o_orderkey": attribute("id"), "n": attribute("n"), "price": content("price")})


def malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records before the error are kept and the broken document leaves one marker."""
    records = parse_column(_broken_orders(spark, sf_dir), "doc", _BROKEN, source_column="o_orderkey")
    return records.select(
        as_type("_source", "bigint", "source_key"),
        F.col("_position.index").alias("position"),
        as_type("o_orderkey", "bigint"),
        as_type("n", "int"),
        as_type("price", "double"),
        F.col(MALFORMED).alias("malformed"),
    )


def error_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and quarantined rows side by side."""
    records = parse_column(_broken_orders(spark, sf_dir), "doc", _BROKEN, source_column="o_orderkey")
    good, bad = apply_error_policy(annotate(records, _BROKEN), "quarantine", "record")
    columns = [as_type("_source", "bigint", "source_key"), as_type("n", "int")]
    return good.select(*columns, F.lit("loaded").alias("outcome")).unionByName(
        bad.select(*columns, F.col(REASON).alias("outcome"))
    )


QUERIES = {
    "required_filter": required_filter_query,
    "enum_filter": enum_filter_query,
    "empty_record_filter": empty_record_filter,
    "reject_reasons": reject_reasons,
    "malformed_quarantine": malformed_quarantine,
    "error_policy": error_policy,
}

_BLANKED_SQL = """
    (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status,
            CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders)"""

ORACLES = {
    "required_filter": f"SELECT * FROM {_BLANKED_SQL} WHERE status IS NOT NULL AND priority IS NOT NULL",
    "enum_filter": f"SELECT * FROM {_BLANKED_SQL} WHERE status IS NULL OR status IN ('O', 'f')",
    "empty_record_filter": f"""
        SELECT o_orderkey AS source_key, status, priority FROM {_BLANKED_SQL}
        WHERE status IS NOT NULL OR priority IS NOT NULL""",
    "reject_reasons": f"""
        SELECT * FROM (
            SELECT o_orderkey,
                   CASE WHEN status IS NULL THEN 'required:status'
                        WHEN status NOT IN ('O', 'F') THEN 'enum:status'
                        WHEN priority NOT IN ('1-URGENT', '5-LOW') THEN 'enum:priority' END AS reason
            FROM {_BLANKED_SQL}) WHERE reason IS NOT NULL""",
    "malformed_quarantine": """
        SELECT o_orderkey AS source_key, CAST(n - 1 AS BIGINT) AS position, o_orderkey, n, o_totalprice AS price,
               false AS malformed
        FROM orders, (VALUES (1), (2)) AS copies(n)
        UNION ALL
        SELECT o_orderkey, 2, NULL, NULL, NULL, true FROM orders WHERE o_orderkey % 5 = 0""",
    "error_policy": """
        SELECT o_orderkey AS source_key, n, 'loaded' AS outcome FROM orders, (VALUES (1), (2)) AS copies(n)
        UNION ALL
        SELECT o_orderkey, NULL, 'malformed_document' FROM orders WHERE o_orderkey % 5 = 0""",
}
