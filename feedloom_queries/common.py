"""Helpers to turn table rows into XML documents inside Spark, and text values back into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import parse_text
from feedloom.functions.text import name_column
from feedloom.plans.mapping import ValueSpec, ValueType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def escape(text: Column) -> Column:
    for raw, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(reference))
    return text


def text_of(value) -> Column:
    return F.lit(value) if isinstance(value, str) else escape(value.cast("string"))


def element(name: str, *content, attributes: dict | None = None) -> Column:
    """Markup of one element. Strings are literal markup; columns made by ``text_of`` or ``element`` go in as they are."""
    parts = [F.lit("<" + name)]
    for key, value in (attributes or {}).items():
        parts += [F.lit(f' {key}="'), text_of(value), F.lit('"')]
    parts.append(F.lit(">"))
    parts += [F.lit(c) if isinstance(c, str) else c for c in content]
    parts.append(F.lit(f"</{name}>"))
    return F.concat(*parts)


def attribute(*path: str, **options) -> ValueSpec:
    return ValueSpec(tuple(path), ValueType.ATTRIBUTE, **options)


def content(*path: str, **options) -> ValueSpec:
    return ValueSpec(tuple(path), ValueType.CONTENT, **options)


def json_object(*path: str, structure: dict, **options) -> ValueSpec:
    return ValueSpec(tuple(path), ValueType.JSON_OBJECT, structure=structure, **options)


def json_array(*path: str, structure: dict, **options) -> ValueSpec:
    return ValueSpec(tuple(path), ValueType.JSON_ARRAY, structure=structure, **options)


def as_type(text: str | Column, type_: str | T.DataType, name: str | None = None) -> Column:
    """A text column read as the given type by the library's own cast rules."""
    data_type = T.DataType.fromDDL(type_) if isinstance(type_, str) else type_
    label = name or (text if isinstance(text, str) else None)
    column = name_column(text) if isinstance(text, str) else text
    return parse_text(column, T.StructField(label or "value", data_type)).alias(label)


ORDER_VALUES = {
    "o_orderkey": attribute("id", required=True),
    "o_orderstatus": attribute("status"),
    "o_totalprice": content("price"),
    "o_orderpriority": content("priority"),
}

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


def typed_orders(records: DataFrame) -> DataFrame:
    return records.select(*[as_type(name, type_) for name, type_ in ORDER_TYPES.items()])


def order_element(orders: DataFrame | None = None, name: str = "order") -> Column:
    return element(
        name,
        element("customer", element("name", text_of(F.concat(F.lit("C & "), F.col("o_custkey")))),
                attributes={"id": F.col("o_custkey")}),
        element("price", text_of(F.col("o_totalprice"))),
        element("priority", text_of(F.col("o_orderpriority"))),
        element("placed", text_of(F.col("o_orderdate"))),
        attributes={"id": F.col("o_orderkey"), "status": F.col("o_orderstatus")},
    )


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order. A row-wise projection: no order is brought together with another one."""
    return table(spark, sf_dir, "orders").withColumn("doc", element("orders", order_element()))


def order_rows_for_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nested columns that the XML writer turns into attributes and elements."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderstatus").alias("_status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )


def part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part, with repeated children, nested nodes and a part in every fifth without a supplier node."""
    price = element("price", text_of(F.col("p_retailprice")), attributes={"currency": "EUR"})
    body = element(
        "part",
        element("label", text_of(F.col("p_name")), attributes={"lang": "en"}),
        element("label", "other", attributes={"lang": "xx"}),
        element(
            "traits",
            element("trait", text_of(F.col("p_brand")), attributes={"kind": "brand"}),
            element("trait", text_of(F.col("p_type")), attributes={"kind": "type"}),
            element("trait", element("size", text_of(F.col("p_size"))), attributes={"kind": ""}),
        ),
        F.when(
            F.col("p_partkey") % 5 != 0,
            element("offer", price, element("price", "0"), element("note", "  "), attributes={"id": F.col("p_partkey")}),
        ).otherwise(F.lit("")),
        element("empty"),
        attributes={"id": F.col("p_partkey")},
    )
    return table(spark, sf_dir, "part").withColumn("doc", element("parts", body))
