"""Value extraction: P1-P10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.validate import validate
from feedloom.plans.mapping import XmlSpec
from feedloom.sources.xml import parse_column
from feedloom_queries.common import (
    as_type,
    attribute,
    content,
    element,
    json_array,
    json_object,
    part_documents,
    table,
    text_of,
)

_ROOT = ("parts", "part")


def _parts(spark: SparkSession, sf_dir: str, values: dict, root: tuple[str, ...] = _ROOT, **options) -> DataFrame:
    spec = XmlSpec(root, {"p_partkey": attribute("id"), **values})
    return parse_column(part_documents(spark, sf_dir), "doc", spec, **options)


def value_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, {"missing": attribute("nope")}).select(as_type("p_partkey", "bigint"), "missing")


def value_attribute_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "lang": attribute("label", "lang"),
        "kind": attribute("traits", "trait", "kind"),
        "offer_id": attribute("offer", "id"),
        "currency": attribute("offer", "price", "currency"),
    }
    records = _parts(spark, sf_dir, values)
    return records.select(as_type("p_partkey", "bigint"), "lang", "kind", as_type("offer_id", "bigint"), "currency")


def value_last_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The option that takes the last of several same-named elements."""
    values = {"lang": attribute("label", "lang"), "kind": attribute("traits", "trait", "kind"), "label": content("label")}
    records = _parts(spark, sf_dir, values, on_repeat="last")
    return records.select(as_type("p_partkey", "bigint"), "lang", "kind", "label")


def value_content_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "part").withColumn(
        "doc", element("parts", element("name", "\n  ", text_of(F.col("p_name")), "\t ", attributes={"id": F.col("p_partkey")}))
    )
    spec = XmlSpec(("parts", "name"), {"p_partkey": attribute("id"), "p_name": content()})
    return parse_column(documents, "doc", spec).select(as_type("p_partkey", "bigint"), "p_name")


def value_content_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "p_name": content("label"),
        "first_trait": content("traits", "trait"),
        "traits_text": content("traits"),
        "price": content("offer", "price"),
        "note": content("offer", "note"),
    }
    records = _parts(spark, sf_dir, values)
    return records.select(
        as_type("p_partkey", "bigint"), "p_name", "first_trait", "traits_text", as_type("price", "double"), "note"
    )


def value_mixed_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(
        F.lit("  "), text_of(F.col("p_name")), F.lit("<b>bold</b>\n "), text_of(F.col("p_brand")), F.lit("<!-- note -->"),
        F.lit("<![CDATA[ <"), F.col("p_type"), F.lit("> & ]]>"),
    )
    documents = table(spark, sf_dir, "part").withColumn(
        "doc", element("parts", element("part", body, attributes={"id": F.col("p_partkey")}))
    )
    spec = XmlSpec(_ROOT, {"p_partkey": attribute("id"), "mixed": content(), "bold": content("b")})
    return parse_column(documents, "doc", spec).select(as_type("p_partkey", "bigint"), "mixed", "bold")


def _json(column: str, *steps: str):
    return F.get_json_object(column, "$" + "".join(steps))


def value_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "offer": json_object(
            "offer",
            structure={
                "id": attribute("id"),
                "price": content("price"),
                "currency": attribute("price", "currency"),
                "note": content("note"),
            },
        ),
        "whole": json_object(structure={"name": content("label"), "lang": attribute("label", "lang")}),
        "hollow": json_object("empty", structure={"x": attribute("x")}),
    }
    return _parts(spark, sf_dir, values).select(
        as_type("p_partkey", "bigint"),
        F.col("offer").isNotNull().alias("has_offer"),
        as_type(_json("offer", ".id"), "bigint", "offer_id"),
        as_type(_json("offer", ".price"), "double", "offer_price"),
        _json("offer", ".currency").alias("offer_currency"),
        F.col("offer").contains("note").alias("has_note"),
        _json("whole", ".name").alias("whole_name"),
        "hollow",
    )


def value_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "traits": json_array("traits", "trait", structure={"kind": attribute("kind"), "text": content()}),
        "labels": json_array("label", structure={"lang": attribute("lang")}),
        "none": json_array("offers", structure={"id": attribute("id")}),
        "nodes": json_array(structure={"lang": attribute("lang"), "id": attribute("id")}, children=("label", "offer")),
    }
    return _parts(spark, sf_dir, values).select(
        as_type("p_partkey", "bigint"),
        "traits",
        "labels",
        "none",
        F.json_array_length("nodes").alias("n_nodes"),
        as_type(_json("nodes", "[2].id"), "bigint", "third_id"),
    )


def value_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    trait = {
        "kind": attribute("kind"),
        "text": content(),
        "detail": json_object("size", structure={"value": content(required=True)}),
        "sizes": json_array("size", structure={"value": content(default_value="0")}),
    }
    values = {
        "card": json_object(
            structure={
                "key": attribute("id"),
                "traits": json_array("traits", "trait", structure=trait),
                "offer": json_object("offer", structure={"prices": json_array("price", structure={"amount": content()})}),
            }
        )
    }
    return _parts(spark, sf_dir, values).select(
        as_type("p_partkey", "bigint"),
        as_type(_json("card", ".key"), "bigint", "card_key"),
        _json("card", ".traits[0].text").alias("brand"),
        _json("card", ".traits[0].detail").alias("brand_detail"),
        as_type(_json("card", ".traits[2].detail.value"), "int", "size_value"),
        as_type(_json("card", ".traits[2].sizes[0].value"), "int", "sizes_value"),
        as_type(_json("card", ".offer.prices[0].amount"), "double", "amount"),
        F.json_array_length(_json("card", ".offer.prices")).alias("n_prices"),
    )


def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(key % 7 == 0, F.lit("")).when(key % 7 == 1, F.lit(" \t")).otherwise(F.col("o_orderstatus"))
    priority = F.when(key % 5 == 0, F.lit(" \n ")).otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\n")))
    documents = table(spark, sf_dir, "orders").withColumn(
        "doc",
        element(
            "orders", element("order", element("priority", text_of(priority)), attributes={"id": key, "status": status})
        ),
    )
    values = {"o_orderkey": attribute("id"), "status": attribute("status"), "priority": content("priority")}
    records = parse_column(documents, "doc", XmlSpec(("orders", "order"), values))
    return records.select(as_type("o_orderkey", "bigint"), "status", "priority")


def validation_only_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "p_name": content("label"),
        "offer_id": attribute("offer", "id", required=True, not_for_save=True),
        "brand": content("traits", "trait", not_for_save=True),
    }
    spec = XmlSpec(_ROOT, values, enums={"brand": frozenset({"Brand#1", "Brand#2", "Brand#3"})})
    records = parse_column(part_documents(spark, sf_dir), "doc", spec, keep=["p_partkey"])
    valid, _ = validate(records, spec)
    return valid.drop("_source", "_source_name", "_position")


QUERIES = {
    "value_attribute": value_attribute,
    "value_attribute_nested": value_attribute_nested,
    "value_last_repeat": value_last_repeat,
    "value_content_self": value_content_self,
    "value_content_nested": value_content_nested,
    "value_mixed_content": value_mixed_content,
    "value_json_object": value_json_object,
    "value_json_array": value_json_array,
    "value_json_nested": value_json_nested,
    "blank_to_null": blank_to_null,
    "validation_only_columns": validation_only_columns,
}

ORACLES = {
    "value_attribute": "SELECT p_partkey, CAST(NULL AS VARCHAR) AS missing FROM part",
    "value_attribute_nested": """
        SELECT p_partkey, 'en' AS lang, 'brand' AS kind,
               CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS offer_id,
               CASE WHEN p_partkey % 5 <> 0 THEN 'EUR' END AS currency
        FROM part""",
    "value_last_repeat": "SELECT p_partkey, 'xx' AS lang, CAST(NULL AS VARCHAR) AS kind, 'other' AS label FROM part",
    "value_content_self": "SELECT p_partkey, p_name FROM part",
    "value_content_nested": """
        SELECT p_partkey, p_name, p_brand AS first_trait, CAST(NULL AS VARCHAR) AS traits_text,
               CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS price, CAST(NULL AS VARCHAR) AS note
        FROM part""",
    "value_mixed_content": """
        SELECT p_partkey, p_name || chr(10) || p_brand || chr(10) || '<' || p_type || '> &' AS mixed, 'bold' AS bold
        FROM part""",
    "value_json_object": """
        SELECT p_partkey, p_partkey % 5 <> 0 AS has_offer,
               CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS offer_id,
               CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS offer_price,
               CASE WHEN p_partkey % 5 <> 0 THEN 'EUR' END AS offer_currency,
               CASE WHEN p_partkey % 5 <> 0 THEN false END AS has_note,
               p_name AS whole_name, '{}' AS hollow
        FROM part""",
    "value_json_array": """
        SELECT p_partkey,
               '[{"kind":"brand","text":"' || p_brand || '"},{"kind":"type","text":"' || p_type || '"},{"kind":""}]'
                   AS traits,
               '[{"lang":"en"},{"lang":"xx"}]' AS labels, CAST(NULL AS VARCHAR) AS none,
               CAST(CASE WHEN p_partkey % 5 <> 0 THEN 3 ELSE 2 END AS INTEGER) AS n_nodes,
               CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS third_id
        FROM part""",
    "value_json_nested": """
        SELECT p_partkey, p_partkey AS card_key, p_brand AS brand, CAST(NULL AS VARCHAR) AS brand_detail,
               p_size AS size_value, p_size AS sizes_value,
               CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS amount,
               CAST(CASE WHEN p_partkey % 5 <> 0 THEN 2 END AS INTEGER) AS n_prices
        FROM part""",
    "blank_to_null": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 NOT IN (0, 1) THEN o_orderstatus END AS status,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority
        FROM orders""",
    "validation_only_columns": """
        SELECT p_partkey, p_name FROM part
        WHERE p_partkey % 5 <> 0 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')""",
}
