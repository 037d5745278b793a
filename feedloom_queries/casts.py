"""Typed casts: T0-T11. Texts of many shapes are made from the tables; each row gives its value and reject reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import annotate_casts
from feedloom.plans.columns import REASON
from feedloom_queries.common import table


def _pick(key: Column, *choices: Column | str) -> Column:
    """The choice whose number is the key modulo the number of choices."""
    picked = F.lit(None).cast("string")
    for number, choice in enumerate(choices):
        picked = F.when(key % len(choices) == number, F.lit(choice) if isinstance(choice, str) else choice).otherwise(picked)
    return picked


def _cast(rows: DataFrame, key: str, fields: list[T.StructField]) -> DataFrame:
    return annotate_casts(rows, fields, [key]).withColumnRenamed(REASON, "reason")


def cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
    return _cast(rows, "doc_id", [T.StructField("value", T.StringType())])


def cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = _pick(F.col("event_id"), "1", "TRUE", "t", "Yes", "y", "0", "false", "on", F.col("event_type"), "2", F.lit(None))
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return _cast(rows, "event_id", [T.StructField("value", T.BooleanType())])


_INTEGERS = {"tiny": T.ByteType(), "small": T.ShortType(), "normal": T.IntegerType(), "big": T.LongType()}


def cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, part = F.col("l_orderkey"), F.col("l_partkey").cast("string")
    text = _pick(
        key, part, F.concat(F.lit("+"), part), F.concat(F.lit("-"), part), F.concat(part, F.lit(".0")),
        F.concat(part, F.lit("00000000000000000")), F.concat(F.lit(" "), part), "1e3", "abc", F.lit(None),
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *[text.alias(name) for name in _INTEGERS])
    return _cast(rows, "l_orderkey", [T.StructField(name, type_) for name, type_ in _INTEGERS.items()])


def cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("string")
    text = _pick(F.col("l_orderkey"), price, F.replace(price, F.lit("."), F.lit(",")), F.concat(F.lit("-"), price),
                 F.concat(price, F.lit("e2")), F.concat(price, F.lit("d")), "1.2.3", "12 5", "x", F.lit(None))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", text.alias("value"), text.alias("single"))
    fields = [T.StructField("value", T.DoubleType()), T.StructField("single", T.FloatType())]
    return _cast(rows, "l_orderkey", fields).withColumn("single", F.col("single").cast("double"))


def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("string")
    text = _pick(F.col("l_orderkey"), price, F.replace(price, F.lit("."), F.lit(",")), F.concat(F.lit("-"), price),
                 F.concat(price, F.lit("49")), F.concat(price, F.lit("5")), F.concat(F.lit("123456789"), price), "x",
                 F.lit(None))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", text.alias("value"))
    return _cast(rows, "l_orderkey", [T.StructField("value", T.DecimalType(12, 2))])


def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, short = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-d")
    text = _pick(F.col("o_orderkey"), day, F.concat(day, F.lit("T23:59:59+03:00")), F.concat(day, F.lit(" and more")),
                 F.date_format("o_orderdate", "dd.MM.yyyy"), F.date_format("o_orderdate", "yyyy-M-d"), "2024-13-01",
                 F.concat(short, F.lit("T12:00")), F.concat(short, F.lit(" x")), F.concat(short, F.lit("T")),
                 F.lit(None))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("value"))
    return _cast(rows, "o_orderkey", [T.StructField("value", T.DateType())])


def cast_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.date_format("ts", "HH:mm:ss")
    text = _pick(F.col("event_id"), clock, F.date_format("ts", "H:m:s"), F.date_format("ts", "HH:mm"), "24:00:00",
                 F.concat(clock, F.lit(".5")), F.lit(None))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return _cast(rows, "event_id", [T.StructField("value", T.StringType(), metadata={"type": "time"})])


def _moments() -> Column:
    micros = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return _pick(
        F.col("event_id"), micros, F.replace(micros, F.lit("T"), F.lit(" ")), F.concat(micros, F.lit("Z")),
        F.concat(micros, F.lit("+03:00")), F.concat(micros, F.lit("-05:30")), F.date_format("ts", "yyyy-MM-dd'T'HH:mm"),
        F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy"), F.date_format("ts", "dd.MM.yyyy HH:mm"), F.lit(None),
    )


def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", _moments().alias("value"))
    return _cast(rows, "event_id", [T.StructField("value", T.TimestampNTZType())])


def cast_timestamptz(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", _moments().alias("value"))
    typed = _cast(rows, "event_id", [T.StructField("value", T.TimestampType())])
    return typed.withColumn("value", F.unix_micros("value"))


def cast_binary_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.hex(F.col("p_name"))
    text = _pick(F.col("p_partkey"), code, F.lower(code), F.concat(code, F.lit("0")), F.concat(code, F.lit("zz")), F.lit(None))
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("value"))
    typed = _cast(rows, "p_partkey", [T.StructField("value", T.BinaryType())])
    return typed.withColumn("value", F.decode("value", "UTF-8"))


def cast_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    text = _pick(F.col("event_id"), props, F.concat(F.lit("["), props, F.lit("]")), F.concat(props, F.lit("}")),
                 F.concat(F.lit("{"), F.col("event_type")), "null", F.lit(None))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return _cast(rows, "event_id", [T.StructField("value", T.StringType(), metadata={"type": "jsonb"})])


def not_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    blank = F.when(key % 3 != 0, F.col("o_custkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", *[blank.alias(name) for name in ("open", "filled", "defaulted", "strict")]
    )
    fields = [
        T.StructField("open", T.LongType(), True, {"default": "7"}),
        T.StructField("filled", T.LongType(), False, {"default": "-1"}),
        T.StructField("defaulted", T.StringType(), False, {"CURRENT_DEFAULT": "'it''s'"}),
        T.StructField("strict", T.LongType(), False),
    ]
    return _cast(rows, "o_orderkey", fields)


QUERIES = {
    "cast_string": cast_string,
    "cast_boolean": cast_boolean,
    "cast_integer": cast_integer,
    "cast_double": cast_double,
    "cast_decimal": cast_decimal,
    "cast_date": cast_date,
    "cast_time": cast_time,
    "cast_timestamp": cast_timestamp,
    "cast_timestamptz": cast_timestamptz,
    "cast_binary_hex": cast_binary_hex,
    "cast_json": cast_json,
    "not_null_default": not_null_default,
}


def _integer_sql(name: str, type_: str, low: int, high: int) -> str:
    exact = "CASE l_orderkey % 9 WHEN 0 THEN l_partkey WHEN 1 THEN l_partkey WHEN 2 THEN -l_partkey END"
    # The shape with 17 more zeros fits a BIGINT up to a part key of 92; a key of 0 fits any type.
    wide = "CASE WHEN l_orderkey % 9 = 4 THEN CAST(l_partkey AS HUGEINT) * 100000000000000000 END"
    value = f"coalesce(CAST({exact} AS HUGEINT), {wide})"
    return f"CAST(CASE WHEN {value} BETWEEN {low} AND {high} THEN {value} END AS {type_}) AS {name}"


_INT_COLUMNS = {
    "tiny": ("TINYINT", -128, 127, "tinyint"),
    "small": ("SMALLINT", -32768, 32767, "smallint"),
    "normal": ("INTEGER", -(2**31), 2**31 - 1, "int"),
    "big": ("BIGINT", -(2**63), 2**63 - 1, "bigint"),
}
_INT_SELECT = ", ".join(_integer_sql(n, t, lo, hi) for n, (t, lo, hi, _) in _INT_COLUMNS.items())
_INT_REASON = " ".join(f"WHEN {n} IS NULL THEN 'cast:{n}:{t}'" for n, (_, _, _, t) in _INT_COLUMNS.items())

_MOMENT = "date_trunc('minute', ts)"

ORACLES = {
    "cast_string": "SELECT doc_id, text AS value, CAST(NULL AS VARCHAR) AS reason FROM documents",
    "cast_boolean": """
        SELECT event_id, CASE WHEN event_id % 11 = 10 THEN NULL ELSE event_id % 11 < 5 END AS value,
               CAST(NULL AS VARCHAR) AS reason
        FROM events""",
    "cast_integer": f"""
        SELECT l_orderkey, tiny, small, normal, big,
               CASE WHEN l_orderkey % 9 = 8 THEN NULL {_INT_REASON} END AS reason
        FROM (SELECT l_orderkey, {_INT_SELECT} FROM lineitem)""",
    "cast_double": """
        SELECT l_orderkey, value, CAST(CAST(value AS FLOAT) AS DOUBLE) AS single,
               CASE WHEN l_orderkey % 9 BETWEEN 5 AND 7 THEN 'cast:value:double' END AS reason
        FROM (SELECT l_orderkey,
                     CASE l_orderkey % 9 WHEN 0 THEN l_extendedprice WHEN 1 THEN l_extendedprice
                          WHEN 2 THEN -l_extendedprice
                          WHEN 3 THEN CAST(CAST(l_extendedprice AS VARCHAR) || 'e2' AS DOUBLE)
                          WHEN 4 THEN l_extendedprice END AS value
              FROM lineitem)""",
    "cast_decimal": """
        SELECT l_orderkey, value, CASE WHEN value IS NULL AND l_orderkey % 8 <> 7 THEN 'cast:value:decimal(12,2)' END AS reason
        FROM (SELECT l_orderkey,
                     CASE l_orderkey % 8
                         WHEN 0 THEN CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12, 2))
                         WHEN 1 THEN CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12, 2))
                         WHEN 2 THEN -CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12, 2))
                         WHEN 3 THEN CAST(CAST(CAST(l_extendedprice AS VARCHAR) || '49' AS DECIMAL(20, 6)) AS DECIMAL(12, 2))
                         WHEN 4 THEN CAST(CAST(CAST(l_extendedprice AS VARCHAR) || '5' AS DECIMAL(20, 6)) AS DECIMAL(12, 2))
                         END AS value
              FROM lineitem)""",
    "cast_date": """
        SELECT o_orderkey, value, CASE WHEN value IS NULL AND o_orderkey % 10 <> 9 THEN 'cast:value:date' END AS reason
        FROM (SELECT o_orderkey,
                     CASE WHEN o_orderkey % 10 < 3 THEN CAST(o_orderdate AS DATE)
                          WHEN o_orderkey % 10 = 4 AND month(o_orderdate) > 9 AND day(o_orderdate) > 9
                               THEN CAST(o_orderdate AS DATE)
                          WHEN o_orderkey % 10 BETWEEN 6 AND 8 AND day(o_orderdate) > 9
                               THEN CAST(o_orderdate AS DATE) END AS value
              FROM orders)""",
    "cast_time": """
        SELECT event_id, value, CASE WHEN value IS NULL AND event_id % 6 <> 5 THEN 'cast:value:string' END AS reason
        FROM (SELECT event_id, CASE WHEN event_id % 6 < 2 THEN strftime(ts, '%H:%M:%S') END AS value FROM events)""",
    "cast_timestamp": f"""
        SELECT event_id, value, CASE WHEN value IS NULL AND event_id % 10 <> 9 THEN 'cast:value:timestamp_ntz' END AS reason
        FROM (SELECT event_id,
                     CASE event_id % 10 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN ts
                          WHEN 3 THEN ts - INTERVAL 3 HOUR WHEN 4 THEN ts + INTERVAL 330 MINUTE
                          WHEN 5 THEN {_MOMENT} WHEN 6 THEN date_trunc('day', ts) END AS value
              FROM events)""",
    "cast_timestamptz": f"""
        SELECT event_id, epoch_us(value) AS value,
               CASE WHEN value IS NULL AND event_id % 10 <> 9 THEN 'cast:value:timestamp' END AS reason
        FROM (SELECT event_id,
                     CASE event_id % 10 WHEN 0 THEN ts WHEN 2 THEN ts
                          WHEN 3 THEN ts - INTERVAL 3 HOUR WHEN 4 THEN ts + INTERVAL 330 MINUTE
                          WHEN 5 THEN {_MOMENT} END AS value
              FROM events)""",
    "cast_binary_hex": """
        SELECT p_partkey, CASE WHEN p_partkey % 5 < 2 THEN p_name END AS value,
               CASE WHEN p_partkey % 5 IN (2, 3) THEN 'cast:value:binary' END AS reason
        FROM part""",
    "cast_json": """
        SELECT event_id,
               CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '[' || props || ']' WHEN 4 THEN 'null' END AS value,
               CASE WHEN event_id % 6 IN (2, 3) THEN 'cast:value:string' END AS reason
        FROM events""",
    "not_null_default": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS open,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey ELSE -1 END AS filled,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'it''s' END AS defaulted,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS strict,
               CASE WHEN o_orderkey % 3 = 0 THEN 'not_null:strict' END AS reason
        FROM orders""",
}
