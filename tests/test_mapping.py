"""Mapping documents, the checks on them, routing and file names."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import UnsupportedTypeError
from feedloom.operators.fanout import check_target, project_to_target
from feedloom.plans.mapping import (
    ColumnId,
    Mapping,
    MappingError,
    TableId,
    TableSpec,
    ValueSpec,
    ValueType,
    XmlSpec,
    load_mappings,
    named_groups,
)
from feedloom.sources.files import filename_value, route

BASE = {
    "xml": {
        "files": [r"^(?<plant>[a-z]+)-day(?<yday>\d{3})\.xml"],
        "root_path": ["plant", "hall", "sensor"],
        "values": {
            "meters.sensor.serial": {"path": ["nr"], "required": True, "surprise": 1},
            "meters.sensor.place": {"path": ["where", "shelf"], "type": "CONTENT", "default_value": "floor"},
            "trace.curve": {
                "path": ["curve", "point"],
                "type": "JSON_ARRAY",
                "structure": {"t": {"path": ["t"]}, "bar": {"path": ["bar"], "type": "CONTENT"}},
            },
            "state": {"path": ["state"], "not_for_save": True},
        },
        "enums": {"state": ["on", "idle"]},
    },
    "db": {
        "meters.sensor": {"unique_columns": ["serial"], "filename_groups_to_columns": {"yday": "day_of_year"}},
        "trace": {"batch_size": 40},
    },
}


def changed(path: str, value) -> list:
    raw = json.loads(json.dumps(BASE))
    node = raw
    *steps, last = path.split("/")
    for step in steps:
        node = node[step]
    if value is KeyError:
        del node[last]
    else:
        node[last] = value
    return [raw]


def test_document(tmp_path):
    path = tmp_path / "mappings.json"
    path.write_text(json.dumps([BASE]), encoding="utf-8")
    (mapping,) = load_mappings(path)
    assert mapping == load_mappings(json.dumps([BASE]))[0]
    sensor, trace = TableId("sensor", "meters"), TableId("trace", "public")
    assert mapping.columns == {
        "meters.sensor.serial": ColumnId(sensor, "serial"),
        "meters.sensor.place": ColumnId(sensor, "place"),
        "trace.curve": ColumnId(trace, "curve"),
    }
    assert mapping.loaded_tables == [sensor, trace]
    assert mapping.target_columns(sensor) == ["serial", "place", "day_of_year"]
    assert mapping.db[sensor].batch_size == 500 and mapping.db[trace].batch_size == 40
    assert mapping.xml.validation_only_keys == ["state"]
    assert mapping.xml.values["trace.curve"].structure["bar"].type is ValueType.CONTENT


def test_root_path_in_both_spellings():
    raw = json.loads(json.dumps(BASE))
    raw["xml"]["rootPath"] = raw["xml"].pop("root_path")
    assert load_mappings([raw])[0].xml.root_path == ("plant", "hall", "sensor")


@pytest.mark.parametrize(
    ("path", "value", "message"),
    [
        ("xml/root_path", [], "root path"),
        ("xml/values", {}, "values"),
        ("xml/files", [], "files"),
        ("xml/files", [" "], "files"),
        ("db", {}, "db section"),
        ("db/trace", KeyError, "missing from 'db'"),
        ("xml/values/short", {"path": ["x"]}, "names no table"),
        ("xml/values/trace.x", {"path": []}, "ATTRIBUTE"),
        ("xml/values/trace.x", {"path": ["a"], "type": "JSON_OBJECT"}, "structure"),
        ("xml/values/trace.x", {"type": "JSON_ARRAY", "structure": {}}, "children"),
        ("xml/values/trace.x", {"path": ["a"], "type": "NUMBER"}, "NUMBER"),
        ("db/trace/batch_size", 0, "batch_size"),
        ("db/trace/filename_groups_to_columns", {"plant": "c", "yday": "c"}, "more than once"),
        ("db/trace/filename_groups_to_columns", {"nobody": "c"}, "no pattern"),
        ("db/" + "x" * 64, {}, "63"),
    ],
)
def test_unusable_documents(path, value, message):
    with pytest.raises(ValueError, match=message):
        load_mappings(changed(path, value))


def test_repeated_output_keys():
    text = '[{"xml": {"files": ["a"], "root_path": ["r"], "values": {"a": {"path": ["x"]}, "a": {"path": ["y"]}}}, "db": {"t": {}}}]'
    with pytest.raises(MappingError, match="more than once"):
        load_mappings(text)


def test_empty_content_path_is_allowed():
    assert ValueSpec((), ValueType.CONTENT).path == ()


def test_identifiers():
    assert TableId.parse("t") == TableId("t", "public")
    assert TableId.parse("s.t", "other") == TableId("t", "s")
    assert ColumnId.parse("t.c", "other") == ColumnId(TableId("t", "other"), "c")
    assert ColumnId.parse("s.t.c") == ColumnId(TableId("t", "s"), "c")
    with pytest.raises(MappingError):
        ColumnId.parse("c")


def test_group_numbers():
    assert named_groups(r"(a)(?<b>x)(?:c)(?<=d)(?<!e)(?=f)\((?<g>[()\]]+)(?<h>(?<i>y))") == {"b": 2, "g": 3, "h": 4, "i": 5}
    assert named_groups(r"\Q(\E(?<a>x)[(](?<b>y)") == {"a": 1, "b": 2}


def test_table_with_file_columns_only_is_not_loaded():
    raw = json.loads(json.dumps(BASE))
    raw["db"]["log"] = {"filename_groups_to_columns": {"plant": "plant"}}
    assert TableId("log") not in load_mappings([raw])[0].loaded_tables


def test_routing_takes_the_first_hit(spark):
    spec = {"v": ValueSpec(("x",))}
    mappings = [
        Mapping(XmlSpec(("r",), spec, files=("^b", "^ab")), {TableId("a"): TableSpec()}),
        Mapping(XmlSpec(("r",), spec, files=("b",)), {TableId("b"): TableSpec()}),
    ]
    names = spark.createDataFrame([("b.xml",), ("ab.xml",), ("xb.xml.gz",), ("c.xml",)], "file_name string")
    assert [r.mapping_index for r in route(names, mappings).collect()] == [0, 0, 1, None]


def test_file_name_values(spark):
    names = spark.createDataFrame([("f_1_x",), ("f_1",), ("g_2",), ("h",)], "n string")
    patterns = [r"f_(?<no>\d)(_(?<tag>\w))?", r"(g)_(?<no>\d)"]
    rows = names.select(*[filename_value(F.col("n"), patterns, g).alias(g) for g in ("no", "tag")]).collect()
    assert [tuple(r) for r in rows] == [("1", "x"), ("1", None), ("2", None), (None, None)]


TARGET = T.StructType([T.StructField("ID", T.LongType(), False), T.StructField("Name", T.StringType())])


def _mapping(values: dict, **table) -> Mapping:
    return Mapping(XmlSpec(("r",), values), {TableId("t"): TableSpec(**table)})


def test_target_checks(spark):
    value = ValueSpec(("x",))
    check_target(_mapping({"id": value, "NAME": value}, unique_columns=("Id",)), TableId("t"), TARGET)
    for mapping, target, message in (
        (_mapping({"id": value, "other": value}), TARGET, "target columns"),
        (_mapping({"id": value}, unique_columns=("other",)), TARGET, "unique columns"),
        (_mapping({"id": value}, unique_columns=("name",)), TARGET, "get no value"),
        (_mapping({"name": value}), TARGET, "NOT NULL"),
        (_mapping({"id": value}), T.StructType([]), "no columns"),
    ):
        with pytest.raises(MappingError, match=message):
            check_target(mapping, TableId("t"), target)
    for type_ in ("array<int>", "struct<a:int>", "map<int,int>", "interval day", "void"):
        target = T.StructType([T.StructField("id", T.DataType.fromDDL(type_))])
        with pytest.raises(UnsupportedTypeError):
            check_target(_mapping({"id": value}), TableId("t"), target)


def test_projection_order(spark):
    rows = spark.createDataFrame([("n", "1")], "name string, id string")
    assert project_to_target(rows, TARGET, ["name", "id"]).columns == ["ID", "Name"]
