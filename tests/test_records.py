"""Extraction and validation on small documents."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.text import SPACES, strip
from feedloom.operators.validate import annotate, validate
from feedloom.plans.columns import MALFORMED, REASON
from feedloom.plans.mapping import MappingError, ValueSpec, ValueType, XmlSpec
from feedloom.sources.elements import complete_elements
from feedloom.sources.xml import cut_exactly, parse_column, read_records, tag_report
from tests.conftest import records_of


def attr(*path, **options):
    return ValueSpec(tuple(path), ValueType.ATTRIBUTE, **options)


def text(*path, **options):
    return ValueSpec(tuple(path), ValueType.CONTENT, **options)


def obj(*path, structure, **options):
    return ValueSpec(tuple(path), ValueType.JSON_OBJECT, structure=structure, **options)


def arr(*path, structure, **options):
    return ValueSpec(tuple(path), ValueType.JSON_ARRAY, structure=structure, **options)


SCANS = ("document", "record", "split", "auto")
READING = XmlSpec(("log", "reading"), {"level": text()})


def levels(df):
    return [r.get("level") for r in records_of(df)]


@pytest.mark.parametrize("scan", SCANS)
def test_text_of_records(spark, xml_file, scan):
    path = xml_file("<log>\n\t<reading>12.5</reading>\n\t<reading>  11.0\n</reading><reading/>\n</log>\n")
    assert levels(read_records(spark, path, READING, scan=scan)) == ["12.5", "11.0", None]


@pytest.mark.parametrize("scan", SCANS)
def test_attributes_beside_text(spark, xml_file, scan):
    path = xml_file(
        """<depot><pallet dock='9' state="full">rice</pallet>
        <pallet state="6 < 7 > 5" dock="10"/><pallet dock="11">tea &amp; mate</pallet></depot>""".replace("6 <", "6 &lt;")
    )
    spec = XmlSpec(("depot", "pallet"), {"dock": attr("dock"), "state": attr("state"), "goods": text()})
    assert records_of(read_records(spark, path, spec, scan=scan)) == [
        {"dock": "9", "state": "full", "goods": "rice"},
        {"dock": "10", "state": "6 < 7 > 5"},
        {"dock": "11", "goods": "tea & mate"},
    ]


ROUTES = """<fleet><truck plate="KX 11"><driver><badge>77</badge></driver>
    <leg km="40"><stop>Oulu</stop></leg><leg km="15"><stop>Kemi</stop><stop>Tornio</stop></leg></truck>
  <truck plate="KX 12"><driver/><leg km="3"/></truck></fleet>"""
TRUCK = XmlSpec(
    ("fleet", "truck"),
    {"plate": attr("plate"), "badge": text("driver", "badge"), "km": attr("leg", "km"), "stop": text("leg", "stop")},
)


@pytest.mark.parametrize("scan", SCANS)
def test_nested_takes_the_first(spark, xml_file, scan):
    first, second = records_of(read_records(spark, xml_file(ROUTES), TRUCK, scan=scan))
    assert first == {"plate": "KX 11", "badge": "77", "km": "40", "stop": "Oulu"}
    assert second == {"plate": "KX 12", "km": "3"}


def test_last_on_request(spark, xml_file):
    first = records_of(read_records(spark, xml_file(ROUTES), TRUCK, on_repeat="last"))[0]
    assert (first["km"], first["stop"]) == ("15", "Tornio")


@pytest.mark.parametrize("scan", SCANS)
def test_cdata(spark, xml_file, scan):
    path = xml_file("<jobs><job><cmd><![CDATA[a < b && </job> <job>]]></cmd><env><![CDATA[ ]]></env></job></jobs>")
    spec = XmlSpec(("jobs", "job"), {"cmd": text("cmd"), "env": text("env")})
    if scan != "record":
        assert records_of(read_records(spark, path, spec, scan=scan)) == [{"cmd": "a < b && </job> <job>"}]


@pytest.mark.parametrize("scan", SCANS)
@pytest.mark.parametrize("value", [text("since"), attr("rev")])
def test_a_root_that_is_the_record(spark, xml_file, value, scan):
    spec = XmlSpec(("status",), {"v": value})
    assert records_of(read_records(spark, xml_file("<status rev='x'><since>x</since></status>"), spec, scan=scan)) == [{"v": "x"}]
    valid, rejected = validate(read_records(spark, xml_file("<status/>", "none.xml"), spec, scan=scan), spec)
    assert valid.count() == 0
    assert [row[REASON] for row in rejected.collect()] == ["empty"]


@pytest.mark.parametrize("scan", SCANS)
def test_malformed_document_keeps_what_came_before(spark, xml_file, scan):
    path = xml_file("<log><reading>3</reading><reading>4<reading>5</reading></log>")
    rows = annotate(read_records(spark, path, READING, scan=scan), READING).collect()
    assert "3" in [row.level for row in rows if row[REASON] is None]
    assert "malformed_document" in [row[REASON] for row in rows]
    assert len(rows) == 2


def test_well_formed_documents_meet_no_python(spark, xml_file):
    frames = [parse_column(spark.createDataFrame([("<log/>",)], "d string"), "d", READING)]
    frames.append(read_records(spark, xml_file("<log><reading>3</reading></log>"), READING))
    for frame in frames:
        assert "ArrowEvalPython" not in frame._jdf.queryExecution().executedPlan().toString()


def test_what_comes_before_an_error_in_a_column(spark):
    documents = [
        "<f><b><r n='1'>a</r></b> <!-- --><b><r n='2'/><r n='3'>c</r></b><b><r n='4'>d</r></c></f>",
        "<f><b><r n='1'>a</r></b>",
        "<f><b n='</b><r n='1'>a</r></b></f>",
        "no xml",
        "<other><b><r n='1'>a</r></b>",
    ]
    frame = spark.createDataFrame(list(enumerate(documents)), "i int, d string")
    spec = XmlSpec(("f", "b", "r"), {"n": attr("n"), "v": text()})
    found = {}
    for row in parse_column(frame, "d", spec, keep=["i"]).collect():
        found.setdefault(row.i, []).append(None if row[MALFORMED] else row.n)
    assert found[0] == ["1", "2", "3", "4", None] and found[1] == ["1", None]
    assert [found[i] for i in (2, 3, 4)] == [[None]] * 3


def test_malformed_modes(spark, xml_file):
    path = xml_file("<log><reading>8</reading><reading>9</log>")
    for scan in ("document", "auto"):
        assert read_records(spark, path, READING, mode="DROPMALFORMED", scan=scan).count() == 1
        with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
            read_records(spark, path, READING, mode="FAILFAST", scan=scan).collect()


def test_record_scan_can_be_counted(spark, xml_file):
    path = xml_file("<log><reading>8</reading><reading>9</log>")
    frame = read_records(spark, path, READING, scan="record")
    assert frame.count() == 2
    assert frame.groupBy(MALFORMED).count().count() == 2


def test_many_records(spark, xml_file):
    rows = [{"at": str(3 * n), "v": f"level {n % 7}"} for n in range(12_000)]
    path = xml_file("<log>" + "\n".join(f"<reading at='{r['at']}'><v>{r['v']}</v></reading>" for r in rows) + "</log>")
    spec = XmlSpec(("log", "reading"), {"at": attr("at"), "v": text("v")})
    for scan in ("document", "record", "split"):
        assert records_of(read_records(spark, path, spec, scan=scan)) == rows


@pytest.mark.parametrize("bare", [False, True])
def test_one_file_is_cut_into_many_tasks(spark, xml_file, bare):
    """Also records of nothing but attributes; other elements, comments and children named alike do no harm."""
    one = "<box id='{0}' w='é {0}'/>" if bare else "<box id='{0}'><!-- </boxes> --><w>é {0}</w><boxed/></box><note n='{0}'/>"
    body = "\n".join(one.format(n) for n in range(4_000))
    path = xml_file(f'<?xml version="1.0"?><!-- day --><boxes day="2">{body}\n<!-- end --></boxes>\n')
    spec = XmlSpec(("boxes", "box"), {"id": attr("id"), "w": attr("w") if bare else text("w")})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [r.exact for r in cut_exactly(spark, path, spec).collect()] == [True]
        rows = records_of(read_records(spark, path, spec, scan="split"))
        assert rows == [{"id": str(n), "w": f"é {n}"} for n in range(4_000)]
        blocks = {r._position.block for r in read_records(spark, path, spec, scan="split").collect()}
        assert len(blocks) > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    ("encoding", "declaration"),
    [("utf-16", 'encoding="UTF-16"'), ("windows-1251", 'encoding="windows-1251"'), ("utf-8-sig", ""), ("koi8-r", 'encoding="KOI8-R"')],
)
def test_encodings_are_found(spark, xml_file, encoding, declaration):
    path = xml_file(f'<?xml version="1.0" {declaration}?><log><reading>высоко</reading></log>', encoding=encoding)
    for scan in ("document", "auto"):
        assert levels(read_records(spark, path, READING, scan=scan)) == ["высоко"]


def test_encoding_can_be_given(spark, xml_file):
    path = xml_file("<log><reading>высоко</reading></log>", encoding="windows-1251")
    assert levels(read_records(spark, path, READING, encoding="windows-1251")) == ["высоко"]


SHIFTS = """<roster><shift code="N" from="22:00"><crew>4</crew></shift><shift code=" " from="06:00"><crew>2</crew></shift>
  <shift code="L" from="14:00"><crew>\t</crew></shift><shift from="00:00"/><shift code="D"><crew>0</crew></shift></roster>"""


def test_required(spark, xml_file):
    spec = XmlSpec(
        ("roster", "shift"),
        {"code": attr("code", required=True), "crew": text("crew", required=True), "start": attr("from")},
    )
    valid, rejected = validate(read_records(spark, xml_file(SHIFTS), spec), spec)
    assert {tuple(r) for r in valid.select("code", "crew", "start").collect()} == {("N", "4", "22:00"), ("D", "0", None)}
    assert sorted(r[REASON] for r in rejected.collect()) == ["required:code", "required:code", "required:crew"]


def test_enum(spark, xml_file):
    path = xml_file(
        "<yard>" + "".join(f"<gate no='{n}'{k}/>" for n, k in enumerate((" side='N'", " side='n'", "", " side='S'", " side=''"))) + "</yard>"
    )
    spec = XmlSpec(
        ("yard", "gate"), {"no": attr("no"), "side": attr("side")}, enums={"side": frozenset({"N", "W"}), "no": frozenset()}
    )
    valid, rejected = validate(read_records(spark, path, spec), spec)
    assert sorted(r.no for r in valid.collect()) == ["0", "2", "4"]
    assert {r[REASON] for r in rejected.collect()} == {"enum:side"}


def test_blank_values_are_absent(spark, xml_file):
    path = xml_file(
        """<bin><part no="a" lot=""><w>1</w></part><part no="b" lot=" "><w> </w><h>2</h></part>
        <part no="c"><w/><!-- h --></part><part lot="z" no="d"><h>\n</h></part></bin>"""
    )
    spec = XmlSpec(("bin", "part"), {"no": attr("no"), "lot": attr("lot"), "w": text("w"), "h": text("h")})
    assert records_of(read_records(spark, path, spec)) == [
        {"no": "a", "w": "1"}, {"no": "b", "h": "2"}, {"no": "c"}, {"no": "d", "lot": "z"}]


def test_attribute_only_records(spark, xml_file):
    names = ("sensor", "unit", "low", "high")
    rows = [{"sensor": f"s{n}", "unit": "bar", "low": str(-n), "high": str(n * n)} for n in range(600)]
    markup = "".join("<LIMIT " + " ".join(f'{k.upper()}="{v}"' for k, v in r.items()) + " UNUSED='u'  />\n" for r in rows)
    path = xml_file(f"<?xml version='1.0'?>\n<LIMITS>{markup}</LIMITS>", "limits.XML")
    spec = XmlSpec(("LIMITS", "LIMIT"), {n: attr(n.upper()) for n in names})
    for scan in SCANS:
        assert records_of(read_records(spark, path, spec, scan=scan)) == rows


def test_root_path_is_exact_and_names_lose_prefixes(spark, xml_file):
    path = xml_file(
        """<c xmlns:p="u"><item id="no"/><g><p:item p:id="1"><item id="inner"/></p:item></g>
        <g/><h><item id="no"/></h><g><item id="2"/><item id="3"/></g></c>"""
    )
    spec = XmlSpec(("c", "g", "item"), {"id": attr("id")})
    assert [r["id"] for r in records_of(read_records(spark, path, spec))] == ["1", "2", "3"]
    assert len(records_of(read_records(spark, path, spec, scan="record"))) == 5
    report = tag_report(spark, path, spec).collect()
    assert [(row.at_root_path, row.by_tag) for row in report] == [(3, 5)]


def test_other_root_in_a_column_gives_nothing(spark):
    documents = spark.createDataFrame(
        [("<w><c><g><item id='1'/></g></c></w>",), ("<!-- <c> --> <p:c xmlns:p='u'><g><item id='2'/></g></p:c>",), (None,)],
        "doc string",
    )
    spec = XmlSpec(("c", "g", "item"), {"id": attr("id")})
    assert [r.id for r in parse_column(documents, "doc", spec).collect()] == ["2"]


def test_mixed_content(spark, xml_file):
    path = xml_file("<r><d> x<b>y</b>\n z<!-- c -->w <![CDATA[ & ]]></d></r>")
    spec = XmlSpec(("r",), {"d": text("d"), "b": text("d", "b")})
    assert records_of(read_records(spark, path, spec)) == [{"d": "x\nz\nw  &", "b": "y"}]


def test_unicode_space_is_blank(spark, xml_file):
    path = xml_file('<r><d a=" "> </d><e a=" x ">　y </e></r>')
    spec = XmlSpec(("r",), {"d": text("d"), "da": attr("d", "a"), "e": text("e"), "ea": attr("e", "a")})
    assert records_of(read_records(spark, path, spec)) == [{"e": "y", "ea": "x"}]


ORDER = """<orders><order id="7" status="new"><customer><name>Ann "A" &amp; Co</name></customer>
<items><item sku="a"><qty>1</qty><price>2.5</price></item><item sku=""><qty> </qty></item></items><gone/></order></orders>"""


def test_stripping_knows_every_space_at_both_ends(spark):
    texts = ["", " ", "a", "a b", "\x7f", "é", "aé", "éa", "~", "!", *[t for s in SPACES for t in (s, s + "a", "a" + s, s + "é b" + s)]]
    found = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", strip(F.col("t")).alias("stripped"))
    assert all(row.stripped == (None if row.t is None else row.t.strip(SPACES)) for row in found.collect())


def test_conditions_on_records_do_not_take_their_values_out_again(spark):
    spec = XmlSpec(("log", "reading"), {"id": attr("id", required=True), "level": text("level")})
    documents = spark.createDataFrame([("<log><reading id='1'><level>2</level></reading></log>",)], "doc string")
    valid = validate(parse_column(documents, "doc", spec), spec)[0]
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")]
    assert conditions and not any("node" in line for line in conditions)
    assert [(row.id, row.level) for row in valid.collect()] == [("1", "2")]


def test_json_values(spark, xml_file):
    item = {"sku": attr("sku"), "qty": text("qty"), "price": text("price")}
    spec = XmlSpec(
        ("orders", "order"),
        {
            "items": arr("items", "item", structure=item),
            "none": arr("items", "thing", structure=item),
            "customer": obj("customer", structure={"name": text("name"), "vip": attr("vip")}),
            "missing": obj("nobody", structure={"name": text("name")}),
            "hollow": obj("gone", structure={"x": attr("x")}),
            "bare": obj("gone", structure={}),
            "all": obj(
                structure={
                    "id": attr("id"),
                    "who": obj("customer", structure={"name": text("name")}),
                    "lines": arr("items", "item", structure={"sku": attr("sku"), "more": obj("qty", structure={"n": text()})}),
                    "no": arr("no", structure={"x": text()}),
                }
            ),
            "children": arr(structure={"text": text("name")}, children=("customer", "gone")),
        },
    )
    (row,) = records_of(read_records(spark, xml_file(ORDER), spec))
    assert row["items"] == '[{"sku":"a","qty":"1","price":"2.5"},{"sku":""}]'
    assert "none" not in row and "missing" not in row
    assert json.loads(row["customer"]) == {"name": 'Ann "A" & Co'}
    assert row["hollow"] == "{}" and row["bare"] == "{}"
    assert json.loads(row["all"]) == {
        "id": "7",
        "who": {"name": 'Ann "A" & Co'},
        "lines": [{"sku": "a", "more": {"n": "1"}}, {"sku": "", "more": {}}],
    }
    assert json.loads(row["children"]) == [{"text": 'Ann "A" & Co'}, {}]


def test_same_path_under_two_keys(spark, xml_file):
    spec = XmlSpec(("orders", "order"), {"a": attr("id"), "b.c": attr("id")})
    assert records_of(read_records(spark, xml_file(ORDER), spec)) == [{"a": "7", "b.c": "7"}]


def test_names_that_differ_in_case(spark, xml_file):
    path = xml_file('<r><x ID="1" id="2"/></r>')
    spec = XmlSpec(("r", "x"), {"a": attr("ID"), "b": attr("id")})
    with pytest.raises(MappingError, match="caseSensitive"):
        read_records(spark, path, spec)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert records_of(read_records(spark, path, spec)) == [{"a": "1", "b": "2"}]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_directory_scan(spark, tmp_path, xml_file):
    for name in ("a.xml", "sub/b.XML", "sub/deep/c.xMl"):
        xml_file(f"<log><reading>{name}</reading></log>", name)
    xml_file("<log><reading>no</reading></log>", "d.txt")
    (tmp_path / "empty.xml").touch()
    import gzip

    (tmp_path / "e.xml.gz").write_bytes(gzip.compress(b"<log><reading>gz</reading></log>"))
    for scan in ("document", "auto"):
        rows = read_records(spark, str(tmp_path), READING, scan=scan).select("_source_name", "level", MALFORMED).collect()
        assert sorted((r[0], r[1]) for r in rows) == [
            ("a.xml", "a.xml"), ("b.XML", "sub/b.XML"), ("c.xMl", "sub/deep/c.xMl"), ("e.xml", "gz")]
        assert not any(r[2] for r in rows)


def test_file_condition_opens_no_other_file(spark, tmp_path, xml_file):
    xml_file("<log><reading>a</reading></log>", "a.xml")
    (tmp_path / "b.xml").write_bytes(b"<log><reading>\xff</reading></log>")  # ends the job that reads it
    frame = read_records(spark, str(tmp_path), READING, scan="record", files=F.col("_metadata.file_name").rlike("^a"))
    assert levels(frame) == ["a"]
    with pytest.raises(Exception):
        read_records(spark, str(tmp_path), READING, scan="record").collect()


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_records(spark, str(tmp_path / "none.xml"), READING)


def test_complete_elements():
    document = "<?xml version='1.0' encoding='windows-1251'?><p:a><b><c x='&lt;'>1<!-- --><d/>é</c></b><c/><b><c>2</c><c>3"
    assert complete_elements(document, ("a", "b", "c")) == ['<c x="&lt;">1<!----><d></d>é</c>', "<c>2</c>"]
    assert complete_elements("no xml", ("a",)) == []


_TEXT = st.text(
    st.characters(codec="utf-8", exclude_categories=("Cs", "Cc", "Co", "Cn", "Zs", "Zl", "Zp"), exclude_characters="﻿"),
    min_size=1,
    max_size=12,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_TEXT, _TEXT), min_size=1, max_size=30))
def test_round_trip(spark, tmp_path, rows):
    from xml.sax.saxutils import escape, quoteattr

    body = "".join(f"<item a={quoteattr(a)}><b>{escape(b)}</b></item>" for a, b in rows)
    path = tmp_path / "round.xml"
    path.write_text(f"<root>{body}</root>", encoding="utf-8")
    spec = XmlSpec(("root", "item"), {"a": attr("a"), "b": text("b")})
    expected = [{"a": a, "b": b} for a, b in rows]
    for scan in ("document", "record", "split"):
        assert records_of(read_records(spark, str(path), spec, scan=scan)) == expected


def test_wrong_bytes_are_replaced_when_decoded(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(b"<log><reading>ok</reading><reading>bad \xff byte</reading></log>")
    (tmp_path / "with space.xml").write_bytes(b"<log><reading>fine</reading></log>")
    for options in ({"encoding": "utf-8"}, {"scan": "auto"}):
        frame = read_records(spark, str(tmp_path), READING, **options)
        assert sorted(levels(frame)) == ["bad � byte", "fine", "ok"]
    skipped = read_records(spark, str(tmp_path), READING, skip_unreadable=True)
    assert levels(skipped) == ["fine"]


CUT = {
    "plain": '<?xml version="1.0" encoding="UTF-8"?>\n<!-- a --><crates at="1"><crate id="1"/> <crate id="2">x</crate>\n</crates>\n',
    "no declaration": "<crates>\n<crate id='1' >a</crate></crates >",
    "comment between": "<crates><crate id='1'>a</crate><!-- b --><crate id='2'>c</crate><!-- d --></crates><!-- e -->",
    "child alike": "<crates><crate id='1'><crated/><w/></crate><crates2/><crate id='2'>a</crate></crates>",
    "prefixed parent": "<p:crates xmlns:p='u'><crate id='1'>a</crate></p:crates>",
    "space in end tag": "<crates><crate id='1'>a</crate ><crate id='2'>b</crate></crates>",
    "only empty records": "<crates><crate id='1'/><crate id='2'/></crates>",
    "prefixed records": "<crates xmlns:p='u'><p:crate id='1'>a</p:crate></crates>",
    "tag in comment": "<crates><crate id='1'>a</crate><!-- <crate id='2'/> --></crates>",
    "no records": "<crates></crates>",
}
STREAMED = {
    "record elsewhere": "<crates><crate id='1'>a</crate><g><crate id='2'>b</crate></g></crates>",
    "other encoding": "<?xml version='1.0' encoding='windows-1251'?><crates><crate id='1'>a</crate></crates>",
    "end in text": "<crates><crate id='1'><![CDATA[</crate>]]></crate></crates>",
    "end in comment": "<crates><crate id='1'><!--</crate>--></crate></crates>",
    "nested": "<crates><crate id='1'>a<crate id='2'>b</crate></crate></crates>",
    "other root": "<other><crate id='1'>a</crate></other>",
    "root below": "<other><crates><crate id='1'>a</crate></crates><crates/></other>",
    "truncated": "<crates><crate id='1'>a</crate><crate id='2'>b</crate><crate>",
    "two documents": "<crates><crate id='1'>a</crate></crates><crates><crate id='2'>b</crate></crates>",
    "entity": "<!DOCTYPE crates [<!ENTITY e 'x'>]><crates><crate id='1'>&e;</crate></crates>",
}


def test_files_are_cut_only_where_that_is_right(spark, tmp_path):
    spec = XmlSpec(("crates", "crate"), {"id": attr("id"), "v": text()})
    for name, document in (CUT | STREAMED).items():
        (tmp_path / f"{name}.xml").write_text(document, encoding="utf-8")
    found = {}
    for scan in ("auto", "document"):
        rows = read_records(spark, str(tmp_path), spec, scan=scan).orderBy("_source", "_position").collect()
        for row in rows:
            name = row._source_name.removesuffix(".xml").replace("%20", " ")
            found.setdefault((scan, name), []).append((row.id, row.v, row._malformed))
    for name in CUT | STREAMED:
        by_auto, by_document = found.get(("auto", name), []), found.get(("document", name), [])
        # Two roots are not XML, and the first one's records are kept. Only streamed files have entities of their own.
        if name not in ("two documents", "entity"):
            assert by_auto == by_document, name
        assert bool(by_auto) is (name not in ("no records", "other root", "root below")), name
    verdicts = {r.file.rpartition("/")[2].replace("%20", " "): r.exact for r in cut_exactly(spark, str(tmp_path), spec).collect()}
    assert {f"{n}.xml" for n in CUT} == {n for n, exact in verdicts.items() if exact}


def test_groups_of_records_are_cut(spark, xml_file):
    batches = "".join(f"<p:batch n='{b}'> <row id='{b}'>a</row><row id='{b}x'/><!-- --></p:batch >\n" for b in range(30))
    path = xml_file(f"<feed xmlns:p='u'>{batches}</feed>")
    spec = XmlSpec(("feed", "batch", "row"), {"id": attr("id"), "v": text()})
    wanted = [r for b in range(30) for r in ({"id": str(b), "v": "a"}, {"id": f"{b}x"})]
    for scan in ("document", "auto"):
        assert records_of(read_records(spark, path, spec, scan=scan)) == wanted


def test_missing_bytes_are_noticed(spark, xml_file, monkeypatch):
    """A piece that the reader passes over does not vanish: the file is streamed."""
    from feedloom.sources import xml

    monkeypatch.setattr(xml, "LONGEST_PIECE", 1000)
    path = xml_file(f"<log><reading>1</reading><reading>{'2' * 3000}</reading><reading>3</reading></log>")
    assert [r.exact for r in cut_exactly(spark, path, READING).collect()] == [False]
    assert levels(read_records(spark, path, READING, scan="auto")) == ["1", "2" * 3000, "3"]


def test_other_root_gives_nothing_in_any_scan(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<w><log><reading>1</reading></log><z><log><reading>2</reading></log></z></w>")
    (tmp_path / "b.xml").write_text("<p:log xmlns:p='u'><reading>3</reading></p:log>")
    for scan in SCANS:
        assert levels(read_records(spark, str(tmp_path), READING, scan=scan)) == ["3"], scan
    assert levels(read_records(spark, str(tmp_path), READING, encoding="utf-8")) == ["3"]
