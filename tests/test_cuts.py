"""Files in other encodings and with nested records are cut into pieces, natively, and give what a whole parse gives."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from feedloom.plans.mapping import ValueSpec, ValueType, XmlSpec
from feedloom.sources import cuts, xml
from feedloom.sources.xml import cut_records, read_records
from tests.conftest import records_of

SPEC = XmlSpec(("orders", "order"), {"id": ValueSpec(("id",), ValueType.ATTRIBUTE), "name": ValueSpec(("name",), ValueType.CONTENT)})
DEEP = XmlSpec(("feed", "batch", "order"), SPEC.values)


def _scan(spark, path, spec=SPEC, encoding=None, **conf):
    """(records, names of the folders that have some), cut in small splits."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "2k")
    try:
        rows, folders = cut_records(spark, path, spec, F.col("_metadata.file_size") > 0, encoding=encoding)
        cut = {f for f in folders if not f.endswith("streamed") and spark.read.parquet(f"{f}-verdicts").where("exact").count()}
        cut |= {f for f in folders if f.endswith("streamed") and spark.read.parquet(f).where("NOT _malformed").count()}
        return records_of(rows), {f.rpartition("/")[2] for f in cut}
    finally:
        spark.conf.set(name, before)


def _document(n, text, encoding):
    body = "".join(f'<order id="{i}"><name>{text} {i}</name></order>\n' for i in range(n))
    return f'<?xml version="1.0" encoding="{encoding}"?>\n<orders>\n{body}</orders>\n'


@pytest.mark.parametrize("encoding", ["windows-1251", "koi8-r", "iso-8859-1", "utf-16", "utf-16-be"])
def test_other_encodings_are_cut(spark, xml_file, encoding):
    text = "café" if encoding == "iso-8859-1" else "Привет – №" if encoding == "windows-1251" else "Привет"
    declared = "utf-16" if encoding.startswith("utf-16") else encoding
    document = _document(300, text, declared)
    mark = "﻿" if encoding in ("utf-16-le", "utf-16-be") else ""
    path = xml_file(mark + document, encoding=encoding)
    found, used = _scan(spark, path)
    assert found == [{"id": str(i), "name": f"{text} {i}"} for i in range(300)]
    assert len(used) == 1 and used.pop().startswith("coded-")


def test_an_encoding_that_is_given_is_cut(spark, xml_file):
    path = xml_file(_document(100, "Привет", "utf-8"), encoding="koi8-r")
    found, used = _scan(spark, path, encoding="koi8-r")
    assert [r["name"] for r in found] == [f"Привет {i}" for i in range(100)] and used == {"coded-koi8-r"}


def test_tags_that_are_not_ascii(spark, xml_file):
    spec = XmlSpec(("заказы", "заказ"), {"id": ValueSpec(("id",), ValueType.ATTRIBUTE), "имя": ValueSpec(("имя",), ValueType.CONTENT)})
    body = "".join(f'<заказ id="{i}"><имя>Ж{i}</имя></заказ>' for i in range(200))
    for encoding in ("windows-1251", "utf-16"):
        path = xml_file(f'<?xml version="1.0" encoding="{encoding}"?><заказы>{body}</заказы>', f"{encoding}/x.xml", encoding)
        found, used = _scan(spark, path, spec)
        assert [(r["id"], r["имя"]) for r in found] == [(str(i), f"Ж{i}") for i in range(200)]
        assert used == {"coded-cp1251" if encoding != "utf-16" else "coded-utf-16-le"}


def test_encodings_without_a_table_are_streamed(spark, xml_file):
    assert cuts.upper_half("shift_jis") is None and cuts.upper_half("utf-8") is None and cuts.upper_half("no-such") is None
    assert len(cuts.upper_half("cp1252")) == 128
    found, used = _scan(spark, xml_file(_document(50, "日本", "shift_jis"), encoding="shift_jis"))
    assert len(found) == 50 and used == {"streamed"}


@pytest.mark.parametrize("order", ["le", "be"])
def test_wrong_surrogates_are_found(spark, order):
    texts = ["a🙂b", "日本", ""]
    raw = [t.encode(f"utf-16-{order}") for t in texts]
    lone = "\ud800".encode(f"utf-16-{order}", "surrogatepass")
    raw += [lone, raw[0] + lone, lone + raw[1], b"\x00", "\udc00\ud800".encode(f"utf-16-{order}", "surrogatepass")]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary")
    got = [r[0] for r in df.orderBy("i").select(cuts.decoded(F.col("b").cast("string"), f"utf-16-{order}")).collect()]
    assert got == [*texts, *[None] * 5]


def test_no_python_in_the_plan_of_cut_files(spark, xml_file):
    path = xml_file(_document(10, "Привет", "windows-1251"), encoding="windows-1251")
    rows = xml._cut_rows(spark, path, SPEC, F.lit(True), None, "PERMISSIVE", "first", "cp1251")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def _nested(n, seed):
    """Orders within orders, in other elements, in comments and text sections, and parents that end and begin again."""
    pick = random.Random(seed)

    def order(i, depth):
        inner = "".join(order(-i, depth + 1) for _ in range(pick.randint(0, 2))) if depth < 3 else ""
        shape = pick.random()
        if shape < 0.1:
            return f'<order id="{i}"/>'
        odd = pick.choice(["", "<!-- <order> & </x> -->", "<![CDATA[<order id='9'>]]>", "<note a='1 > 0' b=\"</\"/>".replace("</", "x")])
        return f'<order id="{i}">{odd}<list>{inner}</list><name>n{i}</name></order>'

    parts = []
    for i in range(n):
        parts.append(order(i, 0))
        if pick.random() < 0.3:
            parts.append(f'<archive><order id="{10_000 + i}"><name>old</name></order></archive>')
        if pick.random() < 0.2:
            parts.append("\n</batch>\n<batch kind='x'>\n")
    return "".join(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_nested_records_are_cut_and_put_together(spark, xml_file, seed):
    flat = _nested(150, seed).replace("\n</batch>\n<batch kind='x'>\n", "\n")
    for name, spec, text in (("flat", SPEC, f"<orders>{flat}</orders>"), ("deep", DEEP, f"<feed><batch>{_nested(150, seed)}</batch></feed>")):
        path = xml_file(text, f"{name}.xml")
        found, used = _scan(spark, path, spec)
        assert found == records_of(read_records(spark, path, spec, scan="document")) and len(found) >= 150
        assert used == {"nested-utf-8"}


def test_nested_records_in_another_encoding(spark, xml_file):
    path = xml_file(f'<?xml version="1.0" encoding="koi8-r"?><orders>{_nested(60, 5)}</orders>'.replace("n1", "Ж1"), encoding="koi8-r")
    text = _nested(60, 5).replace("\n</batch>\n<batch kind='x'>\n", "\n").replace(">n", ">Ж")
    path = xml_file(f'<?xml version="1.0" encoding="koi8-r"?><orders>{text}</orders>', "k.xml", "koi8-r")
    found, used = _scan(spark, path)
    assert found == records_of(read_records(spark, path, SPEC, scan="document")) and used == {"nested-koi8-r"}


def test_what_does_not_fit_is_streamed(spark, xml_file, monkeypatch):
    """Another parent of the same depth, a cut in a comment, an error, and records longer than a task may hold."""
    one = "<order id='1'><order id='-1'/><name>a</name></order>"
    cases = {
        "parent": f"<feed><other>{one}</other><batch>{one}</batch></feed>",
        "comment": f"<feed><batch><!-- </order> </batch> -->{one}</batch></feed>",
        "error": f"<feed><batch>{one}</wrong></batch></feed>",
    }
    for name, text in cases.items():
        path = xml_file(text, f"{name}.xml")
        assert _scan(spark, path, DEEP)[0] == ([{"id": "1", "name": "a"}]), name
    path = xml_file(f"<feed><batch>{_nested(40, 8)}</batch></feed>", "long.xml")
    whole = records_of(read_records(spark, path, DEEP, scan="document"))
    monkeypatch.setattr(xml, "LONGEST_PIECE", 300)
    found, used = _scan(spark, path, DEEP)
    assert found == whole and "streamed" in used


def test_pieces_of_one_file_are_many_tasks(spark, xml_file):
    path = xml_file(f"<orders>{_nested(400, 9)}</orders>".replace("\n</batch>\n<batch kind='x'>\n", ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        pieces = xml._pieces(spark, path, F.lit(True), None, "</order>")
        assert pieces.select("block").distinct().count() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("tail", ["<orders><order id='2'><name>b</name></order></orders>", "<x/>", "text", "</orders>"])
def test_a_root_that_was_closed_gives_its_records_once(spark, xml_file, tail):
    path = xml_file("<orders><order id='1'><name>a</name></order></orders>" + tail)
    for scan in ("document", "auto"):
        rows = read_records(spark, path, SPEC, scan=scan)
        assert records_of(rows) == [{"id": "1", "name": "a"}] and rows.where("_malformed").count() == 1, scan


def test_partitions_of_the_cutting_queries_grow_with_the_files(spark, tmp_path):
    """Tasks of a cutting query are a few for each file, not one for every 64 KB."""
    from feedloom_queries.common import ORDER_VALUES
    from feedloom_queries.scans import _cut_natively

    body = "".join(f"<order id='{n}'><price>{n}</price><pad>{'x' * 1000}</pad></order>" for n in range(2000))
    (tmp_path / "a.xml").write_text(f"<orders>{body}</orders>")
    rows = _cut_natively(spark, str(tmp_path), XmlSpec(("orders", "order"), ORDER_VALUES))
    assert rows.count() == 2000 and rows.where("cut").count() == 2000
    folder = next(f for f in rows.inputFiles() if "/cut/" in f).rpartition("/")[0].removeprefix("file://")
    assert 4 <= len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 6


@pytest.mark.parametrize("tail", ["</orders><orders><order id='9'/></orders>", "</orders><x/>", "<order id='8'/>", "<order id='8'></orders>", "&no;</orders>"])
@pytest.mark.parametrize("middle", ["", "<order id='7'>a & b</order>"])
def test_broken_documents_are_cut_up_to_their_error(spark, tmp_path, monkeypatch, tail, middle):
    record = lambda n: f"<order id='{n}'><name>n{n}</name><pad>{'x' * 100}</pad></order>"
    head, rest = "".join(map(record, range(100, 200))), "".join(map(record, range(200, 220)))
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?><orders>{head}{middle}{rest}{tail}")
    whole = xml.read_decoded(xml.list_files(spark, str(tmp_path)), SPEC)
    marks = whole.where("_malformed").count()
    found, folders = _scan(spark, str(tmp_path))
    assert marks == 1 and found == records_of(whole) and not folders
    monkeypatch.setattr(xml, "LONGEST_DOCUMENT", 1000)
    rows = read_records(spark, str(tmp_path), SPEC)
    assert records_of(rows) == found and rows.where("_malformed").count() == 1
    assert any("feedloom-cut" in f for f in rows.inputFiles())


@pytest.mark.parametrize("name", ["b.xml.gz", "b.xml.bz2", "b.xml"])
def test_compressed_files_of_nothing_are_empty_files(spark, tmp_path, name):
    import bz2
    import gzip

    (tmp_path / "a.xml").write_text('<orders><order id="1"><name>x</name></order></orders>')
    pack = {"z": gzip.compress, "2": bz2.compress}.get(name[-1], bytes)
    (tmp_path / name).write_bytes(pack(b""))
    for scan in ("auto", "document"):
        rows = read_records(spark, str(tmp_path), SPEC, scan=scan)
        assert [(row.id, row._malformed) for row in rows.collect()] == [("1", False)]


def test_change_of_depth_beside_other_markup(spark):
    texts = {"<a><b x='>'>": 2, "<a><!-- </a> --></a>": 0, "<![CDATA[</a>]]></a>": -1, "<?p </a>?><a/>": 0, "</a></a>": -2, "": 0}
    rows = spark.createDataFrame([(text,) for text in texts], "t string").select("t", cuts.depth_change(F.col("t")).alias("change"))
    assert {row.t: row.change for row in rows.collect()} == texts


def test_pieces_between_the_parents_are_told_by_a_name(spark, xml_file):
    path = xml_file("<orders>" + "<order id='1'><name>a</name></order>" * 3 + "</orders>")
    rows = xml._cut_rows(spark, path, SPEC, F.lit(True), None, "PERMISSIVE", "first")
    assert "Contains(value" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [row.exact for row in xml.cut_exactly(spark, path, SPEC).collect()] == [True]


def test_pieces_in_another_encoding_are_parsed_in_it_only(spark, xml_file):
    """Nothing of a file that is no UTF-8 is given to the parser before its encoding is known."""
    path = os.path.dirname(xml_file(_document(40, "Заказ", "windows-1251"), "a.xml", "windows-1251"))
    xml_file(_document(40, "Заказ", "utf-8"), "b.xml")
    xml_file(_document(40, "Заказ", "utf-16"), "c.xml", "utf-16")
    rows = xml._cut_rows(spark, path, SPEC, F.col("_metadata.file_size") > 0, None, "PERMISSIVE", "first")
    found = rows.where("_cut.is_record").groupBy("_source_name").count().collect()
    assert [tuple(r) for r in found] == [("b.xml", 40)]
    assert len(records_of(read_records(spark, path, SPEC, scan="auto"))) == 120


@pytest.mark.parametrize("charset", ["utf-16-le", "utf-16-be"])
def test_utf_16_with_and_without_surrogates(spark, charset):
    units = ["0417", "00d8", "d800", "dc00", "dfff", "d8d8", "20d9", "0041"]
    given = [bytes.fromhex(a + b) for a in units for b in units] + [b"", b"a", bytes.fromhex("d800dc00d8"), "Заказ 😀".encode(charset)]
    if charset == "utf-16-le":
        given += [bytes(x for i in range(0, len(g) - 1, 2) for x in (g[i + 1], g[i])) for g in given]
    rows = spark.createDataFrame([(bytearray(g),) for g in given], "b binary")
    raw = rows.select("b", F.col("b").cast("string").alias("s"))
    for row in raw.select("b", cuts.decoded(F.col("s"), charset).alias("text")).collect():
        try:
            wanted = bytes(row.b).decode(charset)
        except UnicodeDecodeError:
            wanted = None
        assert row.text == wanted, bytes(row.b).hex()
