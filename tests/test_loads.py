"""De-duplication, upsert, sinks, whole runs, archives and streams."""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import cast_to
from feedloom.operators.dedup import batch_winner, dedup_first, mark_missing_key, number_rows
from feedloom.operators.upsert import row_bytes, upsert
from feedloom.operators.validate import apply_error_policy
from feedloom.plans.columns import REASON
from feedloom.plans.load import LoadError, run
from feedloom.plans.mapping import Mapping, MappingError, TableId, TableSpec, ValueSpec, ValueType, XmlSpec
from feedloom.sinks.tables import (
    JdbcTables,
    MergeTables,
    ParquetTables,
    merge_statement,
    scratch_dir,
    spark_merge_statement,
)
from feedloom.sources.archives import expand_archives, extract_archives
from feedloom.streaming.ingest import run_stream, source_options


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- casts -----------------------------------------------------------------------------------------------------------

GOOD = {
    "boolean": [("YES", True), ("t", True), ("on", False), ("", False)],
    "int": [("+5", 5), ("-2147483648", -(2**31)), ("007", 7)],
    "double": [("1,5", 1.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("2d", 2.0), ("Infinity", float("inf")), ("1e999", float("inf"))],
    "decimal(6,2)": [("1,5", "1.50"), ("1.005", "1.01"), ("-9999.99", "-9999.99"), ("1E2", "100.00")],
    "date": [("2024-01-02", "2024-01-02"), ("2024-01-02T00:00:00", "2024-01-02"), ("2024-01-02x", "2024-01-02")],
    "timestamp_ntz": [
        ("2024-01-02T03:04:05+03:00", "2024-01-02 00:04:05"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04", "2024-01-02 03:04:00"), ("2024-01-02", "2024-01-02 00:00:00"),
        ("2024-01-02T03:04:05.5Z", "2024-01-02 03:04:05.5"), ("2024-01-02T03:04:05-05:00", "2024-01-02 08:04:05")],
    "timestamp": [("2024-01-02T03:04:05+03:00", "2024-01-02 00:04:05"), ("2024-01-02T03:04:05", "2024-01-02 03:04:05")],
    "binary": [("0aFF", bytearray(b"\x0a\xff"))],
    "string": [(" x ", " x ")],
}
BAD = {
    "int": ["1.0", "2147483648", " 1", "1 ", "x", "1e3", ""],
    "double": ["1.2.3", "inf", "nan", "NAN", "x", "1 2", ""],
    "decimal(6,2)": ["12345.6", "x", " 1", ""],
    "date": ["02.01.2024", "2024-1-2", "2024-13-01", "2024-02-30", "x2024-01-02", "2024"],
    "timestamp_ntz": ["2024", "2024-01", "2024-01-02 3:04:05", "2024-01-02T25:00:00", "2024-01-02 03:04:05 UTC", "03:04:05"],
    "timestamp": ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05 Europe/Paris"],
    "binary": ["abc", "zz"],
}


@pytest.mark.parametrize("type_", GOOD)
def test_texts_that_fit(spark, type_):
    given = spark.createDataFrame([(text,) for text, _ in GOOD[type_]], "v string")
    field = T.StructField("v", T.DataType.fromDDL(type_))
    good, bad = cast_to(given, T.StructType([field]))
    assert bad.count() == 0
    shown = good if type_ in ("boolean", "int", "double", "binary", "string") else good.select(F.col("v").cast("string"))
    assert [r[0] for r in shown.collect()] == [value for _, value in GOOD[type_]]


@pytest.mark.parametrize("type_", BAD)
def test_texts_that_do_not_fit(spark, type_):
    given = spark.createDataFrame([(text,) for text in BAD[type_]], "v string")
    good, bad = cast_to(given, T.StructType([T.StructField("v", T.DataType.fromDDL(type_))]))
    assert good.collect() == []
    assert {r[REASON] for r in bad.collect()} == {f"cast:v:{type_}"}


@pytest.mark.parametrize("type_", ["tinyint", "smallint", "int", "bigint"])
def test_integers_are_what_a_cast_gives(spark, type_):
    from feedloom.functions.casts import _unpadded, to_integer

    top = 2 ** ({"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[type_] - 1)
    edges = [f"{sign}{top + d}" for sign in ("", "+", "-", "-000", "0" * 40) for d in (-1, 0, 1)]
    texts = [*edges, "", "+", "-", "--1", "1-", "+-1", "0", "-0", "+0", "00", "1.0", "1.", ".", "1e3", "0x1", "1_0", "١", "1L", " 1", "1 "]
    texts += [f"{c}7" for c in "\x00\x01\x0b\x1b\x7f\x85\u200b\u2028"] + [f"7{c}" for c in "\x00\x01\x0b\x1b\x7f\x85\u200b\u2028"]
    texts += ["9" * 19, "9" * 20, "1" + "0" * 60, "\x015\n", "5\x01 "]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    v, kind = F.col("v"), T.DataType.fromDDL(type_)
    found = rows.select("v", to_integer(v, kind).alias("a"), F.when(_unpadded(v), v.try_cast(type_)).alias("b"))
    assert found.schema["a"].dataType == kind
    assert [(r.v, r.a) for r in found.collect()] == [(r.v, r.b) for r in found.collect()]


def test_texts_that_are_no_integers_are_not_cast(spark, monkeypatch):
    """A cast that fails makes an exception in each row; here it would end the job."""
    from pyspark.sql import Column

    from feedloom.functions.casts import to_integer

    monkeypatch.setattr(Column, "try_cast", Column.cast)
    texts = ["abc", "1e3", "7.0", "1" + "0" * 20, "", "-"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        rows = spark.createDataFrame([(t,) for t in [*texts, "300", "5"]], "v string")
        assert [r[0] for r in rows.select(to_integer(F.col("v"), T.ByteType())).collect()] == [None] * 7 + [5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_json_and_time_texts(spark):
    texts = ['{"k":1}', "[1]", '"s"', "null", '{"k":1}}', "1,2", "1] [2", '1,"a":2', "{'a':1}", "", "{"]
    given = spark.createDataFrame([(t, "1:2:3") for t in texts], "j string, t string")
    target = T.StructType(
        [T.StructField("j", T.StringType(), metadata={"type": "json"}), T.StructField("t", T.StringType(), metadata={"type": "time"})]
    )
    good, _ = cast_to(given, target)
    assert [tuple(r) for r in good.collect()] == [(t, "01:02:03") for t in texts[:4]]


def test_time_type(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        given = spark.createDataFrame([("01:02:03",), ("1:2:3",), ("25:00:00",), ("01:02",)], "v string")
        good, bad = cast_to(given, T.StructType([T.StructField("v", T.TimeType(0))]))
        assert [r[0] for r in good.select(F.col("v").cast("string")).collect()] == ["01:02:03", "01:02:03"]
        assert bad.count() == 2
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_scratch_folders_follow_the_session(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_variant(spark):
    given = spark.createDataFrame([('{"k":1}',), ("{",)], "v string")
    good, bad = cast_to(given, T.StructType([T.StructField("v", T.VariantType())]))
    assert good.select(F.to_json("v")).collect()[0][0] == '{"k":1}'
    assert bad.count() == 1


def test_cast_errors_end_the_job_on_request(spark):
    given = spark.createDataFrame([("1",), ("x",)], "v string")
    good, _ = cast_to(given, T.StructType([T.StructField("v", T.IntegerType())]), on_error="fail")
    with pytest.raises(Exception, match="cast:v:int"):
        good.count()
    with pytest.raises(ValueError):
        apply_error_policy(given, "ignore", "x")


# --- de-duplication and upsert ---------------------------------------------------------------------------------------


def test_dedup_without_keys_keeps_all(spark):
    rows = spark.createDataFrame([(1,), (1,)], "a int")
    assert dedup_first(rows, [], ["a"]).count() == 2
    assert dedup_first(rows, ["a"], ["a"]).count() == 1


def test_missing_keys(spark):
    rows = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    reasons = [r[REASON] for r in mark_missing_key(rows, ["x", "y"]).collect()]
    assert reasons == [None, "missing_key:x", "missing_key:y"]


def brute_force_winner(rows, batch_size):
    """Batches written one after the other, the first row of a key per batch."""
    table = {}
    for source in sorted({r[0] for r in rows}):
        mine = sorted(r for r in rows if r[0] == source)
        for start in range(0, len(mine), batch_size):
            seen = set()
            for row in mine[start : start + batch_size]:
                if row[2] not in seen:
                    seen.add(row[2])
                    table[row[2]] = row
    return sorted(table.values())


@pytest.mark.parametrize("batch_size", [1, 3, 7, 1000])
def test_batch_winner_against_brute_force(spark, batch_size):
    # One source and one key hold most of the rows.
    rows = [("big", 3 * i, 0 if i % 3 == 0 else i % 17, i) for i in range(300)]
    rows += [("a", i, i % 5, i) for i in range(20)] + [("z", i, i % 4 + 15, -i) for i in range(9)]
    frame = spark.createDataFrame(rows, "source string, at long, key int, v int").repartition(5)
    won = batch_winner(frame, ["key"], "source", [F.col("at")], batch_size)
    assert rows_of(won, "source", "at", "key", "v") == sorted(brute_force_winner(rows, batch_size), key=repr)


def test_row_numbers_span_ranges(spark):
    frame = spark.range(0, 1000).select(F.lit("s").alias("s"), (F.col("id") * 7).alias("at"), F.lit(0).cast("long").alias("b"))
    numbered = number_rows(frame, "s", [F.col("b"), F.col("at")], chunk=100)
    assert rows_of(numbered, "_sequence", "at") == sorted(((i, 7 * i) for i in range(1000)), key=repr)
    assert numbered.columns == ["s", "at", "b", "_sequence"]


@pytest.mark.parametrize("size", [None, 1])
def test_upsert(spark, size):
    schema = T.StructType(
        [T.StructField("K", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType(), True, {"default": "d"})]
    )
    target = spark.createDataFrame([(1, "old", "keep"), (2, "old", "keep"), (None, "no key", "keep")], schema)
    source = spark.createDataFrame([(2, None), (3, "new")], "k long, A string")
    merged = upsert(target, source, ["k"], schema, size)
    assert merged.columns == ["K", "a", "b"]
    assert rows_of(merged) == sorted(
        [(1, "old", "keep"), (2, None, "keep"), (None, "no key", "keep"), (3, "new", "d")], key=repr
    )
    only_keys = upsert(target, source.select("k"), ["k"], schema, size)
    assert rows_of(only_keys) == sorted(
        [(1, "old", "keep"), (2, "old", "keep"), (None, "no key", "keep"), (3, None, "d")], key=repr
    )
    assert upsert(target, source, [], schema).count() == 5


def test_small_sources_are_broadcast_and_large_ones_are_not(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, source = spark.range(10).withColumn("v", F.lit(1)), spark.range(5).withColumn("v", F.lit(2))
        for size, broadcast in ((1, True), (10**12, False), (None, False)):
            plan = upsert(target, source, ["id"], None, size)._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) is broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sources_that_are_small_on_disk_only_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr("feedloom.operators.upsert.BROADCAST_ROW_BYTES", 100_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(10).withColumn("v", F.lit("old"))
        for n, broadcast in ((100, True), (2000, False)):
            source = spark.range(n).withColumn("v", F.repeat(F.lit("x"), 100))
            assert row_bytes(source) == n * (3 * 8 + 100)
            merged = upsert(target, source, ["id"], None, 1)
            assert ("BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()) is broadcast
            assert merged.count() == n and merged.where("v = 'old'").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    nested = spark.sql("SELECT array('ab') AS a, CAST(1 AS DECIMAL(20, 2)) AS d, CAST(NULL AS STRING) AS s")
    assert row_bytes(nested) > 4 * 8 + 16 and row_bytes(nested.limit(0)) == 0


# --- sinks -----------------------------------------------------------------------------------------------------------

TABLE = TableId("t", "s")


def test_statements(spark):
    assert merge_statement(TABLE, "stage", ["k", 'a"b'], ["K"]) == (
        'INSERT INTO "s"."t" ("k", "a""b") SELECT "k", "a""b" FROM stage'
        ' ON CONFLICT ("K") DO UPDATE SET "a""b" = EXCLUDED."a""b"'
    )
    assert merge_statement(TABLE, "stage", ["k"], ["k"]).endswith('ON CONFLICT ("k") DO NOTHING')
    assert "CONFLICT" not in merge_statement(TABLE, "stage", ["k"], [])
    parser = spark._jsparkSession.sessionState().sqlParser()
    for columns, keys in ((["k", "a"], ["k"]), (["k"], ["k"])):
        parser.parsePlan(spark_merge_statement("s.t", "v", columns, keys))
        parser.parsePlan(MergeTables(spark).statement(TABLE, "v", columns, keys))
    parser.parsePlan(MergeTables(spark, {TABLE: "c.s.t"}).statement(TABLE, "v", ["k"], []))


def test_jdbc_statements_run_in_order(spark):
    ran = []
    sink = JdbcTables(spark, "jdbc:none:", {}, execute=ran.append)
    with pytest.raises(Exception):
        sink.load(TABLE, spark.range(1), ["id"])
    assert [str(s[0])[:20] for s in ran] == ["DROP TABLE IF EXISTS"]  # the staging write failed, so nothing may be merged


def test_jdbc_loads_of_several_tables_under_one_token(spark, monkeypatch):
    other = TableId("u", "s")
    fields = T.StructType([T.StructField("id", T.LongType()), T.StructField("j", T.StringType(), metadata={"type": "jsonb"})])
    ran = []
    sink = JdbcTables(spark, "jdbc:none:", {}, execute=ran.append, targets={TABLE: fields})
    monkeypatch.setattr(sink, "_stage", lambda rows, staging: ran.append(["STAGE " + staging]))
    rows = spark.createDataFrame([(1, "{}")], "id long, J string")
    for table in (TABLE, other):
        sink.load(table, rows, ["id"], token="x" * 80)
    stages = [s[0].removeprefix("STAGE ") for s in ran if s[0].startswith("STAGE")]
    assert len(set(stages)) == 2 and all(len(name) <= 65 for name in stages)
    create, merge, note = ran[1]
    assert create.startswith("CREATE TABLE IF NOT EXISTS") and note.startswith("INSERT INTO") and note.endswith("DO NOTHING")
    assert 'CAST("J" AS jsonb)' in merge and "WHERE NOT EXISTS" in merge and 'ON CONFLICT ("id")' in merge
    assert ran[2] == [f"DROP TABLE IF EXISTS {stages[0]}"]
    assert "CAST" not in ran[4][1] and sink.staging(TABLE, "a") != sink.staging(TABLE, "b")


def test_merge_tables_skip_a_repeated_load(spark):
    name = "loads_of_one_token"
    spark.sql(f"CREATE TABLE {name} (k BIGINT) USING parquet")
    try:
        sink = MergeTables(spark, {TABLE: name})
        for token in ("a", "a", "b"):
            sink.load(TABLE, spark.range(2).withColumnRenamed("id", "k"), [], token)
        assert spark.table(name).count() == 4
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_parquet_tables(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    store = ParquetTables(spark, str(tmp_path), {TABLE: schema})
    assert store.read(TABLE).count() == 0
    store.load(TABLE, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["k"], token="x-1")
    store.load(TABLE, spark.createDataFrame([(2, "c"), (3, "d")], schema), ["k"], token="x-2")
    store.load(TABLE, spark.createDataFrame([(2, "again")], schema), ["k"], token="x-2")
    assert rows_of(store.read(TABLE)) == [(1, "a"), (2, "c"), (3, "d")]
    # A version without its success file never happened.
    broken = tmp_path / "s.t" / "v00000009-dead"
    broken.mkdir()
    assert rows_of(store.read(TABLE)) == [(1, "a"), (2, "c"), (3, "d")]
    for _ in range(2):
        store.load(TABLE, spark.createDataFrame([(4, "e")], schema), [], token="x-3")
    assert store.read(TABLE).count() == 4
    store.drop_old_versions(TABLE, keep=1)
    assert sorted(p.name for p in (tmp_path / "s.t").iterdir()) == ["v00000002-x-2", "v00000009-dead", "v00000010-x-3.add"]
    store.load(TABLE, spark.createDataFrame([(4, "f")], schema), ["k"], token="x-4")
    store.drop_old_versions(TABLE, keep=1)
    assert rows_of(store.read(TABLE)) == [(1, "a"), (2, "c"), (3, "d"), (4, "f")]
    assert [p.name for p in (tmp_path / "s.t").iterdir()] == ["v00000011-x-4"]


def test_an_append_writes_its_own_rows_only(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    store = ParquetTables(spark, str(tmp_path), {TABLE: schema})
    sizes = []
    for part in range(4):
        store.load(TABLE, spark.range(part * 2000, part * 2000 + 2000, 1, 1).selectExpr("id AS k", "md5(string(id)) AS v"), [])
        last = sorted((tmp_path / "s.t").iterdir())[-1]
        sizes.append(sum(f.stat().st_size for f in last.iterdir()))
    assert max(sizes) < 1.1 * min(sizes)
    assert store.read(TABLE).count() == 8000


# --- archives --------------------------------------------------------------------------------------------------------

MEMBERS = {
    "deep/a.xml": b"<root><item>a</item></root>",
    "b.XML": "<?xml version='1.0' encoding='windows-1251'?><root><item>Привет</item></root>".encode("windows-1251"),
    "hollow.xml": b"",
    "readme.txt": b"text",
    "big.xml": b"<root><item>" + b"x" * 5000 + b"</item></root>",
}


def make_archives(folder):
    with zipfile.ZipFile(folder / "one.ZIP", "w") as archive:
        archive.mkdir("deep")
        for name, data in MEMBERS.items():
            archive.writestr(name, data)
    for name, mode in (("two.tar", "w"), ("three.tar.gz", "w:gz"), ("four.tgz", "w:gz"), ("five.tar.bz2", "w:bz2"), ("six.tbz2", "w:bz2")):
        with tarfile.open(folder / name, mode) as archive:
            for member, data in MEMBERS.items():
                info = tarfile.TarInfo(member)
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))
    (folder / "seven.xml.gz").write_bytes(gzip.compress(MEMBERS["deep/a.xml"]))
    (folder / "eight.xml.bz2").write_bytes(bz2.compress(MEMBERS["big.xml"]))
    (folder / "broken.zip").write_bytes(b"no archive")
    (folder / "not an archive.txt").write_bytes(b"x")


def test_members(spark, tmp_path):
    make_archives(tmp_path)
    rows = expand_archives(spark, str(tmp_path), max_member_bytes=1000).collect()
    found = {}
    for row in rows:
        found.setdefault(row.archive_path.rpartition("/")[2], {})[row.member] = row
    for name in ("one.ZIP", "two.tar", "three.tar.gz", "four.tgz", "five.tar.bz2", "six.tbz2"):
        assert set(found[name]) == {"deep/a.xml", "b.XML", "big.xml"}
        assert found[name].pop("big.xml").error == f"too_large:{len(MEMBERS['big.xml'])}"
        for member, row in found[name].items():
            assert bytes(row.content) == MEMBERS[member] and row.size == len(MEMBERS[member]) and row.error is None
    assert bytes(found["seven.xml.gz"]["seven.xml"].content) == MEMBERS["deep/a.xml"]
    assert "larger than 1000" in found["eight.xml.bz2"]["eight.xml"].error
    assert "broken.zip" in found and next(iter(found["broken.zip"].values())).error
    assert len(found) == 9


def test_masks_match_whole_names_and_limits_can_be_off(spark, tmp_path):
    make_archives(tmp_path)
    rows = expand_archives(spark, str(tmp_path / "one.ZIP"), [r"[a-z]\.xml", "readme", ".*txt", "big.*"], 0).collect()
    assert sorted(r.member for r in rows) == ["big.xml", "deep/a.xml", "readme.txt"]
    rows = expand_archives(spark, str(tmp_path / "one.ZIP"), ["readme.*", "big.*"], 0, xml_only=True).collect()
    assert [r.member for r in rows] == ["big.xml"]


def test_archive_errors_end_the_job_on_request(spark, tmp_path):
    make_archives(tmp_path)
    with pytest.raises(Exception, match="broken.zip"):
        expand_archives(spark, str(tmp_path / "broken.zip"), on_error="fail").collect()


def test_members_cannot_leave_the_folder(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "evil.zip", "w") as archive:
        archive.writestr("../../evil.xml", b"<a/>")
    out = tmp_path / "out"
    (row,) = extract_archives(spark, str(tmp_path / "evil.zip"), str(out)).collect()
    assert row.extracted_path.startswith(str(out)) and ".." not in row.extracted_path
    assert [p.name for p in out.rglob("*.xml")] == ["evil.xml"]


def test_archives_of_the_queries_are_written_by_many_tasks(spark):
    from feedloom_queries import archives

    written = Path(archives._write_archives(spark, "/root/testdata/sf0.001"))
    names = [p.name for p in written.iterdir() if not p.name.startswith("seg_")]
    assert len({name.partition("-")[0] for name in names}) > 1
    assert {name[name.index(".") :] for name in names} == set(archives._FORMATS)


def test_members_of_one_folder_are_written_to_one_folder(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        for name in ("x/a.xml", "x/b.xml", "y/a.xml", "a.xml", "x\\y/a.xml"):
            archive.writestr(name, f"<a>{name}</a>")
    (tmp_path / "b.zip").write_bytes((tmp_path / "a.zip").read_bytes())
    out = tmp_path / "out"
    rows = extract_archives(spark, str(tmp_path), str(out)).collect()
    files = {row.extracted_path for row in rows}
    assert len(files) == len(rows) == 10
    for row in rows:
        assert Path(row.extracted_path).read_text() == f"<a>{row.member}</a>"
    assert len({Path(f).parent for f in files}) == 8


# --- whole runs ------------------------------------------------------------------------------------------------------

ITEMS, NOTES = TableId("items"), TableId("notes", "log")
MAPPING = Mapping(
    XmlSpec(
        ("root", "item"),
        {
            "items.id": ValueSpec(("id",), required=True),
            "items.qty": ValueSpec(("qty",), ValueType.CONTENT, default_value="0"),
            "log.notes.note": ValueSpec(("note",), ValueType.CONTENT),
            "kind": ValueSpec(("kind",), not_for_save=True),
        },
        files=(r"^items_(?<day>\d+)\.xml$",),
        enums={"kind": frozenset({"good"})},
    ),
    {
        ITEMS: TableSpec(("ID",), 2, {"day": "day"}),
        NOTES: TableSpec(),
    },
)
TARGETS = {
    ITEMS: T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("QTY", T.IntegerType()),
            T.StructField("day", T.StringType()),
            T.StructField("status", T.StringType(), False, {"default": "new"}),
        ]
    ),
    NOTES: T.StructType([T.StructField("note", T.StringType())]),
}
FEED = {
    "items_1.xml": """<root><item id="1"><qty>5</qty><note>n1</note></item><item id="01"><qty>6</qty></item>
        <item id="1"><qty>7</qty></item><item id="2" kind="bad"/><item/><item id="x"/></root>""",
    "sub/items_2.xml": '<root><item id="3" kind="good"><qty>many</qty></item><item id="4"/><item id="5"></root>',
    "items_3.xml": b"<root><item id='6'><note>wrong \xff byte</note></item></root>",
    "items_4.xml": "<root/>",
    "other.xml": "<root><item id='9'/></root>",
}


def write_feed(folder):
    for name, text in FEED.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    with zipfile.ZipFile(folder / "more.zip", "w") as archive:
        archive.writestr("in/items_7.xml", "<root><item id='4'><qty>44</qty></item><item id='7'/></root>")
        archive.writestr("other.xml", "<root><item id='8'/></root>")


def test_run(spark, tmp_path):
    feed = tmp_path / "feed"
    write_feed(feed)
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    report = run(spark, str(feed), [MAPPING], store, TARGETS, winner="first")
    # Paths decide between files: the archive's member is extracted to a folder whose path sorts before the feed or after.
    four = [r for r in store.read(ITEMS).collect() if r.id == 4]
    assert len(four) == 1
    assert rows_of(store.read(ITEMS).where("id <> 4"), "id", "QTY", "day", "status") == [
        (1, 6, "1", "new"), (6, 0, "3", "new"), (7, 0, "7", "new")]
    assert rows_of(store.read(NOTES)) == [("n1",), ("wrong � byte",)]
    assert report.summary.collect()[0].asDict() == {
        "files_found": 5, "files_loaded": 3, "files_failed": 2, "files_unrouted": 1}
    counts = {r.source.rpartition("/")[2]: (r.processed, r.skipped, r.failed) for r in report.files.collect()}
    assert counts == {
        "items_1.xml": (4, 2, True), "items_2.xml": (2, 0, True), "items_3.xml": (1, 0, False),
        "items_4.xml": (0, 0, False), "items_7.xml": (2, 0, False)}
    reasons = sorted((r.source.rpartition("/")[2], r.table_name, r.reason) for r in report.rejected.collect())
    assert reasons == [
        ("items_1.xml", "", "enum:kind"),
        ("items_1.xml", "", "required:items.id"),
        ("items_1.xml", "public.items", "cast:id:bigint"),
        ("items_2.xml", "", "malformed_document"),
        ("items_2.xml", "public.items", "cast:QTY:int"),
    ]
    tables = {(r.source.rpartition("/")[2], r.table_name): (r.batches, r.rows) for r in report.tables.collect()}
    assert tables[("items_1.xml", "public.items")] == (2, 4)
    assert tables[("items_1.xml", "log.notes")] == (1, 1)

    # A second run changes nothing in the keyed table.
    before = rows_of(store.read(ITEMS))
    run(spark, str(feed), [MAPPING], store, TARGETS, winner="first")
    assert rows_of(store.read(ITEMS).where("id <> 4")) == [r for r in before if r[0] != 4]
    from pathlib import Path

    assert sorted(p.name for p in Path(report.work_dir).iterdir()) == ["files", "manifest", "report"]
    report.clean()
    assert not Path(report.work_dir).exists()


def test_failed_archives_and_large_members_are_told(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "items_1.xml").write_text("<root><item id='1'/></root>")
    (feed / "broken.zip").write_bytes(b"no archive")
    with zipfile.ZipFile(feed / "large.zip", "w") as archive:
        archive.writestr("items_2.xml", "<root><item id='2'/>" + " " * 2000 + "</root>")
        archive.writestr("items_3.xml", "<root><item id='3'/></root>")
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    report = run(spark, str(feed), [MAPPING], store, TARGETS, max_member_bytes=1000)
    assert rows_of(store.read(ITEMS), "id") == [(1,), (3,)]
    assert report.summary.collect()[0].asDict() == {
        "files_found": 4, "files_loaded": 2, "files_failed": 2, "files_unrouted": 0}
    reasons = {r.source.rpartition("/")[2]: r.reason for r in report.rejected.collect()}
    assert reasons["large.zip"].startswith("archive:too_large:20") and reasons["broken.zip"].startswith("archive:")


def test_one_archive_gives_every_member_that_is_named(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "feed.zip", "w") as archive:
        archive.writestr("a/part.dat", "<root><item id='1'/></root>")
        archive.writestr("b/part.dat", "<root><item id='2'/></root>")
        archive.writestr("b/other.dat", "<root><item id='3'/></root>")
    mapping = Mapping(XmlSpec(("root", "item"), {"items.id": ValueSpec(("id",))}, files=(r"part\.dat",)), {ITEMS: TableSpec(("id",))})
    for path, ids in ((tmp_path / "feed.zip", [(1,), (2,)]), (tmp_path, [])):
        store = ParquetTables(spark, str(tmp_path / f"store{len(ids)}"), TARGETS)
        run(spark, str(path), [mapping], store, TARGETS)
        assert rows_of(store.read(ITEMS), "id") == ids


def test_all_mappings_are_checked_before_the_first_is_loaded(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "items_1.xml").write_text("<root><item id='1'/></root>")
    (feed / "notes.xml").write_text("<root><item><note>x</note></item><item>")
    notes = Mapping(
        XmlSpec(("root", "item"), {"log.notes.note": ValueSpec(("note",), ValueType.CONTENT)}, files=("notes",)), {NOTES: TableSpec()}
    )
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    with pytest.raises(LoadError, match="malformed_document"):
        run(spark, str(feed), [MAPPING, notes], store, TARGETS, on_error="fail")
    assert store.read(ITEMS).count() == 0


def test_work_folders_are_the_same_place_for_spark_and_tasks(spark, tmp_path):
    from feedloom.sinks.tables import qualified
    from feedloom.sources.documents import local_uri

    assert qualified(spark, f"{tmp_path}/w") == f"file:{tmp_path}/w"
    assert local_uri("s3a://b/k") == "s3://b/k" and local_uri("dbfs:/mnt/x") == "file:///dbfs/mnt/x"
    assert local_uri("file:///a") == "file:///a"


def test_run_in_batch_order(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    body = "".join(f'<item id="{i % 3}"><qty>{i}</qty></item>' for i in range(8))
    (tmp_path / "feed" / "items_1.xml").write_text(f"<root>{body}</root>")
    for winner, expected in (("first", [(0, 0), (1, 1), (2, 2)]), ("batch", [(0, 6), (1, 7), (2, 5)])):
        store = ParquetTables(spark, str(tmp_path / winner), TARGETS)
        run(spark, str(tmp_path / "feed"), [MAPPING], store, TARGETS, winner=winner)
        assert rows_of(store.read(ITEMS), "id", "QTY") == expected
    store = ParquetTables(spark, str(tmp_path / "default"), TARGETS)
    run(spark, str(tmp_path / "feed"), [MAPPING], store, TARGETS)
    assert rows_of(store.read(ITEMS), "id", "QTY") == [(0, 6), (1, 7), (2, 5)]  # batches one after the other


def test_files_that_repeat_no_key_are_not_numbered(spark, tmp_path, monkeypatch):
    """The later file wins by its name; only rows of one file that share a key need their batches."""
    feed = tmp_path / "feed"
    feed.mkdir()
    for name, qty in (("items_1.xml", 1), ("items_2.xml", 2), ("items_3.xml", 3)):
        body = "".join(f'<item id="{i}"><qty>{qty}</qty></item>' for i in range(3 if qty == 3 else 8))
        (feed / name).write_text(f"<root>{body}</root>")

    def numbered(*_):
        raise AssertionError("rows are numbered")

    with monkeypatch.context() as patch:
        patch.setattr("feedloom.plans.load.number_rows", numbered)
        store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
        run(spark, str(feed), [MAPPING], store, TARGETS)
        assert rows_of(store.read(ITEMS), "id", "QTY") == [(i, 3 if i < 3 else 2) for i in range(8)]
        (feed / "items_3.xml").write_text("<root><item id='1'/><item id='01'/></root>")
        with pytest.raises(AssertionError, match="numbered"):
            run(spark, str(feed), [MAPPING], store, TARGETS)


def test_records_are_read_once_for_all_tables(spark, tmp_path, monkeypatch):
    """Records of a run are checked and cast by one job, whose result has a row for each of them."""
    from feedloom.plans import load

    write_feed(tmp_path / "feed")
    passes, check = [], load.annotate
    monkeypatch.setattr(load, "annotate", lambda records, spec: passes.append(records) or check(records, spec))
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    run(spark, str(tmp_path / "feed"), [MAPPING], store, TARGETS, archives=False, work_dir=str(tmp_path / "work"), keep_work=True)
    assert len(MAPPING.loaded_tables) == 2 and len(passes) == 1
    assert spark.read.parquet(str(tmp_path / "work" / "mapping0" / "checked")).count() == passes[0].count()


def test_repeated_keys_against_brute_force(spark):
    from feedloom.plans.load import repeated_keys

    for pairs in ([], [(1, "a")], [(1, "a"), (2, "a")], [(1, "a"), (1, "a")], [(1, "a"), (1, "b")],
                  [(1, "a"), (1, "b"), (1, "c"), (2, "a")], [(1, "a"), (1, "b"), (1, "b")]):
        rows = spark.createDataFrame(pairs, "id long, _source string")
        assert repeated_keys(rows, ["id"]) == (len({k for k, _ in pairs}) < len(pairs), len(set(pairs)) < len(pairs)), pairs


def test_run_stops_on_request_and_checks_first(spark, tmp_path):
    feed = tmp_path / "feed"
    write_feed(feed)
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    with pytest.raises(LoadError):
        run(spark, str(feed), [MAPPING], store, TARGETS, on_error="fail", archives=False)
    assert store.read(ITEMS).count() == 0
    with pytest.raises(MappingError):
        run(spark, str(feed), [MAPPING], store, {ITEMS: TARGETS[ITEMS]})


# --- streams ---------------------------------------------------------------------------------------------------------


EXTRA = Mapping(
    XmlSpec(("extra",), {"log.notes.note": ValueSpec(("note",), ValueType.CONTENT)}, files=("^extra",)), {NOTES: TableSpec()}
)


def test_stream(spark, tmp_path):
    feed, checkpoint = tmp_path / "feed", str(tmp_path / "checkpoint")
    feed.mkdir()
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)

    def start():
        query = run_stream(
            spark, str(feed), [MAPPING, EXTRA], store, TARGETS, checkpoint, max_files=4, clean_up="delete",
            work_dir=str(tmp_path / "work"))
        query.awaitTermination()

    (feed / "items_1.xml").write_text("<root><item id='1'><note>a</note></item><item id='x'/></root>")
    (feed / "items_2.xml").write_text("<root><item id='2'><note>b</note></item><item id='3'></root>")
    (feed / "other.xml").write_text("<root><item id='9'/></root>")
    (feed / "extra.xml").write_bytes(b"<extra><note>wrong \xff byte</note></extra>")
    with zipfile.ZipFile(feed / "more.zip", "w") as archive:
        archive.writestr("items_5.xml", "<root><item id='5'/></root>")
    start()
    assert rows_of(store.read(ITEMS), "id", "day") == [(1, "1"), (2, "2"), (5, "5")]
    (feed / "items_3.xml").write_text("<root><item id='1'><qty>8</qty><note>c</note></item></root>")
    start()
    start()
    assert rows_of(store.read(ITEMS), "id", "QTY") == [(1, 8), (2, 0), (5, 0)]
    assert rows_of(store.read(NOTES)) == [("a",), ("b",), ("c",), ("wrong � byte",)]
    reasons = spark.read.parquet(str(tmp_path / "work" / "rejected")).select("reason")
    assert rows_of(reasons) == [("cast:id:bigint",), ("malformed_document",)]
    assert spark.read.parquet(str(tmp_path / "work" / "files")).count() == 5
    assert not (feed / "items_1.xml").exists()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """Without its commit the last batch is run again, also the appends and rejects of it."""
    feed, checkpoint = tmp_path / "feed", tmp_path / "checkpoint"
    feed.mkdir()
    store = ParquetTables(spark, str(tmp_path / "store"), TARGETS)
    (feed / "items_1.xml").write_text("<root><item id='1'><note>a</note></item><item id='x'/></root>")
    for _ in range(2):
        run_stream(spark, str(feed), MAPPING, store, TARGETS, str(checkpoint), work_dir=str(tmp_path / "work")).awaitTermination()
        for commit in (checkpoint / "commits").iterdir():
            commit.unlink()
    assert rows_of(store.read(NOTES)) == [("a",)]
    assert spark.read.parquet(str(tmp_path / "work" / "rejected")).count() == 1


def test_source_options():
    assert source_options() == {"cleanSource": "off"}
    assert source_options("archive", "/a", 5) == {"cleanSource": "archive", "sourceArchiveDir": "/a", "maxFilesPerTrigger": "5"}
    for bad in (("move", None), ("archive", None), ("delete", "/a")):
        with pytest.raises(ValueError):
            source_options(*bad)


@pytest.mark.parametrize("name", ["fan_out_tables", "report_table_rows"])
def test_documents_of_several_tables_are_parsed_once(spark, name):
    from feedloom_queries import all_queries

    frame = all_queries()[name](spark, "/root/testdata/sf0.001")
    assert "from_xml" not in frame._jdf.queryExecution().optimizedPlan().toString().lower().replace("xmltostructs", "from_xml")
