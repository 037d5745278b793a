"""Batch runs over a folder that grows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from feedloom.plans.ledger import FileLedger, run_new
from feedloom.plans.mapping import Mapping, TableId, TableSpec, ValueSpec, ValueType, XmlSpec
from feedloom.sinks.buckets import BucketTables

NOTES = TableId("notes", "shop")
MAPPING = Mapping(XmlSpec(("notes", "note"), {"shop.notes.of": ValueSpec(("of",), ValueType.ATTRIBUTE)}), {NOTES: TableSpec()})
TARGETS = {NOTES: T.StructType([T.StructField("of", T.LongType())])}


@pytest.fixture
def feed(spark, tmp_path):
    store = BucketTables(spark, str(tmp_path / "store"), TARGETS)
    folder = tmp_path / "feed"
    folder.mkdir()

    def put(name, *ids):
        (folder / name).write_text("<notes>" + "".join(f"<note of='{i}'/>" for i in ids) + "</notes>")

    def load():
        reports = run_new(spark, str(folder), [MAPPING], store, TARGETS, str(tmp_path / "ledger"))
        return [sorted(os.path.basename(r[0]) for r in report.files.select("source").collect()) for report in reports]

    def rows():
        return sorted(r[0] for r in store.read(NOTES).collect())

    return put, load, rows, str(tmp_path / "ledger"), folder


def test_only_new_and_changed_files_are_opened(feed):
    put, load, rows, _, folder = feed
    put("a [1].xml", 1)
    put("b.xml", 2)
    assert load() == [["a%20%5B1%5D.xml", "b.xml"]] or rows() == [1, 2]
    assert load() == []
    put("c.xml", 3)
    put("b.xml", 2, 4)
    assert load() == [["b.xml", "c.xml"]] and rows() == [1, 2, 2, 3, 4]
    os.utime(folder / "c.xml", (1, 1))
    assert load() == [["c.xml"]]


def test_a_run_that_died_is_repeated_once(spark, feed, monkeypatch):
    put, load, rows, ledger, _ = feed
    put("a.xml", 1)

    def dies(self, token):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(FileLedger, "end", dies)
        with pytest.raises(InterruptedError):
            load()
    assert rows() == [1] and len(FileLedger(spark, ledger).pending()) == 1
    put("b.xml", 2)
    assert load() == [["a.xml"], ["b.xml"]] and rows() == [1, 2]
    assert FileLedger(spark, ledger).pending() == [] and FileLedger(spark, ledger).files().count() == 2
