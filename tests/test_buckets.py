"""Bucketed tables: what a load touches, snapshots, transactions, and merged versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.mapping import TableId
from feedloom.sinks.buckets import BucketTables, Conflict

ITEMS, NOTES = TableId("items", "shop"), TableId("notes")
ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType(), True, {"default": "none"}), T.StructField("w", T.IntegerType())])
NOTE = T.StructType([T.StructField("text", T.StringType())])


@pytest.fixture
def store(spark, tmp_path):
    return BucketTables(spark, str(tmp_path / "store"), {ITEMS: ITEM, NOTES: NOTE}, buckets=32)


def _items(spark, rows, columns="id bigint, v string, w int"):
    return spark.createDataFrame(rows, columns)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_upsert_and_append(spark, store):
    assert store.read(ITEMS).count() == 0 and store.files(ITEMS) == []
    store.load(ITEMS, _items(spark, [(i, f"v{i}", i) for i in range(100)]), ["id"])
    store.load(ITEMS, _items(spark, [(5, None), (200, "new")], "id bigint, v string"), ["id"])
    want = {i: (i, f"v{i}", i) for i in range(100)} | {5: (5, None, 5), 200: (200, "new", None)}
    assert _rows(store.read(ITEMS)) == sorted(want.values(), key=repr)
    store.load(ITEMS, _items(spark, [(5,), (201,)], "id int"), ["id"])  # keys only, of another type: known rows stay
    want[201] = (201, "none", None)
    assert _rows(store.read(ITEMS)) == sorted(want.values(), key=repr)
    store.load(ITEMS, _items(spark, [(7, "twice", 0)]), [])  # an append to a table with keys
    assert _rows(store.read(ITEMS)) == sorted([*want.values(), (7, "twice", 0)], key=repr)
    store.load(ITEMS, _items(spark, [], "id bigint, v string, w int"), ["id"])
    assert store.read(ITEMS).count() == len(want) + 1


def test_rows_without_key_meet_nothing(spark, store):
    rows = [(None, "a", 1), (None, "b", 2), (1, "c", 3)]
    store.load(ITEMS, _items(spark, rows), ["id"])
    store.load(ITEMS, _items(spark, [(None, "d", 4), (1, "e", 5)]), ["id"])
    assert _rows(store.read(ITEMS)) == sorted([(None, "a", 1), (None, "b", 2), (None, "d", 4), (1, "e", 5)], key=repr)


@pytest.mark.parametrize("broadcast_bytes", [16 << 20, 0])
def test_other_buckets_are_neither_read_nor_written(spark, store, monkeypatch, broadcast_bytes):
    monkeypatch.setattr("feedloom.sinks.buckets.BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr("feedloom.operators.upsert.BROADCAST_BYTES", broadcast_bytes)
    store.load(ITEMS, spark.range(20_000).select("id", F.lit("x").alias("v"), F.lit(1).alias("w")), ["id"])
    before = set(store.files(ITEMS))
    changes = _items(spark, [(i, "y", 2) for i in range(0, 20_000, 1000)][:3] + [(30_000, "z", 3)])
    seen = {}
    rows = BucketTables._rows

    def spy(self, table, entry, only=None):
        seen["frame"] = rows(self, table, entry, only)
        return seen["frame"]

    monkeypatch.setattr(BucketTables, "_rows", spy)
    store.load(ITEMS, changes, ["id"])
    plan = seen["frame"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters:")[1]
    assert len(seen["frame"].inputFiles()) <= 4
    monkeypatch.setattr(BucketTables, "_rows", rows)
    after = set(store.files(ITEMS))
    assert len(before - after) <= 4 and len(before & after) >= 28
    assert store.read(ITEMS).where("v = 'y'").count() == 3 and store.read(ITEMS).count() == 20_001


def test_one_exchange_of_each_side_for_join_and_write(spark, store, monkeypatch):
    monkeypatch.setattr("feedloom.sinks.buckets.BROADCAST_BYTES", 0)
    monkeypatch.setattr("feedloom.operators.upsert.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    write = __import__("feedloom.sinks.buckets", fromlist=["Transaction"]).Transaction._write
    monkeypatch.setattr(
        "feedloom.sinks.buckets.Transaction._write",
        lambda self, table, rows: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(self, table, rows))[1],
    )
    try:
        for v in ("x", "y"):
            store.load(ITEMS, spark.range(1000).select("id", F.lit(v).alias("v"), F.lit(1).alias("w")), ["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[1].count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plans[1]
    held = {p.rpartition("/")[0] for p in store.files(ITEMS)}
    assert len(held) == len(store.files(ITEMS)) == 32  # one file for each bucket


def test_other_keys_than_the_buckets(spark, store):
    store.load(ITEMS, _items(spark, [(1, "a", 1), (2, "b", 2)]), ["id"])
    store.load(ITEMS, _items(spark, [("b", 20), ("c", 30)], "v string, w int"), ["v"])
    assert _rows(store.read(ITEMS)) == [(1, "a", 1), (2, "b", 20), (None, "c", 30)]
    store.load(ITEMS, _items(spark, [(2, "z", 0)]), ["id"])
    assert _rows(store.read(ITEMS)) == [(1, "a", 1), (2, "z", 0), (None, "c", 30)]


def test_a_named_load_counts_once(spark, store):
    for _ in range(2):
        store.load(NOTES, _items(spark, [("a",)], "text string"), [], token="one")
    assert store.read(NOTES).count() == 1 and store.is_loaded(NOTES, "one") and not store.is_loaded(NOTES, "two")


def test_a_transaction_is_seen_as_a_whole_or_not_at_all(spark, store, tmp_path):
    store.load(ITEMS, _items(spark, [(1, "a", 1)]), ["id"])
    changes = store.transaction()
    changes.load(ITEMS, _items(spark, [(1, "b", 2), (2, "c", 3)]), ["id"])
    changes.load(ITEMS, _items(spark, [(2, "d", 4)]), ["id"])  # sees what it did before
    changes.load(NOTES, _items(spark, [("n",)], "text string"), [])
    assert _rows(store.read(ITEMS)) == [(1, "a", 1)] and store.read(NOTES).count() == 0
    changes.commit()
    assert _rows(store.read(ITEMS)) == [(1, "b", 2), (2, "d", 4)] and store.read(NOTES).count() == 1
    folders = set((tmp_path / "store" / "shop.items").iterdir())
    failed = store.transaction()
    failed.load(NOTES, _items(spark, [("m",)], "text string"), [])
    with pytest.raises(Exception, match="no space"):
        failed.load(ITEMS, _items(spark, [(9, "x", 1)]).withColumn("w", F.raise_error(F.lit("no space")).cast("int")), ["id"])
    failed.abort()
    assert store.read(NOTES).count() == 1 and set((tmp_path / "store" / "shop.items").iterdir()) == folders


def test_loads_side_by_side(spark, store):
    """Of other tables: both are kept. Of one table: the second is refused and leaves nothing."""
    store.load(ITEMS, _items(spark, [(1, "a", 1)]), ["id"])
    one, two, three = store.transaction(), store.transaction(), store.transaction()
    one.load(ITEMS, _items(spark, [(2, "b", 1)]), ["id"])
    two.load(NOTES, _items(spark, [("n",)], "text string"), [])
    three.load(ITEMS, _items(spark, [(3, "c", 1)]), ["id"])
    one.commit()
    two.commit()
    with pytest.raises(Conflict):
        three.commit()
    assert _rows(store.read(ITEMS)) == [(1, "a", 1), (2, "b", 1)] and store.read(NOTES).count() == 1


def test_one_number_is_published_once(store):
    assert store._publish(1, {"x": {}}) and not store._publish(1, {"y": {}})
    assert store._latest() == (1, {"x": {}})


def test_fifty_appends_stay_a_short_chain(spark, store):
    store.chain = 6
    for k in range(50):
        if k == 49:
            reader = store.read(NOTES)
        store.load(NOTES, _items(spark, [(f"t{k}",)], "text string").coalesce(1), [])
        if k % 10 == 9 or k > 46:
            assert len({p.rpartition("/")[0] for p in store.files(NOTES)}) <= 6
    assert _rows(store.read(NOTES)) == sorted([(f"t{k}",) for k in range(50)], key=repr)
    assert reader.count() == 49  # what it read was merged, and is still there


def test_old_versions_go(spark, store, tmp_path):
    for k in range(6):
        store.load(ITEMS, _items(spark, [(1, f"v{k}", k)]), ["id"])
    assert len(store._numbers()) == 3
    assert len([f for f in (tmp_path / "store" / "shop.items").iterdir()]) == 3


def test_buckets_grow_with_the_first_load(spark, tmp_path):
    """The changes of a day leave buckets alone in a table whose days have more orders than there were buckets."""
    from feedloom_queries.buckets import upsert_touched_buckets

    day = F.date_add(F.lit("2001-01-01"), (F.col("id") % 1200).cast("int")).cast("timestamp")
    orders = spark.range(1, 1_200_001).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("-").alias("o_orderpriority"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    rows = upsert_touched_buckets(spark, str(tmp_path))
    found = rows.groupBy("untouched").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("price")).collect()
    assert [tuple(r) for r in found] == [(True, 1_201_000, 1_203_000.0)]


def test_rows_of_one_bucket_are_written_as_they_come(spark, tmp_path, monkeypatch):
    """Spark sorts what it writes to several folders, so that a task would hold all its rows."""
    from pyspark.sql.readwriter import DataFrameWriter

    def refuse(*_):
        raise AssertionError("sorted by bucket")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refuse)
    store = BucketTables(spark, str(tmp_path / "appended"), {NOTES: NOTE}, chain=2)
    for n in range(5):
        store.load(NOTES, _items(spark, [(f"t{n}",)], "text string"), [])
    before = store.files(NOTES)
    store.load(NOTES, _items(spark, [], "text string"), [])
    assert store.files(NOTES) == before
    assert _rows(store.read(NOTES)) == [(f"t{n}",) for n in range(5)]
    assert len({file.rpartition("/")[0] for file in before}) <= 2
