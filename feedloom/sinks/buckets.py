"""Tables whose rows lie in hash buckets of their keys, so that an upsert rewrites the buckets it touches only.

A table is a folder ``<base>/<schema>.<table>`` of written versions, each with a partition folder for every bucket it
holds. Which version has the rows of which bucket is said by a manifest, a small JSON file ``<base>/_manifests/<number>``
for all tables of the store. A load writes new versions first; publishing the next manifest makes them all visible at
once. So readers see all tables of a load or none of them, whatever fails in between, and keep the snapshot they opened.

An upsert writes its source once with the bucket of each row, asks which buckets occur, and joins them with those
buckets of the table: other files are neither listed nor read. Source and table are dealt out by bucket once, and the
joined rows of a bucket are written where they are. Rows with a NULL in their keys never meet others and are spread over
the buckets. An append writes its own rows; where that makes long chains of versions they are merged, the newest first,
so that each row is rewritten a logarithmic number of times.

Choose the number of buckets so that a bucket is some 100 to 500 MB, or the work of one task.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Sequence
from copy import deepcopy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import name_column
from feedloom.operators.upsert import BROADCAST_BYTES, upsert
from feedloom.plans.mapping import TableId
from feedloom.sinks.tables import _hadoop_path, delete, directory_bytes, scratch_dir

VERSION, BUCKET = "_version", "_bucket"
#: Names of loads that a table remembers, so that a repeated one is skipped.
REMEMBERED = 1000
#: Bytes that a task writes when versions are merged.
TASK_BYTES = 128 * 1024 * 1024


class Conflict(RuntimeError):
    """Another load changed a table after this one had read it. Nothing of this load is visible; repeat it."""


class BucketTables:
    """``buckets``: how many a table with keys gets at its first load, for all tables or by table. ``keep`` manifests stay
    readable, and ``chain`` versions may hold rows of one bucket before they are merged. ``rows_per_bucket``: a larger
    first load gets more buckets, so that none holds many more rows; changes to a part of a table that stays the same
    then touch a part of the buckets that stays the same, however large the table is."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        targets: dict[TableId, T.StructType],
        buckets: int | dict[TableId, int] = 64,
        keep: int = 3,
        chain: int = 8,
        rows_per_bucket: int | None = None,
    ) -> None:
        self.spark, self.base, self.targets = spark, base.rstrip("/"), targets
        self.buckets, self.keep, self.chain = buckets, max(keep, 1), max(chain, 1)
        self.rows_per_bucket = rows_per_bucket

    # -- manifests

    @property
    def _manifests(self) -> str:
        return f"{self.base}/_manifests"

    def _numbers(self) -> list[int]:
        system, path = _hadoop_path(self.spark, self._manifests)
        if not system.exists(path):
            return []
        names = (status.getPath().getName() for status in system.listStatus(path))
        return sorted(int(name) for name in names if name.isdigit())

    def _manifest(self, number: int) -> dict:
        system, path = _hadoop_path(self.spark, f"{self._manifests}/{number:08d}")
        stream = system.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _latest(self) -> tuple[int, dict]:
        """(number, table -> its keys, buckets, names of loads, and live: version -> buckets)."""
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    def _publish(self, number: int, manifest: dict) -> bool:
        """Whether the manifest is the one of that number; another load may have been faster."""
        jvm, text = self.spark._jvm, json.dumps(manifest)
        system, draft = _hadoop_path(self.spark, f"{self._manifests}/draft-{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        stream.write(text.encode())
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.makeQualified(draft).toUri(), self.spark._jsc.hadoopConfiguration()
        )
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        final = jvm.org.apache.hadoop.fs.Path(f"{self._manifests}/{number:08d}")
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(final), none)
        except Exception as error:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(error) or system.exists(final):
                return False
            raise
        return True

    def _forget(self) -> None:
        """Delete old manifests and the versions that only they name. What other loads are writing is in none."""
        numbers = self._numbers()
        old, kept = numbers[: -self.keep], numbers[-self.keep :]
        if not old:
            return
        named = lambda manifest: {(t, v) for t, entry in manifest.items() for v in entry["live"]}
        needed = set().union(*(named(self._manifest(n)) for n in kept))
        for number in old:
            for table, version in named(self._manifest(number)) - needed:
                delete(self.spark, f"{self.base}/{table}/{VERSION}={version}")
            delete(self.spark, f"{self._manifests}/{number:08d}")

    # -- reading

    def _schema(self, table: TableId) -> T.StructType:
        more = [T.StructField(VERSION, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        return T.StructType([*self.targets[table].fields, *more])

    def _rows(self, table: TableId, entry: dict | None, only: Iterable[int] | None = None) -> DataFrame:
        """Live rows with their bucket, of all or of some buckets. Folders of others are not even listed."""
        schema, wanted = self._schema(table), None if only is None else set(only)
        live = [(v, b) for v, held in (entry or {"live": {}})["live"].items() for b in held if wanted is None or b in wanted]
        if not live:
            return self.spark.createDataFrame([], schema).drop(VERSION)
        folder = f"{self.base}/{table}"
        reader = self.spark.read.schema(schema).option("basePath", folder)
        rows = reader.parquet(*[f"{folder}/{VERSION}={v}/{BUCKET}={b}" for v, b in live])
        if wanted is not None:
            rows = rows.where(F.col(BUCKET).isin(sorted(wanted)))
        return rows.drop(VERSION)

    def read(self, table: TableId) -> DataFrame:
        """The current rows; an empty frame before the first load."""
        names = [field.name for field in self.targets[table].fields]
        return self._rows(table, self._latest()[1].get(str(table))).select(*map(name_column, names))

    def is_loaded(self, table: TableId, token: str) -> bool:
        return token in self._latest()[1].get(str(table), {"tokens": []})["tokens"]

    def files(self, table: TableId) -> list[str]:
        """Paths of the files that hold the table now."""
        entry = self._latest()[1].get(str(table))
        return sorted(self._rows(table, entry).inputFiles()) if entry and entry["live"] else []

    # -- loading

    def transaction(self, token: str | None = None) -> Transaction:
        """Loads of several tables that become visible together by ``commit``."""
        return Transaction(self)

    def load(
        self,
        table: TableId,
        rows: DataFrame,
        keys: Sequence[str],
        token: str | None = None,
        source_bytes: int | None = None,
    ) -> None:
        """Upsert unique rows, or append them without keys, as a transaction of its own."""
        changes = self.transaction()
        try:
            changes.load(table, rows, keys, token, source_bytes)
            changes.commit()
        except BaseException:
            changes.abort()
            raise

    def compact(self, table: TableId) -> bool:
        """Merge the versions of buckets that are in more than ``chain`` of them. False if there was nothing to do, or
        if a load was faster."""
        changes = self.transaction()
        if not changes.merge_chains(table):
            return False
        try:
            changes.commit()
        except Conflict:
            return False
        return True


def _any_null(columns: Sequence[Column]) -> Column:
    found = columns[0].isNull()
    for column in columns[1:]:
        found = found | column.isNull()
    return found


class Transaction:
    """Versions that were written and are not visible yet."""

    def __init__(self, store: BucketTables) -> None:
        self.store, self.spark = store, store.spark
        self.number, self.before = store._latest()
        self.after = deepcopy(self.before)
        self.written: list[str] = []
        self.changed: set[str] = set()
        self.lock = threading.Lock()

    def _bucket(self, table: TableId, entry: dict, columns: Sequence[str]) -> Column:
        """The number of the partition into which an exchange by the keys puts a row."""
        if not entry["keys"]:
            return F.lit(0)
        keys = list(map(name_column, entry["keys"]))
        hashed = F.when(_any_null(keys), F.hash(*map(name_column, columns))).otherwise(F.hash(*keys))
        return F.pmod(hashed, F.lit(entry["buckets"])).cast("int")

    def _typed_keys(self, table: TableId, entry: dict, rows: DataFrame) -> DataFrame:
        """Keys are compared as what they are in the target, and so they are hashed."""
        kinds = {field.name.lower(): field.dataType for field in self.store.targets[table].fields}
        keys = {k.lower() for k in entry["keys"]}
        return rows.select(*[name_column(c).cast(kinds[c.lower()]).alias(c) if c.lower() in keys else name_column(c) for c in rows.columns])

    def _write(self, table: TableId, rows: DataFrame, only: int | None = None) -> tuple[str, list[int]]:
        """Writes a version. Spark sorts what it writes to several folders; rows of the ``only`` bucket go to its folder as
        they come, so that a task holds none of them."""
        version = f"v{self.number + 1:08d}-{uuid.uuid4().hex}"
        location = f"{self.store.base}/{table}/{VERSION}={version}"
        with self.lock:
            self.written.append(location)
        if only is not None:
            folder = f"{location}/{BUCKET}={only}"
            rows = rows.drop(BUCKET)
            rows.write.parquet(folder)
            if self.spark.read.schema(rows.schema).parquet(folder).isEmpty():
                delete(self.spark, location)
                return version, []
            return version, [only]
        rows.write.partitionBy(BUCKET).parquet(location)
        system, path = _hadoop_path(self.spark, location)
        names = [status.getPath().getName() for status in system.listStatus(path)]
        held = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}="))
        if not held:
            delete(self.spark, location)
        return version, held

    def load(
        self,
        table: TableId,
        rows: DataFrame,
        keys: Sequence[str],
        token: str | None = None,
        source_bytes: int | None = None,
    ) -> None:
        """Upsert unique rows, or append them without keys. Later loads of this transaction see what it did."""
        store, name = self.store, str(table)
        with self.lock:
            entry = deepcopy(self.after.get(name))
        if entry is None:
            count = store.buckets if isinstance(store.buckets, int) else store.buckets.get(table, 64)
            entry = {"keys": list(keys), "buckets": count if keys else 1, "tokens": [], "live": {}}
            if keys and store.rows_per_bucket:
                self._load_counted(table, rows, entry, token)
                return
        if token and token in entry["tokens"]:
            return
        schema = T.StructType([*store.targets[table].fields, T.StructField(BUCKET, T.IntegerType(), False)])
        nothing = self.spark.createDataFrame([], schema)
        by_these_keys = bool(keys) and [k.lower() for k in keys] == [k.lower() for k in entry["keys"]]
        if not keys or not entry["live"]:
            version, held = self._write_new(table, rows, entry)
        else:
            stage = scratch_dir(self.spark, "source")
            try:
                if by_these_keys:
                    rows = self._typed_keys(table, entry, rows)
                    rows.withColumn(BUCKET, self._bucket(table, entry, rows.columns)).write.parquet(stage)
                else:
                    rows.write.parquet(stage)
                source, size = self.spark.read.parquet(stage), directory_bytes(self.spark, stage)
                if by_these_keys:
                    # At most as many numbers as there are buckets.
                    touched = [row[0] for row in source.select(BUCKET).distinct().collect()]
                    old = store._rows(table, entry, touched)
                    merged = self._merged(old if touched else nothing, source, entry, schema, size)
                else:
                    # Other keys than the buckets are made of: rows to meet may be anywhere.
                    touched = sorted({b for held in entry["live"].values() for b in held})
                    old = store._rows(table, entry).drop(BUCKET)
                    merged = upsert(old, source, keys, store.targets[table], size)
                    merged = merged.withColumn(BUCKET, self._bucket(table, entry, merged.columns)).repartition(BUCKET)
                version, held = self._write(table, merged)
            finally:
                delete(self.spark, stage)
            gone = set(touched)
            live = {v: [b for b in buckets if b not in gone] for v, buckets in entry["live"].items()}
            entry["live"] = {v: buckets for v, buckets in live.items() if buckets}
        self._take(table, entry, version, held, token)

    def _write_new(self, table: TableId, rows: DataFrame, entry: dict) -> tuple[str, list[int]]:
        """Nothing to meet: rows are only completed with defaults."""
        plain = self.spark.createDataFrame([], self.store.targets[table])
        new = upsert(plain, rows, [], self.store.targets[table])
        new = new.withColumn(BUCKET, self._bucket(table, entry, new.columns))
        return self._write(table, new.repartition(BUCKET)) if entry["keys"] else self._write(table, new, 0)

    def _load_counted(self, table: TableId, rows: DataFrame, entry: dict, token: str | None) -> None:
        """A first load whose rows are written once, to be counted without being made again."""
        stage = scratch_dir(self.spark, "source")
        try:
            rows.write.parquet(stage)
            rows = self.spark.read.parquet(stage)
            entry["buckets"] = max(entry["buckets"], -(-rows.count() // self.store.rows_per_bucket))
            version, held = self._write_new(table, rows, entry)
        finally:
            delete(self.spark, stage)
        self._take(table, entry, version, held, token)

    def _take(self, table: TableId, entry: dict, version: str, held: list[int], token: str | None) -> None:
        if held:
            entry["live"][version] = held
        entry["tokens"] = [*entry["tokens"], *([token] if token else [])][-REMEMBERED:]
        with self.lock:
            self.after[str(table)] = entry
            self.changed.add(str(table))

    @staticmethod
    def _merged(old: DataFrame, source: DataFrame, entry: dict, schema: T.StructType, size: int) -> DataFrame:
        keys = {k.lower() for k in entry["keys"]}
        nullable = [name_column(f.name) for f in schema.fields if f.name.lower() in keys and f.nullable]
        declared = T.StructType([T.StructField(f.name, f.dataType, f.nullable and f.name.lower() not in keys, f.metadata) for f in schema.fields])
        alone = []
        if nullable:
            # They meet nothing, so they stay out of the join.
            nothing = old.limit(0)
            alone = [old.where(_any_null(nullable)), upsert(nothing, source.where(_any_null(nullable)), [], schema)]
            old, source = old.where(~_any_null(nullable)), source.where(~_any_null(nullable))
        if size > BROADCAST_BYTES:
            # Partitions are buckets, so this one exchange serves the join and the write.
            by = [name_column(k) for k in entry["keys"]]
            old, source = old.repartition(entry["buckets"], *by), source.repartition(entry["buckets"], *by)
        merged = upsert(old, source, entry["keys"], declared, size)
        for more in alone:
            merged = merged.unionByName(more)
        return merged

    def merge_chains(self, table: TableId) -> bool:
        """Write the rows of over-long chains of versions once more, as one version."""
        entry = self.after.get(str(table))
        chains: dict[int, list[str]] = {}
        for version, held in (entry or {"live": {}})["live"].items():
            for bucket in held:
                chains.setdefault(bucket, []).append(version)
        chosen: dict[int, list[str]] = {}
        folder, total = f"{self.store.base}/{table}", 0
        for bucket, chain in chains.items():
            if len(chain) <= self.store.chain:
                continue
            sizes = [directory_bytes(self.spark, f"{folder}/{VERSION}={v}/{BUCKET}={bucket}") for v in chain]
            # From the newest on, as long as the one before is not much larger or the chain would stay too long.
            start, merged = len(chain) - 1, sizes[-1]
            while start and (sizes[start - 1] < 2 * merged or start >= self.store.chain):
                start -= 1
                merged += sizes[start]
            chosen[bucket] = chain[start:]
            total += merged
        if not chosen:
            return False
        paths = [f"{folder}/{VERSION}={v}/{BUCKET}={b}" for b, chain in chosen.items() for v in chain]
        reader = self.spark.read.schema(self.store._schema(table)).option("basePath", folder)
        rows = reader.parquet(*paths).drop(VERSION)
        # One bucket needs no exchange: its small files are read by fewer tasks.
        rows = rows.repartition(BUCKET) if len(chosen) > 1 else rows.coalesce(max(1, total // TASK_BYTES))
        version, held = self._write(table, rows, next(iter(chosen)) if len(chosen) == 1 else None)
        live = {v: [b for b in buckets if v not in chosen.get(b, [])] for v, buckets in entry["live"].items()}
        entry["live"] = {v: buckets for v, buckets in live.items() if buckets} | {version: held}
        self.changed.add(str(table))
        return True

    def commit(self) -> None:
        """Make everything visible. Loads of other tables that came first are taken over."""
        if not self.changed:
            return
        while True:
            number, latest = self.store._latest()
            if moved := sorted(t for t in self.changed if latest.get(t) != self.before.get(t)):
                self.abort()
                raise Conflict(f"{', '.join(moved)} changed since this load began")
            if self.store._publish(number + 1, latest | {t: self.after[t] for t in self.changed}):
                break
        changed, self.written, self.changed = self.changed, [], set()
        self.store._forget()
        for table in self.store.targets:
            if str(table) in changed and self._longest(table) > self.store.chain:
                self.store.compact(table)

    def _longest(self, table: TableId) -> int:
        counts: dict[int, int] = {}
        for held in self.after[str(table)]["live"].values():
            for bucket in held:
                counts[bucket] = counts.get(bucket, 0) + 1
        return max(counts.values(), default=0)

    def abort(self) -> None:
        """Delete what was written. Tables are as they were."""
        with self.lock:
            written, self.written, self.changed = self.written, [], set()
        for location in written:
            delete(self.spark, location)
