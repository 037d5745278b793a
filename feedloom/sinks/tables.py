"""Where table rows end up: versioned Parquet tables, mergeable catalog tables, or a database over JDBC."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import logical_type
from feedloom.operators.upsert import upsert
from feedloom.plans.mapping import TableId


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach: below ``spark.checkpoint.dir``, or a local one if Spark runs locally."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/feedloom-{purpose}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def directory_bytes(spark: SparkSession, location: str) -> int:
    """Size of a written directory, from the file system."""
    system, path = _hadoop_path(spark, location)
    return system.getContentSummary(path).getLength()


def is_file(spark: SparkSession, location: str) -> bool:
    system, path = _hadoop_path(spark, location)
    return system.exists(path) and system.getFileStatus(path).isFile()


def delete(spark: SparkSession, location: str) -> None:
    system, path = _hadoop_path(spark, location)
    system.delete(path, True)


def qualified(spark: SparkSession, location: str) -> str:
    """The location with its scheme, so that tasks and Spark mean the same place."""
    system, path = _hadoop_path(spark, location)
    return system.makeQualified(path).toString()


class ParquetTables:
    """Tables as folders of versions: ``<base>/<schema>.<table>/v00000007-<token>``.

    A version is a whole table, or with the suffix ``.add`` rows that are added to the version before it: an append
    writes its own rows only, whatever the size of the table. A load writes a new version next to the one it reads, and
    Spark's ``_SUCCESS`` file commits it: a job that dies leaves the last committed version in place. A repeated load
    with the same token is skipped. ``keep`` versions can still be read after a load, older ones are deleted.
    """

    def __init__(
        self, spark: SparkSession, base: str, targets: dict[TableId, T.StructType], keep: int | None = 2
    ) -> None:
        self.spark, self.base, self.targets, self.keep = spark, base.rstrip("/"), targets, keep

    def _versions(self, table: TableId, committed: bool = True) -> list[str]:
        system, path = _hadoop_path(self.spark, f"{self.base}/{table}")
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        names = sorted(name for name in names if name.startswith("v"))
        if not committed:
            return names
        success = self.spark._jvm.org.apache.hadoop.fs.Path
        return [name for name in names if system.exists(success(f"{self.base}/{table}/{name}/_SUCCESS"))]

    @staticmethod
    def _parts(versions: list[str]) -> list[str]:
        """The folders that the last of the versions consists of."""
        start = len(versions) - 1
        while start > 0 and versions[start].endswith(".add"):
            start -= 1
        return versions[start:]

    def read(self, table: TableId) -> DataFrame:
        """The current rows; an empty frame of the target schema before the first load."""
        schema = self.targets[table]
        versions = self._versions(table)
        if not versions:
            return self.spark.createDataFrame([], schema)
        parts = [f"{self.base}/{table}/{version}" for version in self._parts(versions)]
        return self.spark.read.schema(schema).parquet(*parts)

    def is_loaded(self, table: TableId, token: str) -> bool:
        return any(name.removesuffix(".add").endswith(f"-{token}") for name in self._versions(table))

    def replace(self, table: TableId, rows: DataFrame, token: str | None = None, add: bool = False) -> str:
        """Write rows as the new version, or as an addition to the last one, and return its location."""
        token = token or uuid.uuid4().hex
        taken = self._versions(table, committed=False)
        number = int(taken[-1][1:9]) + 1 if taken else 1
        location = f"{self.base}/{table}/v{number:08d}-{token}{'.add' if add else ''}"
        rows.write.parquet(location)
        return location

    def load(
        self,
        table: TableId,
        rows: DataFrame,
        keys: Sequence[str],
        token: str | None = None,
        source_bytes: int | None = None,
    ) -> None:
        """Upsert unique rows (append without keys). ``source_bytes`` is an upper bound of their size on disk."""
        if token and self.is_loaded(table, token):
            return
        known = bool(self._versions(table))
        if keys and known:
            self.replace(table, upsert(self.read(table), rows, keys, self.targets[table], source_bytes), token)
        else:
            # Nothing to meet: rows are only completed with defaults.
            nothing = self.spark.createDataFrame([], self.targets[table])
            self.replace(table, upsert(nothing, rows, [], self.targets[table]), token, add=known)
        if self.keep is not None:
            self.drop_old_versions(table, self.keep)

    def drop_old_versions(self, table: TableId, keep: int = 2) -> None:
        """Delete what the last committed versions do not consist of, and what failed loads left before them."""
        committed = self._versions(table)
        if not committed:
            return
        kept = committed[: len(committed) - max(keep, 1) + 1] or committed[:1]
        oldest = self._parts(kept)[0]
        for name in self._versions(table, committed=False):
            if name < oldest:
                system, path = _hadoop_path(self.spark, f"{self.base}/{table}/{name}")
                system.delete(path, True)


#: The log of named loads in a database.
LOADS = '"feedloom_loads"'
_CREATE_LOADS = f"CREATE TABLE IF NOT EXISTS {LOADS} (table_name text, token text, PRIMARY KEY (table_name, token))"


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def merge_statement(
    table: TableId, staging: str, columns: Sequence[str], keys: Sequence[str],
    casts: dict[str, str] | None = None, token: str | None = None,
) -> str:
    """One server-side upsert from a staging table into the target. ``casts`` gives the server's type of columns that
    are staged as text; a load whose token is in the log of loads inserts nothing."""
    listed = ", ".join(map(quote, columns))
    values = ", ".join(f"CAST({quote(c)} AS {casts[c]})" if c in (casts or {}) else quote(c) for c in columns)
    target = ".".join(quote(part) for part in (table.schema, table.name) if part)
    statement = f"INSERT INTO {target} ({listed}) SELECT {values} FROM {staging}"
    # Without a condition of its own a SELECT before ON CONFLICT would be ambiguous to some parsers.
    if token:
        statement += f" WHERE NOT EXISTS (SELECT 1 FROM {LOADS} WHERE table_name = {_literal(str(table))} AND token = {_literal(token)})"
    if not keys:
        return statement
    key_set = {key.lower() for key in keys}
    updates = [f"{quote(c)} = EXCLUDED.{quote(c)}" for c in columns if c.lower() not in key_set]
    action = "DO UPDATE SET " + ", ".join(updates) if updates else "DO NOTHING"
    return f"{statement} ON CONFLICT ({', '.join(map(quote, keys))}) {action}"


def spark_merge_statement(target: str, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """The same upsert as ``MERGE INTO`` for catalog tables that support row-level changes."""

    def tick(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    key_set = {key.lower() for key in keys}
    condition = " AND ".join(f"t.{tick(k)} = s.{tick(k)}" for k in keys)
    updates = ", ".join(f"t.{tick(c)} = s.{tick(c)}" for c in columns if c.lower() not in key_set)
    matched = f" WHEN MATCHED THEN UPDATE SET {updates}" if updates else ""
    listed, values = ", ".join(map(tick, columns)), ", ".join(f"s.{tick(c)}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON {condition}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values})"
    )


_TOKEN = "feedloom.last_load"


class MergeTables:
    """Upsert into catalog tables of a format with row-level changes. The format decides which files are rewritten, so
    that a small load into a huge table stays small; ``ParquetTables`` writes a table anew with every load.

    ``names`` gives the catalog name of each table, by default ``schema.table``.
    """

    def __init__(self, spark: SparkSession, names: dict[TableId, str] | None = None) -> None:
        self.spark, self.names = spark, names or {}

    def statement(self, table: TableId, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
        target = self.names.get(table) or f"`{table.schema}`.`{table.name}`"
        if keys:
            return spark_merge_statement(target, source, columns, keys)
        listed = ", ".join(f"`{column}`" for column in columns)
        return f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {source}"

    def load(
        self,
        table: TableId,
        rows: DataFrame,
        keys: Sequence[str],
        token: str | None = None,
        source_bytes: int | None = None,
    ) -> None:
        """A named load is noted in the table's properties after it; a repetition of it is skipped. Between the two a
        failure can only double rows without keys: with keys a repeated merge changes nothing."""
        target = self.names.get(table) or f"`{table.schema}`.`{table.name}`"
        if token and self._last_token(target) == token:
            return
        view = f"load_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            self.spark.sql(self.statement(table, view, rows.columns, keys))
            if token:
                self.spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{_TOKEN}' = {_literal(token)})")
        finally:
            self.spark.catalog.dropTempView(view)

    def _last_token(self, target: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {target}").where(F.col("key") == _TOKEN).collect()
        return rows[0]["value"] if rows else None


class JdbcTables:
    """Upsert into a database: parallel write to a staging table, then one transaction there, so readers see all or none.

    ``execute`` runs statements on the server in one transaction; by default over the JVM's driver manager. ``targets``
    say which text columns the server knows as json, jsonb or time. A load with a token is noted in the transaction
    that merges it, so that a repeated one changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str],
        batch_size: int = 500,
        connections: int = 16,
        execute: Callable[[Sequence[str]], None] | None = None,
        targets: dict[TableId, T.StructType] | None = None,
    ) -> None:
        self.spark, self.url, self.properties = spark, url, properties
        self.batch_size, self.connections = batch_size, connections
        self.execute, self.targets = execute or self._execute, targets or {}

    def _execute(self, statements: Sequence[str]) -> None:
        jvm = self.spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().execute(statement)
            connection.commit()
        finally:
            connection.close()  # without a commit nothing has happened

    def staging(self, table: TableId, token: str | None) -> str:
        """A name of its own for every table and load, short enough for any server."""
        return quote("load_" + hashlib.sha256(f"{table}\n{token or uuid.uuid4().hex}".encode()).hexdigest()[:48])

    def _stage(self, rows: DataFrame, staging: str) -> None:
        (
            rows.write.format("jdbc")
            .options(**self.properties)
            .options(url=self.url, dbtable=staging, batchsize=str(self.batch_size), numPartitions=str(self.connections))
            .mode("overwrite")
            .save()
        )

    def load(
        self,
        table: TableId,
        rows: DataFrame,
        keys: Sequence[str],
        token: str | None = None,
        source_bytes: int | None = None,
    ) -> None:
        staging = self.staging(table, token)
        fields = {field.name.lower(): field for field in self.targets.get(table, T.StructType([])).fields}
        kinds = {name: logical_type(fields[name.lower()]) for name in rows.columns if name.lower() in fields}
        casts = {name: kind for name, kind in kinds.items() if kind in ("json", "jsonb", "time")}
        statements = [merge_statement(table, staging, rows.columns, keys, casts, token)]
        if token:
            noted = f"INSERT INTO {LOADS} VALUES ({_literal(str(table))}, {_literal(token)}) ON CONFLICT DO NOTHING"
            statements = [_CREATE_LOADS, *statements, noted]
        try:
            self._stage(rows, staging)
            self.execute(statements)
        finally:
            self.execute([f"DROP TABLE IF EXISTS {staging}"])
