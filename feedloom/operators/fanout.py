"""One record -> the rows of several tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import default_text, parse_text
from feedloom.functions.text import name_column
from feedloom.plans.columns import POSITION, SOURCE, SOURCE_NAME
from feedloom.plans.mapping import Mapping, MappingError, TableId
from feedloom.sources.files import filename_value


def xml_column_value(mapping: Mapping, table: TableId, name: str) -> Column | None:
    """Value of a table column from the record, mapping defaults included."""
    keys = [key for key, column in mapping.columns.items() if column.table == table and column.name == name]
    if not keys:
        return None
    # Of several keys for one column the last one wins; a default counts like a value found there.
    choices = []
    for key in reversed(keys):
        default = mapping.xml.values[key].default_value
        if default is not None:
            choices.append(F.when(name_column(key).isNull(), F.lit(default)))
    choices += [name_column(key) for key in reversed(keys)]
    return F.coalesce(*choices)


def table_texts(mapping: Mapping, table: TableId) -> dict[str, Column]:
    """The text of each column of a table, taken from a record. File name values win over XML values."""
    groups = {column: group for group, column in mapping.db[table].filename_groups_to_columns.items()}
    texts = {}
    for name in mapping.target_columns(table):
        choices = []
        if name in groups:
            choices.append(filename_value(F.col(SOURCE_NAME), mapping.xml.files, groups[name]))
        from_xml = xml_column_value(mapping, table, name)
        if from_xml is not None:
            choices.append(from_xml)
        texts[name] = F.coalesce(*choices)
    return texts


def table_rows(valid: DataFrame, mapping: Mapping, table: TableId) -> DataFrame:
    """Rows of one table as text columns. A row without any value is left out."""
    carried = [c for c in (SOURCE, POSITION) if c in valid.columns]
    rows = valid.select(*carried, *[text.alias(name) for name, text in table_texts(mapping, table).items()])
    return rows.where(F.coalesce(*[name_column(name) for name in mapping.target_columns(table)]).isNotNull())


def fan_out(valid: DataFrame, mapping: Mapping) -> dict[TableId, DataFrame]:
    """Rows per table. All frames read the same records: materialise those first when there are several tables."""
    return {table: table_rows(valid, mapping, table) for table in mapping.loaded_tables}


def target_fields(target: T.StructType, columns: list[str], unique: list[str] | tuple[str, ...] = ()) -> list[T.StructField]:
    """The mapped fields of a target in its own order. Names are matched without case; unknown ones are errors."""
    if not target.fields:
        raise MappingError("the target table has no columns")
    if not columns:
        raise MappingError("no columns to load")
    known = {field.name.lower() for field in target.fields}
    for kind, names in (("target", columns), ("unique", unique)):
        missing = [name for name in names if name.lower() not in known]
        if missing:
            raise MappingError(f"{kind} columns that the table does not have: {missing}")
    mapped = {name.lower() for name in columns}
    return [field for field in target.fields if field.name.lower() in mapped]


def check_target(mapping: Mapping, table: TableId, target: T.StructType) -> None:
    """Errors that a load would meet in every row: unique columns without values, NOT NULL columns left out."""
    columns, unique = mapping.target_columns(table), mapping.db[table].unique_columns
    target_fields(target, columns, unique)
    loaded = {name.lower() for name in columns}
    never = [name for name in unique if name.lower() not in loaded]
    if never:
        raise MappingError(f"unique columns of {table} that get no value: {never}")
    for field in target.fields:
        if field.name.lower() in loaded:
            parse_text(F.lit(None).cast("string"), field)  # raises for a type that cannot be loaded
    left_out = [
        f.name for f in target.fields if not f.nullable and f.name.lower() not in loaded and default_text(f) is None
    ]
    if left_out:
        raise MappingError(f"NOT NULL columns of {table} without value and default: {left_out}")


def project_to_target(
    rows: DataFrame, target: T.StructType, columns: list[str], carried: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Mapped columns only, renamed and ordered as in the target."""
    source = {name.lower(): name for name in columns}
    fields = target_fields(target, columns)
    return rows.select(*carried, *[name_column(source[f.name.lower()]).alias(f.name) for f in fields])
