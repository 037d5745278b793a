"""Record checks. They run before defaults and file name values are added, so neither can rescue a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import name_column
from feedloom.plans.columns import MALFORMED, REASON
from feedloom.plans.mapping import XmlSpec

MALFORMED_DOCUMENT = "malformed_document"


def reject_reason(spec: XmlSpec, malformed: Column | None = None) -> Column:
    """First failed check of a record in the order of the values, NULL for a valid record."""
    checks = [] if malformed is None else [F.when(malformed, F.lit(MALFORMED_DOCUMENT))]
    for key, value in spec.values.items():
        column = name_column(key)
        if value.required:
            checks.append(F.when(column.isNull(), F.lit(f"required:{key}")))
        if spec.enums.get(key):
            checks.append(F.when(~column.isin(*sorted(spec.enums[key])), F.lit(f"enum:{key}")))
    saved = [name_column(key) for key in spec.saved_keys]
    empty = F.coalesce(*saved).isNull() if saved else F.lit(True)
    checks.append(F.when(empty, F.lit("empty")))
    return F.coalesce(*checks)


def annotate(records: DataFrame, spec: XmlSpec) -> DataFrame:
    """Adds ``_reject_reason``; keeps all rows and columns, validation-only ones included."""
    malformed = F.col(MALFORMED) if MALFORMED in records.columns else None
    return records.withColumn(REASON, reject_reason(spec, malformed))


def validate(records: DataFrame, spec: XmlSpec) -> tuple[DataFrame, DataFrame]:
    """(valid records without validation-only columns, rejected records with their reason)."""
    checked = annotate(records, spec)
    dropped = [c for c in (REASON, MALFORMED) if c in checked.columns]
    valid = checked.where(F.col(REASON).isNull())
    kept = [name_column(c) for c in checked.columns if c not in dropped and c not in spec.validation_only_keys]
    return valid.select(*kept), checked.where(F.col(REASON).isNotNull())


def required_filter(records: DataFrame, *keys: str) -> DataFrame:
    condition = F.lit(True)
    for key in keys:
        condition = condition & name_column(key).isNotNull()
    return records.where(condition)


def enum_filter(records: DataFrame, key: str, allowed: set[str] | frozenset[str]) -> DataFrame:
    """Absent values pass, and an empty set checks nothing. Values are compared with their case."""
    if not allowed:
        return records
    return records.where(name_column(key).isNull() | name_column(key).isin(*sorted(allowed)))


def fail_on(df: DataFrame, reason: Column, message: str) -> DataFrame:
    """Ends the job at the first row with a reason. A filter, so that column pruning cannot remove it."""
    error = F.raise_error(F.concat(F.lit(message + ": "), reason))
    return df.where(F.when(reason.isNotNull(), error.cast("boolean")).otherwise(F.lit(True)))


def apply_error_policy(df: DataFrame, on_error: str, what: str) -> tuple[DataFrame, DataFrame]:
    """Splits an annotated frame into (good, rejected). With ``fail`` reading the good rows raises on a bad one."""
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', got {on_error!r}")
    rejected = df.where(F.col(REASON).isNotNull())
    if on_error == "fail":
        return fail_on(df, F.col(REASON), what).drop(REASON), rejected
    return df.where(F.col(REASON).isNull()).drop(REASON), rejected
