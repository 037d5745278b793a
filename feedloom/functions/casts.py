"""Text -> typed value, as Column expressions. A text that does not fit gives NULL and a reject reason, no error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import name_column, strip
from feedloom.operators.validate import apply_error_policy
from feedloom.plans.columns import REASON

# Texts that mean true, in lower case. Everything else is false.
TRUE_TEXTS = ("1", "true", "t", "yes", "y")

_SPECIAL = r"^[+-]?(NaN|Infinity|[0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?[fFdD]?|\.[0-9]+([eE][+-]?[0-9]+)?[fFdD]?)$"
_TIME = r"^([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$"
_CLOCK = r"[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_OFFSET = r"(Z|[+-][0-9]{2}:[0-9]{2})"
_HEX = r"^([0-9A-Fa-f]{2})*$"

# All texts that a cast to bigint takes, and some of 19 digits that it does not: a cast that fails costs an exception.
_INTEGER = r"^[ \p{Cntrl}]*[+-]?0*[0-9]{1,19}[ \p{Cntrl}]*$"

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}


class UnsupportedTypeError(TypeError):
    """The target column has a type that text cannot be loaded into."""


def to_boolean(text: Column) -> Column:
    return F.lower(text).isin(*TRUE_TEXTS)


def _unpadded(text: Column) -> Column:
    """SQL casts skip surrounding space, which is an error here."""
    return strip(text) == text


def to_integer(text: Column, type_: T.DataType) -> Column:
    """Texts that are no integer, or out of range, are told without a cast, because a failing one is slow."""
    number = F.when(_unpadded(text) & text.rlike(_INTEGER), text.try_cast("bigint"))
    if isinstance(type_, T.LongType):
        return number
    most = 2 ** (_INTEGER_BITS[type(type_)] - 1)
    return F.when(number.between(-most, most - 1), number.cast(type_))


def to_floating(text: Column, type_: T.DataType) -> Column:
    """Decimal comma allowed. Of the special values only ``NaN`` and ``Infinity`` in exactly this case."""
    number = F.replace(text, F.lit(","), F.lit("."))
    value = number.try_cast("double")
    finite = F.abs(value) < float("inf")  # NaN is greater than infinity here
    return F.when(finite | number.rlike(_SPECIAL), value).cast(type_)


def to_decimal(text: Column, type_: T.DecimalType) -> Column:
    """Decimal comma allowed. Rounded half up to the scale; too many digits before the point do not fit."""
    return F.when(_unpadded(text), F.replace(text, F.lit(","), F.lit(".")).try_cast(type_))


def _char(text: Column, position: int) -> Column:
    return F.substring(text, position, 1)


def _has_day(text: Column) -> Column:
    """Dashes where ``YYYY-MM-DD`` has them; the cast itself looks at the digits."""
    return (_char(text, 5) == "-") & (_char(text, 8) == "-")


def to_date(text: Column) -> Column:
    """The leading ``YYYY-MM-DD``, with all its digits; what follows is ignored."""
    digits = F.lit(True)
    for position in (1, 2, 3, 4, 6, 7, 9, 10):
        digits = digits & _char(text, position).between("0", "9")
    return F.when(_has_day(text) & digits, F.substring(text, 1, 10).try_cast("date"))


def to_time_text(text: Column) -> Column:
    """``HH:mm:ss`` with leading zeros; NULL when it is no time of day."""
    parts = [F.regexp_extract(text, _TIME, group).try_cast("int") for group in (1, 2, 3)]
    valid = (parts[0] < 24) & (parts[1] < 60) & (parts[2] < 60)
    return F.when(valid, F.format_string("%02d:%02d:%02d", *parts))


def _is_plain_moment(text: Column, separators: str) -> Column:
    """``YYYY-MM-DD?HH:mm:ss``, the usual shape, told without a regular expression."""
    marks = (F.length(text) == 19) & _has_day(text) & (_char(text, 14) == ":") & (_char(text, 17) == ":")
    return marks & _char(text, 11).isin(*separators) & _char(text, 19).between("0", "9")


def to_local_timestamp(text: Column) -> Column:
    """Zoned text is moved to the session time zone; local text and a bare date are taken as they are."""
    zoned = text.rlike(f"^{_DAY}T{_CLOCK}{_OFFSET}$")
    local = _is_plain_moment(text, "T ") | text.rlike(f"^{_DAY}([T ]{_CLOCK})?$")
    return F.when(local, text.try_cast("timestamp_ntz")).when(zoned, text.try_cast("timestamp").cast("timestamp_ntz"))


def to_zoned_timestamp(text: Column) -> Column:
    """Zoned text, or local text in the session time zone. A bare date is not accepted."""
    fits = _is_plain_moment(text, "T") | text.rlike(f"^{_DAY}T{_CLOCK}{_OFFSET}?$")
    return F.when(fits, text.try_cast("timestamp"))


def to_bytes(text: Column) -> Column:
    return F.when(text.rlike(_HEX), F.unhex(text))


def is_json(text: Column) -> Column:
    """True for exactly one JSON value. The strict parser ignores what follows the first value; inside an array and an
    object nothing can follow: the first bracket too many is wrong in one of the two, and a comma makes two elements."""
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))
    strict = F.try_parse_json(text).isNotNull()
    return F.coalesce(strict & (in_array == 1) & in_object.isNotNull(), F.lit(False))


def to_json_text(text: Column) -> Column:
    return F.when(is_json(text), text)


def logical_type(field: T.StructField) -> str:
    """``json`` and ``time`` can be asked for on a text field by ``metadata={"type": ...}``."""
    return str((field.metadata or {}).get("type", "")).lower()


def parse_text(text: Column, field: T.StructField) -> Column:
    """The typed value of a text for a target field, NULL when the text does not fit."""
    type_, hint = field.dataType, logical_type(field)
    if isinstance(type_, T.StringType) and hint in ("json", "jsonb"):
        return to_json_text(text)
    if isinstance(type_, T.StringType) and hint == "time":
        return to_time_text(text)
    if isinstance(type_, (T.StringType, T.CharType, T.VarcharType)):
        return text
    if isinstance(type_, T.BooleanType):
        return to_boolean(text)
    if isinstance(type_, _INTEGERS):
        return to_integer(text, type_)
    if isinstance(type_, (T.FloatType, T.DoubleType)):
        return to_floating(text, type_)
    if isinstance(type_, T.DecimalType):
        return to_decimal(text, type_)
    if isinstance(type_, T.DateType):
        return to_date(text)
    if isinstance(type_, T.TimestampNTZType):
        return to_local_timestamp(text)
    if isinstance(type_, T.TimestampType):
        return to_zoned_timestamp(text)
    if isinstance(type_, T.BinaryType):
        return to_bytes(text)
    if isinstance(type_, T.VariantType):
        return F.try_parse_json(to_json_text(text))
    if isinstance(type_, getattr(T, "TimeType", ())):
        return to_time_text(text).try_cast(type_)
    raise UnsupportedTypeError(f"column '{field.name}' has type {type_.simpleString()}, which cannot be loaded")


def default_text(field: T.StructField) -> str | None:
    """Literal default of a target column, as text: ``metadata['default']``, else a literal ``CURRENT_DEFAULT``."""
    metadata = field.metadata or {}
    if "default" in metadata:
        return None if metadata["default"] is None else str(metadata["default"])
    text = metadata.get("CURRENT_DEFAULT")
    if text is None:
        return None
    if len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    return None if text.upper() == "NULL" else text


def default_value(field: T.StructField) -> Column:
    """The typed default a new row gets in a column that is not loaded."""
    text = default_text(field)
    return F.lit(None).cast(field.dataType) if text is None else parse_text(F.lit(text), field)


def resolve_null(text: Column, field: T.StructField) -> Column:
    """NULL stays NULL in a nullable column, whatever its default; elsewhere it becomes the default, if there is one."""
    default = default_text(field)
    return text if field.nullable or default is None else F.coalesce(text, F.lit(default))


def cast_reason(text: Column, value: Column, field: T.StructField) -> Column:
    """Why a text is not accepted for a target field, given what it was read as; NULL when it is."""
    defaulted = not field.nullable and default_text(field) is not None
    given = F.lit(True) if defaulted else text.isNotNull()
    reason = F.when(given & value.isNull(), F.lit(f"cast:{field.name}:{field.dataType.simpleString()}"))
    if not field.nullable and not defaulted:
        reason = F.coalesce(F.when(text.isNull(), F.lit(f"not_null:{field.name}")), reason)
    return reason


def cast_value(text: Column, field: T.StructField) -> tuple[Column, Column]:
    """(typed value, reject reason or NULL) of a text for a target field."""
    value = parse_text(resolve_null(text, field), field)
    return value, cast_reason(text, value, field)


def annotate_casts(
    rows: DataFrame, fields: list[T.StructField], carried: list[str] | tuple[str, ...] = (), keep_text: bool = False
) -> DataFrame:
    """Typed columns plus ``_reject_reason``; ``keep_text`` adds the original texts as one struct ``_text``.

    Two projections: values first, then the reasons, which look at the values and so cast nothing a second time.
    """
    has_reason = REASON in rows.columns
    texts = F.struct(*[name_column(field.name) for field in fields]).alias("_text")
    values = [parse_text(resolve_null(name_column(f.name), f), f).alias(f.name) for f in fields]
    typed = rows.select(*carried, *values, texts, *([REASON] if has_reason else []))
    reasons = [F.col(REASON)] if has_reason else []
    reasons += [cast_reason(F.col("_text").getField(f.name), name_column(f.name), f) for f in fields]
    kept = [*carried, *[f.name for f in fields], *(["_text"] if keep_text else [])]
    return typed.select(*map(name_column, kept), F.coalesce(*reasons).alias(REASON))


def cast_to(
    rows: DataFrame,
    target: T.StructType,
    on_error: str = "quarantine",
    carried: list[str] | tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows with the reason) for text columns named as in the target."""
    present = {c.lower() for c in rows.columns}
    fields = [field for field in target.fields if field.name.lower() in present]
    return apply_error_policy(annotate_casts(rows, fields, carried), on_error, "row cannot be loaded")
