"""Pieces of XML files in other encodings, and pieces put together to whole records.

A file is cut at the bytes of the record's end tag in its own encoding. Single-byte encodings are decoded by a table of
128 characters, UTF-16 by Spark, both natively. Where records hold elements of their own name, or such elements are
elsewhere in the document, some cuts are inside of a record. How deep a piece ends follows from the tags it opens and
closes and from the sum of all pieces before it; a cut is between records where that is the depth of the records'
parent. Sums go over ranges of a file first, so a file of any size is the work of many tasks.
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.plans.columns import SOURCE

_WIDE = ("utf-16-le", "utf-16-be")
# Comments, text sections and instructions that are whole; what is in them is no markup.
_NO_MARKUP = r"<!--(?s:.*?)-->|<!\[CDATA\[(?s:.*?)\]\]>|<\?(?s:.*?)\?>"
_OPENED = r"<(?![/!?])(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+(?<!/)>"
_CLOSED = r"</"
_SURROGATE = r"[\xD8-\xDF]"
# Hexadecimal digits of UTF-16 units: one that is no surrogate, or a pair of them.
_UNITS = {
    "utf-16-le": r"\G(?:..(?:[0-9A-CEF].|D[0-7])|..D[89AB]..D[C-F])",
    "utf-16-be": r"\G(?:(?:[0-9A-CEF].|D[0-7])..|D[89AB]..D[C-F]..)",
}


def upper_half(charset: str) -> str | None:
    """The characters of bytes 128 to 255 where a byte is a character and the lower half is ASCII; some may be missing."""
    try:
        alone = [bytes([b]).decode(charset, "replace") for b in range(256)]
        joined = bytes(range(255, -1, -1)).decode(charset, "replace")
    except (LookupError, UnicodeError):
        return None
    if any(len(c) != 1 for c in alone) or joined != "".join(reversed(alone)) or alone.count("\ufffd") > 64:
        return None
    return "".join(alone[128:]) if "".join(alone[:128]) == bytes(range(128)).decode() else None


def is_cuttable(charset: str) -> bool:
    """Whether files in this encoding (by its Python name) are cut and decoded natively."""
    return charset in ("utf-8", "ascii", *_WIDE) or upper_half(charset) is not None


def cut_options(mark: str, charset: str) -> dict[str, str]:
    """Reader options that cut a file at the mark's bytes."""
    if charset in _WIDE:
        return {"lineSep": mark, "encoding": "UTF-16LE" if charset.endswith("le") else "UTF-16BE"}
    if upper_half(charset) is not None:
        return {"lineSep": mark_bytes(mark, charset).decode("latin-1"), "encoding": "ISO-8859-1"}
    return {"lineSep": mark}


def mark_bytes(mark: str, charset: str) -> bytes:
    """The mark as it is written, or nothing that could be found if the encoding does not have its characters."""
    try:
        return mark.encode(charset)
    except UnicodeError:
        return mark.encode()


def decoded(raw: Column, charset: str) -> Column:
    """Text of a piece whose bytes Spark read as a string; NULL where they are wrong."""
    data = raw.cast("binary")
    if charset in _WIDE:
        # Without a byte that could be of a surrogate all pairs of bytes are characters, and units need not be looked at.
        plain = (F.octet_length(data) % 2 == 0) & ~F.decode(data, "ISO-8859-1").rlike(_SURROGATE)
        whole = plain | (F.regexp_replace(F.hex(data), _UNITS[charset], "") == "")
        return F.when(whole, F.decode(data, "UTF-16LE" if charset.endswith("le") else "UTF-16BE"))
    if charset in ("utf-8", "ascii"):
        return F.when(F.is_valid_utf8(raw), raw)
    upper = upper_half(charset)
    pairs = [(chr(128 + k), c) for k, c in enumerate(upper) if c != chr(128 + k)]
    text = F.decode(data, "ISO-8859-1")
    return F.translate(text, "".join(a for a, _ in pairs), "".join(b for _, b in pairs)) if pairs else text


def known_charset(name: str | None) -> str:
    try:
        return codecs.lookup(name or "utf-8").name
    except LookupError:
        return "utf-8"


def depth_change(text: Column) -> Column:
    """Elements that a piece opens and leaves open, less those that it closes and did not open."""
    other = F.contains(text, F.lit("<!")) | F.contains(text, F.lit("<?"))
    markup = F.when(other, F.regexp_replace(text, _NO_MARKUP, "")).otherwise(text)
    closed = (F.octet_length(markup) - F.octet_length(F.replace(markup, F.lit(_CLOSED), F.lit("")))) / len(_CLOSED)
    return F.regexp_count(markup, F.lit(_OPENED)) - closed.cast("int")


def _before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds the sum of a value over all earlier pieces of a file: over earlier blocks, and within the block."""
    within = W.partitionBy(SOURCE, "block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_value", value.cast("long"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(F.col(SOURCE).alias("_file"), F.col("block").alias("_block")).agg(F.sum("_value").alias("_sum"))
    sums = sums.select("_file", "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    joined = rows.join(sums, (F.col(SOURCE) == F.col("_file")) & (F.col("block") == F.col("_block")))
    here = F.coalesce(F.sum("_value").over(within), F.lit(0))
    return joined.withColumn(name, F.col("_earlier") + here).drop("_value", "_file", "_block", "_earlier")


def groups(pieces: DataFrame, level: int) -> DataFrame:
    """``pieces``: file, block, at (the order within a block), change of depth. Adds ``group``: pieces with one number
    end together at depth ``level``, or at the end of the file."""
    rows = _before(pieces, F.col("change"), "_depth")
    between = (F.col("_depth") + F.col("change") == level).cast("long")
    return _before(rows.withColumn("_between", between), F.col("_between"), "group").drop("_depth", "_between")


def joined_groups(pieces: DataFrame, level: int, mark: str, longest: int) -> DataFrame:
    """Written pieces (file, name, file_size, block, at, octets, value, change) -> one row per group, in file order by
    ``block``: the text of its pieces with the marks between them. Files with a group longer than ``longest`` have none.
    """
    carried = [c for c in pieces.columns if c not in ("block", "at", "octets", "value", "change")]
    numbered = groups(pieces.select(SOURCE, "block", "at", "octets", "change"), level)
    named = numbered.select(F.col(SOURCE).alias("_file"), F.col("block").alias("_block"), F.col("at").alias("_at"), "octets", "group")
    sizes = named.groupBy("_file", "group").agg(F.sum("octets").alias("octets"), F.count("*").alias("n"))
    last = sizes.groupBy("_file").agg(F.max("group").alias("_last"), F.max("octets").alias("_most"))
    fit = last.where(F.col("_most") <= longest).select("_file", "_last")
    same = (F.col(SOURCE) == F.col("_file")) & (F.col("block") == F.col("_block")) & (F.col("at") == F.col("_at"))
    rows = pieces.drop("octets").join(named, same).drop("_file", "_block", "_at")
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value", "octets")))
    rows = rows.groupBy(*carried, "group").agg(parts.alias("parts"))
    rows = rows.join(fit, F.col(SOURCE) == F.col("_file")).drop("_file")
    text = F.array_join(F.transform("parts", lambda p: p["value"]), mark)
    octets = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["octets"])
    return rows.select(
        *carried, F.col("group").alias("block"), (F.col("group") == F.col("_last")).alias("is_last"),
        text.alias("value"), octets.alias("octets"), F.size("parts").alias("n_pieces"),
    )
