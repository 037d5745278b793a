"""Text rules shared by extraction and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the characters that count as surrounding space (controls, then Unicode separators).
_SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x20,
    0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
SPACES = "".join(map(chr, _SPACE_CODES))


def strip(text: Column) -> Column:
    """Remove surrounding space of every kind; SQL ``trim`` alone knows only U+0020.

    Trimming looks for both ends of a text among all kinds of space. Most texts begin and end with a visible ASCII
    character, which two comparisons tell."""
    visible = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(visible, text).otherwise(F.btrim(text, F.lit(SPACES)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def join_chunks(chunks: Column) -> Column:
    """Element content from its text chunks: each stripped, blank ones left out, one per line; NULL when none is left."""
    lines = F.filter(F.transform(chunks, strip), lambda line: line != "")
    # Most elements hold one text, which needs no lambda.
    text = F.when(F.size(chunks) == 1, strip(F.get(chunks, F.lit(0)))).otherwise(F.array_join(lines, "\n"))
    return F.nullif(text, F.lit(""))


def name_column(name: str) -> Column:
    """The column of exactly this name, also when it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")
