"""Fill-in-middle: texts cut at two random places and put together again in another order.

Cuts are given in units (code points), texts are UTF-8. The bytes of a whole Arrow batch lie in one buffer, which is
viewed as 64-bit words. Arithmetic on a word marks the bytes that end a unit: all whose next byte is no continuation
(``10xxxxxx``). ``bitwise_count`` gives the ends in each word and their running sum is searched for the word that holds
the k-th end; the place in the word is found by one multiplication, which sums the marks below every byte. So no text is
decoded and no character is looked at by itself. Tasks return three numbers for a text; Spark slices its bytes.

Random numbers are the first four groups of eight hexadecimal digits of SHA-256 of ``seed:doc_id``, so that reruns and
repartitioned inputs agree.

Defined cases: a null text is empty, an empty one is plain; a text that holds a marker is plain, since it could not be
told apart afterwards; a null id counts as an empty one; repeated rows are transformed alike; a text of any length is cut
in one piece with some five times its size in memory; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents: how many are transformed, and how many of those with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = 1
#: Words that are marked at a time.
BLOCK = 1 << 20
_LOW = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)


class Units:
    """Counts and finds units of a buffer of UTF-8."""

    def __init__(self, data: np.ndarray) -> None:
        # Two words of zeros behind the text: a zero is no continuation, so the last unit ends at the last byte.
        padded = np.zeros((len(data) + 7) // 8 * 8 + 16, np.uint8)
        padded[: len(data)] = data
        self.words = padded.view("<u8")
        counts = np.empty(len(self.words) - 1, np.int64)
        for at in range(0, len(counts), BLOCK):
            block = np.arange(at, min(at + BLOCK, len(counts)))
            counts[block] = np.bitwise_count(self.marks(block))
        #: Ends before each word.
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])

    def marks(self, at: np.ndarray) -> np.ndarray:
        """For words by number: 1 in every byte that ends a unit."""
        here, after = self.words[at], self.words[at + 1]
        here = (here >> np.uint64(7)) & ~(here >> np.uint64(6)) & _LOW
        after = (after >> np.uint64(7)) & ~(after >> np.uint64(6)) & _LOW
        return ~((here >> np.uint64(8)) | (after << np.uint64(56))) & _LOW

    def ended(self, place: np.ndarray) -> np.ndarray:
        """Units that end before each byte place."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        below = (np.uint64(1) << (np.uint64(8) * byte)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks(word) & below)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The byte place behind the k-th end, counted from one."""
        word = np.searchsorted(self.before[1:], k, side="left")
        rank = (k - self.before[word]).astype(np.uint64)
        # Byte i of the product is the number of ends up to byte i, at most eight.
        upto = self.marks(word) * _LOW
        reached = np.bitwise_count(((upto | _HIGH) - rank * _LOW) & _HIGH)
        return 8 * word + 9 - reached.astype(np.int64)


def cut_places(starts: np.ndarray, stops: np.ndarray, data: np.ndarray, first: np.ndarray, second: np.ndarray):
    """For texts by their places in ``data`` and two random numbers each: units, and of both cuts the unit and the byte
    where it is."""
    units = Units(data)
    base = units.ended(starts)
    n = units.ended(stops) - base
    one, two = first % (n + 1), second % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    place = lambda k: np.where(k > 0, units.after(np.maximum(base + k, 1)), starts) - starts
    return n, low, place(low), high, place(high)


_CUT = "struct<n:bigint,low:bigint,low_byte:bigint,high:bigint,high_byte:bigint>"


def _cut(text: Column, first: Column, second: Column) -> Column:
    @F.arrow_udf(_CUT)
    def of(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        found = cut_places(
            offsets[:-1] - offsets[0],
            offsets[1:] - offsets[0],
            data[offsets[0] : offsets[-1]],
            one.to_numpy(zero_copy_only=False),
            two.to_numpy(zero_copy_only=False),
        )
        names = ["n", "low", "low_byte", "high", "high_byte"]
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names)

    return of(text, first, second)


def _random(seed: int) -> list[Column]:
    """Four numbers below 2^32 for each document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output."""
    h1, h2, h3, h4 = _random(seed)
    marked = "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE)))
    rows = docs.select("doc_id", whole("text").alias("text"))
    rows = rows.select("doc_id", "text", _cut(F.col("text"), h1, h2).alias("cut"))
    plain = (F.col("text") == "") | F.col("text").rlike(marked) | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    bytes_, low, high = F.col("text").cast("binary"), F.col("cut.low_byte"), F.col("cut.high_byte")
    piece = lambda at, upto: F.substring(bytes_, (at + 1).cast("int"), (upto - at).cast("int")).cast("string")
    prefix, middle = piece(F.lit(0), low), piece(low, high)
    suffix = piece(high, F.octet_length("text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    cut = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        "doc_id",
        "cut.n",
        "form",
        F.when(cut, F.col("cut.low")).alias("prefix_chars"),
        F.when(cut, F.col("cut.high") - F.col("cut.low")).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")).alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that a transformed one was made of. Its parts hold no marker, and a marker begins with a character that
    no marker has again, so none can arise where parts meet."""
    parts = F.split(output, "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
