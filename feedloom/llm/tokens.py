"""Token counts of a word-level byte-pair vocabulary, by rank-synchronous merging of ragged arrays.

The pre-tokens of many texts are taken together, each different one once. They lie end to end in one array of symbol
numbers, with the rank of every pair of neighbours beside it. In a step every pre-token finds its own lowest rank and
merges that pair wherever it has it; only ranks next to a merge are looked up again; pre-tokens without a mergeable
pair leave with the number of symbols they have. One call of numpy so does one merge in all pre-tokens at once.

Normalising and splitting follow the tokenizer's file. Texts whose characters are all below U+0250 are split by the
regular expression here, unless lower case brings one of them above; others by the library's own normaliser and splitter,
as their Unicode tables may be of another version than Python's.

Defined cases: null and empty texts have no bytes and no tokens; the strings of special tokens count one token each;
repeated rows are counted each for itself; a text of any length is counted in one piece, with some hundred bytes of
memory a character; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 2048
#: Characters of text that are split before their pre-tokens are merged, and pre-tokens remembered within an Arrow batch.
BATCH_CHARS, REMEMBERED = 1_000_000, 200_000
#: Characters below this one are normalised alike by all versions of Unicode; none of them combines with another.
SAFE = 0x250
_NONE = np.iinfo(np.int64).max


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of bytes."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Merger:
    """Ranks of pairs, and merging by them. Made from the text of a tokenizer file."""

    def __init__(self, model: dict) -> None:
        vocabulary, merges = model["vocab"], model["merges"]
        end = model.get("end_of_word_suffix") or ""
        symbols = _byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int64)
        self.last = np.array([vocabulary[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.width = len(vocabulary) + 1
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], np.arange(len(keys))[order], made
        # A merge whose product is part of an earlier pair has to be done one place at a time.
        first_use = np.full(self.width, _NONE)
        np.minimum.at(first_use, left, np.arange(len(keys)))
        np.minimum.at(first_use, right, np.arange(len(keys)))
        self.one_by_one = first_use[made] < np.arange(len(keys))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that are left of each pre-token; none of them is empty."""
        out = np.zeros(len(pieces), np.int64)
        if not pieces:
            return out
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        stop = np.cumsum(length)
        ids = self.inner[raw]
        ids[stop - 1] = self.last[raw[stop - 1]]
        owner = np.arange(len(pieces))
        ranks = np.full(len(ids), _NONE)
        ranks[:-1] = self.rank(ids[:-1], ids[1:])
        ranks[stop - 1] = _NONE
        while True:
            start = stop - length
            lowest = np.minimum.reduceat(ranks, start)
            busy = lowest != _NONE
            if not busy.all():
                out[owner[~busy]] = length[~busy]
                keep = np.repeat(busy, length)
                ids, ranks, owner, length, lowest = ids[keep], ranks[keep], owner[busy], length[busy], lowest[busy]
                if not len(owner):
                    return out
                stop = np.cumsum(length)
            low = np.repeat(lowest, length)
            at = np.flatnonzero(ranks == low)
            # In a run of one pair (aaa) every second place merges, from the left.
            new_run = np.empty(len(at), bool)
            new_run[0] = True
            new_run[1:] = np.diff(at) != 1
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            rank = low[at]
            if self.one_by_one[rank].any():
                seq = np.searchsorted(stop, at, side="right")
                again = np.empty(len(at), bool)
                again[0] = False
                again[1:] = seq[1:] == seq[:-1]
                once = ~(again & self.one_by_one[rank])
                at, rank = at[once], rank[once]
            seq = np.searchsorted(stop, at, side="right")
            ids[at] = self.made[rank]
            gone = np.zeros(len(ids), bool)
            gone[at + 1] = True
            # A merged symbol is last if the one that went was.
            ends = np.zeros(len(ids), bool)
            ends[stop - 1] = True
            ends[at] |= ends[at + 1]
            keep = ~gone
            place = np.cumsum(keep) - 1
            ids, ranks, ends = ids[keep], ranks[keep], ends[keep]
            length = length - np.bincount(seq, minlength=len(length))
            stop = np.cumsum(length)
            merged = place[at]
            touched = np.unique(np.concatenate([merged, merged[merged > 0] - 1]))
            open_ = touched[~ends[touched]]
            ranks[touched] = _NONE
            ranks[open_] = self.rank(ids[open_], ids[open_ + 1])


def _letters_and_numbers() -> tuple[str, str]:
    chars = [chr(c) for c in range(SAFE)]
    of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
    return of("L"), of("N")


class Counter:
    """Counts tokens of texts for one tokenizer file; a task makes its own from the file's text."""

    def __init__(self, source: str) -> None:
        self.source = source

    def __getstate__(self) -> dict:
        return {"source": self.source}

    @cached_property
    def merger(self) -> Merger:
        return Merger(json.loads(self.source)["model"])

    @cached_property
    def special(self) -> re.Pattern:
        names = sorted((t["content"] for t in json.loads(self.source)["added_tokens"]), key=len, reverse=True)
        return re.compile("|".join(map(re.escape, names)) or r"(?!)")

    @cached_property
    def split(self):
        letters, numbers = _letters_and_numbers()
        white = r"\t-\r \x85\xa0"
        # The file's pattern, with its classes written out.
        pattern = f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{white}{letters}{numbers}]+"
        return re.compile(pattern).findall

    @cached_property
    def unsafe(self):
        # Also those that lower case brings above the bound, or makes two characters.
        odd = [c for c in map(chr, range(SAFE)) if len(c.lower()) > 1 or c.lower() >= chr(SAFE)]
        return re.compile(f"[{''.join(odd)}{chr(SAFE)}-\U0010ffff]").search

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.source)

    @cached_property
    def byte_of(self) -> dict[str, int]:
        return {s: b for b, s in enumerate(_byte_symbols())}

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens, as ordinary text."""
        if not self.unsafe(text):
            return self.split(text.lower())
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, piece)).decode() for piece, _ in found]

    def count(self, texts: pd.Series) -> np.ndarray:
        known: dict[str, int] = {}
        out = np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            new = list({p for _, pieces in waiting for p in pieces if p not in known})
            known.update(zip(new, self.merger.counts([p.encode() for p in new]).tolist(), strict=True))
            for i, pieces in waiting:
                out[i] += sum(map(known.__getitem__, pieces))
            waiting.clear()
            if len(known) > REMEMBERED:
                known.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            parts = [text]
            if "<" in text and self.special.search(text):
                out[i] += len(self.special.findall(text))
                parts = self.special.split(text)
            for part in parts:
                waiting.append((i, self.pieces(part)))
            size += len(text)
            if size >= BATCH_CHARS:
                flush()
                size = 0
        flush()
        return out


def count(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. The file is read here and sent to the tasks."""
    with open(tokenizer_file, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("bigint")
    def tokens(texts: pd.Series) -> pd.Series:
        return pd.Series(_counter(source).count(texts))

    rows = docs.select(
        "doc_id", F.octet_length(whole("text")).cast("bigint").alias("n_bytes"), tokens(F.col("text")).alias("n_tokens")
    )
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


_COUNTERS: dict[int, Counter] = {}


def _counter(source) -> Counter:
    """One counter per process: a worker keeps it for its later batches."""
    key = hash(source.value)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(source.value)
    return _COUNTERS[key]
