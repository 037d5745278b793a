"""Periodic runs of words, and texts in which every run is cut back to one period.

A run is a maximal stretch of words with smallest period q, at least ``least`` words and ``times`` periods long. Two
places of a run that are one period apart begin suffixes which agree for the length of the run less q, so places of runs
are neighbours among the suffixes that agree for long.

Method, for the texts of a batch together:

1. Ranks of 1, 2, 4, ... words by doubling tell which texts repeat a stretch as long as a run needs; most have none.
2. Of the others all suffixes are sorted by further doubling, and the common length of neighbours is read off the ranks.
3. Suffix classes are united by falling common length, as Kruskal unites trees: a class is an ordered set of positions,
   the smaller is put into the larger. Two positions that become neighbours in the united class agree for exactly the
   present length. If their distance, at most that length, makes a run, it is the run's smallest period: a smaller one
   would have put another position of the class between them, earlier. The run begins at the lesser position if the
   words before both differ, and its end follows from the length. So each run is found once and none is compared.

Defined cases: null, empty and blank texts have no words and no runs; repeated rows are rows of their own; equally good
runs all count; a text is one task's work, whatever its length, at about 80 bytes a word and n log n steps; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, TIMES = 24, 3
#: Words of texts that are searched together; a longer text is searched alone.
BATCH_WORDS = 500_000
#: Positions in one list of an ordered set.
CHUNK = 512

Run = tuple[int, int, int]  # start, length, period


class Places:
    """An ordered set of positions, in sorted lists of bounded length."""

    __slots__ = ("chunks", "firsts", "size")

    def __init__(self, place: int) -> None:
        self.chunks, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def neighbours(self, place: int) -> tuple[int, int]:
        """The next lesser and the next greater member of the set, -1 for none."""
        c = max(bisect_left(self.firsts, place + 1) - 1, 0)
        chunk = self.chunks[c]
        at = bisect_left(chunk, place)
        below = chunk[at - 1] if at else (self.chunks[c - 1][-1] if c else -1)
        if at < len(chunk) and chunk[at] == place:
            at += 1
        above = chunk[at] if at < len(chunk) else (self.firsts[c + 1] if c + 1 < len(self.firsts) else -1)
        return below, above

    def add(self, place: int) -> None:
        c = max(bisect_left(self.firsts, place) - 1, 0)
        chunk = self.chunks[c]
        chunk.insert(bisect_left(chunk, place), place)
        self.firsts[c] = chunk[0]
        self.size += 1
        if len(chunk) > 2 * CHUNK:
            self.chunks[c : c + 1] = [chunk[:CHUNK], chunk[CHUNK:]]
            self.firsts.insert(c + 1, chunk[CHUNK])


def shortest_agreement(least: int, times: int) -> int:
    """Words on which two positions of a run agree at least, if they are one period apart."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, rank, n = np.unique(keys, return_inverse=True, return_counts=True)
    return rank.astype(np.int64), n


def repeating(words: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the texts in which some stretch of ``length`` words, or of the next smaller power of two, is repeated.

    ``text``: the number of each word's text, ascending. Positions that are alone at one length are left out of the next.
    """
    rank = np.full(len(words), -1, np.int64)
    at = np.arange(len(words))
    found, n = _dense(text * (words.max(initial=0) + 1) + words)
    width = 1
    while True:
        again = n[found] > 1
        at, found = at[again], found[again]
        if not len(at) or 2 * width > length:
            return np.unique(text[at])
        rank[:] = -1
        rank[at] = found
        keep = at + width < len(words)
        at, found = at[keep], found[keep]
        keep = (rank[at + width] >= 0) & (text[at + width] == text[at])
        at, found = at[keep], found[keep]
        found, n = _dense(found * len(words) + rank[at + width])
        width *= 2


def agreeing(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, common length) of suffixes that are neighbours in suffix order, where at least ``least`` words agree."""
    size = len(words)
    stops = np.searchsorted(text, text, side="right")
    levels = [_dense(text * (words.max(initial=0) + 1) + words)[0]]
    width = 1
    while levels[-1].max(initial=-1) + 1 < size:
        rank, next_ = levels[-1], np.zeros(size, np.int64)
        inside = np.flatnonzero(np.arange(size) + width < stops)
        next_[inside] = rank[inside + width] + 1
        levels.append(_dense(rank * (size + 1) + next_)[0])
        width *= 2
    order = np.argsort(levels[-1])
    a, b = order[:-1], order[1:]
    # Neighbours that agree on the greatest power of two below the least length are few in most texts.
    gate = min(least.bit_length() - 1, len(levels) - 1)
    keep = levels[gate][a] == levels[gate][b]
    a, b = a[keep], b[keep]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        inside = (i < stops[a]) & (j < stops[b])
        equal = np.zeros(len(a), bool)
        equal[inside] = levels[k][i[inside]] == levels[k][j[inside]]
        common[equal] += 1 << k
    keep = common >= least
    return a[keep], b[keep], common[keep]


def runs_of(words: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """Runs of all texts, starts counted over all of their words."""
    floor = shortest_agreement(least, times)
    a, b, common = agreeing(words, text, floor)
    order = np.argsort(-common, kind="stable")
    starts = np.searchsorted(text, text, side="left")
    home: dict[int, Places] = {}
    found: list[Run] = []

    def seed(i: int, j: int, length: int) -> None:
        period = j - i
        if (times - 1) * period <= length and length + period >= least:
            if i == starts[i] or words[i - 1] != words[j - 1]:
                found.append((i, length + period, period))

    for i, j, length in zip(a[order].tolist(), b[order].tolist(), common[order].tolist(), strict=True):
        large, small = home.get(i), home.get(j)
        if large is None:
            large = home[i] = Places(i)
        if small is None:
            small = home[j] = Places(j)
        if large.size < small.size:
            large, small = small, large
        moved = list(small)
        for place in moved:
            large.add(place)
            home[place] = large
        for k, place in enumerate(moved):
            below, above = large.neighbours(place)
            # Neighbours from the same class were neighbours before.
            if below >= 0 and (k == 0 or below != moved[k - 1]):
                seed(below, place, length)
            if above >= 0 and (k + 1 == len(moved) or above != moved[k + 1]):
                seed(place, above, length)
    return found


def _search(texts: list[list[bytes]], least: int, times: int) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    chosen = repeating(words, text, shortest_agreement(least, times))
    if not len(chosen):
        return out
    keep = np.isin(text, chosen)
    words, text = words[keep], text[keep]
    starts = np.searchsorted(text, np.arange(len(texts)))
    for start, length, period in runs_of(words, text, least, times):
        owner = int(text[start])
        out[owner].append((start - int(starts[owner]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: Iterable[Run]) -> bytes:
    """The words without those that a run repeats."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


_FOUND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(text: Column, least: int, times: int) -> Column:
    @F.arrow_udf(_FOUND)
    def of(texts: pa.Array) -> pa.Array:
        sizes, runs, left = [], [], []
        waiting: list[list[bytes]] = []

        def flush() -> None:
            for words, found in zip(waiting, _search(waiting, least, times), strict=True):
                sizes.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                left.append((collapsed(words, found) if found else b" ".join(words)).decode())
            waiting.clear()

        size = 0
        for value in texts:
            # bytes.split() knows the six ASCII characters of white space and no others.
            words = (value.as_py() or "").encode().split()
            if waiting and size + len(words) > BATCH_WORDS:
                flush()
                size = 0
            waiting.append(words)
            size += len(words)
        flush()
        parts = [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(left, pa.string())]
        return pa.StructArray.from_arrays(parts, ["n_words", "runs", "collapsed"])

    return of(text)


def find(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed text."""
    rows = docs.select("doc_id", _found(F.col("text"), least, times).alias("found"))
    return rows.select("doc_id", "found.n_words", "found.runs", "found.collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, compared exactly; of equal ones the first. Null without runs."""
    better = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(r, best), r).otherwise(best))
