"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

The automaton accepts every run of words of every item. A document's words are streamed through it; after each word
the state and the length of the longest match that ends there are known. A match of a window's length marks its words,
and the state says which items have that window. Where two neighbouring words follow each other in no item, the longest
match is one word, so the stream can start afresh: numpy finds the stretches between such places, and only stretches
long enough for a window are walked word by word.

Items are cut into pieces and dealt to blocks of about a bounded number of words. Each block's automaton is built by a
task and written to the shared folder. A task that scans documents reads the automata one after the other, each for some
megabytes of texts, so that texts are read once and only one automaton is held; the size of a block does not change
results.

Defined cases: null texts have no words; items without words match nothing; an item shorter than a window is one window;
repeated item ids are one item, a null id is the empty one; repeated documents are judged each for itself; empty tables
give no hits or an empty result; other columns stay as they are.
"""

from __future__ import annotations

import pickle
import re
import sys
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, whole
from feedloom.sinks.tables import scratch_dir
from feedloom.sources.documents import open_file

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
#: Words of items in one automaton, of which a task holds one; and the pieces of items that make a block.
BLOCK_WORDS, PIECES = 200_000, 16
#: Characters of texts for which all automata are read in turn.
CHUNK_CHARS = 1 << 24
#: Share of hit words above which a document goes as a whole.
MOST_COVERED = 0.5
# A word is digits, lower-case letters and everything outside of ASCII.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_JAVA_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Automaton:
    """Words are numbers; a transition's key is the state and the word in one number."""

    def __init__(self, items: dict[str, list[list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted(items)
        self.size, self.link, self.go = [0], [-1], {}
        out: list[list[int]] = [[]]  # a state's words, for cloning
        ends: dict[int, list[tuple[int, int]]] = {}
        paths: list[tuple[int, list[int]]] = []
        pairs: set[int] = set()
        shortest = window
        for number, name in enumerate(self.names):
            for text in items[name]:
                word_ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text]
                if not word_ids:
                    continue
                last = 0
                for w in word_ids:
                    last = self._add(last, w, out)
                pairs.update(a << 32 | b for a, b in zip(word_ids, word_ids[1:], strict=False))
                paths.append((number, word_ids))
                shortest = min(shortest, len(word_ids))
        self.shortest = shortest
        self.pairs = np.array(sorted(pairs), np.int64)
        # States are final now: walk every item again for the items of each window and the short items.
        self.full = [-1] * len(self.size)
        for s in range(len(self.size)):
            if self.size[s] >= window:
                t = s
                while self.size[self.link[t]] >= window:
                    t = self.link[t]
                self.full[s] = t
        owners: dict[int, set[int]] = {}
        for number, word_ids in paths:
            s = 0
            for i, w in enumerate(word_ids):
                s = self.go[s << 32 | w]
                if i + 1 >= window:
                    owners.setdefault(self.full[s], set()).add(number)
            if len(word_ids) < window:
                ends.setdefault(s, []).append((len(word_ids), number))
        self.owners = {s: tuple(sorted(o)) for s, o in owners.items()}
        # Short items that end in a state or in one of its suffixes.
        self.ends: dict[int, list[tuple[int, int]]] = {}
        if ends:
            for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
                found = ends.get(s, []) + self.ends.get(self.link[s], [])
                if found:
                    self.ends[s] = found

    def _add(self, last: int, w: int, out: list[list[int]]) -> int:
        size, link, go = self.size, self.link, self.go
        q = go.get(last << 32 | w)
        if q is not None:
            return q if size[q] == size[last] + 1 else self._clone(last, q, w, out)
        new = len(size)
        size.append(size[last] + 1)
        link.append(0)
        out.append([])
        p = last
        while p != -1 and (p << 32 | w) not in go:
            go[p << 32 | w] = new
            out[p].append(w)
            p = link[p]
        if p != -1:
            q = go[p << 32 | w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, q, w, out)
        return new

    def _clone(self, p: int, q: int, w: int, out: list[list[int]]) -> int:
        size, link, go = self.size, self.link, self.go
        copy = len(size)
        size.append(size[p] + 1)
        link.append(link[q])
        out.append(list(out[q]))
        for x in out[q]:
            go[copy << 32 | x] = go[q << 32 | x]
        while p != -1 and go.get(p << 32 | w) == q:
            go[p << 32 | w] = copy
            p = link[p]
        link[q] = copy
        return copy

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where a match may be: stretches of known words that all follow each other in some item."""
        known = ids >= 0
        follows = np.zeros(len(ids), bool)  # a word with the one before it
        at = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(at) and len(self.pairs):
            keys = ids[at - 1] << 32 | ids[at]
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            follows[at] = self.pairs[place] == keys
        starts = np.flatnonzero(known & ~follows)
        stops = np.flatnonzero(known & ~np.append(follows[1:], False)) + 1
        long_enough = stops - starts >= self.shortest
        return list(zip(starts[long_enough].tolist(), stops[long_enough].tolist(), strict=True))

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of hit words, joined where they touch, and the numbers of the items."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if len(words) < self.shortest:
            return spans, items
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        size, link, go, window = self.size, self.link, self.go, self.window

        def mark(start: int, stop: int) -> None:
            while spans and start <= spans[-1][1]:
                start = min(start, spans.pop()[0])
            spans.append((start, stop))

        for start, stop in self.stretches(ids):
            state = length = 0
            for i, w in enumerate(ids[start:stop].tolist(), start):
                while state and (state << 32 | w) not in go:
                    state = link[state]
                    length = size[state]
                state = go.get(state << 32 | w, 0)
                length = length + 1 if state else 0
                if length >= window:
                    mark(i + 1 - window, i + 1)
                    items.update(self.owners[self.full[state]])
                if state in self.ends:
                    for n, item in self.ends[state]:
                        if n <= length:
                            mark(i + 1 - n, i + 1)
                            items.add(item)
        return spans, items


class Automata:
    """The automata of all blocks, as files in the shared folder. A task holds one of them at a time."""

    def __init__(self, files: list[str], blocks: int) -> None:
        self.files, self.blocks = files, blocks
        self.only: Automaton | None = None

    def __len__(self) -> int:
        return self.blocks

    def __iter__(self) -> Iterator[Automaton]:
        for file in self.files:
            found = self.only or self._read(file)
            if len(self.files) == 1:
                self.only = found
            yield found

    @staticmethod
    def _read(file: str) -> Automaton:
        from pyarrow import parquet

        with ExitStack() as stack:
            packed = parquet.ParquetFile(open_file(file, stack)).read(["packed"])
        found = Automaton.__new__(Automaton)
        found.__dict__.update(pickle.loads(packed["packed"][0].as_py()))
        return found

    def chunks(self, texts: list[str | None]) -> Iterator[range]:
        """Where one automaton is all there is, texts are looked at one by one, else as many as a task may hold."""
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if len(self.files) <= 1 or size >= CHUNK_CHARS:
                yield range(start, i + 1)
                start, size = i + 1, 0
        if start < len(texts):
            yield range(start, len(texts))

    def hits(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Spans of hit words and names of items of each text, by all automata."""
        found: list[tuple[list, set[str]]] = [([], set()) for _ in texts]
        for automaton in self:
            for (spans, names), words in zip(found, texts, strict=True):
                here, items = automaton.hits(words)
                spans += here
                names.update(automaton.names[i] for i in items)
        return [(joined(spans), names) for spans, names in found]

    def cleaned(self, texts: list[str | None], most_covered: float) -> None:
        """Texts without hit spans, in place; null if too much is hit. A seam may make a new match: look again."""
        live = range(len(texts))
        while len(live):
            words = [split_words(texts[i]) for i in live]
            cut = []
            for i, w, (spans, _) in zip(live, words, self.hits(words), strict=True):
                if spans:
                    texts[i] = without(texts[i], len(w), spans, most_covered)
                    if texts[i] is not None:
                        cut.append(i)
            live = cut


_LOWER = {c: c + 32 for c in range(65, 91)}


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of several automata in order, joined where they touch."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            start, stop = out[-1][0], max(out.pop()[1], stop)
        out.append((start, stop))
    return out


def without(text: str, n_words: int, spans: list[tuple[int, int]], most_covered: float) -> str | None:
    """The text without spans of its words; null if they cover too much of it."""
    if sum(b - a for a, b in spans) > most_covered * n_words:
        return None
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "\n".join([*parts, text[at:]])


def _pieces(window: int, most: int):
    """Texts of items in pieces of bounded length; neighbours overlap, so that every window is in a piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch["id"], batch["t"], strict=True):
                words = split_words(text)
                starts = range(0, max(1, len(words) - window + 1), most - window + 1) if words else ()
                rows = [(name, b" ".join(words[at : at + most]).decode()) for at in starts]
                yield pd.DataFrame(rows, columns=["id", "words"])

    return run


def _packed(window: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        grouped: dict[str, list[list[bytes]]] = {}
        for name, words in sorted(zip(pieces["id"], pieces["words"], strict=True)):
            grouped.setdefault(name, []).append(split_words(words))
        packed = pickle.dumps(vars(Automaton(grouped, window)), pickle.HIGHEST_PROTOCOL)
        return pd.DataFrame({"block": pieces["block"].iloc[:1], "packed": [packed]})

    return run


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Automata:
    """One automaton per block of items. Each is built by a task; the driver learns the files' names only."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), whole("text").alias("t"))
    total = items.agg(F.sum(F.size(F.split("t", _JAVA_NOT_WORD)))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    # A block is a share of many small pieces, so that neither a long item nor chance makes it much larger than others.
    most = max(2 * window, block_words // PIECES)
    pieces = items.mapInPandas(_pieces(window, most), "id string, words string").distinct()
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("id", "words"), F.lit(blocks)))
    location = scratch_dir(spark, "automata")
    built = pieces.groupBy("block").applyInPandas(_packed(window), "block bigint, packed binary")
    built.write.option("maxRecordsPerFile", 1).parquet(location)
    rows = spark.read.schema(built.schema).parquet(location)
    files = rows.select("block", F.col("_metadata.file_path").alias("file")).orderBy("block").collect()
    return Automata([r["file"] for r in files], blocks)


def _hits_udf(found: Automata):
    @F.pandas_udf("n_words bigint, n_hit bigint, items array<string>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows, values = [], texts.tolist()
        for chunk in found.chunks(values):
            words = [split_words(values[i]) for i in chunk]
            for w, (spans, names) in zip(words, found.hits(words), strict=True):
                rows.append((len(w), sum(b - a for a, b in spans), sorted(names)))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items"])

    return of


def _cleaned_udf(found: Automata, most_covered: float):
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        rows, values = [], [t or "" for t in texts]
        for chunk in found.chunks(values):
            part = values[chunk.start : chunk.stop]
            found.cleaned(part, most_covered)
            rows += part
        return pd.Series(rows, dtype=object)

    return of


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted). Texts are read once, whatever the benchmark's size."""
    of = _hits_udf(automata(benchmark, window, block_words))
    return docs.select("doc_id", of(F.col("text")).alias("f")).select("doc_id", "f.n_words", "f.n_hit", "f.items")


def _replaced(docs: DataFrame, text: Column) -> DataFrame:
    """The documents with new texts, without those whose new text is null; nulls stay, ``n_chars`` follows."""
    now = free_name(docs, "cleaned")
    rows = docs.withColumn(now, text).where(F.col(now).isNotNull())
    changed = F.col("text").isNotNull() & (F.col(now) != F.col("text"))
    new = {"text": F.when(F.col("text").isNotNull(), F.col(now))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(now)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_covered: float = MOST_COVERED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without their hit spans, and without those of which too much is hit; a column ``n_chars`` follows.

    Several blocks look at the same texts, which are judged and cut by all their spans at once. What was cut is looked
    at again by every block, as a seam may make a match of any of them.
    """
    found = automata(benchmark, window, block_words)
    return _replaced(docs, _cleaned_udf(found, most_covered)(F.col("text")))
