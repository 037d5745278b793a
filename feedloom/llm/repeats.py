"""Removal of passages that occur in an earlier document, by windows that grow from level to level.

The levels' lengths halve from the window down to the seed: 7 and 13 words for a window of 13; 7, 13, 25 and 50 for one
of 50. A window can only be repeated if both of its halves are: only what is repeated at one length is looked at again
at the next, which is at most twice as long, until the last length or until nothing survives. At the first level not
every seed is looked at: of the seeds in a window the one with the least hash speaks for it, and equal windows have
equal speakers.

A level is a question and an answer. Tasks put the hashes of their windows into buckets, one entry per hash, after
settling between their own documents what they can; a bucket's task finds the hashes that several documents have, or of
which a document with a lesser id has one, and answers with the places. A window that is in a third of all documents is
thus one entry per task. Seeds are 64-bit hashes, where a collision only means another look. Windows are told apart by
64 bits beside the bucket, which is chosen by 64 other bits: buckets grow in number with the data, and so the bits do.
Answers go to groups of documents, packed, and are unpacked there. Texts travel compressed.

Defined cases: null texts have no words; texts shorter than a window stay; a null id is neither earlier nor later than
others, such rows stay as they are; rows of one id are not earlier than each other; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import shuffle_parts, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SEED = 13, 7
#: Windows that a task settles between its own documents before it asks.
CHUNK = 1_000_000
_ROWS_AT_ONCE = 10_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def lengths(window: int, seed: int = SEED) -> list[int]:
    """From the seed's length to the window's; each at most twice the one before."""
    out = [window]
    while out[0] > seed:
        out.insert(0, -(-out[0] // 2))
    return out


def split_words(text: str | None) -> list[bytes]:
    # bytes.split() knows the six ASCII characters of white space and no others.
    return (text or "").encode().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def speakers(words: list[bytes], seed: int, reach: int) -> np.ndarray:
    """For each window of ``reach`` words the least hash of its seeds."""
    if len(words) < reach:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    n = len(h) - seed + 1
    grams = h[:n].copy()
    for k in range(1, seed):
        grams = grams * _MULTIPLIER + h[k : k + n]
    grams = _mixed(grams)
    span = reach - seed + 1  # seeds in a window
    least, width = grams, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def window_hashes(words: list[bytes], places: np.ndarray, length: int) -> bytes:
    """128 bits for each window of that length that begins at one of the places."""
    text = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = stops - sizes
    cuts = zip(starts[places].tolist(), stops[places + length - 1].tolist(), strict=True)
    digest = xxhash.xxh3_128_digest
    return b"".join([digest(text[a:b]) for a, b in cuts])


def _bytes_of(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    n = len(keys[0])
    if not n:
        return []
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))
    start = np.flatnonzero(new)
    return list(zip(start.tolist(), np.append(start[1:], n).tolist(), strict=True))


def _planes(places: np.ndarray) -> bytes:
    """Low halves, then high halves: these are nearly all zero, and the shuffle's compression takes them away."""
    return _bytes_of(places.astype(np.int32).view(np.uint16).reshape(-1, 2).T)


def _places(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint16).reshape(2, -1).T).view(np.int32).ravel()


# ---------------------------------------------------------------------------------------------- the first level: seeds

# ``part`` is a bucket, or with ``known`` the group of the documents that are answered already.
_ASKED_SEEDS = "part int, known boolean, docs binary, counts binary, hashes binary"
_TOLD_SEEDS = "part int, docs binary, counts binary, hashes binary"


def _counted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and lengths of runs of equal keys."""
    runs = np.array(_runs(*keys), np.int64).reshape(-1, 2)
    return runs[:, 0], (runs[:, 1] - runs[:, 0]).astype(np.int32)


def _ask_seeds(seed: int, reach: int, parts: int):
    def settle(docs: list[int], seeds: list[np.ndarray]) -> pd.DataFrame:
        """Seeds of several documents are known here to be repeated; one entry for each seed asks about the others."""
        doc = np.repeat(np.array(docs, np.int64), [len(s) for s in seeds])
        h = np.concatenate(seeds)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        first = np.append(True, h[1:] != h[:-1])
        run = np.cumsum(first) - 1
        start = np.flatnonzero(first)
        stop = np.append(start[1:], len(h))
        many = doc[start] != doc[stop - 1]
        rows: list[tuple] = []
        known = many[run]
        d, k = doc[known], h[known]
        by = np.lexsort((d, d % parts))
        d, k = d[by], k[by]
        for a, b in _runs(d % parts):
            at, n = _counted(d[a:b])
            rows.append((int(d[a] % parts), True, _bytes_of(d[a:b][at]), _bytes_of(n), _bytes_of(k[a:b])))
        # A repeated seed asks with two documents, so that the other tasks' documents hear of it.
        ask = np.concatenate([start, stop[many] - 1])
        h, doc = h[ask], doc[ask]
        part = (h >> np.uint64(32)) % np.uint64(parts)
        by = np.lexsort((doc, part))
        h, doc, part = h[by], doc[by], part[by]
        for a, b in _runs(part):
            rows.append((int(part[a]), False, _bytes_of(doc[a:b]), None, _bytes_of(h[a:b])))
        return pd.DataFrame(rows, columns=["part", "known", "docs", "counts", "hashes"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, seeds, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = np.unique(speakers(split_words(text), seed, reach))
                if len(found):
                    docs.append(doc)
                    seeds.append(found)
                    size += len(found)
                if size >= CHUNK:
                    yield settle(docs, seeds)
                    docs, seeds, size = [], [], 0
        if size:
            yield settle(docs, seeds)

    return run


def _answer_seeds(parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, docs = [], []
        for batch in batches:
            known = batch["known"]
            if known.any():
                yield batch.loc[known, ["part", "docs", "counts", "hashes"]]
            hashes += [np.frombuffer(b, np.uint64) for b in batch.loc[~known, "hashes"]]
            docs += [np.frombuffer(b, np.int64) for b in batch.loc[~known, "docs"]]
        if not hashes:
            return
        h, doc = np.concatenate(hashes), np.concatenate(docs)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        start, n = _counted(h)
        told = np.repeat(doc[start] != doc[start + n - 1], n)
        h, doc = h[told], doc[told]
        by = np.lexsort((doc, doc % parts))
        h, doc = h[by], doc[by]
        rows = []
        for a, b in _runs(doc % parts):
            at, n = _counted(doc[a:b])
            rows.append((int(doc[a] % parts), _bytes_of(doc[a:b][at]), _bytes_of(n), _bytes_of(h[a:b])))
        yield pd.DataFrame(rows, columns=["part", "docs", "counts", "hashes"])

    return run


def _gather_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All answers to a document in one row."""
    docs, hashes = [], []
    for batch in batches:
        for row in batch.itertuples(index=False):
            docs.append(np.repeat(np.frombuffer(row.docs, np.int64), np.frombuffer(row.counts, np.int32)))
            hashes.append(np.frombuffer(row.hashes, np.uint64))
    if not docs:
        return
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    by = np.argsort(doc, kind="stable")
    doc, h = doc[by], h[by]
    runs = _runs(doc)
    for at in range(0, len(runs), _ROWS_AT_ONCE):
        part = runs[at : at + _ROWS_AT_ONCE]
        yield pd.DataFrame({"of": doc[[a for a, _ in part]], "hashes": [_bytes_of(h[a:b]) for a, b in part]})


# --------------------------------------------------------------------------------------------- further levels: windows

_ROWS = "doc_id bigint, tag bigint, n_words bigint, kept_sha256 string, text binary, places binary"
_ASKED = "part int, known boolean, docs binary, tags binary, counts binary, hashes binary, places binary"
_TOLD = "part int, docs binary, tags binary, counts binary, places binary"


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        batch["text"] = [None if t is None else pack(t.encode()) for t in batch["text"]]
        yield batch


def _as_they_are(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words = [split_words(t) for t in batch["text"]]
        yield pd.DataFrame({"n_words": [len(w) for w in words], "kept_sha256": [_sha(w) for w in words]})


def _unpack(text: bytes | None) -> str:
    return "" if text is None else zstandard.ZstdDecompressor().decompress(text).decode()


def _tag(text: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode()), "big", signed=True)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _candidates(seed: int, reach: int, window: int):
    """Rows whose windows of ``reach`` words have a repeated speaker keep their text and places; others are done."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, packed, known in zip(batch["doc_id"], batch["text"], batch["hashes"], strict=True):
                text = _unpack(packed)
                words = split_words(text)
                places = np.empty(0, np.int64)
                if known is not None and len(words) >= window:
                    places = np.flatnonzero(np.isin(speakers(words, seed, reach), np.frombuffer(known, np.uint64)))
                if len(places):
                    rows.append((doc, _tag(text), len(words), None, packed, _bytes_of(places.astype(np.int32))))
                else:
                    rows.append((doc, 0, len(words), _sha(words), None, None))
            frame = pd.DataFrame(rows, columns=["doc_id", "tag", "n_words", "kept_sha256", "text", "places"])
            yield frame.astype({"tag": "int64"})

    return run


def _halves(places: np.ndarray, before: int, length: int) -> np.ndarray:
    """Where windows of ``length`` begin whose first and last ``before`` words are repeated."""
    return places if before == length else places[np.isin(places + (length - before), places)]


def _ask(before: int, length: int, last: bool, parts: int):
    def settle(docs: list[int], tags: list[int], hashes: list[bytes], places: list[np.ndarray]) -> pd.DataFrame:
        counts = [len(p) for p in places]
        owner = np.repeat(np.arange(len(docs)), counts)
        doc, tag = np.array(docs, np.int64), np.array(tags, np.int64)
        h = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)
        place = np.concatenate(places).astype(np.int32)
        order = np.lexsort((place, owner, doc[owner], h[:, 1], h[:, 0]))
        h, owner, place = h[order], owner[order], place[order]
        d = doc[owner]
        first = np.append(True, (h[1:] != h[:-1]).any(axis=1))
        run, start = np.cumsum(first) - 1, np.flatnonzero(first)
        stop = np.append(start[1:], len(h))
        least = d[start][run]
        several = (d[stop - 1] != d[start])[run]
        # Who is told without asking: at the last level all but the first document, before it all of several.
        known = d != least if last else several
        ask = d == least
        rows: list[tuple] = []
        by = np.flatnonzero(known)
        by = by[np.lexsort((place[by], owner[by], d[by] % parts))]
        for a, b in _runs(d[by] % parts):
            at, n = _counted(owner[by[a:b]])
            mine = owner[by[a:b]][at]
            rows.append((
                int(doc[mine[0]] % parts), True, _bytes_of(doc[mine]), _bytes_of(tag[mine]), _bytes_of(n), None,
                _planes(place[by[a:b]]),
            ))
        if not last:  # the greatest document as well, so that the bucket knows of several
            ask |= several & (d == d[stop - 1][run])
        part = (h[:, 0] % np.uint64(parts)).astype(np.int64)
        by = np.flatnonzero(ask)
        by = by[np.lexsort((owner[by], part[by]))]
        p, o = part[by], owner[by]
        for a, b in _runs(p):
            mine, n = np.unique(o[a:b], return_counts=True)
            rows.append((
                int(p[a]), False, _bytes_of(doc[mine]), _bytes_of(tag[mine]), _bytes_of(n.astype(np.int32)),
                _bytes_of(h[by[a:b], 1]), _planes(place[by[a:b]]),
            ))
        return pd.DataFrame(rows, columns=["part", "known", "docs", "tags", "counts", "hashes", "places"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple = ([], [], [], [])
        size = 0
        for batch in batches:
            for doc, tag, text, found in zip(batch["doc_id"], batch["tag"], batch["text"], batch["places"], strict=True):
                places = _halves(np.frombuffer(found, np.int32).astype(np.int64), before, length)
                words = split_words(_unpack(text))
                places = places[places + length <= len(words)]
                if len(places):
                    for x, y in zip(held, (doc, tag, window_hashes(words, places, length), places), strict=True):
                        x.append(y)
                    size += len(places)
                if size >= CHUNK:
                    yield settle(*held)
                    held, size = ([], [], [], []), 0
        if size:
            yield settle(*held)

    return run


def _answer(last: bool, groups: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, docs, tags, hashes, places = [], [], [], [], []
        for batch in batches:
            known = batch["known"]
            if known.any():
                yield batch.loc[known, ["part", "docs", "tags", "counts", "places"]]
            for row in batch[~known].itertuples(index=False):
                n = np.frombuffer(row.counts, np.int32)
                docs.append(np.repeat(np.frombuffer(row.docs, np.int64), n))
                tags.append(np.repeat(np.frombuffer(row.tags, np.int64), n))
                hashes.append(np.frombuffer(row.hashes, np.uint64))
                places.append(_places(row.places))
                parts.append(np.full(len(hashes[-1]), row.part, np.int32))
        if not docs:
            return
        part, doc, tag, h, place = map(np.concatenate, (parts, docs, tags, hashes, places))
        order = np.lexsort((doc, h, part))
        part, doc, tag, h, place = part[order], doc[order], tag[order], h[order], place[order]
        first = np.append(True, (h[1:] != h[:-1]) | (part[1:] != part[:-1]))
        run_, start = np.cumsum(first) - 1, np.flatnonzero(first)
        stop = np.append(start[1:], len(doc))
        told = doc != doc[start][run_] if last else (doc[stop - 1] != doc[start])[run_]
        doc, tag, place = doc[told], tag[told], place[told]
        order = np.lexsort((place, tag, doc, doc % groups))
        doc, tag, place = doc[order], tag[order], place[order]
        rows = []
        for a, b in _runs(doc % groups):
            at, n = _counted(doc[a:b], tag[a:b])
            rows.append((
                int(doc[a] % groups), _bytes_of(doc[a:b][at]), _bytes_of(tag[a:b][at]), _bytes_of(n), _planes(place[a:b]),
            ))
        yield pd.DataFrame(rows, columns=["part", "docs", "tags", "counts", "places"])

    return run


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All answers to a text in one row."""
    docs, tags, places = [], [], []
    for batch in batches:
        for row in batch.itertuples(index=False):
            n = np.frombuffer(row.counts, np.int32)
            docs.append(np.repeat(np.frombuffer(row.docs, np.int64), n))
            tags.append(np.repeat(np.frombuffer(row.tags, np.int64), n))
            places.append(_places(row.places))
    if not docs:
        return
    doc, tag, place = map(np.concatenate, (docs, tags, places))
    order = np.lexsort((place, tag, doc))
    doc, tag, place = doc[order], tag[order], place[order]
    runs = _runs(doc, tag)
    for at in range(0, len(runs), _ROWS_AT_ONCE):
        part = runs[at : at + _ROWS_AT_ONCE]
        heads = [a for a, _ in part]
        yield pd.DataFrame({"of": doc[heads], "of_tag": tag[heads], "found": [_bytes_of(place[a:b]) for a, b in part]})


def _surviving(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with the places of the answers instead of their own."""
    for batch in batches:
        batch["places"] = [_bytes_of(np.unique(np.frombuffer(found, np.int32))) for found in batch["found"]]
        yield batch.drop(columns="found")


def _removed(window: int):
    """What is left of a text without the words of the windows at the places of the answers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, found in zip(batch["doc_id"], batch["text"], batch["found"], strict=True):
                words = split_words(_unpack(text))
                gone = np.zeros(len(words) + 1, np.int64)
                if found is not None:
                    at = np.frombuffer(found, np.int32)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone)[: len(words)] > 0
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                rows.append((doc, len(words), int(gone.sum()), _sha(kept), b" ".join(kept).decode()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def _question(rows: DataFrame, ask, asked: str, answer, told: str, gather, answers: str) -> DataFrame:
    """Hashes to their buckets, answers to their groups of documents; one row per document comes out."""
    parts = shuffle_parts(rows.sparkSession)
    replies = rows.mapInPandas(ask(parts), asked).repartition(parts, "part").mapInPandas(answer(parts), told)
    # Texts are joined with answers by sorting, whatever the number of answers.
    return replies.repartition(parts, "part").mapInPandas(gather, answers).hint("merge")


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (the words left; null if none can go)."""
    levels = lengths(window, seed)
    first, reach = levels[0], levels[1] if len(levels) > 1 else levels[0]
    everything = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = everything.where("doc_id IS NOT NULL")
    known = _question(
        texts, lambda p: _ask_seeds(first, reach, p), _ASKED_SEEDS, _answer_seeds, _TOLD_SEEDS,
        _gather_seeds, "of bigint, hashes binary",
    )
    packed = texts.mapInPandas(_pack, "doc_id bigint, text binary")
    joined = packed.join(known, F.col("doc_id") == F.col("of"), "left").select("doc_id", "text", "hashes")
    rows = written(joined.mapInPandas(_candidates(first, reach, window), _ROWS), "repeats")
    live = rows.where("places IS NOT NULL")
    before = reach  # the length at which ``places`` are windows that may be repeated
    same = (F.col("doc_id") == F.col("of")) & (F.col("tag") == F.col("of_tag"))
    found = None
    for length in levels[1:] or levels:
        last = length == window
        found = _question(
            live, lambda p, b=before, n=length, z=last: _ask(b, n, z, p), _ASKED, lambda p, z=last: _answer(z, p), _TOLD,
            _gather, "of bigint, of_tag bigint, found binary",
        )
        if last:
            break
        survivors = live.join(found, same).drop("of", "of_tag")
        survivors = written(survivors.mapInPandas(_surviving, _ROWS), f"repeats-{length}")
        live, before = survivors, length
        if survivors.isEmpty():
            found = None
            break
    nameless = everything.where("doc_id IS NULL").select("text").mapInPandas(_as_they_are, "n_words bigint, kept_sha256 string")
    nameless = nameless.withColumn("doc_id", F.lit(None).cast("bigint"))
    columns = ("doc_id", "n_words", "kept_sha256")
    done = rows.where("places IS NULL").select(*columns).unionByName(nameless).select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept")
    )
    rest = rows.where("places IS NOT NULL")
    rest = rest.withColumn("found", F.lit(None).cast("binary")) if found is None else rest.join(found, same, "left")
    rest = rest.select("doc_id", "text", "found")
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    return done.unionByName(rest.mapInPandas(_removed(window), out))
