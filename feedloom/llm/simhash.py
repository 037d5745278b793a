"""SimHash fingerprints, and near copies by exact comparison of tiles of fingerprints.

A fingerprint's four 16-bit words have four population counts, and together they name its cell: fingerprints that
differ in r bits have cells whose counts differ by r at most, summed over the words. A tile is a bounded part of one
cell. Only pairs of tiles whose counts are within the radius are compared; there, numpy takes the exclusive or of all
fingerprints of one tile with all of the other and counts bits. The tiles of a crowded cell, and those compared with
them, are dealt to several keys, so that no task has all pairs of one cell. Equal fingerprints are one from the start,
and of the links in a task a spanning forest is kept, so that a large group of copies makes as many links as it has
members.

The comparison is exact and quadratic in the number of different fingerprints, at about a twentieth of all pairs.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; fewer words than a shingle
are one shingle; repeated rows are rows of one group; a null id never names a component unless all its ids are null;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, written
from feedloom.llm.graph import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SEED, RADIUS = 3, 42, 3
TILE = 1024
#: Tiles of one cell that are compared under one key, with four times as many of its neighbours.
BLOCK = 16
#: A key with more than this part of all rows is looked up by broadcast.
HOT_KEYS = 1000
WORDS, WORD_BITS = 4, 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed, since Spark has no unsigned numbers."""
    # bytes.split() knows the six ASCII characters of white space and no others.
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(p, seed) for p in parts]), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(text)


def _cell(fp: Column) -> Column:
    """Population counts of the words, five bits apart, so that a step out of range meets no other cell."""
    parts = [
        F.shiftleft(F.bit_count(F.shiftrightunsigned(fp, WORD_BITS * k).bitwiseAND(F.lit((1 << WORD_BITS) - 1))), 5 * k)
        for k in range(WORDS)
    ]
    return sum(parts[1:], parts[0])


def _steps(radius: int) -> list[int]:
    """From a cell to itself and to those of its neighbours that come after it."""
    near = [d for d in product(range(-radius, radius + 1), repeat=WORDS) if sum(map(abs, d)) <= radius]
    codes = {sum(x << 5 * k for k, x in enumerate(d)) for d in near}
    return sorted(c for c in codes if c >= 0)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the least node of their component, for a list of links; nodes that are the least are left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = np.minimum(new, new[label])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            low, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a, b in zip(pairs["a"], pairs["b"], strict=True):
                a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
                for at in range(0, len(a), 256):
                    rows = a[at : at + 256]
                    i, j = np.nonzero(np.bitwise_count((rows[:, None] ^ b[None, :]).view(np.uint64)) <= radius)
                    differ = rows[i] != b[j]
                    if differ.any():
                        node, root = forest(rows[i[differ]], b[j[differ]])
                        low.append(root)
                        high.append(node)
            node, root = forest(np.concatenate(high), np.concatenate(low))
            yield pd.DataFrame({"node": node, "root": root})

    return run


def keyed_pairs(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``fp``, all different. Pairs of tiles (a, b) to compare, with the key (cell, group, salt) where they meet."""
    celled = fingerprints.select("fp", _cell(F.col("fp")).alias("cell"))
    sizes = written(celled.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("chunks")), "cells")
    steps = _steps(radius)
    step = F.explode(F.array(*[F.lit(s) for s in steps]))
    # 17 counts for each of 4 words: never over 83,521 rows.
    tiles = celled.join(F.broadcast(sizes), "cell").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    tiles = written(tiles.groupBy("cell", "chunk").agg(F.collect_list("fp").alias("fps")), "tiles")
    # What is compared in one cell: its own tiles in groups, and those sent to it over salts, so that a key has about
    # a block of each, however many tiles there are.
    near = F.explode(F.array(*[F.col("cell") + s for s in steps]))
    sent = sizes.select(near.alias("cell"), "chunks").groupBy("cell").agg(F.sum("chunks").alias("n"))
    keys = sizes.join(sent, "cell").select(
        "cell", F.ceil(F.col("chunks") / block).alias("groups"), F.ceil(F.col("n") / (4 * block)).alias("salts")
    )
    keys = F.broadcast(written(keys, "cell-keys"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sent = tiles.select(F.col("cell").alias("home"), F.col("chunk").alias("part"), F.col("fps").alias("a"), step.alias("s"))
    sent = sent.withColumn("cell", F.col("home") + F.col("s")).join(keys, "cell")
    sent = sent.withColumn("salt", F.pmod(F.xxhash64("home", "part"), F.col("salts"))).withColumn("group", upto("groups"))
    sent = sent.drop("home", "groups", "salts")
    held = tiles.join(keys, "cell").withColumn("group", F.floor(F.col("chunk") / block)).withColumn("salt", upto("salts"))
    held = held.select("cell", "group", "salt", "chunk", F.col("fps").alias("b"))
    met = sent.join(held, ["cell", "group", "salt"]).where("s != 0 OR part <= chunk")
    return met.select("cell", "group", "salt", "a", "b")


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``fp``, all different. Links (node, root) that join just the fingerprints which a chain of near ones joins."""
    pairs = keyed_pairs(fingerprints, radius, tile, block).select("a", "b")
    return pairs.mapInPandas(_compare(radius), "node bigint, root bigint")


def _looked_up(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """``rows`` with what ``named`` says of their key. ``named`` has each key once, and ``n``, its number of rows.

    Keys that hold more than a thousandth of all rows are less than a thousand, and are broadcast: no task has all rows
    of one.
    """
    total = named.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(named.where(F.col("n") * HOT_KEYS > total))
    cold = rows.join(hot.select(key), key, "left_anti").join(named.where(F.col("n") * HOT_KEYS <= total), key)
    return rows.join(hot, key).unionByName(cold).drop("n")


def _grouped(docs: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of all documents, and (fp, n, root, component_id) of all fingerprints."""
    printed = written(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "fingerprints")
    nodes = written(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "nodes")
    groups = components(links(nodes.select("fp"), radius), "node", "root")
    named = nodes.join(groups, nodes["fp"] == groups["node"], "left")
    named = written(named.select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")), "named")
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "components")
    labels = _looked_up(named, ids, "root").select("fp", F.col("rows").alias("n"), "root", "component_id")
    return printed, written(labels, "labels")


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id."""
    printed, labels = _grouped(docs, radius)
    return _looked_up(printed, labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The document with the least id of each group, with the columns it came with. Rows without id stay."""
    id_, fp, row = free_name(docs, "keeper"), free_name(docs, "fp"), free_name(docs, "row")
    printed, labels = _grouped(docs, radius)
    first = F.count_if(F.col("doc_id") == F.col("component_id"))
    rows = _looked_up(printed, labels, "fp").where("doc_id IS NOT NULL")
    ids = written(rows.groupBy(F.col("doc_id").alias(id_)).agg(F.count("*").alias("n"), first.alias("first")), "keepers")
    # Texts move once, to where their ids are, whatever the size of the table of keepers.
    ids = ids.where("first > 0").hint("merge")
    kept = docs.join(ids.where("n = 1").select(id_), docs["doc_id"] == F.col(id_), "left_semi")
    if not ids.where("n > 1").isEmpty():
        # Several rows of one id may be of several groups, each of which keeps one row.
        again = docs.join(ids.where("n > 1").select(id_), docs["doc_id"] == F.col(id_), "left_semi")
        packed = again.select(
            "doc_id",
            fingerprint_column(F.col("text")).alias(fp),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
            F.xxhash64("text").alias("at"),
        )
        groups = labels.drop("n").withColumnRenamed("fp", "label")
        packed = packed.join(groups, F.col(fp) == F.col("label")).where(F.col("doc_id") == F.col("component_id"))
        one = packed.groupBy("doc_id", "root").agg(F.min_by(row, "at").alias(row))
        kept = kept.unionByName(one.select(*[F.col(row)[c].alias(c) for c in docs.columns]))
    return kept.unionByName(docs.where("doc_id IS NULL"))
