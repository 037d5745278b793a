"""Near copies among embeddings, by a forest of random-projection trees.

A node of a tree splits its vectors along a random direction. The place of the split is drawn among the middle quantiles
of a sample, near the one that the fewest vectors are close to; vectors closer than a margin go to both sides (spill), so
that a near pair is rarely parted, and a pair that one tree parts meets in another. In a leaf all pairs are compared:
numpy multiplies the leaf with itself in single precision, and what comes near the threshold is verified in double
precision. Pairs from all trees are united once, links are counted, and components named by their least id.

Equal vectors are one vector from the start, with a weight. Splitting goes in rounds: trees of up to ``DEPTH`` levels are
fitted to a bounded sample of what they split, first of all vectors, then of each leaf that is still too large, until
every leaf is small or does not get smaller. A leaf that stays large, since it is a crowd of near copies, is compared in
tiles that go to different tasks; so no leaf is cut short, and a task holds two tiles.

What is lost: pairs that every tree parts. README has the measured recall.

Bounds (parameters): ``SAMPLE`` vectors fit one tree of a round; the first forest is broadcast, with ``TREES`` times
2^``DEPTH`` directions; a direction that would send more than ``SPILL`` of the sample both ways is not used.

Defined cases: a vector that is null or empty, has only zeros or holds a null or a value that is not finite has no links;
vectors of different lengths never link; equal vectors always do; a null id never names a component unless all its ids
are null, and its row is not kept; rows with one id are rows of their own; an empty table gives an empty result; other
columns are not looked at. Very long texts do not occur here; very long vectors only cost memory in proportion.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BROADCAST_ROWS, written
from feedloom.llm.graph import components
from feedloom.llm.simhash import forest as spanning_forest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.95
TREES, LEAF, SAMPLE, DEPTH = 6, 1024, 8192, 9
#: Half the width of the zone that goes to both sides, by the spread of the distance of a pair at the threshold.
MARGIN = 0.25
#: Most of a node's sample that may go both ways; directions that are tried; least sample of a leaf.
SPILL, TRIES, LEAST = 0.3, 4, 16
SEED = 11
#: Fewer keys than this, those with more than this part of all rows, are broadcast.
HOT_KEYS = 1000
#: A leaf that keeps more than this share of its parent's vectors is not split again.
STUCK = 0.9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one. The largest part is divided out first, so that squares neither overflow nor vanish."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, depth: int, margin: float, seed: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(cuts, directions) of the inner nodes of a tree, numbered as in a heap; a cut that is no number is a leaf."""
    nodes = (1 << depth) - 1
    cuts, directions = np.full(nodes, np.nan), np.zeros((nodes, sample.shape[1]), np.float32)
    random = np.random.default_rng([x % (1 << 32) for x in seed])
    inside = {0: np.arange(len(sample))}
    for node in range(nodes):
        at = inside.pop(node, None)
        if at is None or len(at) < 2 * LEAST:
            continue
        best = SPILL
        for _ in range(TRIES):
            way = random.normal(size=sample.shape[1])
            way = (way / np.linalg.norm(way)).astype(np.float32)
            placed = np.sort(sample[at] @ way)
            tried = np.quantile(placed, random.uniform(0.35, 0.65, size=5))
            close = np.searchsorted(placed, tried + margin) - np.searchsorted(placed, tried - margin)
            if close.min() / len(at) <= best:
                best = close.min() / len(at)
                cuts[node], directions[node] = tried[close.argmin()], way
        if np.isnan(cuts[node]):
            continue
        placed = sample[at] @ directions[node]
        for child, goes in ((2 * node + 1, placed <= cuts[node] + margin), (2 * node + 2, placed > cuts[node] - margin)):
            if child < nodes:
                inside[child] = at[goes]
    return cuts, directions


def leaves(tree: tuple[np.ndarray, np.ndarray], vectors: np.ndarray, margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows in it) of the leaves that get rows; a row may be in several."""
    cuts, directions = tree
    open_ = [(0, np.arange(len(vectors)))]
    while open_:
        node, at = open_.pop()
        if not len(at):
            continue
        if node >= len(cuts) or np.isnan(cuts[node]):
            yield node, at
            continue
        placed = vectors[at] @ directions[node]
        open_.append((2 * node + 1, at[placed <= cuts[node] + margin]))
        open_.append((2 * node + 2, at[placed > cuts[node] - margin]))


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b of pairs with at least this cosine; within one list each pair once."""
    rows, columns = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    fine = unit(b)
    coarse = fine.astype(np.float32)
    for at in range(0, len(a), 512):
        left = unit(a[at : at + 512])
        i, j = np.nonzero(left.astype(np.float32) @ coarse.T >= threshold - 1e-4)
        if same:
            i, j = i[i + at < j], j[i + at < j]
        for part in range(0, len(i), 1 << 16):
            x, y = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
            near = np.einsum("ij,ij->i", left[x], fine[y]) >= threshold
            rows.append(x[near] + at)
            columns.append(y[near])
    return np.concatenate(rows), np.concatenate(columns)


def _mixed(leaf: int, node: int) -> int:
    """A number for a leaf of a leaf. Two leaves with one number are compared together, which only costs time."""
    x = (leaf * 0x9E3779B97F4A7C15 + node + 1) % (1 << 64)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % (1 << 64)
    return (x ^ (x >> 31)) - (1 << 63)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _margin(threshold: float, width: int) -> float:
    return MARGIN * float(np.sqrt(max(2 - 2 * threshold, 0) / width))


_ROUTED = "leaf bigint, width int, node bigint, copies bigint, was bigint, vec "


def _routed(batch: pa.Table, models: dict[int, list], width: int, threshold: float, was: int | None) -> pa.Table:
    """Rows of one width, once for each leaf they fall in. ``models``: leaf -> tree, or -1 -> the trees of the root."""
    raw = _matrix(batch["vec"], width)
    vectors = unit(raw)
    picked, named = [], []
    for leaf, tree in models.items():
        for node, at in leaves(tree, vectors, _margin(threshold, width)):
            picked.append(at)
            named.append(np.full(len(at), _mixed(leaf, node), np.int64))
    at = pa.array(np.concatenate(picked))
    out = batch.select(["node", "copies", "vec"]).take(at)
    n = len(at)
    return pa.table(
        {
            "leaf": pa.array(np.concatenate(named)),
            "width": pa.array(np.full(n, width, np.int32)),
            "node": out["node"],
            "copies": out["copies"],
            "was": pa.array(np.full(n, was, np.int64)),
            "vec": out["vec"],
        }
    )


_MODEL = "leaf bigint, width int, tree binary"


def _fitted(threshold: float, per_leaf: int, sampled: int, depth: int):
    """A tree for the sample of each leaf, with as many levels as bring it down to ``per_leaf`` rows."""

    def run(batch: pa.Table) -> pa.Table:
        leaf, width, was = (batch[c][0].as_py() for c in ("leaf", "width", "n"))
        batch = batch.sort_by("node")
        levels = min(depth, max(1, int(np.ceil(np.log2(max(was / per_leaf, 2))))))
        tree = fit(unit(_matrix(batch["vec"], width)), levels, _margin(threshold, width), (SEED, leaf, width))
        return pa.table({"leaf": [leaf], "width": pa.array([width], pa.int32()), "tree": [pickle.dumps(tree)]})

    return run


def _split_again(rows: DataFrame, sizes: DataFrame, threshold: float, leaf: int, sample: int, depth: int) -> DataFrame:
    """Rows of leaves that are too large, in the leaves of trees fitted to a sample of each of them."""
    key = ["leaf", "width"]
    if sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    counted = rows.join(sizes, key)
    share = F.pmod(F.xxhash64("node", "leaf"), F.lit(1 << 30)) / float(1 << 30)
    drawn = counted.where(share < sample / F.col("n")).select(*key, "n", "node", "vec")
    models = drawn.groupBy(*key).applyInArrow(_fitted(threshold, leaf, sample, depth), _MODEL)
    models = written(models, "trees")
    # A leaf's rows are shared by tasks, each of which gets the leaf's tree.
    parts = F.greatest(F.ceil(F.col("n") / sample), F.lit(1)).cast("bigint")
    salted = models.hint("merge").join(sizes, key, "right").select(*key, "tree", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
    counted = counted.withColumn("part", F.pmod(F.xxhash64("node"), parts))

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        width, name, was = left["width"][0].as_py(), left["leaf"][0].as_py(), left["n"][0].as_py()
        tree = right["tree"][0].as_py()
        tree = pickle.loads(tree) if tree else (np.empty(0), np.empty((0, width), np.float32))
        return _routed(left, {name: tree}, width, threshold, was)

    kind = rows.schema["vec"].dataType.simpleString()
    keys = [*key, "part"]
    return counted.groupBy(*keys).cogroup(salted.groupBy(*keys)).applyInArrow(route, _ROUTED + kind)


def planted(
    vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, depth: int = DEPTH
) -> DataFrame:
    """``node``, ``copies``, ``width``, ``vec`` of different vectors -> the same for each leaf they are in, with the
    leaf's name and its size ``n``."""
    kind = vectors.schema["vec"].dataType.simpleString()
    total = vectors.count()
    first = vectors.orderBy(F.xxhash64("node"), "node").limit(sample).toArrow()
    by_width: dict[int, list] = {}
    levels = min(depth, max(0, int(np.ceil(np.log2(max(total / leaf, 1))))))
    for width in sorted(set(first["width"].to_pylist())):
        here = first.filter(pa.array(np.asarray(first["width"]) == width))
        points = unit(_matrix(here["vec"], width))
        by_width[width] = [fit(points, levels, _margin(threshold, width), (SEED, t, width)) for t in range(trees)]
    shared = vectors.sparkSession.sparkContext.broadcast(by_width)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for width in sorted(set(table["width"].to_pylist())):
                here = table.filter(pa.array(np.asarray(table["width"]) == width))
                none = (np.empty(0), np.empty((0, width), np.float32))
                # Widths that the sample did not meet begin as one leaf.
                yield from _routed(here, dict(enumerate(shared.value.get(width, [none]))), width, threshold, total).to_batches()

    rows = written(vectors.mapInArrow(route, _ROUTED + kind), "leaves")
    done = None
    while True:
        sizes = written(rows.groupBy("leaf", "width").agg(F.count("*").alias("n"), F.max("was").alias("was")), "sizes")
        more = sizes.where((F.col("n") > leaf) & (F.col("n") <= STUCK * F.col("was"))).select("leaf", "width", "n")
        small = F.broadcast(sizes) if sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else sizes
        closed = rows.join(small.where((F.col("n") <= leaf) | (F.col("n") > STUCK * F.col("was"))).drop("was"), ["leaf", "width"])
        done = closed if done is None else done.unionByName(closed)
        if more.isEmpty():
            return done.drop("was")
        rows = written(_split_again(rows.drop("was"), more, threshold, leaf, sample, depth), "leaves")


_PAIR = "a bigint, b bigint, a_copies bigint, b_copies bigint"


def _compared(threshold: float):
    def run(batch: pa.Table) -> pa.Table:
        width, one, two = (batch[c][0].as_py() for c in ("width", "one", "two"))
        vectors, part = _matrix(batch["vec"], width), np.asarray(batch["part"])
        node, copies = np.asarray(batch["node"]), np.asarray(batch["copies"])
        left, right = np.flatnonzero(part == one), np.flatnonzero(part == two)
        i, j = near_pairs(vectors[left], vectors[right], threshold, one == two)
        i, j = left[i], right[j]
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return pa.table({"a": node[i], "b": node[j], "a_copies": copies[i], "b_copies": copies[j]})

    return run


def links(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = LEAF, **forest) -> DataFrame:
    """Pairs (a < b, with their copies) of different vectors with at least this cosine, each once."""
    rows = planted(vectors, threshold, **forest)
    tiles = F.ceil(F.col("n") / tile).cast("bigint")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node", "leaf"), tiles))
    # A tile meets itself and each other tile of its leaf.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1))
    rows = rows.select("*", other.alias("other"))
    rows = rows.select("*", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    pairs = rows.groupBy("leaf", "width", "one", "two").applyInArrow(_compared(threshold), _PAIR)
    return pairs.distinct()


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch, without those that close a circle in it."""
    for batch in batches:
        node, root = spanning_forest(np.asarray(batch["a"]), np.asarray(batch["b"]))
        yield pa.RecordBatch.from_pydict({"a": pa.array(node, pa.int64()), "b": pa.array(root, pa.int64())})


def _usable(vec: Column) -> Column:
    value = lambda x: x.cast("double")
    finite = lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf"))
    return vec.isNotNull() & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0)


def _looked_up(rows: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """A join with facts that are unique by key, of which ``n`` is the number of rows.

    Keys that hold more than a thousandth of all rows are less than a thousand, and are broadcast: no task has all rows
    of one. The others are joined by sorting, whatever Spark takes their size for: none of them goes to the driver.
    """
    total, most = facts.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) * HOT_KEYS <= (total or 0):
        return rows.join(facts.hint("merge"), by).drop("n")
    hot = F.broadcast(facts.where(F.col("n") * HOT_KEYS > total))
    others = facts.where(F.col("n") * HOT_KEYS <= total).hint("merge")
    cold = rows.join(hot.select(*by), by, "left_anti").join(others, by)
    return rows.join(hot, by).unionByName(cold).drop("n")


def near_copies(embeddings: DataFrame, threshold: float = THRESHOLD, **forest) -> DataFrame:
    """One row per vector (``vec_id``, ``embedding``): vec_id, n_links, component_id, kept."""
    usable = _usable(F.col("embedding"))
    hashes = F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")
    rows = embeddings.select("vec_id", "embedding")
    good = rows.where(usable)
    # One vector of each sort, with its number. Vectors are counted per task before they are shuffled.
    sorts = good.groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    sorts = sorts.select(*hashes, "copies", "least", F.size("embedding").alias("width"), F.col("embedding").alias("vec"))
    sorts = written(sorts.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = written(links(sorts.select("node", "copies", "width", "vec"), threshold, **forest), "links")
    ends = [F.struct(F.col("a").alias("node"), F.col("b_copies").alias("n")), F.struct(F.col("b").alias("node"), F.col("a_copies").alias("n"))]
    degrees = found.select(F.explode(F.array(*ends)).alias("e")).groupBy("e.node").agg(F.sum("e.n").alias("linked"))
    groups = components(found.select("a", "b").mapInArrow(_spanning, "a bigint, b bigint"), "a", "b")
    named = sorts.select("h1", "h2", "copies", "least", "node")
    named = named.join(degrees.hint("merge"), "node", "left").join(groups.hint("merge"), "node", "left")
    named = written(named.withColumn("root", F.coalesce("root", "node")), "named")
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "components")
    linked = (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    facts = _looked_up(named, ids, ["root"]).select("h1", "h2", linked, "component_id", F.col("copies").alias("n"))
    told = _looked_up(good.select("vec_id", *hashes), written(facts, "labels"), ["h1", "h2"])
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = told.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
