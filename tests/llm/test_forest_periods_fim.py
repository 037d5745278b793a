"""Embedding near-dedup, periodic runs and fill-in-middle against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import fim, forest, graph, periods
from tests.llm import brute

# -------------------------------------------------------------------------------------------------------------- forest

VECTORS = "vec_id bigint, embedding array<float>, label int, node int, copies string, n int"


def _vectors(spark, rows, kind=VECTORS, partitions=3):
    return spark.createDataFrame([(i, v, 1, 7, "x", 3) for i, v in rows], kind).repartition(partitions)


def _cloud(groups, members, width=16, noise=0.05, seed=0):
    """Groups of near copies; a pair of a group has a cosine of some 0.96."""
    random_ = np.random.default_rng(seed)
    centres = random_.normal(size=(groups, width))
    rows = (centres[:, None, :] + noise * np.sqrt(width) / 4 * random_.normal(size=(groups, members, width))).reshape(-1, width)
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]


def _near(rows, threshold=0.95):
    """vec_id -> (links, least id), for different ids."""

    def usable(v):
        return v and None not in v and np.isfinite(v).all() and np.any(v)

    good = [(i, np.asarray(v, np.float64)) for i, v in rows if usable(v)]
    links = []
    for k, (i, v) in enumerate(good):
        for j, w in good[:k]:
            if len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links.append((i, j))
    n = Counter(x for pair in links for x in pair)
    found = brute.groups([i for i, _ in rows], links)
    return {i: (n[i], found[i], found[i] == i) for i, _ in rows}


def _answers(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


ODD = [
    (9000, None), (9001, []), (9002, [0.0] * 16), (9003, [1.0, None] + [0.0] * 14), (9004, [float("nan")] * 16),
    (9005, [float("inf")] + [1.0] * 15), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, [2.0, -4.0]), (9009, [1e-38] * 16),
    (9010, [3e38] * 16), (9011, [1.0] * 16), (9012, [1.0] * 16), (9013, [0.0, -0.0] + [1.0] * 14), (9014, [-0.0, 0.0] + [1.0] * 14),
]


def test_vectors_match_python(spark):
    rows = _cloud(30, 4) + ODD
    assert _answers(forest.near_copies(_vectors(spark, rows))) == _near(rows)
    assert forest.near_copies(_vectors(spark, [])).count() == 0
    assert _answers(forest.near_copies(_vectors(spark, ODD[:5]))) == _near(ODD[:5])


def test_vectors_of_doubles_are_compared_in_double_precision(spark):
    angle = np.arccos(0.95)
    rows = [(0, [1.0, 0.0]), (1, [np.cos(angle - 1e-12), np.sin(angle - 1e-12)]), (2, [np.cos(-angle - 1e-9), np.sin(-angle - 1e-9)])]
    rows = [(i, [float(x) for x in v]) for i, v in rows] + [(3, [1e300, 1e299]), (4, [1e-300, 1e-301])]
    found = _answers(forest.near_copies(_vectors(spark, rows, VECTORS.replace("float", "double"))))
    assert found[0][0] == 3 and found[2][0] == 0 and found[3][0] >= 2 and found[4][1] == 0


def test_ids_that_are_null_or_repeat(spark):
    one = [1.0] * 4
    rows = [(None, one), (5, one), (5, one), (3, [2.0, 2.0, 2.0, 2.1]), (None, [1.0, -1.0, 0.0, 0.0]), (7, None), (None, None)]
    got = sorted(map(tuple, forest.near_copies(_vectors(spark, rows)).collect()), key=repr)
    want = [(None, 3, 3, False), (5, 3, 3, False), (5, 3, 3, False), (3, 3, 3, True)]
    want += [(None, 0, None, False), (7, 0, 7, True), (None, 0, None, False)]
    assert got == sorted(want, key=repr)


def test_rounds_of_splitting_find_nearly_all_links(spark):
    """Small leaves, samples and trees, so that leaves are split again and again."""
    rows = _cloud(150, 6, seed=3)
    want, small = _near(rows), {"leaf": 32, "tile": 32, "sample": 128, "depth": 2}
    vectors = _vectors(spark, rows).withColumn("node", F.col("vec_id")).withColumn("copies", F.lit(1).cast("bigint"))
    vectors = vectors.select("node", "copies", F.size("embedding").alias("width"), F.col("embedding").alias("vec"))
    leaves = forest.planted(vectors, leaf=32, sample=128, depth=2)
    assert leaves.groupBy("leaf").count().agg(F.max("count")).first()[0] <= 64
    assert leaves.groupBy("node").count().count() == len(rows)
    got = _answers(forest.near_copies(_vectors(spark, rows), **small))
    found, there = sum(n for n, _, _ in got.values()), sum(n for n, _, _ in want.values())
    assert there > 1000 and 0.97 * there <= found <= there
    assert all(got[i][0] <= want[i][0] for i in got)


def test_a_crowd_of_near_copies_is_compared_in_tiles(spark):
    """It cannot be split; every pair is found by every tree, and counted once."""
    rows = _cloud(1, 120, noise=0.01) + [(1000 + i, v) for i, v in _cloud(40, 1, seed=9)]
    got = _answers(forest.near_copies(_vectors(spark, rows), leaf=16, tile=16, sample=64, depth=3))
    assert got == _near(rows)
    copies = [(i, rows[0][1]) for i in range(2000, 2500)]
    assert _answers(forest.near_copies(_vectors(spark, rows + copies), leaf=16, tile=16, sample=64, depth=3))[2100] == (619, 0, False)


def test_results_do_not_depend_on_partitions(spark):
    rows = _cloud(60, 5, seed=4)
    small = {"leaf": 32, "tile": 32, "sample": 64, "depth": 2}
    assert sum(n for n, _, _ in _answers(forest.near_copies(_vectors(spark, rows, partitions=1), **small)).values()) > 0
    one, two = (_answers(forest.near_copies(_vectors(spark, rows, partitions=p), **small)) for p in (1, 7))
    lost = sum(one[i] != two[i] for i in one)
    assert lost <= 0.03 * len(one)  # numbers of vectors, and so the trees, differ; both find nearly all


def test_tables_of_vectors_and_links_are_not_broadcast(spark, monkeypatch):
    """Spark would broadcast small ones by the size of their files, and does not count what an explode makes of them."""
    plans, limit = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for module in forest, graph:
        monkeypatch.setattr(module, "written", lambda df, purpose, f=module.written: plans.append((purpose, plan(df))) or f(df, purpose))
    rows = _cloud(1250, 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = forest.near_copies(_vectors(spark, rows))
        plans.append(("result", plan(found)))
        got = _answers(found)
        many = forest.near_copies(_vectors(spark, rows + [(9000 + i, rows[0][1]) for i in range(30)]))
        assert "BroadcastHashJoin" in plan(many)  # of the one vector that has over a thousandth of the rows
        more = _answers(many)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    after = plans[[purpose for purpose, _ in plans].index("links") + 1 :]
    after = after[: [purpose for purpose, _ in after].index("result") + 1]
    assert not [purpose for purpose, text in after if "Broadcast" in text]
    assert {"links", "named", "labels", "result"} <= {purpose for purpose, text in after if "SortMergeJoin" in text}
    assert sum(n for n, _, _ in got.values()) > 1000
    assert more[9000] == (got[0][0] + 30, got[0][1], False) and more[0][0] == more[9029][0]
    assert {i: more[i] for i in range(2, 2500)} == {i: got[i] for i in range(2, 2500)}


# ------------------------------------------------------------------------------------------------------------- periods


def brute_runs(w, least=24, times=3):
    """Every period in turn: stretches of words that are the same one period later."""
    number = {}
    a = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    found = []
    for q in range(1, len(w) // times + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = stop - start + q
            if length >= max(least, times * q) and not any(s <= start and s + n >= start + length for s, n, _ in found):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _cut_back(w, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def _periodic_texts(n, seed):
    pick = random.Random(seed)
    for i in range(n):
        parts = []
        for _ in range(pick.randint(1, 4)):
            q = pick.randint(1, 12)
            unit = [pick.choice("abc") for _ in range(q)]
            parts += (unit * 60)[: pick.randint(0, 60)] if pick.random() < 0.7 else [pick.choice("ab") for _ in range(pick.randint(0, 30))]
        yield i, " ".join(parts)


def test_runs_match_python(make, edges):
    docs = list(_periodic_texts(250, 1)) + [(500, "a " * 3000), (501, "a b " * 11 + "a"), (502, "a b " * 12), *edges]
    docs += [(503, "x y z " * 9 + "x y w " + "y w " * 30), (None, "b " * 24), (502, "a b " * 12)]
    got = Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in periods.find(make(docs)).collect())
    want = Counter()
    for doc, text in docs:
        w = brute.words(text)
        runs = brute_runs(w)
        want[doc, len(w), tuple(runs), _cut_back(w, runs)] += 1
    assert got == want and sum(n for (_, _, runs, _), n in want.items() if runs) > 100
    assert periods.find(make([])).count() == 0


@pytest.mark.parametrize(("least", "times"), [(6, 2), (10, 2), (9, 3), (40, 4), (1, 2)])
def test_other_lengths_of_runs(least, times):
    for _, text in _periodic_texts(150, 2):
        w = text.encode().split()
        assert periods._search([w], least, times)[0] == brute_runs(w, least, times)


def test_texts_that_are_searched_together_stay_apart():
    texts = [t.encode().split() for _, t in _periodic_texts(60, 3)] + [[]]
    assert periods._search(texts, 24, 3) == [brute_runs(t) for t in texts]
    one = ["a"] * 12
    assert periods._search([[x.encode() for x in one]] * 3, 24, 3) == [[], [], []]


def test_a_long_text_of_one_word_takes_no_quadratic_time():
    words = np.zeros(60_000, np.int64)
    assert periods.runs_of(words, np.zeros(len(words), np.int64)) == [(0, 60_000, 1)]
    words = np.arange(60_000) % 1000
    assert periods.runs_of(words, np.zeros(len(words), np.int64)) == [(0, 60_000, 1000)]


def test_ordered_sets():
    pick = random.Random(4)
    values = pick.sample(range(100_000), 5000)
    places, known = periods.Places(values[0]), {values[0]}
    for v in values[1:]:
        places.add(v)
        known.add(v)
    order = sorted(known)
    assert list(places) == order and places.size == len(order)
    for k in (0, 1, 2500, 4998, 4999):
        below, above = places.neighbours(order[k])
        assert below == (order[k - 1] if k else -1) and above == (order[k + 1] if k < 4999 else -1)


def test_the_strongest_run_is_chosen_exactly(spark):
    runs = [[(0, 100, 33), (5, 200, 66), (9, 3_000_001, 1_000_000)], [(3, 48, 2), (1, 24, 1)], []]
    df = spark.createDataFrame([(r,) for r in runs], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = [r[0] and tuple(r[0]) for r in df.select(periods.strongest(F.col("runs"))).collect()]
    assert got == [(0, 100, 33), (3, 48, 2), None]


# ----------------------------------------------------------------------------------------------------------------- fim


def brute_fim(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_matches_python(make, edges):
    pick = random.Random(6)
    chars = ["a", "é", "日", "🙂", "\n", "<", "P", ">", "S>", "<M", "́", "\U0010ffff", "\x00", "~"]
    docs = [(i, "".join(pick.choices(chars, k=pick.randint(0, 40)))) for i in range(600)]
    docs += [(1000, "a<P>b"), (1001, "a<S>"), (1002, "<M>"), *[(1100 + i, "🙂" * i) for i in range(30)], *edges]
    rows = fim.transform(make(docs))
    got = rows.select("*", fim.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, *brute_fim(d, t), t or "") for d, t in docs)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(make([])).count() == 0


def test_rates(make):
    docs = make([(i, "some text") for i in range(300)])
    assert fim.transform(docs, rate=0).where("form = 'plain'").count() == 300
    assert fim.transform(docs, rate=100, suffix_first=100).where("form = 'spm'").count() == 300
    other = {r["output"] for r in fim.transform(docs, seed=2).collect()}
    assert other != {r["output"] for r in fim.transform(docs).collect()}


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_units_of_a_buffer(block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    pick = random.Random(8)
    for _ in range(60):
        texts = ["".join(pick.choices("aé日🙂", k=pick.randint(0, 20))) for _ in range(pick.randint(1, 6))]
        raw = [t.encode() for t in texts]
        stops = np.cumsum([len(r) for r in raw])
        starts = stops - [len(r) for r in raw]
        one, two = (np.array([pick.randrange(1 << 32) for _ in raw]) for _ in range(2))
        found = fim.cut_places(starts, stops, np.frombuffer(b"".join(raw), np.uint8), one, two)
        for i, t in enumerate(texts):
            a, b = sorted((int(one[i]) % (len(t) + 1), int(two[i]) % (len(t) + 1)))
            assert [int(x[i]) for x in found] == [len(t), a, len(t[:a].encode()), b, len(t[:b].encode())]
