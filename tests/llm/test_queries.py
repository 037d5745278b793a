"""The registered corpus queries over the driver's smallest tables, against their SQL or plain Python."""

from __future__ import annotations

import zlib
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from feedloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.test_queries import duck, plain  # noqa: F401

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry_point.queries()
    assert sorted({n.split("_")[0] for n in names if n.startswith("op")}, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, duck, name):  # noqa: F811
    frame = QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    order = sorted(names)
    found = sorted((tuple(plain(row[n]) for n in order) for row in frame.collect()), key=repr)
    picks = [names.index(n) for n in order]
    assert found == sorted((tuple(plain(row[i]) for i in picks) for row in result.fetchall()), key=repr)


def test_token_counts(spark, documents):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, str(SF_DIR)).collect()}
    n = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t, _ in documents}
    assert got == {d: (len(t.encode()), n[d], n[d] > 2048) for d, t, _ in documents}


def test_near_copies(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_near_dedup"](spark, str(SF_DIR)).collect()}
    assert got == brute.near_copies([(d, t) for d, t, _ in documents])


def test_languages(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, str(SF_DIR)).collect()}
    held = {d for d, _, _ in documents if zlib.crc32(str(d).encode()) % 4 == 2}
    assert {d for d, r in got.items() if r.held_out} == held and len(got) == len(documents)
    right = sum(got[d].lang_pred == lang for d, _, lang in documents if d in held)
    assert right >= 0.97 * len(held)
