"""Benchmark windows against a scan of every position."""

import pytest
from pyspark.sql import functions as F

from storemart.llm import decontam as D
from tests.conftest import SF_SMALL

from . import brute

ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "tiny item"), (3, None), (4, "  ,;"), (None, "no id here"),
         (5, "tiny item"), (1, "another text under the first id"), (6, "a a a a a a a a a a a a"), (7, "A-b_c9 É́ ½x")]
DOCS = [(1, "Alpha, beta GAMMA delta epsilon; zeta eta theta iota kappa lambda mu and on"), (2, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (3, "a tiny-item twice: TINY item tiny"), (4, None), (5, ""), (6, "a " * 15), (6, "there is no id here"), (7, "a b c9 é́ ½x"),
        (8, "another text under the first id")]


@pytest.mark.parametrize("block", [100_000, 3])
def test_small_cases_in_one_and_many_blocks(spark, block):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("found", F.lit("mine"))
    found = D.find(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), out="got", block_windows=block)
    rows = found.withColumn("n", D.n_hit("got")).collect()
    assert len(rows) == len(DOCS) and all(r["found"] == "mine" for r in rows)
    for r in rows:
        n, at, ids = brute.hits(r["text"], ITEMS)
        assert (r["got"]["n_words"], r["n"], r["got"]["items"]) == (n, len(at), sorted(str(i) for i in ids if i is not None))
        assert {p for s in r["got"]["spans"] for p in range(s["s"], s["e"])} == at


def test_documents_table(spark, documents):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    plain = [(r["item_id"], r["text"]) for r in items.collect()]
    rows = D.find(documents, items).withColumn("n", D.n_hit()).collect()
    sizes = [brute.hits(r["text"], plain) for r in rows]
    assert [(r["found"]["n_words"], r["n"], r["found"]["items"]) for r in rows] == [(n, len(a), sorted(map(str, i))) for n, a, i in sizes]
    assert any(a for _, a, _ in sizes)


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    clean = D.keep_clean(odd, none)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    some = spark.createDataFrame([(1, "one"), (2, "d e f g h")], "item_id long, text string")
    assert sorted(str(r["doc_id"]) for r in D.keep_clean(odd, some).collect()) == sorted(
        str(r["doc_id"]) for r in odd.collect() if not brute.hits(r["text"], [(1, "one"), (2, "d e f g h")])[1])
    assert D.find(nothing, some).count() == 0
