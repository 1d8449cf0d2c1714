"""Quality rules against a plain Python statement."""

import re
from collections import Counter

import pytest
import xxhash

from storemart.llm import quality_llr as Q
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    twice = Counter(windows)
    covered = {j for i, x in enumerate(windows) if twice[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def mean_weight(text, model):
    w = WORD.findall(text or "")
    total = 0
    for a, b in zip(w, [*w[1:], "\n"]):
        one = xxhash.xxh64_intdigest(a.encode(), seed=42)
        total += model.weights[one & (model.buckets - 1)]
        total += model.weights[xxhash.xxh64_intdigest(b.encode(), seed=one) & (model.buckets - 1)]
    return total / (2 * len(w)) / 1e6 if w else None


@pytest.fixture(scope="module")
def model(spark, documents):
    return Q.fit(documents, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), buckets=1 << 10)


def test_counts_and_scores(documents, odd, model):
    docs = documents.union(odd.select("doc_id", "text"))
    for r in Q.assess(docs, model).collect():
        q = r["quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == base(r["text"])
        failed = q["n_words"] < 20 or 100 * q["n_repeat_words"] > 30 * q["n_words"]
        want = mean_weight(r["text"], model)
        assert q["base_failed"] == failed
        assert q["score"] == (pytest.approx(want, abs=1e-12) if want is not None else None)
        assert q["kept"] == (not failed and want >= model.threshold)


def test_verdict_separates_labels(spark, documents, model):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = Q.assess(documents, model, out="verdict").join(labels, "doc_id").where("not verdict.base_failed").collect()
    good = [r["verdict"]["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["verdict"]["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_no_python_on_the_main_path(documents, model):
    plan = Q.assess(documents, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_pass_and_empty_tables(spark, odd, nothing, model):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = Q.fit(odd, labels, buckets=64)
    assert set(empty.weights) == {0}
    kept = Q.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in odd.collect() if base(r["text"])[0] >= 20 and 100 * base(r["text"])[4] <= 30 * base(r["text"])[0]}
    assert Q.assess(nothing, model).count() == 0 and Q.keep_good(nothing, labels).count() == 0


def test_threshold_rules():
    assert Q.pick_threshold([], 0.99) == float("-inf")
    assert Q.pick_threshold([(1.0, 1), (2.0, 1)], 0.99) == 1.0
    assert Q.pick_threshold([(0.0, 0), (0.2, 0), (1.0, 1), (2.0, 1)], 0.99) == 0.6
    assert Q.pick_threshold([(5.0, 0), (1.0, 1), (2.0, 1)], 0.99) <= 1.0
