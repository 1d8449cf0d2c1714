"""The corpus pipeline and the registered queries."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from storemart.llm import quality_llr as Q
from tests.conftest import SF_SMALL

from . import brute


def test_pipeline_equals_plain_statement(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = Q.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = [(r["doc_id"], r["text"]) for r in Q.assess(docs, model, out="q").where("q.kept").orderBy("doc_id").collect()]
    group, _ = brute.groups([t for _, t in kept], 5)
    first = {}
    for g, row in zip(group, kept):
        first.setdefault(g, row)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = [row for row in first.values() if not brute.hits(row[1], items)[1]]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, text in clean:
        ids = np.array(enc.encode_ordinary(text), "<u4")
        want[i] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want and 0 < len(clean) < len(first) < len(kept) < docs.count()


def test_stages_take_odd_rows(spark, odd):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicate removal", "benchmark decontamination", "byte-level BPE"]
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "byte-level BPE":
            assert out.columns == odd.columns and out.dtypes == odd.dtypes
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        out.count()


def test_every_operator_is_registered():
    names = set(E.queries())
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
