"""Fill-in-middle against a plain statement, and exact round trips."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from storemart.llm import fim_arrow as M


def plain(doc_id, text, percent=100, spm_percent=50, seed=7):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    u = re.findall(r"[^\n]*\n|[^\n]+", text)
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(u), "plain", None, None, text
    if h4 % 100 < spm_percent:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "a\r\nb\n\nc\n", "é😀\n日本\n", "x <P> y\nz", "<S", "<", "<\n<S\nP>\n>M>\n", "<M>", "one two\x0bthree\nfour"] + [
    "\n".join(f"line {i} {j}" for j in range(i)) + "\n" * (i % 3) for i in range(40)]


def test_equals_the_plain_statement(spark):
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, spm in ((100, 50), (60, 20), (0, 50)):
        made = M.transform(df, percent=percent, spm_percent=spm)
        back = M.restore(made.withColumnRenamed("text", "was")).collect()
        assert len(back) == len(rows)
        for r in back:
            assert tuple(r["fim"]) == plain(r["doc_id"], r["was"], percent, spm)
            assert r["text"] == (r["was"] or "")


def test_odd_rows(odd, nothing, spark):
    from pyspark.sql import functions as F
    wide = odd.withColumns({c: F.lit(1) for c in ("fim", "__h1", "__output", "__FORM", "output")})
    made = M.transform(wide)
    assert sorted(made.columns) == sorted(wide.columns)
    got = M.restore(made.drop("text")).select("doc_id", "fim.*", "text", "__h1", "found").collect()
    want = sorted(((i or -1), t or "") for i, t in [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sorted(((r["doc_id"] or -1), r["text"]) for r in got) == want
    assert all(r["__h1"] == 1 and r["found"] == "extra found" for r in got)
    assert M.restore(M.transform(nothing).drop("text")).count() == 0
    with pytest.raises(ValueError):
        M.transform(odd, sentinels=("aa", "<S>", "<M>"))


def test_slices_bound_the_bytes(monkeypatch):
    monkeypatch.setattr(M, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 4, "", "b" * 30, "c" * 6, "d" * 4, "e"])], names=["t"])
    parts = [p.column(0).to_pylist() for p in M._slices(batch, 0)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert [len(p) for p in parts] == [2, 1, 2, 1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab<>PSM\n", max_size=30), min_size=1, max_size=8), st.integers(0, 2**32))
def test_any_text_comes_back(texts, seed):
    import numpy as np
    h = [np.random.default_rng([seed, i]).integers(0, 1 << 32, len(texts)) for i in range(4)]
    made = M._transform(pa.array(texts), h, 100, 50, M.SENTINELS)
    assert M._restore(made.field("output"), made.field("form"), M.SENTINELS).to_pylist() == texts
