"""Near-duplicate groups against all pairs."""

import random

import numpy as np

from storemart.llm import components as C
from storemart.llm import minhash_hamming as M

from . import brute


def near_copies(seed=5):
    """A base with near copies at growing distance, a chain, exact copies, and unrelated texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(i % 12):
            t[rnd.randrange(len(t))] = f"edit{rnd.random()}"
        rows.append(" ".join(t))
    chain = [rnd.choice(words) for _ in range(120)]
    for i in range(12):  # each link shifts the text, far ends share nothing
        chain = chain[3:] + [f"c{i}a", f"c{i}b", f"c{i}c"]
        rows.append(" ".join(chain))
    rows += [" ".join(base).upper()] * 5 + ["short one"] * 3 + ["", None, "  \n"]
    rows += [" ".join(rnd.choice(words) for _ in range(rnd.randrange(2, 80))) for _ in range(40)]
    return list(enumerate(rows))


def check(rows, found, k):
    texts = [t for _, t in rows]
    group, sets = brute.groups(texts, k)
    smallest = {}
    for (i, _), g in zip(rows, group):
        smallest[g] = min(smallest.get(g, i), i)
    want = {i: (len(s), smallest[g]) for (i, _), g, s in zip(rows, group, sets)}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_groups_equal_all_pairs(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, M.groups(df, shingle=4).collect(), 4)
    kept = M.keep_one(df, shingle=4).collect()
    group, _ = brute.groups([t for _, t in rows], 4)
    assert sorted(r["doc_id"] for r in kept) == sorted({g: i for (i, _), g in reversed(list(zip(rows, group)))}.values())


def test_documents_table(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(rows, M.groups(documents, shingle=5).collect(), 5)


def test_index_guarantees_the_distance():
    """Any two signatures within the threshold share a key, whatever the errors' places."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, M.SYMBOLS)
        b = a.copy()
        at = rng.choice(M.SYMBOLS, M.MAX_ERRORS, replace=False)
        b[at] ^= 1
        same = (a == b).reshape(M.CHUNKS, M.CHUNK).sum(axis=1)
        assert (same >= M.CHUNK - 1).any()


def test_odd_rows(odd, nothing):
    found = M.groups(odd, shingle=4).collect()
    assert len(found) == odd.count()
    by_text = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in found}
    assert by_text[(1, 0)] == 1 and by_text[(2, 0)] == 2 and by_text[(3, 0)] == 3  # wordless: alone
    assert by_text[(10, 1)] == 5 and by_text[(11, 1)] == 5  # "a b c" three times, once in capitals and tabs
    assert by_text[(None, 2)] is None  # a component of a null id only has no name
    kept = M.keep_one(odd, shingle=4)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert rows.count((4, "one")) == 1 and (5, "a b c") in rows and (5, "d e f g h") in rows and (10, "a b c") not in rows
    assert (None, "a null id has words") in rows
    assert M.groups(nothing, shingle=4).count() == 0


def test_components_of_path_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (1, 0)]
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_buckets_in_the_same_blocks_ask_once(spark):
    """Near copies share many buckets: each guest asks for a block once, not once for every bucket it shares."""
    keys, nodes = range(64), range(30)
    guests = spark.createDataFrame([(k, n, n % 3) for k in keys for n in nodes], "key long, node long, own long")
    there = spark.createDataFrame([(k, b, b == 2) for k in keys for b in range(3)] + [(64, 0, True), (64, 7, False)], "key long, block long, has_top boolean")
    guests = guests.union(spark.createDataFrame([(64, 5, 2), (64, 99, 9)], guests.schema))
    asked, held = M._same_blocks(guests, there)
    assert asked.count() == 30 + 2 and held.count() == 3 + 2
    met = {(r["node"], r["block"]) for r in M._visits(guests, there).collect()}
    assert met == {(n, b) for n in nodes for b in range(3) if b == 2 or b >= n % 3} | {(5, 0), (5, 7), (99, 0)}


def test_a_block_of_many_guests_lies_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 20)
    blocks = spark.createDataFrame([(n, n, n % 2) for n in range(40)], "node long, label long, block long")
    meet = spark.createDataFrame([(n, 0) for n in range(1, 40, 2)] * 1 + [(n, 1) for n in range(0, 2)], "node long, block long")
    many = spark.createDataFrame([(n, 100 + n, 5) for n in range(1000, 1500)], blocks.schema)
    rows = M._dealt(blocks.union(many), meet.union(many.selectExpr("node", "0L AS block"))).collect()
    parts = {}
    for r in rows:
        parts.setdefault((r["block"], r["part"]), {True: [], False: []})[r["guest"]].append(r["node"])
    assert all(sorted(p[False]) == [n for n in range(40) if n % 2 == b] for (b, _), p in parts.items())
    assert len(parts) == 26 + 1 and max(len(p[True]) for p in parts.values()) < 60
    assert sorted(n for (b, _), p in parts.items() if b == 0 for n in p[True]) == sorted([*range(1, 40, 2), *range(1000, 1500)])
