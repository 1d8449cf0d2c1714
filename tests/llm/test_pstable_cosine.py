"""Embedding near-duplicates against all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from storemart.llm import pstable_cosine as M


def brute(rows, cosine=0.98):
    """{row number: (n_links, smallest id of the component)} for (vec_id, label, components)."""
    vec = [None if l is None else M._double(v) for _, l, v in rows]
    links = [[] for _ in rows]
    for x in range(len(rows)):
        for y in range(x):
            if vec[x] is not None and vec[y] is not None and rows[x][1] == rows[y][1] and len(vec[x]) == len(vec[y]):
                if M.unit(vec[x]) @ M.unit(vec[y]) >= cosine:
                    links[x].append(y)
                    links[y].append(x)
    out = []
    for x in range(len(rows)):
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        out.append((rows[x][0], len(links[x]), min((rows[y][0] for y in seen if rows[y][0] is not None), default=None)))
    return sorted(out, key=str)


def check(spark, rows, **args):
    df = spark.createDataFrame([(i, l, None if v is None else [None if x is None else float(x) for x in v]) for i, l, v in rows],
                               "vec_id long, label int, embedding array<double>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in M.groups(df, **args).collect()), key=str)
    assert got == brute(rows)


def near(rng, base, cosine):
    """A vector at this cosine to ``base``."""
    side = rng.standard_normal(len(base))
    side -= (side @ base) * base
    return cosine * base + math.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side)


def planted(seed=4, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        rows += [(label, rng.standard_normal(dim)) for _ in range(60)]
        centre = M.unit(rng.standard_normal(dim))
        rows += [(label, near(rng, centre, 0.996) * rng.uniform(0.1, 9)) for _ in range(70)]  # a ball with its border
        rows += [(label, near(rng, centre, c)) for c in (0.9801, 0.981, 0.985, 0.97, 0.9799, 0.99) * 4]
        wide = M.unit(rng.standard_normal(dim))
        rows += [(label, near(rng, wide, 0.988)) for _ in range(40)]  # members about 0.976 apart: links and others
        step = M.unit(rng.standard_normal(dim))
        for _ in range(12):  # a chain
            step = M.unit(near(rng, step, 0.9802))
            rows.append((label, step))
        rows += [(label, centre)] * 5
        rows.append((None, centre))
    rng.shuffle(rows)
    return [(i, l, v) for i, (l, v) in enumerate(rows)]


def test_planted_groups_equal_all_pairs(spark):
    check(spark, planted())


def test_cells_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 7)
    check(spark, planted(9)[:400])
    monkeypatch.setattr(M, "BALL_NODES", 1 << 30)  # without balls every pair is held together
    check(spark, planted(11)[:400])


def test_odd_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, 0, None), (2, 0, []), (3, 0, [0.0, 0.0, -0.0]), (4, 0, [1.0, None, 2.0]), (5, 0, [1.0, math.nan, 2.0]), (6, 0, [math.inf, 1.0, 1.0]),
            (7, 0, a), (7, 0, a), (8, 0, [2.0, 4.0, 6.0]), (9, 1, a), (10, None, a), (None, 0, a), (None, 2, a), (None, 2, a), (11, 0, [1.0, 2.0]),
            (12, 0, [1e200, 2e200, 3e200]), (13, 0, [1e-300, 2e-300, 3e-300]), (14, 0, [-1.0, -2.0, -3.0]), (15, 3, [5.0]), (16, 3, [1.0]), (17, 3, [-1.0])]
    check(spark, rows)
    check(spark, [])
    df = spark.createDataFrame([(1, 5, [1.0, 0.0], 3, "x"), (2, 5, [1.0, 0.001], 4, "y")], "vec_id long, label int, embedding array<float>, node int, digest string")
    assert sorted(tuple(r) for r in M.groups(df.withColumn("weight", F.lit(0))).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_plan_keeps_the_miss_rate():
    for n in (1, 100, 10**6, 10**10):
        k, tables = M.plan(n)
        r = math.sqrt(2 - 2 * M.COSINE)
        assert (1 - M.collision(M.WIDTH * r, r) ** k) ** tables <= M.MISS
        assert n * M.collision(M.WIDTH * r, math.sqrt(2)) ** k <= 1
