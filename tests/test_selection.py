"""Distributed selection and border carry against single-task definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storemart.operators import keys as K
from storemart.operators import selection as S


def test_quantiles_equal_sorted_values(spark):
    rnd = random.Random(1)
    columns = {
        "a": [rnd.gauss(0, 1) for _ in range(900)], "ties": [float(rnd.randrange(3)) for _ in range(900)],
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.randrange(-300, 300) for _ in range(900)], "one": [4.25] * 900,
        "gaps": [None if rnd.random() < 0.4 else rnd.random() for _ in range(900)],
        "odd": [rnd.choice([math.nan, math.inf, -math.inf, 1.0, 2.0, 7.0]) for _ in range(900)], "none": [None] * 900,
        "ends": [1.7e308] * 450 + [-1.7e308] * 449 + [0.0]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    points = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = S.quantiles(df, list(columns), points)
    for c, values in columns.items():
        v = sorted(x for x in values if x is not None and math.isfinite(x))
        assert got[c]["n"] == len(v)
        for p in points:
            if not v:
                assert got[c][p] is None
                continue
            h = (len(v) - 1) * p
            lo, hi = v[int(h)], v[min(int(h) + 1, len(v) - 1)]
            assert got[c][p] == lo + (hi - lo) * (h - int(h))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "a double")
    assert S.quantiles(df, ["a"], [0.5])["a"][0.5] is None and S.quantiles(df, [], [0.5]) == {}


@pytest.mark.parametrize("slices", [1, 3, 40, 200])
def test_neighbours_cross_slice_borders(spark, slices):
    rng = np.random.default_rng(slices)
    rows = [(int(g), None if g == 3 else "s", i, float(rng.integers(0, 100)), "extra") for i, g in enumerate(
        np.concatenate([np.zeros(150), rng.integers(1, 9, 60)]).astype(int))]
    df = spark.createDataFrame(rows, "g int, h string, o int, x double, e string")
    w = Window.partitionBy("g", "h").orderBy("o")
    want = df.withColumns({"p": F.collect_list(F.struct("x")).over(w.rowsBetween(-3, -1)), "n": F.collect_list(F.struct("x")).over(w.rowsBetween(1, 2))})
    got = K.neighbours(df, ["g", "h"], ["o"], ["x"], 3, 2, "p", "n", num_partitions=slices)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_tasks_send_cells_and_not_values(spark):
    """a round sends at most CELLS rows per interval and task, also where nulls, NaN and infinities lie between."""
    values = [None, math.nan, math.inf, -math.inf, *[i / 7 for i in range(3000)], *[5.0] * 2000]
    df = spark.createDataFrame([(x,) for x in values], "a double").repartition(2)
    got = {(r["k"], r["cell"]): (r["n"], r["lo"], r["hi"]) for r in S.count_cells(df, [("a", 0.0, 1000.0), ("a", 4.0, 6.0)]).collect()}
    for k, (lo, hi) in enumerate(((0.0, 1000.0), (4.0, 6.0))):
        want = {}
        for x in sorted(v for v in values if v is not None and lo <= v <= hi):
            cell = min(int((x / 2 - lo / 2) / (hi / 2 - lo / 2) * S.CELLS), S.CELLS - 1)
            n, low, _ = want.get(cell, (0, x, x))
            want[cell] = n + 1, low, x
        assert {c: v for (i, c), v in got.items() if i == k} == want


def test_moments_of_many_columns(spark):
    """more columns than are taken at once."""
    n = S.MOMENT_COLUMNS * 2 + 1
    df = spark.createDataFrame([tuple(float(i * j) if (i + j) % 5 else None for j in range(n)) for i in range(40)], ", ".join(f"c{j} double" for j in range(n)))
    got = S.quantiles(df, df.columns, [0.5])
    for j in range(n):
        x = [float(i * j) for i in range(40) if (i + j) % 5]
        assert (got[f"c{j}"]["n"], got[f"c{j}"]["min"], got[f"c{j}"]["max"]) == (len(x), min(x), max(x))
        assert got[f"c{j}"]["mean"] == pytest.approx(sum(x) / len(x)) and got[f"c{j}"][0.5] == pytest.approx((x[len(x) // 2 - 1] + x[len(x) // 2]) / 2)
