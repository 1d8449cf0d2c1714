"""Exact order statistics of many columns by distributed selection.

A round counts, for every column under way, the values of each of ``CELLS`` equal cells of the interval that
holds a wanted rank, with each cell's smallest and largest value.  Tasks count in numpy and send at most ``CELLS`` rows
per interval, not a row per value, which Spark adds up; only the cell with the wanted rank (its bounds and the count below
it) is looked at in the next round, until it holds one value.  No value is moved and no column is sorted as a whole; the
driver holds one interval per wanted rank.  Null, NaN and infinite values are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import inf_to_null
from ..session import ship_package

CELLS = 4096
#: Columns whose moments are taken at once: beyond 100 fields Spark compiles no code for an aggregate.
MOMENT_COLUMNS = 12


def finite(c: Column) -> Column:
    x = inf_to_null(c.cast("double"))
    return F.when(~F.isnan(x), x)


def _moments(df: DataFrame, cols: list) -> dict:
    """Count, extremes, mean and sample deviation per column, in one pass for every ``MOMENT_COLUMNS`` columns."""
    out = {}
    for first in range(0, len(cols), MOMENT_COLUMNS):
        some = cols[first:first + MOMENT_COLUMNS]
        x = df.select(*[finite(F.col(c)).alias(f"c{i}") for i, c in enumerate(some)])
        row = x.agg(*[a for i in range(len(some)) for a in (
            F.count(f"c{i}").alias(f"n{i}"), F.min(f"c{i}").alias(f"lo{i}"), F.max(f"c{i}").alias(f"hi{i}"),
            F.avg(f"c{i}").alias(f"m{i}"), F.stddev_samp(f"c{i}").alias(f"s{i}"))]).first()
        out.update({c: {"n": row[f"n{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"], "mean": row[f"m{i}"], "std": row[f"s{i}"]} for i, c in enumerate(some)})
    return out


def add_cells(x: np.ndarray, lo: float, hi: float, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Count the ascending values ``x`` (none below ``lo`` or above ``hi``) in the equal cells of [lo, hi], with their extremes."""
    # halves first: the width of the widest interval still is a double
    cell = np.minimum(np.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * CELLS), CELLS - 1).astype(np.int64)
    start = np.flatnonzero(np.diff(cell, prepend=-1))
    at, end = cell[start], np.append(start[1:], len(x))
    n[at] += end - start
    low[at], high[at] = np.minimum(low[at], x[start]), np.maximum(high[at], x[end - 1])


def count_cells(df: DataFrame, intervals: list) -> DataFrame:
    """(k, cell, n, lo, hi) of the cells with values of each interval (column, lowest, highest)."""
    ship_package(df.sparkSession)
    cols = list(dict.fromkeys(c for c, _, _ in intervals))
    asked = [(k, cols.index(c), lo, hi) for k, (c, lo, hi) in enumerate(intervals)]

    def run(batches):
        held = [(np.zeros(CELLS, np.int64), np.full(CELLS, np.inf), np.full(CELLS, -np.inf)) for _ in asked]
        for batch in batches:
            columns = [x.to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for x in batch.columns]  # nulls become NaN
            for (_, c, lo, hi), sums in zip(asked, held):
                x = columns[c]
                x = x[(x >= lo) & (x <= hi)]
                if len(x):
                    add_cells(np.sort(x), lo, hi, *sums)
        for (k, _, _, _), (n, low, high) in zip(asked, held):
            at = np.flatnonzero(n)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at), pa.array(n[at]), pa.array(low[at]), pa.array(high[at])],
                                                 names=["k", "cell", "n", "lo", "hi"])

    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    return values.mapInArrow(run, "k int, cell long, n long, lo double, hi double").groupBy("k", "cell").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def order_statistics(df: DataFrame, wanted: dict, bounds: dict) -> dict:
    """{(column, rank): value} for ``wanted`` {column: ranks from 0} and ``bounds`` {column: (smallest, largest)}."""
    found, under_way = {}, {}
    for c, ranks in wanted.items():
        for r in set(ranks):
            lo, hi = bounds[c]
            if lo == hi:
                found[c, r] = lo
            else:
                under_way.setdefault((c, lo, hi, 0), []).append(r)
    while under_way:
        at = [(k, r, r - below) for k, ((_, _, _, below), ranks) in enumerate(under_way.items()) for r in ranks]
        cells = count_cells(df, [(c, lo, hi) for c, lo, hi, _ in under_way])
        # at most CELLS rows per interval
        before = F.sum("n").over(Window.partitionBy("k").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
        ranked = cells.withColumn("before", F.coalesce(before, F.lit(0)))
        asked = df.sparkSession.createDataFrame(at, "k int, rank long, place long")
        hits = ranked.join(F.broadcast(asked), "k").where("before <= place AND place < before + n").collect()
        names, following = list(under_way), {}
        for h in hits:
            c, _, _, below = names[h["k"]]
            if h["lo"] == h["hi"]:
                found[c, h["rank"]] = h["lo"]
            else:
                following.setdefault((c, h["lo"], h["hi"], below + h["before"]), []).append(h["rank"])
        under_way = following
    return found


def quantiles(df: DataFrame, cols: list, points: list) -> dict:
    """{column: {..moments, point: value}}: exact linearly interpolated quantiles; None for a column without values."""
    stats = _moments(df, cols) if cols else {}
    places = {c: {p: (s["n"] - 1) * p for p in points} for c, s in stats.items() if s["n"]}
    wanted = {c: [r for h in ps.values() for r in (int(h), min(int(h) + 1, stats[c]["n"] - 1))] for c, ps in places.items()}
    values = order_statistics(df, wanted, {c: (stats[c]["min"], stats[c]["max"]) for c in wanted})
    for c, s in stats.items():
        for p in points:
            if c not in places:
                s[p] = None
                continue
            h = places[c][p]
            low, high = values[c, int(h)], values[c, min(int(h) + 1, s["n"] - 1)]
            s[p] = low + (high - low) * (h - int(h))
    return stats
