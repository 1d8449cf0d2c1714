"""Centroid clustering against a plain statement."""

import math
import random

from pyspark.sql import functions as F

from storemart.llm import centroid_native as M
from tests.conftest import SF_SMALL

from . import brute


def rows_of(df, **args):
    got = M.cluster(df, **args).withColumn("digest", M.centroid_digest())
    return sorted(tuple(r) for r in got.select(F.coalesce("vec_id", F.lit(-1)), "cluster", "distance", "cluster_inertia", "inertia", "digest").collect())


def want(rows, **args):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in brute.centroids(rows, **args))


def test_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert rows_of(df) == want(rows)


def test_odd_vectors(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(3)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, math.nan, 0.0]), (104, [math.inf, 0.0, 0.0]), (105, [1.0, 2.0]),
             (106, [0.0, -0.0, 0.0]), (None, [0.5, 0.5, -0.5]), (7, rows[7][1]), (8, [9.0, 9.0, 9.0]), (107, [1e9, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(0) for c in ("q", "cluster", "__v")})
    for args in ({"k": 4, "dim": 3, "rounds": 5, "seed": 3}, {"k": 1, "dim": 3, "rounds": 2, "seed": 9}, {"k": 8, "dim": 2, "rounds": 3, "seed": 3}):
        assert rows_of(df, **args) == want(rows, **args)
    assert rows_of(df.where("vec_id > 99 and vec_id < 106"), k=3, dim=3, rounds=2) == []


def test_ties_and_empty_clusters(spark):
    # two equal vectors start two equal centroids: the smaller number takes all, the other stays empty
    rows = [(i, [1.0, 1.0]) for i in range(6)] + [(10 + i, [float(i % 2), 0.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert rows_of(df, k=5, dim=2, rounds=4) == want(rows, k=5, dim=2, rounds=4)
