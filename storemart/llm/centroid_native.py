"""Centroid clustering (Lloyd rounds on integers) as JVM expressions.

Vectors become arrays of integers floor(1024 * x) and are written once.  A round is one job: ``zip_with`` and
``aggregate`` give the squared distance to each literal centroid array, ``array_min`` of (distance, number)
structs picks the nearest (ties: the smaller number), and plain column sums over each component, partially
aggregated before the shuffle, give the new centroids.  Only k rows of sums per round and k literal arrays
pass the driver, whatever the size of the table.  All arithmetic is on integers, so results do not depend on
the order of summation or on partitions.

Defined cases: kept are vectors with exactly ``dim`` components, none null, NaN or infinite, and none that
leaves +-``LIMIT`` as an integer (their squared distances would not fit 64 bits).  Repeated rows count as
often as they occur.  A null id hashes like the empty id; equal ids are put in order by their vectors.  With
fewer than ``k`` kept vectors there are as many centroids as vectors; an empty table gives an empty table.
Extra columns are ignored.  A sum beyond 64 bits is an error, not a wrapped value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE = 1024
LIMIT = 1 << 27


def integers(vectors: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, q): the kept vectors as integer arrays."""
    raw = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("__v"))
    wide = F.transform("__v", lambda x: F.floor(F.lit(float(SCALE)) * x))
    # NaN is the largest double for Spark, so one comparison drops it with the infinities
    fits = F.forall("__v", lambda x: F.coalesce(F.abs(x * F.lit(float(SCALE))) <= F.lit(float(LIMIT)), F.lit(False)))
    return raw.where((F.size("__v") == dim) & fits).select("vec_id", wide.alias("q"))


def start(vectors: DataFrame, k: int, seed: int) -> list:
    """The k vectors of smallest sha256('seed:id'), in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r["q"]) for r in vectors.select("q", digest.alias("h")).orderBy("h", "q").limit(k).collect()]


def _array(numbers: list) -> str:
    return "array(" + ", ".join(f"{x}L" for x in numbers) + ")"


def nearest(centroids: list) -> Column:
    """Struct (distance, cluster) of the nearest centroid to ``q``."""
    squared = "aggregate(zip_with(q, {}, (x, y) -> (x - y) * (x - y)), 0L, (s, x) -> s + x)"
    return F.expr("array_min(array(" + ", ".join(
        f"named_struct('distance', {squared.format(_array(c))}, 'cluster', {i})" for i, c in enumerate(centroids)) + "))")


def update(vectors: DataFrame, centroids: list, dim: int) -> list:
    """Centroids after one round: exact floor of the mean of each component; empty clusters keep theirs."""
    rows = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "q").groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.expr(f"sum(q[{i}])") for i in range(dim)]).collect()
    moved = list(centroids)
    for r in rows:
        moved[r["cluster"]] = [total // r["n"] for total in r[2:]]  # Python's // is the floor
    return moved


def cluster(vectors: DataFrame, k: int = 8, dim: int = 64, rounds: int = 10, seed: int = 3, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its final integers)."""
    kept = materialise(integers(vectors, dim, id_col, vector_col), "centroid-vectors")
    centroids = start(kept, k, seed)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                           F.col("q").alias("centroid"))
    for _ in range(rounds):
        centroids = update(kept, centroids, dim)
    last = materialise(kept.select("vec_id", nearest(centroids).alias("near")).select("vec_id", "near.cluster", "near.distance"), "centroid-assigned")
    spent = {r["cluster"]: int(r["s"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    by_cluster = F.array(*[F.lit(spent.get(i, 0)).cast("long") for i in range(len(centroids))])
    arrays = F.expr(f"array({', '.join(map(_array, centroids))})")
    return last.select("vec_id", "cluster", "distance", by_cluster[F.col("cluster")].alias("cluster_inertia"),
                       F.lit(sum(spent.values())).cast("long").alias("inertia"), arrays[F.col("cluster")].alias("centroid"))


def centroid_digest() -> Column:
    return F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",").cast("binary"), 256)


def duckdb_sql(k: int = 8, dim: int = 64, rounds: int = 10, seed: int = 3) -> str:
    """The whole computation in DuckDB, one pair of steps per round."""
    def assign(r):
        return f"""a{r} AS MATERIALIZED (SELECT r, q, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT v.r, v.q, m.c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.q, m.q)]) AS d FROM v, c{r} m) x GROUP BY r, q)"""

    def move(r):
        return f"""c{r + 1} AS MATERIALIZED (SELECT old.c, coalesce(new.q, old.q) AS q FROM c{r} old LEFT JOIN (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM (
              SELECT c, i, sum(q[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) t(i) GROUP BY c, i) y GROUP BY c) new ON new.c = old.c)"""

    steps = ",\n".join(x for r in range(rounds) for x in (assign(r), move(r)))
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings WHERE len(embedding) = {dim} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x) AND abs({SCALE} * CAST(x AS DOUBLE)) <= {LIMIT}]) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (
  SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v ORDER BY h, q LIMIT {k}) x),
{steps},
{assign(rounds)},
s AS (SELECT c, sum(d) AS spent FROM a{rounds} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(s.spent AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(spent) FROM s) AS BIGINT) AS inertia, sha256(array_to_string(m.q, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a ON a.r = v.r JOIN s ON s.c = a.c JOIN c{rounds} m ON m.c = a.c
"""
