"""Near-duplicate embeddings: Euclidean p-stable hashing, then exact cosine.

Vectors are normalised; cosine >= c means a distance of at most r = sqrt(2 - 2c).  A projection on a Gaussian
direction (2-stable), shifted and cut into cells of width ``WIDTH * r``, agrees for two vectors at distance r
with probability p_near (about 0.90) and for unrelated unit vectors with p_far.  A table's key is ``k`` such
cells together with label and length; ``plan`` takes k from the number of vectors (so that a bucket holds few
unrelated ones) and the number of tables from the wanted miss rate of a pair at distance r.

Work stays linear in the size of a group of near copies:

1. equal vectors of a label collapse to one node with a weight;
2. a bucket of many nodes forms a ball: nodes within r / 2 of the direction of its mean.  Two members of a ball
   are within r of each other by the triangle inequality, so they are links without being held together;
3. in a bucket with several balls each member outside its largest ball (a guest) is held against the members of
   other balls.  Members and guests are dealt into cells of at most ``CELL`` on either side, so neither a task
   nor a group grows with the bucket.  A pair counts in the first table in which it meets; only counts and one
   link per node leave the cell, never pairs.

Links are confirmed in double precision: dot(x, y) / (|x| |y|) >= c.  Components are contracted links of balls.

Defined cases: a null, empty or zero vector, one with a null, NaN or infinite component, and a null label link
with nothing (component: its own id).  Vectors of different length never link.  Every row is a vector: repeated
rows link with each other.  A null id takes part; a component is named by its smallest non-null id (null if it
has none).  Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise
from .components import components
from .shingles import mix

COSINE = 0.98
WIDTH = 8.0
MISS = 1e-6
CELL = 512
BALL_NODES = 16
MARGIN = 1e-6
SEED = 20240311


def collision(width: float, distance: float) -> float:
    """Probability that one projection puts two points at this distance into one cell."""
    t = width / distance
    normal = 0.5 * (1 + math.erf(-t / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(projections per table, tables) for n vectors: about one unrelated vector per bucket at most, and a pair
    at the threshold is missed with probability ``miss``."""
    r = math.sqrt(2 - 2 * cosine)
    near, far = collision(WIDTH * r, r), collision(WIDTH * r, math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near ** k))


def _double(value) -> np.ndarray | None:
    """The vector as doubles, or None if it links with nothing."""
    if value is None or not len(value) or any(x is None for x in value):
        return None
    v = np.array(value, np.float64) + 0.0  # -0.0 becomes 0.0
    return v if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # no overflow of the squares
    return v / math.sqrt(v @ v)


def read_vectors(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, digest, vec): vec is the unit vector as little-endian doubles; digest tells label and vector apart and is
    null where the row links with nothing."""
    def run(frames):
        for batch in frames:
            digests, units = [], []
            for label, value in zip(batch.column("label").to_pylist(), batch.column("vec").to_pylist()):
                v = None if label is None else _double(value)
                name = None if label is None else label.encode()
                digests.append(None if v is None else hashlib.blake2b(len(name).to_bytes(8, "little") + name + v.tobytes(), digest_size=16).digest())
                units.append(None if v is None else unit(v).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                                             names=["vec_id", "label", "digest", "vec"])

    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vec"))
    return plain.mapInArrow(run, "vec_id long, label string, digest binary, vec binary")


def hash_tables(nodes: DataFrame, cosine: float, k: int, tables: int, seed: int = SEED) -> DataFrame:
    """``nodes`` plus ``codes``: the bucket of the node in each table (label, length and table are part of the code)."""
    width = WIDTH * math.sqrt(2 - 2 * cosine)

    def run(frames):
        lines: dict = {}  # projections of each length, drawn from the seed alone
        table = mix(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in frames:
            codes = []
            for label, raw in zip(batch.column("label").to_pylist(), batch.column("vec").to_pylist()):
                v = np.frombuffer(raw, "<f8")
                if len(v) not in lines:
                    rng = np.random.default_rng([seed, len(v)])
                    lines[len(v)] = rng.standard_normal((tables * k, len(v))), rng.uniform(0, width, tables * k)
                directions, shift = lines[len(v)]
                cells = np.floor((directions @ v + shift) / width).astype(np.int64).view(np.uint64).reshape(tables, k)
                name = np.uint64(int.from_bytes(hashlib.blake2b(label.encode(), digest_size=8).digest(), "little"))
                code = mix(table + name + np.uint64(len(v)))
                for i in range(k):
                    code = mix(code * np.uint64(0x9E3779B97F4A7C15) + cells[:, i])
                codes.append(code.view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])

    return nodes.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in nodes.dtypes)}, codes array<long>")


def _balls(members: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(node, ball) of the nodes within half the link distance of the mean direction of one of their larger buckets;
    ball is its smallest node.  A node joins the ball whose centre is nearest."""
    half = math.sqrt(2 - 2 * cosine) / 2 - MARGIN
    large = members.where(F.col("n") >= BALL_NODES).select("key", "node").join(nodes.select("node", "vec"), "node")

    def partial(frames):
        for batch in frames:
            total: dict = {}
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("vec").to_pylist()):
                v = np.frombuffer(raw, "<f8")
                total[key] = total[key] + v if key in total else v
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                                             names=["key", "part"])

    parts = large.mapInArrow(partial, "key long, part array<double>")
    sums = parts.select("key", F.posexplode("part").alias("i", "x")).groupBy("key", "i").agg(F.sum("x").alias("x"))
    centres = sums.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centre"))

    def reach(frames):
        for batch in frames:
            out = []
            for raw, centre in zip(batch.column("vec").to_pylist(), batch.column("centre").to_pylist()):
                c = np.array(centre)
                d = math.inf if not c.any() else float(np.sqrt(((np.frombuffer(raw, "<f8") - unit(c)) ** 2).sum()))
                out.append(d if d <= half else None)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("key"), pa.array(out, pa.float64())], names=["node", "key", "d"])

    near = large.join(centres, "key").mapInArrow(reach, "node long, key long, d double").where("d is not null")
    home = materialise(near.groupBy("node").agg(F.min(F.struct("d", "key")).alias("x")).select("node", F.col("x.key").alias("key")), "cosine-home")
    return home.join(home.groupBy("key").agg(F.min("node").alias("ball")), "key").select("node", "ball")


def _cells(members: DataFrame, balls: DataFrame) -> DataFrame:
    """(key, i, j, t, node, ball, guest): members and guests of the buckets that hold several balls, dealt into cells
    (i, j) of at most about ``CELL`` members and ``CELL`` guests; a guest comes to every share i of the members."""
    placed = members.join(balls, "node", "left").select("key", "t", "node", "n", F.coalesce("ball", "node").alias("ball"))
    sizes = placed.groupBy("key", "ball").agg(F.count("*").alias("m"))
    top = sizes.groupBy("key").agg(F.max(F.struct("m", "ball")).alias("x"), F.count("*").alias("k")).where("k > 1").select(
        "key", F.col("x.ball").alias("top"), F.col("x.m").alias("m"))
    rows = placed.join(top, "key")
    rows = rows.withColumns({"i": F.ceil(F.col("n") / F.lit(CELL)), "j": F.ceil((F.col("n") - F.col("m")) / F.lit(CELL)),
                             "guest": F.col("ball") != F.col("top")})
    def share(n):
        return F.pmod(F.xxhash64("node"), F.col(n))

    def every(n):
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    own = rows.select("key", "t", "node", "ball", F.lit(False).alias("visits"), "guest", share("i").alias("i"), F.explode(every("j")).alias("j"))
    guests = rows.where("guest").select("key", "t", "node", "ball", F.lit(True).alias("visits"), "guest", F.explode(every("i")).alias("i"), share("j").alias("j"))
    return own.select(guests.columns).union(guests)


def _meet(cells: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(node, n, ball, other): links of a node counted in a cell and a ball that it is linked with through them.
    Rows stream in cell order, the members first; a task holds the members of one cell and one batch of guests."""
    def cut(rows, chosen):
        return {"node": [rows["node"][x] for x in chosen], "ball": np.array([rows["ball"][x] for x in chosen]),
                "weight": np.array([rows["weight"][x] for x in chosen]), "guest": np.array([rows["guest"][x] for x in chosen]),
                "vec": np.frombuffer(b"".join(rows["vec"][x] for x in chosen), "<f8").reshape(len(chosen), -1),
                "codes": np.array([rows["codes"][x] for x in chosen])}

    def join(parts):
        return {k: sum((p[k] for p in parts), []) if k == "node" else np.concatenate([p[k] for p in parts]) for k in parts[0]}

    def met(own, come, t):
        linked = (come["vec"] @ own["vec"].T >= cosine) & (come["ball"][:, None] != own["ball"][None, :])
        for s in range(t):  # counted in an earlier table
            if not linked.any():
                return
            linked &= come["codes"][:, s][:, None] != own["codes"][:, s][None, :]
        if not linked.any():
            return
        # smallest ball of each connected part of the cell: one link per node instead of all pairs
        a, b, none = come["ball"].copy(), own["ball"].copy(), np.iinfo(np.int64).max
        while True:
            a2 = np.minimum(a, np.where(linked, b[None, :], none).min(axis=1))
            b2 = np.minimum(b, np.where(linked, a2[:, None], none).min(axis=0))
            if (a2 == a).all() and (b2 == b).all():
                break
            a, b = a2, b2
        counts = linked @ own["weight"]
        for x in np.flatnonzero(linked.any(axis=1)):
            yield come["node"][x], int(counts[x]), int(come["ball"][x]), int(a[x])
        counts = come["weight"] @ linked
        for x in np.flatnonzero(linked.any(axis=0)):  # a member that is a guest itself counts where it visits
            yield own["node"][x], 0 if own["guest"][x] else int(counts[x]), int(own["ball"][x]), int(b[x])

    def run(frames):
        cell, parts, own = None, [], None
        for batch in frames:
            rows = {c: batch.column(c).to_pylist() for c in ("key", "i", "j", "t", "visits", "guest", "node", "ball", "weight", "vec", "codes")}
            named = list(zip(rows["key"], rows["i"], rows["j"], rows["visits"]))
            starts = [x for x in range(len(named)) if not x or named[x] != named[x - 1]] + [len(named)]
            found = []
            for s, e in zip(starts, starts[1:]):
                if named[s][:3] != cell:
                    cell, parts, own = named[s][:3], [], None
                group = cut(rows, range(s, e))
                if not named[s][3]:
                    parts.append(group)
                elif parts:
                    own = own or join(parts)
                    found.extend(met(own, group, rows["t"][s]))
            yield pa.RecordBatch.from_arrays([pa.array([f[x] for f in found], pa.int64()) for x in range(4)], names=["node", "n", "ball", "other"])

    rows = cells.join(nodes.select("node", "weight", "vec", "codes"), "node")
    return (rows.select("key", "i", "j", "t", "visits", "guest", "node", "ball", "weight", "vec", "codes").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j", "visits").mapInArrow(run, "node long, n long, ball long, other long"))


def groups(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, id_col: str = "vec_id", label_col: str = "label",
           vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id."""
    spark = vectors.sparkSession
    read = read_vectors(vectors, id_col, label_col, vector_col)
    rows = materialise(read.select("vec_id", "digest"), "cosine-rows")
    # one node for each different vector of a label; its number is fixed by being written
    nodes = materialise(read.where("digest is not null").groupBy("digest").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first_id"), F.first("label").alias("label"), F.first("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "cosine-nodes")
    k, tables = plan(nodes.count(), cosine, miss)
    hashed = materialise(hash_tables(nodes.select("node", "weight", "label", "vec"), cosine, k, tables), "cosine-codes")
    keys = hashed.select("node", F.posexplode("codes").alias("t", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")  # the others meet nobody
    members = materialise(keys.join(shared, "key"), "cosine-members")
    balls = materialise(_balls(members, hashed, cosine), "cosine-balls")
    met = materialise(_meet(_cells(members, balls), hashed, cosine), "cosine-met")
    links = met.where("ball <> other").select(F.col("ball").alias("a"), F.col("other").alias("b")).distinct()
    labels = materialise(components(links), "cosine-labels")

    counted = met.groupBy("node").agg(F.sum("n").alias("n"))
    homed = (nodes.join(balls, "node", "left").withColumn("ball", F.coalesce("ball", "node"))
             .join(counted, "node", "left").join(labels.withColumnRenamed("node", "ball"), "ball", "left")
             .select("digest", "weight", "first_id", "ball", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "ball").alias("component")))
    inside = homed.groupBy("ball").agg(F.sum("weight").alias("inside"))
    heads = homed.groupBy("component").agg(F.min("first_id").alias("head"))
    named = homed.join(inside, "ball").join(heads, "component").select(
        "digest", (F.col("inside") - 1 + F.col("n")).alias("n_links"), "head")
    out = rows.join(named, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("head")).alias("component_id"))
    forget(spark, members)
    return out


# All pairs of a label in DuckDB.
SQL = """
WITH RECURSIVE
v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NOT NULL AND isfinite(x)]) = len(e)
      AND len([x for x in e if x <> 0]) > 0),
edge AS (SELECT a.r AS x, b.r AS y FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
         WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT r, r AS other FROM v UNION SELECT reach.r, edge.y FROM reach JOIN edge ON edge.x = reach.other),
least_id AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.other GROUP BY reach.r),
degree AS (SELECT x, count(*) AS n FROM edge GROUP BY x)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least_id ON least_id.r = v.r LEFT JOIN degree ON degree.x = v.r
"""
