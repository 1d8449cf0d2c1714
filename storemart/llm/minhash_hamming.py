"""Near-duplicate groups: multi-index Hamming join over b-bit MinHash signatures.

A document's signature holds 64 symbols of 16 bits, one per MinHash permutation.  Two sets with
Jaccard 0.8 differ in 13 of 64 symbols on average; the join takes every pair that differs in 31 or
fewer (a pair at 0.8 has more with probability below 1e-7).  By the pigeonhole principle, of 16
chunks of 4 symbols one has at most floor(31 / 16) = 1 error, so each chunk is indexed under its 4
one-symbol-deleted variants: all pairs within 31 errors share at least one of 64 keys.

Work is kept linear in the size of a bucket:

1. documents with equal shingle sets collapse to one node (a 128-bit digest of the whole set);
2. every node is held against the nearest leader of its buckets (a bucket's most central member)
   and confirmed on the full sets; these links are contracted to components;
3. buckets that still hold several components are completed exactly: each member outside the
   bucket's largest component meets every member of another component, block by block, and only
   confirmed links leave the task.  Members of one component need no further links, so a group of
   n near copies costs n pairs, not n squared.

Confirmation intersects the full sorted sets of 64-bit shingle hashes: 100 * |A and B| >= 80 * |A or B|.

Defined cases: null, empty and wordless texts have an empty set and link with nothing (their own
component); repeated rows and equal texts share a node; a null doc_id takes part like any other and
the component is named by the smallest non-null doc_id; extra columns are ignored, or kept by
``keep_one``.  Rows that share a doc_id but not a text are separate documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, forget, fresh, materialise, whole_text
from .components import components
from .shingles import WordHashes, mix, shingle_set

SYMBOLS = 64
CHUNK = 4
CHUNKS = SYMBOLS // CHUNK
MAX_ERRORS = 31
BLOCK = 1024
_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
assert MAX_ERRORS // CHUNKS == 1  # one error per chunk is enumerated below


def signature(shingles: np.ndarray) -> np.ndarray:
    """64 symbols of 16 bits; numpy works through the set in slices, so memory stays bounded."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        low = np.minimum(low, (_MULT[:, None] * shingles[None, i:i + 512] + _ADD[:, None]).min(axis=1))
    return (mix(low) & np.uint64(0xFFFF)).astype("<u2")


def _sets(frames, k):
    """Each Arrow batch with its rows' sorted shingle sets and their digests (None for empty sets)."""
    cache = WordHashes()
    for batch in frames:
        sets = [shingle_set(cache.of(t.encode().translate(LOWER_AZ).split()), k) for t in batch.column("text").to_pylist()]
        yield batch, sets, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def signatures(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, sig) of every row; digest and sig are null for empty sets."""
    def run(frames):
        for batch, sets, digests in _sets(frames, shingle):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "digest", "sig"])

    text = whole_text(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, digest binary, sig binary")


def index_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): 64 keys for each node, one for each chunk and deleted symbol.  A key packs the
    chunk number, the deleted place and the three symbols left, so equal keys are equal variants."""
    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            sig = np.frombuffer(b"".join(pdf["sig"]), "<u2").reshape(-1, CHUNKS, CHUNK).astype(np.int64)
            keys = np.empty((len(pdf), CHUNKS, CHUNK), np.int64)
            for gone in range(CHUNK):
                a, b, c = (sig[:, :, j] for j in range(CHUNK) if j != gone)
                keys[:, :, gone] = (((np.arange(CHUNKS) * CHUNK + gone)[None, :] << 48) | (a << 32) | (b << 16) | c)
            yield pd.DataFrame({"key": keys.reshape(-1), "node": np.repeat(pdf["node"].to_numpy(), CHUNKS * CHUNK)})

    return nodes.select("node", "sig").mapInPandas(run, "key long, node long")


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) within the signature distance, with that distance."""
    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            x, y = (np.frombuffer(b"".join(pdf[c]), "<u2").reshape(-1, SYMBOLS) for c in ("sig_a", "sig_b"))
            pdf = pdf[["a", "b"]].assign(errors=(x != y).sum(axis=1).astype(np.int32))
            yield pdf[pdf["errors"] <= MAX_ERRORS]

    side = lambda c: nodes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            # sets within 0.8 of each other differ in size by no more than that
            .where("100 * least(n_a, n_b) >= 80 * greatest(n_a, n_b)")
            .select("a", "b", "sig_a", "sig_b").mapInPandas(run, "a long, b long, errors int"))


def _full_sets(docs: DataFrame, wanted: DataFrame, nodes: DataFrame, shingle: int, text_col: str, id_col: str) -> DataFrame:
    """(node, shingles) of the ``wanted`` nodes: their texts are read and shingled again."""
    def run(frames):
        for batch, sets, digests in _sets(frames, shingle):
            rows = [(n, s.tobytes()) for n, s, d, w in zip(batch.column("node").to_pylist(), sets, digests, batch.column("digest").to_pylist()) if d == w]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.binary())],
                                             names=["node", "shingles"])

    wanted = wanted.join(nodes.select("node", "digest", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")), "node")
    text = whole_text(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(text).alias("__hash"), text.alias("text"))
    found = texts.join(wanted, texts["__hash"].eqNullSafe(wanted["__hash"]) & texts["__id"].eqNullSafe(wanted["__id"]))
    sets = found.select("node", "digest", "text").mapInArrow(run, "node long, shingles binary")
    return materialise(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "near-sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    def run(frames):
        for pdf in frames:
            ok = []
            for x, y in zip(pdf["set_a"], pdf["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[ok, ["a", "b"]]

    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


def _leaders(members: DataFrame) -> DataFrame:
    """(key, lead): a bucket is led by its most central member, the one that shares the most keys with others."""
    central = members.groupBy("node").agg(F.sum("n").alias("weight"))
    return members.join(central, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("x")).select("key", F.col("x.node").alias("lead"))


def _first_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each node with the nearest leader of its buckets (``members`` with the column lead)."""
    pairs = members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    return _near(pairs, nodes).groupBy("b").agg(F.min(F.struct("errors", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")


def _open_meetings(members: DataFrame, labels: DataFrame) -> tuple:
    """Who still has to meet whom, without writing pairs out: (node, label, block) puts every member
    of a bucket with several components into one block of about ``BLOCK`` nodes, (node, block) names
    the blocks that a node outside its bucket's largest component has to be held against.  Of two
    such nodes, the one of the lower block visits the other."""
    rows = members.join(labels, "node", "left").select("key", "node", "n", "lead", F.coalesce("component", "node").alias("label"))
    sizes = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("x"), F.count("*").alias("k")).where("k > 1").select(
        "key", F.col("x.label").alias("top"))
    rows = materialise(rows.join(top, "key"), "near-open")
    # nodes are put together by the leader of their largest bucket, so that a large group lies in few blocks
    homes = rows.groupBy("node").agg(F.first("label").alias("label"), F.max(F.struct("n", "key", "lead")).alias("home")).select(
        "node", "label", F.col("home.lead").alias("lead"))
    size = homes.groupBy("lead").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / F.lit(BLOCK)))
    blocks = materialise(homes.join(size, "lead").select("node", "label", F.xxhash64("lead", part).alias("block")), "near-blocks")
    placed = rows.join(blocks.select("node", "block"), "node")
    there = placed.groupBy("key", "block").agg(F.bool_or(F.col("label") == F.col("top")).alias("has_top"))
    guests = placed.where("label <> top").select("key", "node", F.col("block").alias("own"))
    return blocks, materialise(_visits(guests, materialise(there, "near-there")), "near-meet"), rows


def _same_blocks(guests: DataFrame, there: DataFrame) -> tuple:
    """``guests`` (key, node, own) and ``there`` (key, block, has_top) with the blocks of a bucket in place of its key.  Near
    copies share up to 64 buckets that lie in the same blocks: such buckets ask the same of a guest and count once.  The blocks
    are named by their number and two sums of hashes, which merge."""
    name = there.groupBy("key").agg(F.count("*").alias("k"), *[
        F.sum(F.xxhash64(F.lit(i), "block", "has_top").cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)])
    named = lambda x, *columns: x.join(name, "key").select("k", "h0", "h1", *columns).distinct()
    return named(guests, "node", "own"), named(there, "block", "has_top")


def _visits(guests: DataFrame, there: DataFrame) -> DataFrame:
    """(node, block): the blocks that each guest has to be held against."""
    asked, held = _same_blocks(guests, there)
    return asked.join(held, ["k", "h0", "h1"]).where("has_top or block >= own").select("node", "block").distinct()


def _dealt(blocks: DataFrame, meet: DataFrame) -> DataFrame:
    """(node, label, block, part, guest): a block's guests are dealt to parts of about ``BLOCK``, each with all the block's
    members, so a block that very many nodes visit lies in many tasks."""
    parts = meet.groupBy("block").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    own = blocks.join(parts, "block").select("node", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                                             F.lit(False).alias("guest"))
    guests = meet.join(blocks.select("node", "label"), "node").join(parts, "block").select(
        "node", "label", "block", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), F.lit(True).alias("guest"))
    return own.union(guests)


def _meet(blocks: DataFrame, meet: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between the nodes of each block and the nodes that meet it.  Rows stream
    in the order of blocks and their parts, the block's own members first, so a task holds one block and one batch at a time."""
    def links(members, x_node, x_label, x_sig, x_set):
        close = ((members["sig"] != x_sig).sum(axis=1) <= MAX_ERRORS) & (members["label"] != x_label)
        if not close.any():
            return
        at = np.minimum(np.searchsorted(members["all"], x_set), len(members["all"]) - 1)
        mark = np.zeros(len(members["all"]), bool)
        mark[at[members["all"][at] == x_set]] = True
        both = np.add.reduceat(mark[members["flat"]].astype(np.int64), members["start"])
        ok = close & (100 * both >= percent * (members["size"] + len(x_set) - both))
        seen = set()
        for i in np.flatnonzero(ok):  # one link to each component is enough
            if members["label"][i] not in seen:
                seen.add(members["label"][i])
                yield int(x_node), int(members["node"][i])

    def table_of(rows):
        arrays = [np.frombuffer(r[4], np.uint64) for r in rows]
        every, flat = np.unique(np.concatenate(arrays), return_inverse=True)
        size = np.array([len(a) for a in arrays])
        return {"node": np.array([r[1] for r in rows]), "label": np.array([r[2] for r in rows]),
                "sig": np.frombuffer(b"".join(r[3] for r in rows), "<u2").reshape(-1, SYMBOLS),
                "all": every, "flat": flat.reshape(-1), "size": size, "start": np.concatenate([[0], np.cumsum(size)[:-1]])}

    def run(frames):
        block, own, ready = None, [], None
        for batch in frames:
            found = []
            cols = [batch.column(c).to_pylist() for c in ("block", "node", "label", "sig", "shingles", "guest", "part")]
            for row in zip(*cols):
                if (row[0], row[6]) != block:
                    block, own, ready = (row[0], row[6]), [], None
                if not row[5]:
                    own.append(row)
                    continue
                if ready is None:
                    ready = table_of(own)
                found.extend(links(ready, row[1], row[2], np.frombuffer(row[3], "<u2"), np.frombuffer(row[4], np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    facts = sets.join(nodes.select("node", "sig"), "node")
    rows = _dealt(blocks, meet).join(facts, "node")
    return (rows.select("block", "part", "node", "label", "sig", "shingles", "guest").repartition("block", "part")
            .sortWithinPartitions("block", "part", "guest").mapInArrow(run, "a long, b long"))


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, and keep_hash (the text_hash
    of the document that stands for the component)."""
    spark = docs.sparkSession
    rows = materialise(signatures(docs, shingle, id_col, text_col), "near-rows")
    # one node for each different set; its number is fixed by being written
    nodes = materialise(
        rows.where("digest is not null").groupBy("digest").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
            F.min("sig").alias("sig"), F.min("n_shingles").alias("n_shingles"))
        .select("digest", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), "sig", "n_shingles",
                F.monotonically_increasing_id().alias("node")), "near-nodes")
    keys = materialise(index_keys(nodes), "near-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")  # the others join with nothing
    found = materialise(keys.join(shared, "key"), "near-buckets")
    members = materialise(found.join(_leaders(found), "key"), "near-members")
    forget(spark, keys, found)

    sets_of = lambda wanted: _full_sets(docs, wanted, nodes, shingle, text_col, id_col)
    first = materialise(_first_pairs(members, nodes), "near-first")
    sets = sets_of(first.select(F.col("a").alias("node")).union(first.select(F.col("b").alias("node"))).distinct())
    links = materialise(confirm(first, sets, percent), "near-links")
    labels = materialise(components(links), "near-labels")
    forget(spark, sets, first)

    blocks, meet, rows_open = _open_meetings(members, labels)
    sets = sets_of(blocks.select("node"))
    links = links.union(_meet(blocks, meet, nodes, sets, percent))
    labels = materialise(components(links), "near-labels")
    forget(spark, members, rows_open, sets)

    named = nodes.join(labels, "node", "left").select("digest", "doc_id", "text_hash", F.coalesce("component", "node").alias("component"))
    heads = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("head"))
    by_digest = named.join(heads, "component").select("digest", F.col("head.doc_id").alias("head_id"), F.col("head.text_hash").alias("head_hash"))
    return rows.join(by_digest, "digest", "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("head_id")).alias("component_id"),
        F.when(F.col("digest").isNull(), F.col("text_hash")).otherwise(F.col("head_hash")).alias("keep_hash"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipeline form: one document of each group with the columns of ``docs``; exact repeats of its row go too."""
    h, i = fresh(docs, "__hash"), fresh(docs, "__id")
    wide = docs.withColumn(h, F.xxhash64(whole_text(text_col))).withColumn(i, F.col(id_col).cast("long"))
    kid, khash = fresh(wide, "__kid"), fresh(wide, "__khash")
    kept = (groups(docs, shingle, percent, id_col, text_col)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keep_hash")))
            .select(F.col("doc_id").alias(kid), F.col("text_hash").alias(khash)).distinct())
    return (wide.join(kept, F.col(h).eqNullSafe(F.col(khash)) & F.col(i).eqNullSafe(F.col(kid)), "left_semi")
            .dropDuplicates([i, h]).select(*docs.columns))
