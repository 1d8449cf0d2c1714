"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings resolves a pre-token that is a
vocabulary entry in one probe (slot, then a comparison of the stored bytes).  Tier two: the other
pre-tokens are merged with a heap of candidate pairs over a doubly linked list of byte runs, lowest
rank first.  Each task remembers the ids of pre-tokens it has met, up to a fixed number.

The vocabulary (about 50,000 entries, bounded by its file) is read on the driver, where the perfect
hash is built once, and broadcast.

Defined cases: a null text is the empty text (no ids, empty bytes); repeated rows are encoded row by
row; long texts are matched by the pattern as a whole; other columns pass through, one named like the
result is replaced.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, whole_text

VOCABULARY = "byte_bpe_50k.tiktoken"


def read_ranks(path: str) -> dict:
    """Token bytes -> rank of a rank file (base64 and number per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys, n slots, one displacement per bucket of about 4 keys."""

    def __init__(self, keys: list):
        n = self.n = len(keys)
        self.buckets = max(1, n // 4)
        by: dict = {}
        for k in keys:
            by.setdefault(xxhash.xxh3_64_intdigest(k) % self.buckets, []).append(k)
        self.shift = [0] * self.buckets
        taken = bytearray(n)
        self.slots: list = [None] * n
        for b, members in sorted(by.items(), key=lambda x: (-len(x[1]), x[0])):
            seed = 1
            while True:
                at = [xxhash.xxh3_64_intdigest(k, seed) % n for k in members]
                if len(set(at)) == len(at) and not any(taken[a] for a in at):
                    break
                seed += 1
            self.shift[b] = seed
            for k, a in zip(members, at):
                taken[a] = 1
                self.slots[a] = k

    def slot(self, key: bytes) -> int:
        """The slot of a member; of a stranger any slot."""
        return xxhash.xxh3_64_intdigest(key, self.shift[xxhash.xxh3_64_intdigest(key) % self.buckets]) % self.n


class Encoder(dict):
    """pre-token -> its ids as little-endian unsigned 32-bit bytes; unknown ones are worked out and remembered."""

    def __init__(self, ranks: dict, pattern: str = public_tokenizers.PATTERN, remembered: int = 300_000):
        super().__init__()
        self.ranks, self.pattern, self.limit = ranks, regex.compile(pattern), remembered
        self.whole = PerfectHash(sorted(ranks))
        self.ids = [ranks[k] for k in self.whole.slots]
        self.bytes_of = {i: k for k, i in ranks.items()}

    def __reduce__(self):
        return _restore, (self.ranks, self.pattern.pattern, self.limit, self.whole)

    def __missing__(self, token: str) -> bytes:
        piece = token.encode()
        at = self.whole.slot(piece)
        ids = [self.ids[at]] if self.whole.slots[at] == piece else self.merge(piece)
        if len(self) >= self.limit:
            self.clear()
        out = self[token] = np.array(ids, "<u4").tobytes()
        return out

    def merge(self, piece: bytes) -> list:
        """BPE of one piece: the pair of lowest rank (leftmost first) is merged until none is left."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # end of the run that starts here; 0: no run starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two runs has changed
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            p = before[i]
            if p >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        return b"".join([self[t] for t in self.pattern.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _restore(ranks, pattern, limit, whole):
    e = Encoder.__new__(Encoder)
    dict.__init__(e)
    e.ranks, e.pattern, e.limit, e.whole = ranks, regex.compile(pattern), limit, whole
    e.ids = [ranks[k] for k in whole.slots]
    e.bytes_of = {i: k for k, i in ranks.items()}
    return e


def _map_column(df: DataFrame, source: str, out: str, path: str, work) -> DataFrame:
    """Append the binary column ``out`` = work(encoder, value of ``source``); a column of that name is replaced."""
    if out in df.columns and out != source:
        df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(Encoder(read_ranks(path)))
    at = df.columns.index(source)

    def run(frames):
        encoder = shared.value
        for batch in frames:
            done = pa.array([work(encoder, v) for v in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, done], names=[*batch.schema.names, out])

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(out, T.BinaryType())])
    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", out: str = "ids") -> DataFrame:
    """All columns plus ``out``: the ids as little-endian unsigned 32-bit integers."""
    whole = fresh(docs, "__whole")
    df = docs.withColumn(whole, whole_text(text_col))
    return _map_column(df, whole, out, path or public_tokenizers.path(VOCABULARY), lambda e, t: e.encode(t)).drop(whole)


def decode(df: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """All columns plus ``out``: the bytes that the ids stand for."""
    return _map_column(df, ids_col, out, path or public_tokenizers.path(VOCABULARY), lambda e, v: e.decode(v or b""))


def digest(encoded: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the bytes decoded from them."""
    cols = ["doc_id", "ids"]
    df = decode(encoded.select(*cols), path)
    return df.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2("bytes", 256).alias("decoded_sha256"), *([F.col("ids")] if keep_ids else []))
