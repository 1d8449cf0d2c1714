"""Benchmark decontamination: prefix-filtered set join of benchmark windows with documents.

A benchmark item is cut into windows of 10 consecutive words (an item with fewer words is one window).
A window counts as contained only when all its words stand in the document in order, so of its
shingles (runs of 4 words, or the whole window if shorter) every one must occur.  For a containment
of 1 the necessary prefix is a single shingle: windows are indexed under their rarest shingle, rarity
being the number of occurrences in the documents themselves.  A document position whose shingle is a
prefix token proposes one window start (position minus the shingle's offset in the window); the
positional and length bounds drop starts before the text or windows that run past its end, and the
rest is compared word by word.

The benchmark is joined in blocks of at most ``BLOCK_WINDOWS`` windows: one block is what is held on
the driver and broadcast, so a benchmark of any size runs in bounded memory, and documents are never
shuffled.  The first pass counts the benchmark's shingles in the documents (partial sums per task),
the second applies the join.

Defined cases: null and empty texts have no words and are clean; items without words have no window;
items repeated under one id count once; an item with a null id still marks words but is not listed;
repeated documents are judged row by row; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialise, whole_text
from .shingles import WordHashes, windows

WINDOW = 10
SHINGLE = 4
BLOCK_WINDOWS = 100_000

# Fixed rule: word bytes are 0-9, a-z (A-Z lowered) and all of 0x80 and above; the others separate.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str) -> list:
    return text.encode().translate(_WORD_BYTES).split()


def item_windows(item_words: list) -> list:
    """The windows of one item as tuples of words."""
    k = min(WINDOW, len(item_words))
    return [tuple(item_words[i:i + k]) for i in range(len(item_words) - k + 1)] if k else []


class Index:
    """One block of windows, found by shingle."""

    def __init__(self, item_rows: list):
        """``item_rows``: (item_id or None, text) rows of one block."""
        self.items: dict = {}  # window -> ids
        for item, text in item_rows:
            for w in item_windows(words(text)):
                self.items.setdefault(w, set()).add(item)
        self.windows = sorted(self.items)
        cache = WordHashes()
        self.by_size: dict = {}  # shingle size -> (sorted shingles, bitmap)
        self.shingles = []  # per window: (size, array of its shingles)
        for w in self.windows:
            k = min(SHINGLE, len(w))
            self.shingles.append((k, windows(cache.of(list(w)), k)))
        for k in {k for k, _ in self.shingles}:
            self.by_size[k] = _lookup(np.unique(np.concatenate([s for j, s in self.shingles if j == k])))
        self.prefix: dict = {}

    def set_prefixes(self, counts: dict) -> None:
        """Index every window under its rarest shingle (ties: the smallest hash)."""
        self.prefix, table = {}, {}
        for i, (k, s) in enumerate(self.shingles):
            at = min(range(len(s)), key=lambda j: (counts.get((k, int(s[j])), 0), int(s[j])))
            table.setdefault((k, int(s[at])), []).append((i, at))
        for k in self.by_size:
            self.by_size[k] = _lookup(np.array(sorted(h for j, h in table if j == k), np.uint64))
        self.prefix = table
        del self.shingles

    def positions(self, hashes: np.ndarray, k: int) -> tuple:
        """Positions in the text whose k-word shingle is indexed, and those shingles."""
        keys, bits = self.by_size[k]
        s = windows(hashes, k)
        at = np.flatnonzero(bits[(s >> np.uint64(44)).astype(np.int64)])
        s = s[at]
        slot = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
        real = keys[slot] == s
        return at[real], s[real]

    def matches(self, text_words: list, hashes: np.ndarray) -> list:
        """(start, window number) of every occurrence in one text."""
        out, n = [], len(text_words)
        for k in self.by_size:
            if n < k:
                continue
            for p, h in zip(*(a.tolist() for a in self.positions(hashes, k))):
                for i, offset in self.prefix[(k, h)]:
                    w, start = self.windows[i], p - offset
                    if 0 <= start <= n - len(w) and tuple(text_words[start:start + len(w)]) == w:
                        out.append((start, i))
        return out


def _lookup(keys: np.ndarray) -> tuple:
    """Sorted keys and a bitmap over their top 20 bits."""
    bits = np.zeros(1 << 20, bool)
    bits[(keys >> np.uint64(44)).astype(np.int64)] = True
    return keys, bits


def _count_shingles(docs: DataFrame, index: Index, text_col: str) -> dict:
    """Occurrences in the documents of the block's shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(frames):
        cache, own = WordHashes(), shared.value
        sums = {k: np.zeros(len(keys), np.int64) for k, (keys, _) in own.by_size.items()}
        for batch in frames:
            for text in batch.column(0).to_pylist():
                hashes = cache.of(words(text))
                for k in sums:
                    found = own.positions(hashes, k)[1]
                    if len(found):
                        np.add.at(sums[k], np.searchsorted(own.by_size[k][0], found), 1)
        for k, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(own.by_size[k][0][at].view(np.int64)), pa.array(c[at])],
                                             names=["k", "shingle", "n"])

    rows = (docs.select(whole_text(text_col).alias("text")).mapInArrow(run, "k int, shingle long, n long")
            .groupBy("k", "shingle").agg(F.sum("n").alias("n")).collect())  # at most the block's shingles
    shared.unpersist()
    return {(r["k"], r["shingle"] % (1 << 64)): r["n"] for r in rows}


def _block_rows(items: DataFrame, blocks: int, number: int) -> list:
    part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number) if blocks > 1 else items
    return [(r["item"], r["text"]) for r in part.orderBy("item", "text").collect()]


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
         out: str = "found", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All columns plus the struct ``out``: n_words, the hit word spans (start, end), items (ids as strings, sorted)."""
    named = items.select(F.col(item_id).cast("string").alias("item"), whole_text(item_text).alias("text"))
    # a text of n characters has less than n windows
    size = named.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(size // block_windows) + 1)
    spans, ids, count = fresh(docs, "__spans"), fresh(docs, "__items"), fresh(docs, "__n_words")
    df = docs.withColumns({spans: F.lit(None).cast("array<struct<s:int,e:int>>"), ids: F.lit(None).cast("array<string>"),
                           count: F.lit(0).cast("long")})
    text = fresh(df, "__text")
    for number in range(blocks):
        index = Index(_block_rows(named, blocks, number))
        if index.windows:
            index.set_prefixes(_count_shingles(docs, index, text_col))
        df = _apply(df.withColumn(text, whole_text(text_col)), index, text, spans, ids, count).drop(text)
        if blocks > 1 and number < blocks - 1:
            df = materialise(df, "decontam-block")
    return df.withColumn(out, F.struct(
        F.col(count).alias("n_words"), F.coalesce(spans, F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
        F.sort_array(F.coalesce(ids, F.array().cast("array<string>"))).alias("items"))).drop(spans, ids, count)


def _apply(df: DataFrame, index: Index, text: str, spans: str, ids: str, count: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(index)
    at = {c: df.columns.index(c) for c in (text, spans, ids, count)}
    span_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def merged(old, new):
        out = []
        for s, e in sorted([(x["s"], x["e"]) for x in old or ()] + new):
            if out and s <= out[-1]["e"]:
                out[-1]["e"] = max(e, out[-1]["e"])
            else:
                out.append({"s": s, "e": e})
        return out

    def run(frames):
        cache, own = WordHashes(), shared.value
        for batch in frames:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            got_spans, got_ids, got_n = [], [], []
            for t, old, names in zip(cols[at[text]].to_pylist(), cols[at[spans]].to_pylist(), cols[at[ids]].to_pylist()):
                w = words(t)
                hits = own.matches(w, cache.of(w)) if w and own.windows else []
                got_n.append(len(w))
                got_spans.append(merged(old, [(s, s + len(own.windows[i])) for s, i in hits]) if hits else old)
                new = {x for _, i in hits for x in own.items[own.windows[i]] if x is not None}
                got_ids.append(sorted(new | set(names or ())) if new else names)
            cols[at[spans]], cols[at[ids]] = pa.array(got_spans, span_type), pa.array(got_ids, pa.list_(pa.string()))
            cols[at[count]] = pa.array(got_n, pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.mapInArrow(run, schema)


def n_hit(found: str = "found"):
    """Words inside the merged spans."""
    return F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pipeline form: documents without a benchmark window, with the columns of ``docs``."""
    out = fresh(docs, "__found")
    return find(docs, items, out=out).where(F.size(f"{out}.spans") == 0).drop(out)
