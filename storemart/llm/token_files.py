"""Token ids as patched frame-of-reference files.

Format.  A shard is one range of documents in ascending doc_id order; its ids are cut into segments of
whole documents.  A segment is one binary value:

    magic "PFOR1", block size, number of ids, number of blocks        (header)
    byte position of each block and of the end                        (index of block starts)
    blocks: minimum, width, number of exceptions, packed low bits, exception places, exception values

Within a block of ``BLOCK`` ids the block minimum is subtracted; the width is what ``PERCENTILE`` per
cent of the differences need; the differences' low bits are packed at that width, and those that need
more are patched from the exception list.  The index of block starts gives random access: a range of
ids decodes only its own blocks.

Segments are rows of a Parquet table (shard, segment, start of the segment in its shard, the documents'
ids and lengths, payload), because Spark's writers commit a task's output whole or not at all on any
shared store, also when an executor is lost or a task runs twice.

The writer shuffles the texts once by doc_id range, encodes inside each range in order, and holds one
segment at a time.  Ties (rows with one doc_id) are ordered by text.  Null doc_ids come first.  A null
text is the empty text: only the end id is written.  An empty table gives an empty file table.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import whole_text

TOKENIZER = "word_bpe_49k.json"
BLOCK = 2048
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
ROWS = 200  # texts taken from an Arrow batch at a time
_HEAD = struct.Struct("<5sIQI")
_BLOCK_HEAD = struct.Struct("<IBI")
SCHEMA = ("shard int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary")


def pack_block(ids: np.ndarray) -> bytes:
    """One block: frame of reference with patched outliers."""
    low = ids.min()
    diff = ids - low
    width = int(np.partition(diff, k := (len(diff) - 1) * PERCENTILE // 100)[k]).bit_length()
    places = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = ((diff[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return (_BLOCK_HEAD.pack(int(low), width, len(places)) + np.packbits(bits.reshape(-1), bitorder="little").tobytes()
            + places.astype("<u2").tobytes() + diff[places].astype("<u4").tobytes())


def unpack_block(data: memoryview, n: int) -> np.ndarray:
    low, width, patched = _BLOCK_HEAD.unpack_from(data)
    at = _BLOCK_HEAD.size
    packed = (n * width + 7) // 8
    diff = np.zeros(n, np.uint32)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, packed, at), bitorder="little", count=n * width).reshape(n, width)
        for k in range(width):
            diff |= bits[:, k].astype(np.uint32) << np.uint32(k)
    places = np.frombuffer(data, "<u2", patched, at + packed)
    diff[places] = np.frombuffer(data, "<u4", patched, at + packed + 2 * patched)
    return diff + np.uint32(low)


def pack(ids: np.ndarray) -> bytes:
    """A segment of unsigned 32-bit ids."""
    blocks = [pack_block(ids[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return _HEAD.pack(b"PFOR1", BLOCK, len(ids), len(blocks)) + starts.tobytes() + b"".join(blocks)


def unpack(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a segment; only their blocks are decoded."""
    magic, block, n, n_blocks = _HEAD.unpack_from(segment)
    if magic != b"PFOR1":
        raise ValueError("not a token segment")
    last = n if last is None else min(last, n)
    starts = np.frombuffer(segment, "<u8", n_blocks + 1, _HEAD.size).astype(np.int64) + _HEAD.size + 8 * (n_blocks + 1)
    view = memoryview(segment)
    if first >= last:
        return np.empty(0, np.uint32)
    numbers = range(first // block, (last - 1) // block + 1)
    ids = np.concatenate([unpack_block(view[starts[b]:starts[b + 1]], min(block, n - b * block)) for b in numbers])
    return ids[first - numbers[0] * block:last - numbers[0] * block]


_CHUNK = 1 << 19  # bytes of text worked on at a time (a longer word is a chunk of its own)
_KIND = np.array([1 if c in b" \t\n\x0b\x0c\r" else 2 if chr(c).isalnum() else 3 if 32 < c < 127 else 0 for c in range(128)] + [0] * 128, np.uint8)
_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
_LONG = 64  # longer words are not remembered
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 1 << 62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2 to the 64."""
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each word of a byte array, by prefix sums of a polynomial in an odd base."""
    n = -(-(len(data) + 1) // _CHUNK) * _CHUNK  # few different sizes: the powers are kept
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.multiply(_VALUE[data], _powers(_BASE, n)[:len(data)], out=prefix[1:])
    np.cumsum(prefix, out=prefix)
    hashes = prefix[stop]
    hashes -= prefix[start]
    hashes *= _powers(_UNBASE, n)[start]
    return hashes


class Strings:
    """A growing list of short arrays of one type, end to end in one buffer."""

    def __init__(self, dtype):
        self.flat, self.at, self.n = np.empty(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used, n = int(self.at[self.n]), self.n + len(lengths)
        if used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.empty((used + 3 * len(flat)) // 2, self.flat.dtype)])
        if n >= len(self.at):
            self.at = np.concatenate([self.at[:self.n + 1], np.empty(n // 2 + len(lengths), np.int64)])
        self.flat[used:used + len(flat)] = flat
        self.at[self.n + 1:n + 1] = used + np.cumsum(lengths)
        self.n = n

    def gather(self, entry: np.ndarray, lengths: np.ndarray) -> tuple:
        """(the entries' first ``lengths`` values end to end, where each begins and all end)."""
        upto = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(self.at[entry] - upto[:-1], lengths)
        place += np.arange(upto[-1])
        return self.flat.take(place, mode="clip"), upto


class WordIds:
    """Ids of texts by the tokenizers library, which sees each new word once.

    Holds for tokenizers that drop ASCII white space and split letters and digits from marks (checked): a text's
    ids are the concatenation of its words' ids.  A word is cut further before each ASCII mark that follows an ASCII
    letter or digit, where a split always lies, unless it holds "|" (special tokens).  Words are found by numpy over the bytes of many texts and looked up by a 64-bit hash in a sorted array;
    every occurrence is then compared with the remembered bytes, so words that share a hash are told apart.
    Those and words of more than ``_LONG`` bytes go to the library each time.  Beyond ``remembered`` words (about
    70 bytes each) the table keeps the half at most that was met most often."""

    def __init__(self, path: str, remembered: int = 500_000):
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        split, normal = json.dumps(spec.get("pre_tokenizer")), json.dumps(spec.get("normalizer"))
        if '"Removed"' not in split or '"invert": true' not in split or "|[^\\\\s\\\\p{L}\\\\p{N}]+" not in split or '"Lowercase"' not in normal:
            raise ValueError("this tokenizer may join ids across words or marks")
        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.keys, self.entry = np.empty(0, np.uint64), np.empty(0, np.int32)  # sorted hashes, place in the lists
        self.words, self.ids, self.met = Strings(np.uint8), Strings(np.uint32), np.empty(0, np.int32)

    def _forget(self) -> None:
        """Keep the words met most often, half of ``remembered`` at most; what they were met before counts half from here on."""
        met = self.met[self.entry]
        least = 2
        while np.count_nonzero(met >= least) > self.remembered // 2:
            least *= 2
        stay = np.flatnonzero(met >= least)
        old, self.keys, self.entry, self.met = self.entry[stay], self.keys[stay], np.arange(len(stay), dtype=np.int32), met[stay] // 2
        for name in ("words", "ids"):
            strings = getattr(self, name)
            lengths = strings.at[old + 1] - strings.at[old]
            kept = Strings(strings.flat.dtype)
            kept.extend(strings.gather(old, lengths)[0], lengths)
            setattr(self, name, kept)

    def _ask(self, words: list) -> list:
        """The library's ids of each word."""
        out = []
        for i in range(0, len(words), 2_000):
            out.extend(e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words[i:i + 2_000]], add_special_tokens=False))
        return out

    def _learn(self, keys: np.ndarray, words: list) -> None:
        """Remember new words (their hashes ascending)."""
        ids = self._ask(words)
        entry = np.arange(self.words.n, self.words.n + len(words), dtype=np.int32)
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int32)])
        self.words.extend(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids.extend(np.fromiter(chain.from_iterable(ids), np.uint32, lengths.sum()), lengths)
        place = np.searchsorted(self.keys, keys)
        self.keys, self.entry = np.insert(self.keys, place, keys), np.insert(self.entry, place, entry)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 for none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.entry[place], -1)

    def encode(self, texts: list, end: int) -> list:
        """Unsigned 32-bit id arrays, each with the end id."""
        parts, chunk, owner, size = [[] for _ in texts], [], [], 0

        def flush():
            for i, ids in zip(owner, self._encode(chunk)):
                parts[i].append(ids)
            chunk.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for piece in _pieces(text.encode()):
                if chunk and size + len(piece) > _CHUNK:
                    flush()
                    size = 0
                chunk.append(piece)
                owner.append(i)
                size += len(piece) + 1
        if chunk:
            flush()
        last = np.array([end], np.uint32)
        return [np.concatenate([*p, last]) for p in parts]

    def _encode(self, texts: list) -> list:
        joined = b"\n".join(texts) + b"\n"
        data = np.frombuffer(joined, np.uint8)
        kind = _KIND[data]
        space = kind == 1
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1  # words begin and end in turn
        if not space[0]:
            edge = np.concatenate([[0], edge])
        start, stop = edge[0::2], edge[1::2]
        cut = np.flatnonzero((kind[:-1] == 2) & (kind[1:] == 3)) + 1
        bars = np.flatnonzero(data == ord("|"))
        if len(bars):  # these words may hold a special token
            barred = np.zeros(len(start) + 1, bool)
            barred[np.searchsorted(start, bars, "right")] = True
            cut = cut[~barred[np.searchsorted(start, cut, "right")]]
        start, stop = (np.sort(np.concatenate([a, cut]), kind="stable") for a in (start, stop))
        size = stop - start
        keys, first, number, times = np.unique(word_hashes(data, start, stop), return_index=True, return_inverse=True, return_counts=True)
        if self.words.n > self.remembered:
            self._forget()
        found = self._find(keys)
        new = np.flatnonzero((found < 0) & (size[first] <= _LONG))
        if len(new):
            self._learn(keys[new], [joined[a:b] for a, b in zip(start[first[new]].tolist(), stop[first[new]].tolist())])
            found = self._find(keys)
        self.met[found[found >= 0]] += times[found >= 0]
        entry = found[number]
        # every occurrence against the remembered bytes; what differs, and long words, go to the library
        known = (entry >= 0) & (self.words.at[entry + 1] - self.words.at[entry] == size)
        entry[~known] = 0
        stored, begin = self.words.gather(entry, size)
        wrong = np.flatnonzero(stored != data[~space])
        known[np.searchsorted(begin, wrong, "right") - 1] = False
        asked = np.flatnonzero(~known)
        answers = self._ask([joined[start[i]:stop[i]] for i in asked.tolist()])
        many = self.ids.at[entry + 1] - self.ids.at[entry]
        many[asked] = [len(a) for a in answers]
        ids, upto = self.ids.gather(entry, many)
        for i, a in zip(asked.tolist(), answers):
            ids[upto[i]:upto[i + 1]] = a
        # words before each text's end, then ids before it
        cut = upto[np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))].tolist()
        return [ids[a:b] for a, b in zip([0, *cut], cut)]


def _pieces(text: bytes):
    """A text in pieces of about ``_CHUNK`` bytes at most, cut at white space only."""
    at = 0
    while len(text) - at > _CHUNK:
        gap = _GAP.search(text, at + _CHUNK)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:] if at else text


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One table of words for all tasks that a Python worker runs one after the other."""
    return WordIds(path)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the file table of all documents to ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(frames):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder, shard = word_ids(tokenizer), TaskContext.get().partitionId()
        segment = start = held = 0
        doc_ids, parts = [], []

        def close():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())), pa.array([pack(ids)], pa.binary())],
                names=["shard", "segment", "start", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in frames:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                for doc_id, ids in zip(rows.column("id").to_pylist(), encoder.encode(rows.column("text").to_pylist(), end_id)):
                    doc_ids.append(doc_id)
                    parts.append(ids)
                    held += len(ids)
                    if held >= SEGMENT_IDS:
                        yield close()
                        segment, start, held, doc_ids, parts = segment + 1, start + held, 0, [], []
        if parts:
            yield close()
        pa.default_memory_pool().release_unused()  # the worker stays

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    # the text's hash spreads rows of one id over ranges
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    (rows.withColumn("h", F.xxhash64("text")).repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
     .select("id", "text").mapInArrow(run, SCHEMA).write.parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file table, in no special order: doc_id, start (ids of all documents
    before it), n_tokens, ids (unsigned 32-bit little endian)."""
    def run(frames):
        for batch in frames:
            for doc_ids, lengths, payload, start in zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "lengths", "payload", "start"))):
                data = unpack(payload).tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + starts), pa.array(lengths, pa.int64()),
                     pa.array([data[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    table = spark.read.schema(SCHEMA).parquet(path)
    # one row per shard: bounded by the number of ranges
    before = table.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return table.join(F.broadcast(before), "shard").select("doc_ids", "lengths", "payload", (F.col("start") + F.col("before")).alias("start")).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
