"""Token counts of whole texts for a sentencepiece BPE model, without encoding most of the text.

Whole-token shortcut: offline, once per model, every vocabulary string is merged on its own; those
that come out as one token are *proven*.  A text is cut only where no vocabulary string spans the cut
(checked against the vocabulary: nothing but the space mark may precede a space mark, no string holds
a line end), so the pieces between cuts encode independently.  A piece that is a proven string counts
1; only the rest is merged, after further cuts between characters that no vocabulary string holds
side by side.  Counts of pieces met before are remembered per worker, up to a fixed number.

The vocabulary is bounded by its file; it is prepared on the driver and broadcast.

Defined cases: a null or empty text has 0 tokens; strings of control tokens inside a text are ordinary
text; characters outside the vocabulary count one token per UTF-8 byte; repeated rows are counted row
by row; other columns pass through, one named like the result is replaced.
"""

from __future__ import annotations

import heapq
import re

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, whole_text

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_NONE = float("-inf")
#: Longest piece that is merged at once; a longer one is cut first and its parts go through the heap.
SHORT = 24
_PIECES = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


def read_scores(path: str) -> dict:
    """piece -> merge score of the model's ordinary pieces."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not skip(i)}


def merge(piece: str, scores: dict) -> list:
    """BPE over characters: the adjacent pair with the best score (leftmost first) is merged until none is left."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-s, i, i + 2) for i in range(n - 1) if (s := scores.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one side has grown or gone
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (s := scores.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (-s, i, end[stop]))
        p = before[i]
        if p >= 0 and (s := scores.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (-s, p, stop))
    out, i = [], 0
    while i < n:
        out.append(piece[i:end[i]])
        i = end[i]
    return out


def tokens_of(piece: str, scores: dict) -> list:
    """``merge`` for short pieces: the pairs' scores stand in a list, which for a word is quicker to search than a heap is to keep."""
    out, get = list(piece), scores.get
    held = [get(a + b, _NONE) for a, b in zip(out, out[1:])]
    while held and (best := max(held)) != _NONE:
        i = held.index(best)  # the leftmost
        out[i:i + 2] = [out[i] + out[i + 1]]
        del held[i]
        if i < len(held):
            held[i] = get(out[i] + out[i + 1], _NONE)
        if i:
            held[i - 1] = get(out[i - 1] + out[i], _NONE)
    return out


class Counter(dict):
    """piece of a text -> number of tokens; starts with the proven strings, remembers what it works out.  Of at most
    ``remembered`` pieces the newer half is kept when it is full, and pieces of the older half return when they are met again."""

    def __init__(self, scores: dict, remembered: int = 800_000):
        for v in scores:
            if "\n" in v or SPACE in v.lstrip(SPACE):
                raise ValueError(f"the cuts do not hold for this vocabulary: {v!r}")
        self.scores, self.remembered = scores, remembered
        self.pairs = {v[i:i + 2] for v in scores for i in range(len(v) - 1)}
        self.proven = frozenset(v for v in scores if len(v) == 1 or merge(v, scores) == [v])
        super().__init__(dict.fromkeys(self.proven, 1))
        self.older = {}

    def __reduce__(self):
        return _restore, (self.scores, self.remembered, self.pairs, self.proven)

    def __missing__(self, piece: str) -> int:
        if 2 * len(self) >= self.remembered + len(self.proven):
            self.older = dict(self)
            self.clear()
            self.update(dict.fromkeys(self.proven, 1))
        n = self.older.get(piece)
        if n is None:
            n = self.work_out(piece)
        self[piece] = n
        return n

    def work_out(self, piece: str) -> int:
        """Cut between characters that no vocabulary string holds side by side, then merge each part."""
        if len(piece) <= SHORT:
            return sum([1 if t in self.scores else len(t.encode()) for t in tokens_of(piece, self.scores)])
        total, start = 0, 0
        for i in range(1, len(piece) + 1):
            if i == len(piece) or piece[i - 1:i + 1] not in self.pairs:
                part = piece[start:i]
                if part in self.proven:
                    total += 1
                else:
                    total += sum(1 if t in self.scores else len(t.encode()) for t in merge(part, self.scores))
                start = i
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, _PIECES.findall(SPACE + text.replace(" ", SPACE))))


def _restore(scores, remembered, pairs, proven):
    c = Counter.__new__(Counter)
    dict.__init__(c, dict.fromkeys(proven, 1))
    c.scores, c.remembered, c.pairs, c.proven, c.older = scores, remembered, pairs, proven, {}
    return c


def count(docs: DataFrame, path: str | None = None, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """All columns plus the token count of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(Counter(read_scores(path or public_tokenizers.path(MODEL))))
    whole = fresh(docs, "__whole")
    df = docs.withColumn(whole, whole_text(text_col))
    df = df.drop(out) if out in df.columns else df
    at = df.columns.index(whole)

    def run(frames):
        counter = shared.value
        for batch in frames:
            n = pa.array([counter.count(t) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], names=[*batch.schema.names, out])

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(out, T.LongType())])
    return df.mapInArrow(run, schema).drop(whole)
