"""BPE, token counts and token files against the public libraries."""

import base64
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storemart.llm import byte_bpe as B
from storemart.llm import token_counts as C
from storemart.llm import token_files as T

from .conftest import ODD

_rnd = random.Random(3)
_ALPHABET = "aàeé日本 \n▁\t .,'st<|>0129́\x00\x0b\x1c\x1f\x85  　😀ΣTHEthe ()=></s>"
STRINGS = ["".join(_rnd.choice(_ALPHABET) for _ in range(_rnd.randint(0, 40))) + _rnd.choice(["", "<|endoftext|>", " <s>", "\n\n "])
           for _ in range(4000)] + [t or "" for _, t in ODD]


def test_byte_bpe_equals_tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(B.VOCABULARY), "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = B.Encoder(B.read_ranks(P.path(B.VOCABULARY)), remembered=500)
    for s in STRINGS:
        ids = ours.encode(s)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(s), s
        assert ours.decode(ids) == s.encode()


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = [f"k{i}".encode() for i in range(5000)]
    h = B.PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(5000)) and h.slots[h.slot(b"k17")] == b"k17"
    assert h.slots[h.slot(b"stranger")] != b"stranger"


def test_bpe_frames(odd, nothing):
    done = B.decode(B.encode(odd, out="codes"), ids_col="codes", out="plain").collect()
    assert len(done) == len(ODD) and all(bytes(r["plain"]).decode() == (r["text"] or "") and r["ids"] == "extra ids" for r in done)
    assert B.digest(B.encode(nothing)).count() == 0
    assert B.encode(odd).columns.count("ids") == 1 and B.encode(odd).select("ids").dtypes == [("ids", "binary")]
    d = {(r["doc_id"], r["n_tokens"]) for r in B.digest(B.encode(odd.select("doc_id", "text"))).collect()}
    assert (1, 0) in d and (2, 0) in d


def test_counts_equal_sentencepiece(odd, nothing):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(C.MODEL))
    counter = C.Counter(C.read_scores(P.path(C.MODEL)), remembered=len(C.read_scores(P.path(C.MODEL))) + 200)
    assert all(sp.encode(v.replace(C.SPACE, " ").strip(" "), out_type=str) for v in list(counter.proven)[:50] if v.strip(C.SPACE))
    for s in STRINGS:
        assert counter.count(s) == len(sp.encode(s)), s
    rows = C.count(odd).collect()
    assert [r["n_tokens"] for r in rows] == [len(sp.encode(r["text"] or "")) for r in rows] and rows[0]["ids"] == "extra ids"
    assert C.count(nothing).count() == 0


def test_short_pieces_merge_as_long_ones_and_come_back_when_the_memory_is_full(monkeypatch):
    """op4_token_counts: words take the list, and a word met again is not merged again."""
    scores = C.read_scores(P.path(C.MODEL))
    short = [s[:C.SHORT].replace(" ", C.SPACE) for s in STRINGS]
    assert all(C.tokens_of(s, scores) == C.merge(s, scores) for s in short)
    counter = C.Counter(scores)
    counter.remembered = len(counter.proven) + 100
    worked, work_out = [], counter.work_out
    monkeypatch.setattr(counter, "work_out", lambda p: worked.append(p) or work_out(p))
    for i in range(400):
        counter.count(f"qzqzvx w{i}xqj")
    assert worked.count(f"{C.SPACE}qzqzvx") == 1 and len(counter) + len(counter.older) <= 2 * len(counter.proven) + 110


def test_unsafe_vocabulary_is_refused():
    with pytest.raises(ValueError, match="cuts do not hold"):
        C.Counter({"a": -1.0, f"a{C.SPACE}b": -2.0})


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for k in range(200):
        ids = rng.integers(0, rng.integers(1, 1 << 32), rng.integers(0, 9000), dtype=np.uint32)
        if k % 3 == 0 and len(ids):
            ids[rng.integers(0, len(ids), 5)] = (1 << 32) - 1
        packed = T.pack(ids)
        assert (T.unpack(packed) == ids).all()
        lo = int(rng.integers(0, len(ids) + 1))
        hi = int(rng.integers(lo, len(ids) + 1))
        assert (T.unpack(packed, lo, hi) == ids[lo:hi]).all()
    spiky = np.full(T.BLOCK, 7, np.uint32)
    spiky[5] = 1 << 31
    assert len(T.pack(spiky)) < 100  # the outlier is an exception, not the width
    with pytest.raises(ValueError):
        T.unpack(b"x" * 40)


def test_word_ids_equal_library():
    tk = Tokenizer.from_file(P.path(T.TOKENIZER))
    ours = T.WordIds(P.path(T.TOKENIZER), remembered=800)
    marked = ["".join(_rnd.choice("ABab01.,!?-_'s#$%&*|<>()é\u0301Σß² ") for _ in range(_rnd.randint(0, 30))) for _ in range(4000)]
    marked += ["", " ", "x" * 65 + " " + "y" * 300 + "! " + "x" * 65, "é" * 200, "\n\na"]
    assert ours.encode([], 1) == []
    for i in range(0, len(STRINGS + marked), 900):
        part = (STRINGS + marked)[i:i + 900]
        assert [x[:-1].tolist() for x in ours.encode(part, 1)] == [e.ids for e in tk.encode_batch(part, add_special_tokens=False)]


def test_every_letter_before_every_mark():
    """Letters whose lower case or composition ends in a combining mark keep the marks behind them."""
    import sys
    import unicodedata
    tk = Tokenizer.from_file(P.path(T.TOKENIZER))
    ours = T.WordIds(P.path(T.TOKENIZER), remembered=100_000)
    letters = [chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LNM" and not 0x3400 <= c <= 0x9FFF
               and not 0xAC00 <= c <= 0xD7A3 and not 0x17000 <= c <= 0x18CFF and not 0x20000 <= c <= 0x3FFFF]
    marks = list("!\"#$%&()*+,-./:;=?@[\\]^_`{}~")
    texts = [f"a{c}{marks[i % len(marks)]} {c}.. b{c}!{c}" for i, c in enumerate(letters)]
    texts += [f"x{c}{m}" for c in "\u0130\u0958\u095f\u09dc\u0a33\u0f43\ufb1d\u00df\u03a3" for m in marks] + ["\u0130zm\u0130!", "\u0958."]
    for i in range(0, len(texts), 20_000):
        part = texts[i:i + 20_000]
        bad = [t for t, x, e in zip(part, ours.encode(part, 1), tk.encode_batch(part, add_special_tokens=False)) if x[:-1].tolist() != e.ids]
        assert not bad, bad[:10]


def test_words_that_share_a_hash_and_very_long_texts(monkeypatch):
    """Occurrences are compared byte by byte, so equal hashes do not mix words; long texts are cut at white space only."""
    tk = Tokenizer.from_file(P.path(T.TOKENIZER))
    texts = ["one two, three one", "Two! two two three", "four " * 50 + "x" * 90, "", "one"]
    wanted = [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(T, "word_hashes", lambda data, start, stop: (stop - start).astype(np.uint64) % np.uint64(2))
    ours = T.WordIds(P.path(T.TOKENIZER))
    for _ in range(2):
        assert [x[:-1].tolist() for x in ours.encode(texts, 1)] == wanted
    monkeypatch.undo()
    monkeypatch.setattr(T, "_CHUNK", 16)
    ours = T.WordIds(P.path(T.TOKENIZER))
    assert [x[:-1].tolist() for x in ours.encode(texts, 1)] == wanted


def expected(rows):
    tk = Tokenizer.from_file(P.path(T.TOKENIZER))
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tk.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read_back(spark, docs):
    path = f"{tempfile.mkdtemp(prefix='token-files-')}/t"
    T.write(docs, path)
    return [tuple(r) for r in T.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()]


def test_files_of_documents(spark, documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    assert sorted(read_back(spark, documents.repartition(5))) == expected(rows)


def test_files_of_odd_rows(spark, odd, nothing):
    got = sorted(read_back(spark, odd), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([d for d, _ in ODD], key=lambda d: (d is not None, d))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    assert sorted((r[0] or 0, *r[2:]) for r in got) == sorted((d or 0, n, c) for d, _, n, c in expected(ODD))
    assert read_back(spark, nothing) == []
