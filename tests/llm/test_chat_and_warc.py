"""Chat formatting and WARC derivatives."""

import html
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from storemart.llm import chat_pairs as C
from storemart.llm import warc_derivatives as W

TURN = "array<struct<role:string,text:string>>"


def render(turns):
    safe = lambda t: t.replace("<|", "< |")
    return "".join(f"<|{safe(r)}|>\n{safe(t)}<|end|>\n" for r, t in turns)


PAIRS = [
    (1, [("user", "q"), ("assistant", "good")], [("user", "q"), ("assistant", "bad one")]),
    (2, [("user", "q"), ("assistant", "a"), ("user", "more"), ("assistant", "x <|end|> y")], [("user", "q"), ("assistant", "b")]),
    (3, [("user", "q")], [("user", "q")]),
    (4, [("user", "a")], [("system", "a"), ("user", "a")]),
    (5, None, [("assistant", "only")]),
    (6, [], []),
    (7, [("user", "q"), ("assistant", "a"), ("assistant", "b")], [("user", "q"), ("assistant", "a")]),
]


def test_pairs(spark):
    df = spark.createDataFrame(PAIRS, f"conv_id long, chosen {TURN}, rejected {TURN}").withColumns({
        c: F.lit("kept") for c in ("prompt_id", "prompt", "__a", "__rest_b", "N_common")})
    assert sorted(C.format_pairs(df).columns) == sorted(["conv_id", "prompt_id", "__a", "__rest_b", "n_common", "prompt", "chosen_text", "chosen_spans",
                                                         "rejected_text", "rejected_spans"])
    assert {r["__a"] for r in C.format_pairs(df).collect()} == {"kept"}
    for r, (_, a, b) in zip(sorted(C.format_pairs(df).collect(), key=lambda r: r["conv_id"]), PAIRS):
        a, b = a or [], b or []
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        opens = bool(a[n:] and b[n:] and a[n][0] == b[n][0] == "assistant")
        head = "<|assistant|>\n" if opens else ""
        assert r["n_common"] == n and r["prompt"] == render(a[:n]) + head and r["prompt_id"] == "kept"
        # prompt and completion together are the whole conversation
        assert r["prompt"] + r["chosen_text"] == render(a) if a or not opens else True
        assert r["prompt"] + r["rejected_text"] == render(b)
        for text, spans, turns in ((r["chosen_text"], r["chosen_spans"], a[n:]), (r["rejected_text"], r["rejected_spans"], b[n:])):
            assert [text[s["start"]:s["start"] + s["length"]] for s in spans] == [
                t.replace("<|", "< |") + "<|end|>\n" for role, t in turns if role == "assistant"]


def test_conversations_and_reply_pairs(spark):
    rows = [(1, 1, "assistant", "one"), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, 0, None, None), (2, 1, "assistant", "two"),
            (2, 2, "user", "bye"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (5, 0, "user", "q"), (5, 1, "assistant", "last")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in C.reply_pairs(df).collect()}
    as_rows = lambda turns: [tuple(t) for t in turns]
    assert as_rows(got[1]["chosen"]) == [("user", "hi"), ("assistant", "one")]
    assert as_rows(got[1]["rejected"]) == [("user", "hi"), ("assistant", "two")]
    assert as_rows(got[2]["chosen"]) == [("user", ""), ("assistant", "two"), ("user", "bye")] and as_rows(got[2]["rejected"]) == [("user", "")]
    assert as_rows(got[3]["chosen"]) == as_rows(got[3]["rejected"]) == [("user", "alone")] and None in got
    assert as_rows(got[5]["rejected"]) == [("user", "q")]
    assert C.reply_pairs(df.limit(0)).count() == 0
    named = df.withColumn("conv_id", F.concat(F.lit("c"), F.col("conv_id")))  # ids that are no numbers
    assert all(r["rejected"] is not None for r in C.reply_pairs(named).collect())


PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><script>var x = "<a href='no'>";</script></head>
<body><h1>Head</h1><p>Some <b>bold</b> text &copy;<!-- <a href="no2"> --> <a class=k href="/x?a=1&amp;b=2">link</a></p><img src='i.png'></body></html>"""


def test_derivatives_are_linked_and_preserve_the_source():
    source = W.response(7, "http://e.x/a b\r\nX: y", PAGE)
    warc, status, http, body = W.parse(source)
    named = dict(warc)
    assert status == "HTTP/1.1 200 OK" and body.decode() == PAGE and named["WARC-Target-URI"] == "http://e.x/a%20b%0D%0AX:%20y"
    assert named["WARC-Payload-Digest"] == W.digest(PAGE.encode())
    out = W.build(source)
    assert out["text"].split("\n") == ["Head", "Some bold text © link"] and out["n_links"] == 2
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        head, _, rest = out[kind].partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[:int(fields["Content-Length"])]
        assert rest[len(block):] == b"\r\n\r\n" and fields["WARC-Type"] == kind
        assert fields["WARC-Refers-To"] == named["WARC-Record-ID"] and fields["WARC-Concurrent-To"] == out[f"{other}_id"]
        assert fields["WARC-Date"] == named["WARC-Date"] and fields["WARC-Target-URI"] == named["WARC-Target-URI"]
        assert fields["WARC-Block-Digest"] == W.digest(block)
        if kind == "metadata":
            about = json.loads(block)
            assert about["source"]["warc"] == [list(x) for x in warc] and about["source"]["http"] == [list(x) for x in http]
            assert about["title"] == "A & B" and [x["url"] for x in about["links"]] == ["/x?a=1&b=2", "i.png"]
        else:
            assert block.decode() == out["text"]
    assert W.build(source) == out  # the same bytes again


def test_markup_patterns_against_plain_ones():
    """Titles, links and texts of random markup as by one pattern each (quadratic on broken markup)."""
    link = re.compile(r"""<(a|area|link|img|iframe|source)\b[^>]*?\b(?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.S | re.I)
    title = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
    rnd = random.Random(3)
    parts = ["<a ", "<img", " href=", " src = ", '"', "'", ">", "x", " ", "<", "</a>", "<title>", "</title>", "<title ", "<!--", "-->", "<p>", "y.z", "&amp;", "<!", "/"]
    for _ in range(20_000):
        page = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        bare = W._DROP.sub(" ", page)
        assert W.links(page) == [{"tag": m[1].lower(), "url": html.unescape(m[2] or m[3] or m[4] or "")} for m in link.finditer(bare)], page
        m = title.search(page)
        assert W.title(page) == (" ".join(html.unescape(m[1]).split()) if m else None), page
        text = W._TAG.sub(lambda m: "" if (m[1] or "").lstrip("/").lower() in W._INLINE else "\n", title.sub(" ", bare))
        lines = [" ".join(x.split()) for x in html.unescape(text).split("\n")]
        assert W.visible_text(page) == "\n".join(x for x in lines if x), page


@pytest.mark.parametrize("piece", ["<a href", "<a ", "<title ", "<a href=x ", "<a href='", '<a href="', "<!", "<", "<a href ", "<title>", "<script"])
def test_broken_markup_takes_linear_time(piece):
    source = W.response(1, "u", piece * 100_000)
    since = time.process_time()
    W.build(source)
    assert time.process_time() - since < 5


def test_frames(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", "<p>" + "w " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit("mine"))
    got = W.derive(W.responses(df)).collect()
    assert [r["error"] for r in got] == [None] * 5 and got[0] == got[1] and got[2]["target_uri"] is None and got[2]["text"] == ""
    assert len(got[4]["text"]) == 199_999 and got[2]["payload_digest"] == W.digest(b"")
    bad = spark.createDataFrame([(1, bytearray(b"WARC/1.1\r\nWARC-Type: request\r\n\r\n")), (2, None), (3, bytearray(b"\xff\x00"))], "page_id long, record binary")
    assert all(r["error"] and r["metadata"] is None for r in W.derive(bad).collect())
    assert W.derive(W.responses(df.limit(0))).count() == 0


def test_unreadable_length():
    with pytest.raises((ValueError, KeyError)):
        W.parse(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n")
