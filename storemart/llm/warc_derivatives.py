"""WARC derivative builder: response records to linked metadata and plain-text conversion records.

Every response record becomes two records.  The metadata record carries a JSON object with the
source's WARC and HTTP headers, its digests, the page's title and its links; the conversion record
carries the visible text.  Both keep the source's target URI and date, name it in WARC-Refers-To, and
name each other (WARC-Concurrent-To).  Record ids are name-based on the source's id, so a task that
runs twice writes the same bytes.

Records are independent: one pass over the rows, no shuffle.

Defined cases: a record without a body gives an empty text and no links; a null URL leaves out the
target header; control characters in a URL are percent-encoded, so that they cannot add headers;
bodies are read as UTF-8 with replacement; repeated records give repeated results.  A record that is
not a response, or whose header cannot be read, gives a row with ``error`` set and null records.
Very long bodies take time in proportion to their length, broken markup included; a record is worked
on whole in one task.  Other columns of the input are left out, and an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-derivatives")
_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<(/?[a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:(</title\s*>)|\Z)", re.S | re.I)
_LINK_TAG = re.compile(r"<(a|area|link|img|iframe|source)\b", re.I)
_REFERENCE = re.compile(r"\b(?:href|src)\s*=\s*", re.I)
_VALUE = re.compile(r'''"([^"]*)"|'([^']*)'|([^\s>"']+)''')
_INLINE = frozenset("a abbr b bdi bdo cite code em font i kbd mark q s samp small span strong sub sup time tt u var".split())
SCHEMA = ("page_id long, error string, response_id string, target_uri string, payload_digest string, metadata_id string, metadata binary, "
          "conversion_id string, conversion binary, text string, n_links long")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, headers: list, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def response(page_id, url: str | None, body: str | None) -> bytes:
    """The response record of one stored page."""
    payload = (body or "").encode()
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload
    name = uuid.uuid5(_SPACE, f"{page_id} {url}")
    return _record("response", [("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Target-URI", _uri(url)), ("WARC-Date", DATE),
                                ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                                ("Content-Type", "application/http; msgtype=response")], block)


def _headers(text: bytes) -> tuple:
    first, *rest = text.decode("utf-8", "replace").split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in rest) if k.strip()]


def parse(record: bytes) -> tuple:
    """(WARC headers, status line, HTTP headers, body) of a response record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, warc = _headers(head)
    named = dict(warc)
    if not version.startswith("WARC/") or named.get("WARC-Type") != "response":
        raise ValueError("not a response record")
    block = rest[:int(named["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    status, fields = _headers(http)
    return warc, status, fields, body


def _split(page: str) -> tuple:
    """The page up to its last ``>`` and the rest, where no tag can end: patterns that look for the end of a tag
    see the first part only, so each of their attempts succeeds and they take linear time."""
    at = page.rfind(">") + 1
    return page[:at], page[at:]


def title(page: str) -> str | None:
    """The first title, white space collapsed."""
    head, tail = _split(page)
    m = _TITLE.search(head)
    return None if m is None else " ".join(html.unescape(m[1] if m[2] else m[1] + tail).split())


def links(page: str) -> list:
    """Tag and reference of each linking tag, in page order."""
    page, out, at, close = _DROP.sub(" ", page), [], 0, -1
    while m := _LINK_TAG.search(page, at):
        if close < m.end():
            close = page.find(">", m.end())
            close = len(page) if close < 0 else close
        at = close
        for r in _REFERENCE.finditer(page, m.end(), close):
            if v := _VALUE.match(page, r.end()):
                out.append({"tag": m[1].lower(), "url": html.unescape(v[1] or v[2] or v[3] or "")})
                at = v.end()
                break
    return out


def visible_text(page: str) -> str:
    """Text of a page, a line per block, white space collapsed."""
    head, tail = _split(_DROP.sub(" ", page))
    unclosed = []

    def blank(m):
        if m[2] is None:
            unclosed.append(m)
        return " "

    head, rest = _split(_TITLE.sub(blank, head) + ("" if unclosed else tail))
    page = _TAG.sub(lambda m: "" if (m[1] or "").lstrip("/").lower() in _INLINE else "\n", head) + rest
    lines = (" ".join(line.split()) for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def build(record: bytes) -> dict:
    """Both derivatives of one response record."""
    warc, status, http, body = parse(record)
    named = dict(warc)
    source, uri, date = named.get("WARC-Record-ID"), named.get("WARC-Target-URI"), named.get("WARC-Date")
    page = body.decode("utf-8", "replace")
    found, text = links(page), visible_text(page)
    ids = {k: f"<urn:uuid:{uuid.uuid5(_SPACE, f'{k} {source}')}>" for k in ("metadata", "conversion")}
    out = {"response_id": source, "target_uri": uri, "payload_digest": named.get("WARC-Payload-Digest") or digest(body),
           "metadata_id": ids["metadata"], "conversion_id": ids["conversion"], "text": text, "n_links": len(found), "error": None}
    about = json.dumps({"source": {"warc": warc, "status": status, "http": http, "payload_digest": out["payload_digest"],
                                   "block_digest": named.get("WARC-Block-Digest")},
                        "title": title(page), "links": found}, ensure_ascii=False).encode()
    for kind, other, block, mime in (("metadata", "conversion", about, "application/json"), ("conversion", "metadata", text.encode(), "text/plain; charset=utf-8")):
        out[kind] = _record(kind, [("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source), ("WARC-Concurrent-To", ids[other]),
                                   ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Block-Digest", digest(block)), ("Content-Type", mime)], block)
    return out


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): response records of stored pages."""
    def run(frames):
        for batch in frames:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array([response(*r) for r in rows], pa.binary())], names=["page_id", "record"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """One row per response record with its two derivatives and what they were made of."""
    def run(frames):
        for batch in frames:
            rows = []
            for record in batch.column("record").to_pylist():
                try:
                    rows.append(build(record or b""))
                except (ValueError, KeyError) as e:
                    rows.append({"error": f"unreadable record: {e}"})
            types = {"metadata": pa.binary(), "conversion": pa.binary(), "n_links": pa.int64()}
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array([r.get(n) for r in rows], types.get(n, pa.string())) for n in names[1:])],
                                             names=names)

    return records.select("page_id", "record").mapInArrow(run, SCHEMA)
