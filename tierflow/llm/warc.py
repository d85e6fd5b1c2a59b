"""Derivatives of web captures (operator 2): metadata and plain-text conversion records.

Every response record of a WARC table gives one ``metadata`` and one
``conversion`` record. Both refer to the response by its record id and carry its
target and date; the metadata keeps the source's HTTP headers and digests, the
conversion holds the visible text. Record ids are derived from the response's
id, so a task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: that of URLs
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
END = CRLF + CRLF

# A head is what only heads hold; anything else, with or without </head>, is the body's.
HIDDEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<head(?![\w-])[^>]*>(?:\s++|<!--.*?(?:-->|\Z)|<[!?][^>]*>|</(?!head\b|body\b|html\b|br\b)[a-z][^>]*>"
    r"|<(?:meta|link|base)(?![\w-])[^>]*>"
    r"|<(?P<own>script|style|noscript|template|title)(?![\w-])[^>]*>.*?(?:</(?P=own)\s*>|\Z))*+(?:</head\s*>)?",
    re.DOTALL | re.IGNORECASE)
BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    r"|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>",
    re.IGNORECASE)
TAG = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")

RECORD = "record binary"
PARSED = "type string, headers map<string,string>, block binary"
DERIVED = ("response_id string, type string, record_id string, refers_to string, target_uri string, "
           "date string, content_type string, content_length long, block_digest string, "
           "source_block_digest string, source_payload_digest string, source_headers string, "
           "truncated string, payload string, record binary")


def digest(data: bytes) -> str:
    """Labelled digest as WARC headers carry it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A record id that follows from its parts."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(10).join(parts))}>"


def serialize(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; line ends inside values become spaces, the length is added."""
    lines = [b"WARC/1.1", *(f"{k}: {' '.join(v.split())}".encode() for k, v in fields if v),
             f"Content-Length: {len(block)}".encode()]
    return CRLF.join(lines) + END + block + END


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block; raises ValueError on bad records."""
    head, found, rest = record.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    size = fields.get("content-length", "")
    if not size.isdigit() or int(size) > len(rest):
        raise ValueError("bad Content-Length")
    return fields, rest[:int(size)]


def visible_text(source: str) -> str:
    """Text outside scripts, styles and heads; a line for each block, white space as one space."""
    # Line ends of the source are white space; those put in here end blocks.
    source = HIDDEN.sub(" ", source).replace("\r", " ").replace("\n", " ")
    source = BREAK.sub("\n", source)
    lines = (" ".join(html.unescape(TAG.sub("", x)).split()) for x in source.split("\n"))
    return "\n".join(x for x in lines if x)


def http_parts(block: bytes) -> tuple[str, bytes]:
    """HTTP header lines and payload of a response block."""
    head, found, payload = block.partition(END)
    return (head.decode("latin-1"), payload) if found else ("", block)


def response_records(pages: DataFrame) -> DataFrame:
    """(record) response records of (page_id, url, html), as a crawler would store them.

    Null html is an empty payload, a null url an empty target. Rows that repeat
    give equal records.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = []
            for page, url, source in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (source or "").encode()
                http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
                records.append(serialize([
                    ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page), url or "")),
                    ("WARC-Date", DATE), ("WARC-Target-URI", url or ""),
                    ("WARC-Block-Digest", digest(http)), ("WARC-Payload-Digest", digest(payload)),
                    ("Content-Type", "application/http; msgtype=response")], http))
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    return pages.select(F.col("page_id").cast("string"), "url", "html").mapInArrow(run, RECORD)


def derive(fields: dict[str, str], block: bytes) -> list[tuple]:
    """The metadata and conversion records of one response."""
    source = fields.get("warc-record-id", "")
    headers, payload = http_parts(block)
    uri, date = fields.get("warc-target-uri", ""), fields.get("warc-date", "")
    block_digest = fields.get("warc-block-digest") or digest(block)
    payload_digest = fields.get("warc-payload-digest") or digest(payload)
    truncated = fields.get("warc-truncated", "")
    text = visible_text(payload.decode("utf-8", "replace"))
    notes = [("source-record-id", source), ("source-block-digest", block_digest),
             ("source-payload-digest", payload_digest), ("source-payload-length", str(len(payload))),
             ("text-length", str(len(text))),
             *(("source-header", line) for line in headers.split("\r\n") if line)]
    meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
    rows = []
    for kind, own, other, content, body in (
            ("metadata", meta_id, text_id, "application/warc-fields",
             "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in notes).encode()),
            ("conversion", text_id, meta_id, "text/plain; charset=utf-8", text.encode())):
        record = serialize([
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source),
            ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
            ("WARC-Concurrent-To", other if kind == "metadata" else ""), ("WARC-Target-URI", uri),
            ("WARC-Date", date), ("WARC-Truncated", truncated), ("WARC-Block-Digest", digest(body)),
            ("Content-Type", content)], body)
        rows.append((source, kind, own, source, uri, date, content, len(body), digest(body), block_digest,
                     payload_digest, headers, truncated, body.decode(), record))
    return rows


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all response records of a table of (record binary).

    Records of other types, nulls and bytes that are no WARC record give nothing;
    empty payloads give an empty text. Repeated records give repeated rows; other
    columns are ignored. There is no shuffle.
    """
    kinds = [f.split(" ") for f in DERIVED.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for record in batch.column(0).to_pylist():
                try:
                    fields, block = parse(record or b"")
                except ValueError:
                    continue
                if fields.get("warc-type", "").lower() == "response":
                    rows += derive(fields, block)
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, types[k]) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])

    return records.select("record").mapInArrow(run, DERIVED)


def page_derivatives(pages: DataFrame) -> DataFrame:
    """Columns of the derivative query: both derived records of every page's capture."""
    return derivatives(response_records(pages))
