"""WARC derivatives: metadata and plain-text conversion records of responses (operator 7).

Every response record gives two records that refer to it: a metadata record, which keeps the source's HTTP status line
and headers, the payload digest and the id of the conversion, and a conversion record, whose block is the page's plain
text. A digest that the source record states is carried over as it stands; otherwise it is computed from the payload's
bytes. Digests are SHA-1 in base32, as the format has them. Ids are name-based UUIDs over the source record and the
kind, so that a task run again makes the same ids.

Text is made from the payload's bytes: chunks are joined, gzip and deflate coding is undone, and bytes are read in the
character set that the headers or a meta element state (UTF-8 without one; bytes outside it become replacement
characters). Markup is scanned once from left to right, in time linear in the page however malformed it is: a quoted
attribute value may hold `>`, and a `<` that begins no tag is text.

A null page counts as an empty payload; a record without a target URI leaves that header out. Repeated responses give
repeated records. An empty table gives no rows; other columns are ignored. A WARC file is read as one row, so files up to
2 GB can be read; the usual size is 1 GB.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.tables import arrow_schema

VERSION = "WARC/1.1"
NAMESPACE = uuid.NAMESPACE_URL
UNDATED = "1970-01-01T00:00:00Z"  # of responses whose table has no date
RESPONSES = "page_id long,record_id string,target_uri string,date string,http string,payload binary,payload_digest string"
RECORDS = (
    "page_id long,record_type string,record_id string,refers_to string,target_uri string,date string,"
    "content_type string,block_digest string,source_payload_digest string,source_headers string,block string"
)

# Elements by what becomes of them (fixed values: names of HTML elements). The content of those in RAW is hidden to its end
# tag or to the end of the page; of those in HIDDEN an unclosed one hides nothing. A head, whose end tag may be left out,
# then hides its title, which is text elsewhere.
RAW = ("script", "style")
HIDDEN = ("noscript", "template", "head", "title")
IN_HEAD = {"meta", "link", "base", "basefont", "bgsound"}
LINES = {
    "p", "div", "br", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "header",
    "footer", "nav", "blockquote", "pre", "hr", "dl", "dt", "dd", "title", "body", "html",
}
CELLS = {"td", "th"}
_END = {kind: re.compile(rf"</{kind}\s*>", re.I) for kind in (*RAW, "noscript", "template", "title")}
_END["head"] = re.compile(r"</head\s*>|<body\b", re.I)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_STOP = re.compile("[>=]")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")


class _Page:
    """Ends of tags and of elements in one page. What a search has gone through in vain isn't gone through again."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">'\""}
        self.dead: set[int] = set()  # places from which no tag ends
        self.ends: dict[str, re.Match | None] = {}

    def tag_end(self, at: int) -> int:
        """The place after the `>` of a tag, which isn't within a quoted value. A `>` must follow."""
        html, begin, seen = self.html, at, []
        while (stop := _STOP.search(html, at)) and stop.start() not in self.dead:
            if stop[0] == ">":
                return stop.end()
            seen.append(stop.start())
            at = stop.end()
            while html[at : at + 1] == " ":
                at += 1
            quote = html[at : at + 1]
            if quote in self.last and quote != ">" and self.last[quote] > at:
                at = html.index(quote, at + 1) + 1
        self.dead.update(seen)
        return html.index(">", begin) + 1  # quotes that leave no end are none

    def element_end(self, kind: str, at: int) -> re.Match | None:
        """The next end of the element, looked for once."""
        if kind not in self.ends or (self.ends[kind] and self.ends[kind].start() < at):
            self.ends[kind] = _END[kind].search(self.html, at)
        return self.ends[kind]


def _shown(html: str) -> str:
    """A page without markup: lines and cells are parted, hidden elements leave a blank."""
    page, out, at, in_head = _Page(html), [], 0, False
    while 0 <= (start := html.find("<", at)) < page.last[">"]:
        text, after = html[at:start], html[start + 1 : start + 2]
        name = _NAME.match(html, start)
        special = name is None and after in ("!", "?")
        end = page.tag_end(start + 1) if name else -1
        if special:
            if html.startswith("<!--", start) or html.startswith("<![CDATA[", start):
                mark = "-->" if html[start + 2] == "-" else "]]>"
                found = html.find(mark, start + 4)
                end = found + 3 if found >= 0 else len(html)
            else:
                special, end = False, html.index(">", start) + 1  # a declaration, which is no text and leaves nothing
        if end < 0:
            text = html[at : start + 1]
        if in_head and text.strip():
            in_head = False
        out.append(text)
        if end < 0:
            at = start + 1
            continue
        at = end
        if special:
            out.append(" ")
            continue
        kind = name[1].lower() if name else ""
        opens = after != "/"
        if opens and kind in RAW:
            found = page.element_end(kind, at)
            at = found.end() if found else len(html)
            out.append(" ")
        elif opens and kind in HIDDEN and (kind != "title" or in_head):
            out.append(" ")
            found = page.element_end(kind, at)
            if kind == "head" and (found is None or found[0][1] != "/"):
                in_head = True
            elif found:
                at = found.end()
        else:
            out.append("\n" if kind in LINES else " " if kind in CELLS else "")
            in_head = in_head and kind in IN_HEAD
    # No tag ends any more, but a comment that is never closed may begin.
    unclosed = re.search(r"<!--|<!\[CDATA\[", html[at:])
    out.append(html[at : at + unclosed.start()] + " " if unclosed else html[at:])
    return "".join(out)


def plain_text(html: str | None) -> str:
    """Text of a page: hidden elements dropped, block elements as line breaks, entities resolved, blanks folded."""
    text = _shown((html or "").replace("\r", " ").replace("\n", " "))
    return _LINES.sub("\n", _BLANKS.sub(" ", entities.unescape(text))).strip()


def _fields(http: str) -> dict[str, str]:
    """Header fields by lower-case name; of a repeated one the last."""
    pairs = (line.partition(":") for line in http.split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name.strip()}


def _unchunked(payload: bytes) -> bytes:
    """The joined chunks; what does not begin like a chunk is left as it is."""
    parts, at = [], 0
    while True:
        line = payload.find(b"\r\n", at)
        size = payload[at:line].partition(b";")[0].strip() if 0 <= line <= at + 100 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,8}", size):
            return b"".join(parts) if parts else payload
        size = int(size, 16)
        if not size:
            return b"".join(parts)
        parts.append(payload[line + 2 : line + 2 + size])
        at = line + 2 + size + 2


def _inflated(payload: bytes, coding: str) -> bytes:
    """Coding undone as far as the bytes go; what is not so coded is left as it is."""
    windows = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(coding, ())
    for window in windows:
        machine = zlib.decompressobj(window)
        try:
            return machine.decompress(payload) + machine.flush()
        except zlib.error:
            continue
    return payload


_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_META = re.compile(rb"<meta\b[^>]{0,1000}", re.I)
META_BYTES = 4096  # at the begin of a page, in which a meta element may state the character set


def page_of(http: str, payload: bytes) -> str:
    """The text of a response's page."""
    fields = _fields(http)
    if fields.get("transfer-encoding", "").lower().endswith("chunked"):
        payload = _unchunked(payload)
    for coding in reversed(fields.get("content-encoding", "").lower().split(",")):
        payload = _inflated(payload, coding.strip())
    stated = [fields.get("content-type", ""), *(m[0].decode("latin-1") for m in _META.finditer(payload[:META_BYTES]))]
    for found in filter(None, map(_CHARSET.search, stated)):
        try:
            return payload.decode(found[1], "replace")
        except (LookupError, ValueError):
            continue
    return payload.decode("utf-8", "replace")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def named_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join('' if p is None else str(p) for p in parts))}>"


def http_header(payload: bytes) -> str:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"


def response_of(page_id, url, html) -> tuple:
    payload = (html or "").encode()
    own = digest(payload)
    return page_id, named_id("response", page_id, url, own), url, UNDATED, http_header(payload), payload, own


def derive(page_id, record_id, target_uri, date, http, payload, payload_digest) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    payload, http = payload or b"", http or ""
    source = payload_digest or digest(payload)
    conversion_id, metadata_id = named_id("conversion", record_id), named_id("metadata", record_id)
    text = plain_text(page_of(http, payload))
    status, _, fields = http.partition("\r\n")
    lines = [f"response-status: {status}", f"payload-digest: {source}", f"payload-length: {len(payload)}", f"conversion: {conversion_id}"]
    lines += [f"http-header: {line}" for line in fields.split("\r\n") if line]
    metadata = "\r\n".join(lines) + "\r\n"
    return [
        (page_id, "metadata", metadata_id, record_id, target_uri, date, "application/warc-fields", digest(metadata.encode()), source, http, metadata),
        (page_id, "conversion", conversion_id, record_id, target_uri, date, "text/plain", digest(text.encode()), source, http, text),
    ]


def _flat_map(frame: DataFrame, function, schema: str) -> DataFrame:
    """Rows of `schema` that `function` makes from the values of each row."""

    def run(batches):
        kinds = arrow_schema(schema)
        for batch in batches:
            rows = [row for values in zip(*(c.to_pylist() for c in batch.columns), strict=True) for row in function(*values)]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return frame.mapInArrow(run, schema)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of a table of pages."""
    narrow = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return _flat_map(narrow, lambda *page: [response_of(*page)], RESPONSES)


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records (columns as in RESPONSES)."""
    names = [part.split()[0] for part in RESPONSES.split(",")]
    return _flat_map(records.select(*names), derive, RECORDS)


def page_derivatives(pages: DataFrame) -> DataFrame:
    """Both steps in one pass over a table of pages."""
    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return _flat_map(narrow, lambda *page: derive(*response_of(*page)), RECORDS)


def serialise(kind, record_id, target_uri, date, content_type, block: bytes, refers_to=None, more=()) -> bytes:
    """One record as the file format has it."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", target_uri)]
    fields += [("WARC-Refers-To", refers_to), *more, ("WARC-Block-Digest", digest(block))]
    fields += [("Content-Type", content_type), ("Content-Length", len(block))]
    head = "".join(f"{name}: {' '.join(str(value).split())}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def with_bytes(records: DataFrame) -> DataFrame:
    """record_id and the gzip member of each derived record; members laid end to end are a WARC file."""

    def member(record_id, kind, refers_to, uri, date, content_type, payload_digest, block):
        more = [("WARC-Payload-Digest", payload_digest)] if kind == "response" else [("X-Source-Payload-Digest", payload_digest)]
        return [(record_id, gzip.compress(serialise(kind, record_id, uri, date, content_type, block.encode(), refers_to, more), mtime=0))]

    narrow = records.select("record_id", "record_type", "refers_to", "target_uri", "date", "content_type", "source_payload_digest", "block")
    return _flat_map(narrow, member, "record_id string,member binary")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an open, uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields.get("content-length", 0)))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC files (gzip or plain); page_id is null, as files have none."""

    def run(batches):
        kinds = arrow_schema(RESPONSES)
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                stream = gzip.open(io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                for fields, block in parse(stream):
                    if fields.get("warc-type") != "response":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = [fields.get(f"warc-{name}") for name in ("record-id", "target-uri", "date")]
                    values = None, *stated, http.decode("utf-8", "replace") + "\r\n\r\n", payload, fields.get("warc-payload-digest") or digest(payload)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k.type) for v, k in zip(values, kinds, strict=True)], schema=kinds)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RESPONSES)
