"""WARC derivatives: metadata and plain-text records from response records."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION = "WARC/1.0"
#: ``headers`` are those without a column of their own, in their order, repeated ones too.
RECORD = (
    "record_id string, warc_type string, target_uri string, warc_date string, refers_to string, "
    "concurrent_to string, content_type string, content_length long, block_digest string, "
    "payload_digest string, block binary, headers array<struct<name: string, value: string>>"
)
#: The header of a record for each column, in the order in which they are written.
HEADERS = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date",
    "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "concurrent_to": "WARC-Concurrent-To", "content_type": "Content-Type",
    "content_length": "Content-Length", "block_digest": "WARC-Block-Digest",
    "payload_digest": "WARC-Payload-Digest",
}
NAMES = [
    "record_id", "warc_type", "target_uri", "warc_date", "refers_to", "concurrent_to", "content_type", "content_length",
    "block_digest", "payload_digest", "block", "headers",
]

#: Elements whose content is no text, those among them that hold no links either, and those that begin a line.
HIDDEN = frozenset(b"script style noscript template".split())
NO_LINKS = frozenset(b"script style".split())
BLOCKS = frozenset(
    b"address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre "
    b"section table td th title tr ul".split()
)
LINKING = frozenset(b"a link img script iframe area form".split())

_TAG = re.compile(rb"<(?:(!--)|(/?)([a-z][a-z0-9]*)|[/!?])")
_ATTRIBUTE = re.compile(rb"\s(href|src|action)\s*=\s*([\"']?)")
_BARE = re.compile(rb"[^\s>\"']+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def new_id(*parts: str) -> str:
    """The same parts give the same id, so a task that runs again writes the same records."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


class Page:
    """The text, the title and the links of a page, read in one pass.

    Every search goes on from where the last one ended, and what was not found once is not looked for again, so
    the time grows with the page's length, whatever it leaves open. A tag goes to the next ">"; what has none is
    text, and so is the content of an element that is never closed.
    """

    def __init__(self, page: str):
        # As bytes, since these are put into lower case, letters beyond ASCII apart, at no cost.
        self.data = data = page.encode("utf-8", "replace")
        self.plain = plain = data.lower()
        self.missing: set[bytes] = set()
        self.title: str | None = None
        self.links: list[dict[str, str]] = []
        parts: list[bytes] = []
        # Text is taken up to ``done``; before ``hidden`` it is no text, and before ``no_links`` there is nothing to see.
        at = done = hidden = no_links = 0
        while found := _TAG.search(plain, at):
            begin = found.start()
            comment, slash, name = found.groups()
            end = -1
            if comment:
                close = self._find(b"-->", begin + 4)
                end = close + 3 if close >= 0 else -1
            if end < 0:
                end = plain.find(b">", found.end()) + 1
                if end == 0:
                    break
            if begin >= hidden:
                parts.append(data[done:begin])
                if name in BLOCKS:
                    parts.append(b"\n")
                if not slash and name in HIDDEN:
                    close = self._find(b"</" + name, end)
                    close = plain.find(b">", close) + 1 if close >= 0 else 0
                    if close:
                        hidden = close
                        no_links = close if name in NO_LINKS else no_links
                if name == b"title" and not slash and self.title is None:
                    close = self._find(b"</title", end)
                    self.title = _said(data[end:close]).strip() if close >= 0 else None
            if not slash and name in LINKING:
                self._link(name, begin, end)
            at = max(end, no_links)
            done = max(at, hidden)
        if done < len(data):
            parts.append(data[done:])
        text = _said(b"".join(parts))
        for blank in "\t\r\f\v\u00a0":
            text = text.replace(blank, " ")
        while "  " in text:
            text = text.replace("  ", " ")
        self.text = "\n".join(line for line in (x.strip() for x in text.split("\n")) if line)

    def _find(self, what: bytes, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.plain.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def _link(self, name: bytes, at: int, end: int) -> None:
        """The first address that a tag has; a quoted one may hold a ">"."""
        found = _ATTRIBUTE.search(self.plain, at, end)
        if not found:
            return
        start, quote = found.end(), found[2]
        if quote:
            stop = self._find(quote, start)
        else:
            bare = _BARE.match(self.data, start, end)
            stop = bare.end() if bare else -1
        if stop >= 0:
            path = f"{name.upper().decode()}@/{found[1].decode()}"
            self.links.append({"path": path, "url": _said(self.data[start:stop])})


def _said(data: bytes) -> str:
    text = data.decode("utf-8", "replace")
    return html.unescape(text) if "&" in text else text


def page_text(page: str) -> str:
    """The text a reader sees, a line per block, blanks run together, without empty lines."""
    return Page(page).text


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload; a block without a header part is all payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    pairs = [(n.strip(), v.strip()) for n, colon, v in (x.partition(":") for x in lines) if colon]
    return status, pairs, payload


def joined_chunks(body: bytes) -> bytes:
    """A body that was sent in chunks, as one; what does not follow the form is kept as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at, at + 1024)
        size = re.match(rb"\s*([0-9A-Fa-f]{1,8})\s*(?:;|$)", body[at:end]) if end >= 0 else None
        if size is None:
            return b"".join([*out, body[at:]])
        n = int(size[1], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n
        if body[at : at + 2] == b"\r\n":
            at += 2


def plain_body(headers: list[tuple[str, str]], body: bytes) -> tuple[bytes, bytes | None]:
    """The entity, and what it says without compression; None if it is compressed in a way unknown here.

    A compressed body that breaks off gives what came before.
    """
    said = {n.lower(): v.lower() for n, v in headers}
    if "chunked" in said.get("transfer-encoding", ""):
        body = joined_chunks(body)
    plain = body
    for coding in reversed([c.strip() for c in said.get("content-encoding", "").split(",")]):
        if coding in ("", "identity"):
            continue
        if coding in ("gzip", "x-gzip", "deflate"):
            plain = _inflated(plain)
        else:
            return body, None
    return body, plain


def _inflated(data: bytes) -> bytes:
    if not data:
        return data
    out = []
    # Gzip members follow each other; deflate comes with a zlib header or without one.
    bits = 47 if data[:2] == b"\x1f\x8b" or (data[0] & 15 == 8 and int.from_bytes(data[:2]) % 31 == 0) else -15
    while data:
        inflate = zlib.decompressobj(bits)
        try:
            out.append(inflate.decompress(data))
        except zlib.error:
            if not out:
                return data
            break
        if not inflate.eof or not inflate.unused_data.startswith(b"\x1f\x8b"):
            break
        data = inflate.unused_data
    return b"".join(out)


def derivatives(response: dict) -> list[dict]:
    """The metadata record and, for a page, the conversion record of one response."""
    status, headers, payload = split_http(response["block"] or b"")
    kind = next((v for n, v in headers if n.lower() == "content-type"), "")
    mime, _, options = kind.partition(";")
    charset = re.search(r"charset=[\"']?([\w.:-]+)", options, re.I)
    payload, said = plain_body(headers, payload)
    is_page = said is not None and mime.strip().lower() in ("", "text/html", "application/xhtml+xml")
    page = None
    if is_page:
        try:
            page = Page(said.decode(charset[1] if charset else "utf-8", "replace"))
        except (LookupError, UnicodeError):
            page = Page(said.decode("utf-8", "replace"))
    source = response["record_id"] or ""
    own = {k: new_id(source, k) for k in ("metadata", "conversion")}
    kept = {HEADERS[c]: response[c] for c in HEADERS if response.get(c) is not None}
    for further in response.get("headers") or []:
        name, value = further["name"], further["value"]
        kept[name] = value if name not in kept else [*([kept[name]] if isinstance(kept[name], str) else kept[name]), value]
    described = {
        "Envelope": {
            "WARC-Header-Metadata": kept,
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Status": status,
                    "Headers": [[n, v] for n, v in headers],
                    "Entity-Length": len(payload),
                    "Entity-Digest": digest(payload),
                    "HTML-Metadata": {
                        "Title": page.title if page else None,
                        "Links": page.links if page else [],
                    },
                },
            },
        },
    }
    blocks = [("metadata", "application/json", json.dumps(described, ensure_ascii=False).encode("utf-8", "replace"))]
    if is_page:
        blocks.append(("conversion", "text/plain; charset=utf-8", page.text.encode("utf-8", "replace")))
    return [
        {
            "record_id": own[k], "warc_type": k, "target_uri": response["target_uri"],
            "warc_date": response["warc_date"], "refers_to": response["record_id"],
            "concurrent_to": own["conversion" if k == "metadata" else "metadata"] if is_page else None,
            "content_type": content, "content_length": len(block), "block_digest": digest(block),
            "payload_digest": response["payload_digest"], "block": block, "headers": [],
        }
        for k, content, block in blocks
    ]


def _schema_like(rows: list[dict], extra: list[pa.Field]) -> pa.RecordBatch:
    pairs = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
    text = {"content_length": pa.int64(), "block": pa.binary(), "headers": pairs}
    fields = [pa.field(n, text.get(n, pa.string())) for n in NAMES] + extra
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def derive(records: DataFrame, keep: str | None = None) -> DataFrame:
    """Metadata and conversion records of all response records; others are passed over.

    Each refers to its response by ``refers_to``, holds the response's payload digest, and its own
    block's digest; the metadata block repeats the response's WARC headers, all of them, and its HTTP headers, and names the
    links and the title. The two are linked by ``concurrent_to``. Chunks are joined and gzip or deflate is undone first.
    A response that is not HTML, or compressed otherwise, has no conversion record; an empty or null block has an empty
    text. Repeated rows are converted like any other. ``keep`` is a further column to pass on, with a name that no
    record column has; ``headers`` may be missing.
    """
    if keep in NAMES:
        raise ValueError(f"{keep} is a column of records")
    if "headers" not in records.columns:
        records = records.withColumn("headers", F.array().cast("array<struct<name: string, value: string>>"))
    own = records.filter(F.col("warc_type") == "response").select(*NAMES, *([keep] if keep else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = [batch.schema.field(keep)] if keep else []
            for start in range(0, batch.num_rows, 256):
                rows = []
                for response in batch.slice(start, 256).to_pylist():
                    further = {keep: response[keep]} if keep else {}
                    rows += [further | made for made in derivatives(response)]
                yield _schema_like(rows, extra)

    further = f", {keep} {own.schema[keep].dataType.simpleString()}" if keep else ""
    return own.mapInArrow(run, RECORD + further)


def responses(pages: DataFrame, id_col: str, url_col: str, html_col: str, date: str) -> DataFrame:
    """Pages as response records, with the id as ``page_id``; null html is an empty payload.

    Repeated rows get the same record id.
    """
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = [batch.schema.field("page_id")]
            for start in range(0, batch.num_rows, 256):
                made = []
                for row in batch.slice(start, 256).to_pylist():
                    payload = (row["html"] or "").encode("utf-8", "replace")
                    block = (
                        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                        % len(payload)
                    ) + payload
                    sealed = digest(payload)
                    made.append({
                        "record_id": new_id(str(row["page_id"]), row["url"] or "", sealed),
                        "warc_type": "response", "target_uri": row["url"], "warc_date": date,
                        "content_type": "application/http; msgtype=response", "content_length": len(block),
                        "block_digest": digest(block), "payload_digest": sealed, "block": block, "headers": [],
                        "page_id": row["page_id"],
                    })
                yield _schema_like(made, extra)

    return rows.mapInArrow(run, f"{RECORD}, page_id {rows.schema['page_id'].dataType.simpleString()}")


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Records as WARC files, one per task; headers without a column come last."""
    named = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit("\r\n")))
        .otherwise("")
        for c, name in HEADERS.items()
    ]
    if "headers" in records.columns:
        lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), F.coalesce(h["value"], F.lit("")), F.lit("\r\n")))
        named.append(F.coalesce(F.array_join(lines, ""), F.lit("")))
    block = F.coalesce(F.col("block").cast("string"), F.lit(""))
    whole = F.concat(F.lit(f"{VERSION}\r\n"), *named, F.lit("\r\n"), block, F.lit("\r\n"))
    records.select(whole.alias("value")).write.option("lineSep", "\r\n").option("compression", compression).text(path)


#: What every version's first line begins with.
_FIRST = "WARC/1."


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files of versions 1.0 and 1.1, each as long as its Content-Length says.

    Files are cut at what looks like a record's first line, by as many tasks as Spark likes. Where all parts of a file
    are as long as they say, each is a record. A file with a part that is not, because a block holds such a line,
    is put together again in order, by one task that holds one record at a time. A file that does not add up even so
    (cut off, or no WARC file) is an error that names it.
    """
    parts = spark.read.option("lineSep", _FIRST).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    # A file's first part, before its first record, is empty; parts inside a block may be too.
    some = F.octet_length("value") > 0
    odd = parts.filter(some & ~_is_whole(F.col("value"))).select("file").distinct()
    numbered = parts.withColumn("number", F.monotonically_increasing_id())
    plain = parts.filter(some).join(odd, "file", "left_anti").select("value").mapInArrow(_parse, RECORD)
    again = numbered.join(odd, "file", "left_semi").repartition("file").sortWithinPartitions("file", "start", "number")
    return plain.unionByName(again.select("file", "value").mapInArrow(_put_together, RECORD))


def _is_whole(part: Column) -> Column:
    """Whether a part is a record with an end, by its Content-Length."""
    text = part.cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)
    length = F.regexp_extract(head, r"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|$)", 1)
    whole = F.octet_length(head) + 4 + length.try_cast("long") + 4
    return F.coalesce(whole == F.octet_length(text), F.lit(False))


def _head(part: bytes) -> tuple[dict, list[dict], int, int] | None:
    """Columns, further headers, Content-Length, and where the block begins; None if a part does not hold a whole head."""
    end = part.find(b"\r\n\r\n")
    if end < 0:
        return None
    columns = {name.lower(): c for c, name in HEADERS.items()}
    pairs: list[list[str]] = []
    # The first line is what is left of the version.
    for line in part[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and pairs:
            pairs[-1][1] += f" {line.strip()}"
        elif ":" in line:
            name, _, value = line.partition(":")
            pairs.append([name.strip(), value.strip()])
    row: dict = {}
    further = []
    for name, value in pairs:
        c = columns.get(name.lower())
        if c and c not in row:
            row[c] = value
        else:
            further.append({"name": name, "value": value})
    said = str(row.get("content_length", ""))
    if not said.isdigit():
        return None
    row["content_length"] = int(said)
    return row, further, int(said), end + 4


def _record(part: bytes) -> dict | None:
    """The record that a part is; None if it is not as long as it says."""
    found = _head(part)
    if found is None or part[found[3] + found[2] :] != b"\r\n\r\n":
        return None
    row, further, length, start = found
    return {**row, "headers": further, "block": part[start : start + length]}


def _batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["block"])
        if size > 8 << 20 or len(held) >= 256:
            yield _schema_like(held, [])
            held, size = [], 0
    if held:
        yield _schema_like(held, [])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        for batch in batches:
            for value in batch.column(0):
                yield _record(value.as_py())

    yield from _batched(found())


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        file, held, size, need = None, [], 0, None
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                if held and name.as_py() != file:
                    raise ValueError(f"a record is not as long as it says: in {file}")
                begins, file, part = name.as_py() != file, name.as_py(), value.as_py()
                if begins and not part:
                    continue
                # What the parts were cut by belongs to the block in which it stood.
                held.append(_FIRST.encode() + part if held else part)
                size += len(held[-1])
                if need is None:
                    held = [b"".join(held)]
                    head = _head(held[0])
                    need = head and head[3] + head[2] + 4
                if need is None or size < need:
                    continue
                record = _record(b"".join(held))
                if record is None:
                    raise ValueError(f"a record is not as long as it says: in {file}")
                yield record
                held, size, need = [], 0, None
        if held:
            raise ValueError(f"a record is not as long as it says: in {file}")

    yield from _batched(found())
