"""Metadata and plain-text records derived from WARC responses.

Each response yields two records. The metadata record holds, as JSON, the response's own WARC and
HTTP headers, its digests, and the page's title and links; the conversion record holds the page's
text. Both refer to the response by its identifier, target and date, carry its payload digest on,
and the conversion names the metadata record it was made along with. Identifiers are made from
what a record is derived from, so a task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html as references
import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.page_wrappers import tokens

VERSION = "WARC/1.1"
#: The date of responses that have none, and the software named in derived records.
DATE, SOFTWARE = "2024-01-01T00:00:00Z", "tideline"

RESPONSE = "warc_headers map<string,string>, http_headers string, payload binary"
RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, content_type string, "
    "content_length long, block_digest string, source_digest string, header string, block string"
)

# Elements that begin a line of text, and attributes that hold links.
_LINES = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "iframe": "src", "script": "src", "form": "action"}
_LINK = {
    name: re.compile(rf"(?:^|\s){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
    for name in set(_LINKS.values())
}
_TITLE = re.compile(r"<title(?:\s[^>]*)?>([^<]*)", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An identifier that only equal parts share."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(json.dumps(parts).encode()).digest()[:16], version=4)}>"


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``pages`` with the response record of each: its WARC headers, HTTP headers and payload.

    The columns are ``page_id``, and those of :data:`RESPONSE`. A page without url has a
    response without target, one without html a response without payload; equal rows have equal
    records.
    """

    @F.pandas_udf(RESPONSE)
    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, urls, bodies in batches:
            rows = []
            for page_id, url, body in zip(ids, urls, bodies):
                payload = (body or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                whole = hashlib.sha1(http.encode())
                whole.update(payload)
                own = digest(payload)
                headers = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": record_id("response", str(page_id), url or "", own),
                    "WARC-Date": date,
                    "Content-Type": "application/http; msgtype=response",
                    "Content-Length": str(len(http) + len(payload)),
                    "WARC-Payload-Digest": own,
                    "WARC-Block-Digest": "sha1:" + base64.b32encode(whole.digest()).decode(),
                }
                if url is not None:
                    headers["WARC-Target-URI"] = url
                rows.append((headers, http, payload))
            yield pd.DataFrame(rows, columns=["warc_headers", "http_headers", "payload"])

    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return pages.select("page_id", of(key, F.col("url"), F.col("html")).alias("r")).select("page_id", "r.*")


def text_and_links(page: str) -> tuple[str, list[dict[str, str]]]:
    """The lines of text that the page shows, and its links as they are written."""
    lines, links, held = [], [], []

    def flush() -> None:
        line = " ".join(references.unescape("".join(held)).split())
        held.clear()
        if line:
            lines.append(line)

    for kind, name, attributes in tokens(page):
        if kind == "text":
            held.append(name)
            continue
        if name in _LINES and held:
            flush()
        if kind == "start" and attributes and name in _LINKS:
            found = _LINK[_LINKS[name]].search(attributes)
            if found:
                url = references.unescape(found[1] or found[2] or found[3] or "").strip()
                links.append({"path": f"{name.upper()}@/{_LINKS[name]}", "url": url})
    flush()
    return "\n".join(lines), links


def _http_fields(http: str) -> tuple[str, dict[str, str]]:
    first, _, rest = http.strip("\r\n").partition("\r\n")
    pairs = (line.partition(":") for line in rest.split("\r\n") if ":" in line)
    return first, {name.strip(): value.strip() for name, _, value in pairs}


def _derived(kind: str, own_id: str, source: dict[str, str], content_type: str, block: str, more: dict[str, str]) -> dict:
    data = block.encode()
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": own_id,
        "WARC-Date": source.get("WARC-Date", DATE),
        "WARC-Refers-To": source.get("WARC-Record-ID"),
        "WARC-Target-URI": source.get("WARC-Target-URI"),
        "WARC-Refers-To-Target-URI": source.get("WARC-Target-URI"),
        "WARC-Refers-To-Date": source.get("WARC-Date"),
        "WARC-Source-Payload-Digest": source.get("WARC-Payload-Digest"),
        **more,
        "WARC-Block-Digest": digest(data),
        "Content-Type": content_type,
        "Content-Length": str(len(data)),
    }
    # A line break in a value would end the header.
    lines = [f"{name}: {' '.join(value.split())}" for name, value in headers.items() if value is not None]
    return {
        "warc_type": kind, "record_id": own_id, "refers_to": headers["WARC-Refers-To"],
        "target_uri": headers["WARC-Target-URI"], "content_type": content_type, "content_length": len(data),
        "block_digest": headers["WARC-Block-Digest"], "source_digest": headers["WARC-Source-Payload-Digest"],
        "header": "\r\n".join([VERSION, *lines, "", ""]), "block": block,
    }


def derive(source: dict[str, str], http: str | None, payload: bytes | None) -> list[dict]:
    """The metadata and the conversion record of one response."""
    source = {k: v for k, v in (source or {}).items() if v is not None}
    data = payload or b""
    page = data.decode("utf-8", "replace")
    text, links = text_and_links(page)
    title = _TITLE.search(page)
    status, fields = _http_fields(http or "")
    of = source.get("WARC-Record-ID") or record_id("response", digest(data), source.get("WARC-Target-URI", ""))
    source.setdefault("WARC-Record-ID", of)
    source.setdefault("WARC-Payload-Digest", digest(data))
    envelope = {
        "Envelope": {
            "WARC-Header-Metadata": source,
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status,
                    "Headers": fields,
                    "Entity-Length": len(data),
                    "Entity-Digest": digest(data),
                    "HTML-Metadata": {
                        "Head": {"Title": " ".join(references.unescape(title[1]).split()) if title else None},
                        "Links": links,
                    },
                },
            },
        }
    }
    block = json.dumps(envelope, ensure_ascii=False, sort_keys=True)
    metadata = _derived("metadata", record_id("metadata", of), source, "application/json", block, {"Software": SOFTWARE})
    conversion = _derived(
        "conversion", record_id("conversion", of), source, "text/plain; charset=utf-8", text,
        {"WARC-Concurrent-To": metadata["record_id"], "Software": SOFTWARE},
    )
    return [metadata, conversion]


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response: ``page_id`` and the columns of :data:`RECORD`.

    ``records`` has the columns that :func:`responses` gives. Payloads that are no UTF-8 are read
    with replacement characters; their digests are of the bytes. Missing headers and payloads
    count as empty, and a response without identifier gets one from its target and payload.
    """

    @F.pandas_udf(f"array<struct<{RECORD}>>")
    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, https, payloads in batches:
            yield pd.Series(
                [derive(dict(s) if s else {}, h, p) for s, h, p in zip(sources, https, payloads)], dtype=object
            )

    made = records.select("page_id", F.explode(of("warc_headers", "http_headers", "payload")).alias("d"))
    return made.select("page_id", "d.*")


def write_warc(records: DataFrame, path: str) -> None:
    """Derived records as gzipped WARC files, one per partition.

    Their blocks are text without carriage returns, so no block looks like the end of a record.
    """
    whole = F.concat("header", "block").alias("value")
    records.select(whole).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``headers`` and ``block`` of the records that :func:`write_warc` wrote."""
    parts = spark.read.option("lineSep", f"{VERSION}\r\n").text(path).where("value <> ''")
    at = F.expr("instr(value, '\r\n\r\n')")
    lines = F.split(F.expr("substr(value, 1, instr(value, '\r\n\r\n') - 1)"), "\r\n")
    pairs = F.transform(lines, lambda line: F.struct(F.split(line, ": ", 2)[0], F.split(line, ": ", 2)[1]))
    # A record ends with two line breaks that are not part of its block.
    block = F.expr("substr(value, instr(value, '\r\n\r\n') + 4, length(value) - instr(value, '\r\n\r\n') - 7)")
    return parts.where(at > 0).select(F.map_from_entries(pairs).alias("headers"), block.alias("block"))
