import base64
import hashlib
import json
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.test_page_wrappers import RICH
from tideline.llm import warc_derivatives as warc


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


class Plain(HTMLParser):
    """Text lines and links of a page, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.lines, self.held, self.links, self.skip, self.title = [], "", [], 0, None

    def flush(self):
        line = " ".join(self.held.split())
        self.held = ""
        if line:
            self.lines.append(line)

    def handle_starttag(self, tag, attrs):
        if tag in warc._LINES:
            self.flush()
        self.skip += tag in ("script", "style", "title")
        for name, value in attrs:
            if warc._LINKS.get(tag) == name:
                self.links.append(value)

    def handle_endtag(self, tag):
        if tag in warc._LINES:
            self.flush()
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.held += data


def plain(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    parser.flush()
    return "\n".join(parser.lines), parser.links


def test_given_pages(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    sources = {r.page_id: r for r in warc.responses(pages).collect()}
    made = warc.derivatives(warc.responses(pages))
    rows = made.collect()
    given = {r.page_id: r for r in pages.collect()}
    assert len(rows) == 2 * len(given)
    by = {(r.page_id, r.warc_type): r for r in rows}
    assert len({r.record_id for r in rows}) == len(rows)
    for page_id, page in given.items():
        text, links = plain(page.html)
        source, meta, text_row = sources[page_id], by[page_id, "metadata"], by[page_id, "conversion"]
        own = source.warc_headers
        assert bytes(source.payload) == page.html.encode() and own["WARC-Payload-Digest"] == sha1(page.html.encode())
        assert own["WARC-Block-Digest"] == sha1(source.http_headers.encode() + page.html.encode())
        assert int(own["Content-Length"]) == len(source.http_headers) + len(page.html.encode())
        assert text_row.block == text
        for row in (meta, text_row):
            assert row.refers_to == own["WARC-Record-ID"] and row.target_uri == page.url
            assert row.source_digest == sha1(page.html.encode())
            assert (row.block_digest, row.content_length) == (sha1(row.block.encode()), len(row.block.encode()))
            assert f"WARC-Refers-To: {row.refers_to}\r\n" in row.header and row.header.endswith("\r\n\r\n")
        assert f"WARC-Concurrent-To: {meta.record_id}\r\n" in text_row.header
        envelope = json.loads(meta.block)["Envelope"]
        assert envelope["WARC-Header-Metadata"] == own
        http = envelope["Payload-Metadata"]["HTTP-Response-Metadata"]
        assert http["Headers"]["Content-Length"] == str(len(page.html.encode()))
        assert [x["url"] for x in http["HTML-Metadata"]["Links"]] == links
    warc.write_warc(made, f"{tmp_path}/w")
    back = {r.headers["WARC-Record-ID"]: r for r in warc.read_warc(spark, f"{tmp_path}/w").collect()}
    assert len(back) == len(rows)
    for row in rows:
        got = back[row.record_id]
        assert got.block == row.block and got.headers["WARC-Block-Digest"] == row.block_digest


def test_rich_page():
    meta, text = warc.derive({"WARC-Record-ID": "<urn:x>", "WARC-Target-URI": "http://a/\r\nX: y"}, None, RICH.encode())
    assert text["block"].split("\n")[:3] == ["Home", "We use cookies here", "One"]
    assert json.loads(meta["block"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Head"] == {"Title": "T & t"}
    assert "\r\nX: y" not in meta["header"]


def test_edges(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a/b", "<p>x"), (2, "http://a/é", ""), (3, "u", "<p>" + "long word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "block": F.lit(2)})
    got = warc.derivatives(warc.responses(pages)).collect()
    assert len(got) == 10 and sorted(r.content_length for r in got if r.warc_type == "conversion") == [0, 0, 0, 1, 499_999]
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []
    odd = spark.createDataFrame([(1, None, None, None), (2, {"WARC-Date": None}, "x", b"\xff\xfe<p>y")], f"page_id long, {warc.RESPONSE}")
    made = warc.derivatives(odd).collect()
    assert len({r.record_id for r in made}) == 4 and made[3].block == "��\ny"
    assert made[3].source_digest == sha1(b"\xff\xfe<p>y")
