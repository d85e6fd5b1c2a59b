"""WARC derivatives: references, digests, headers, odd records."""

import base64
import hashlib

from tierflow.llm import registry, warc


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


HTTP = b"HTTP/1.1 200 OK\r\nX-Own: a: b\r\n\r\n<title>t</title><p>a\nb &amp; c<br>d<script>x</script>"


def response(**more):
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Date": "2020-02-02T00:00:00Z",
              "WARC-Target-URI": "http://a/b", "WARC-Payload-Digest": "sha1:GIVEN", **more}
    return warc.serialize(list(fields.items()), HTTP)


def test_both_records_refer_to_the_response(frame):
    rows = {r.type: r for r in warc.derivatives(frame("record binary", (response(),))).collect()}
    assert set(rows) == {"metadata", "conversion"}
    assert rows["conversion"].payload == "t\na b & c\nd"
    for r in rows.values():
        fields, block = warc.parse(bytes(r.record))
        assert fields["warc-refers-to"] == "<urn:uuid:1>" == r.refers_to
        assert fields["warc-target-uri"] == "http://a/b" and fields["warc-date"] == "2020-02-02T00:00:00Z"
        assert fields["warc-block-digest"] == sha1(block) == r.block_digest
        assert r.source_payload_digest == "sha1:GIVEN" and r.source_block_digest == sha1(HTTP)
        assert block.decode() == r.payload and r.content_length == len(block)
    assert "source-header: X-Own: a: b" in rows["metadata"].payload
    assert warc.parse(bytes(rows["metadata"].record))[0]["warc-concurrent-to"] == rows["conversion"].record_id


def test_odd_records(frame):
    rows = [(response(**{"WARC-Type": "request"}), 1), (None, 1), (b"", 1), (b"junk", 1), (response()[:40], 1),
            (response(), 1), (response(), 1), (warc.serialize([("WARC-Type", "response")], b""), 1)]
    got = warc.derivatives(frame("record binary, type int", *rows)).collect()
    assert sorted(r.response_id for r in got) == [""] * 2 + ["<urn:uuid:1>"] * 4
    assert len({(r.record_id, r.type) for r in got}) == 4
    assert {r.payload for r in got if r.response_id == "" and r.type == "conversion"} == {""}
    assert warc.derivatives(frame("record binary")).collect() == []


def test_visible_text():
    assert warc.visible_text("<head><title>t</title></head><p>a\n b</p>c<!-- x --><style>y</style>") == "a b\nc"
    assert warc.visible_text("<p>&lt;b&gt;") == "<b>"
    assert warc.visible_text("<script>unclosed") == ""
    assert warc.visible_text("") == ""


def test_head_without_end_tag():
    head = "<html><head lang='x'>\n<meta charset=u><title>t</title><!-- <p>no --><script>'<p>no'</script>\n"
    assert warc.visible_text(head + "<body><p>a</p>b") == "a\nb"
    assert warc.visible_text(head + "<h1>a</h1>b") == "a\nb"
    assert warc.visible_text(head + "a <b>b</b><p>c") == "a b\nc"
    assert warc.visible_text(head + "</head>a") == "a"
    assert warc.visible_text(head) == ""
    assert warc.visible_text("<header>a</header>") == "a"


def test_edge_pages(frame):
    pages = frame("page_id long, url string, html string, record int",
                  (1, None, None, 1), (None, "http://a", "<p>x</p>", 1), (2, "http://b", "<p>é</p>" * 50000, 1))
    rows = warc.page_derivatives(pages).collect()
    assert len(rows) == 6
    assert sorted(len(r.payload) for r in rows if r.type == "conversion") == [0, 1, 99999]


def test_query_on_the_test_table(spark):
    pages = {warc.record_id("response", str(r.page_id), r.url): r for r in spark.read.parquet(
        "/root/testdata/sf0.001/pages.parquet").collect()}
    rows = registry.QUERIES["op2_warc_derivatives"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 2 * len(pages) == 2 * len({r.refers_to for r in rows})
    for r in rows:
        page = pages[r.refers_to]
        assert r.target_uri == page.url and r.source_payload_digest == sha1(page.html.encode())
        fields, block = warc.parse(bytes(r.record))
        assert fields["warc-record-id"] == r.record_id and sha1(block) == r.block_digest
        if r.type == "conversion":
            assert r.payload == warc.visible_text(page.html)
