import base64
import glob
import gzip
import hashlib

from pyspark.sql import functions as F

from weblattice.llm import warc

PAGES = [
    (1, "http://a/x", '<!DOCTYPE html><html lang="en"><head><title>A &amp; B\n c</title><style>p{}</style><script>var t="</p>";</script></head>'
                      '<body><!-- no --><p>One <b>two</b><br>three&nbsp;&lt;é&gt;</p><a href="/q">l</a></body></html>'),
    (2, None, None), (3, "", ""), (None, "http://n", "<script>cut"), (1, "http://a/x", "plain"), (4, "u", "x" * 300_000),
]


def frame(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("block", F.lit(1)).withColumn("text", F.lit("x"))


def test_records(spark):
    got = warc.derivatives(warc.responses(frame(spark))).collect()
    assert len(got) == 2 * len(PAGES)
    for r in got:
        block = r["block"].encode()
        assert r["content_length"] == len(block)
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert len(r["record_id"]) == len("<urn:uuid:>") + 36 and r["record_id"] != r["refers_to"]
    one = {r["record_type"]: r for r in got if r["page_id"] == 1 and "One" in r["block"] or r["page_id"] == 1 and "A & B c" in r["block"]}
    assert one["conversion"]["block"] == "A & B\nc\nOne two\nthree <é>\nl"
    meta = one["metadata"]["block"].split("\r\n")
    assert meta[:3] == ["title: A & B c", "language: en", "outlinks: 1"]
    html = PAGES[0][2].encode()
    assert meta[3] == "source-payload-digest: sha1:" + base64.b32encode(hashlib.sha1(html).digest()).decode()
    assert f"source-header: Content-Length: {len(html)}" in meta
    assert one["conversion"]["refers_to"] == one["metadata"]["refers_to"]
    assert {r["block"] for r in got if r["record_type"] == "conversion" and r["page_id"] in (None, 2, 3)} == {""}


def test_written_files_read_back(spark, tmp_out):
    records = warc.derivatives(warc.responses(frame(spark)))
    warc.write(records, tmp_out + "/w")
    blocks = []
    for name in glob.glob(tmp_out + "/w/part-*"):
        data = gzip.open(name).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            n = int(fields["Content-Length"])
            blocks.append((fields["WARC-Type"], fields["WARC-Refers-To"], rest[:n].decode()))
            assert rest[n:n + 4] == b"\r\n\r\n"
            data = rest[n + 4:]
    assert sorted(blocks) == sorted((r["record_type"], r["refers_to"], r["block"]) for r in records.collect())


def test_empty_table(spark):
    assert warc.derivatives(warc.responses(frame(spark).limit(0))).collect() == []
