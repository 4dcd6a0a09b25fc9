import hashlib
import html
import re

from conftest import SF0001

from docweave.llm import warc

PAGES = [
    (1, "http://a/x?q=1&r=2", "<html lang='de'><head><meta charset=utf-8><title>A &amp;\n B</title><style>p{}</style></head>"
                              "<body><p>One&nbsp;&mdash; two<br>three<!-- no --><script>if (a<b) x();</script><a href='/u v'>li<b>nk</b></a></p>"
                              "<img src=pic.png><noscript>off</noscript></body></html>"),
    (2, None, "plain < text > &eacute;&#8217;"), (3, "http://b/", None), (4, "http://c/", ""), (None, "http://d/", "<p>x"),
    (5, "http://e/", "<br>" * 50_000 + "end"), (6, "http://f/", "<p>a\r\n\r\nb</p><script>never closed"), (6, "http://f/", "<p>a\r\n\r\nb</p><script>never closed"),
]


def sha(t):
    return "sha256:" + hashlib.sha256(t.encode()).hexdigest()


def derived(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("id", "payload", "date", "block"):
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("clash"))
    return warc.derive(warc.response_records(df))


def test_records_link_to_their_response(spark):
    responses = {r.record_id: r for r in warc.response_records(spark.createDataFrame(PAGES, "page_id long, url string, html string")).collect()}
    rows = derived(spark).collect()
    assert len(rows) == 2 * len(PAGES)
    assert len({r.record_id for r in rows}) == 2 * (len(PAGES) - 1) and len(responses) == len(PAGES) - 1
    for r in rows:
        source = responses[r.refers_to]
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id)
        assert (r.target_uri, r.refers_to_date, r.payload_digest) == (source.target_uri, source.date, sha(source.payload))
        assert r.block_digest == sha(r.block) and r.content_length == len(r.block.encode())
        head = dict(x.split(": ", 1) for x in r.headers.split("\r\n")[1:])
        assert head["WARC-Refers-To"] == r.refers_to and head["WARC-Type"] == r.record_type and head["Content-Length"] == str(r.content_length)
        assert ("WARC-Target-URI" in head) == (r.target_uri is not None)
        if r.record_type == "metadata":
            assert all(f"source-header: {h}\r\n" in r.block for h in source.http_headers.split("\r\n"))


def test_blocks(spark):
    rows = {(r.id, r.record_type): r.block for r in derived(spark).collect()}
    assert rows[1, "conversion"] == "One — two\nthree" + "link"
    meta = rows[1, "metadata"]
    assert meta.startswith("title: A & B\r\nlanguage: de\r\ncharset: utf-8\r\n")
    assert meta.endswith("outlink: /u v a/@href\r\noutlink: pic.png img/@src\r\n")
    assert rows[2, "conversion"] == "plain < text > é’"
    assert rows[3, "conversion"] == rows[4, "conversion"] == ""
    assert rows[5, "conversion"] == "end" and rows[6, "conversion"] == "a\nb" and rows[None, "conversion"] == "x"


def test_text_equals_a_regular_expression_model_on_the_table(spark):
    df = spark.read.parquet(f"{SF0001}/pages.parquet")
    got = {r.refers_to: r.block for r in warc.derive(warc.response_records(df)).where("record_type = 'conversion'").collect()}
    for r in warc.response_records(df).collect():
        t = re.sub(r"(?is)<!--.*?-->|<(script|style|noscript|template|title)\b[^>]*>.*?</\1\s*>", "", r.payload)
        t = re.sub(r"(?i)</?(" + "|".join(sorted(warc.BLOCK)) + r")\b[^>]*>", "\n", t)
        t = html.unescape(re.sub(r"</?[a-zA-Z!][^>]*>", "", t))
        want = "\n".join(x for x in (re.sub(r"\s+", " ", line).strip() for line in t.split("\n")) if x)
        assert got[r.record_id] == want


def test_files_round_trip(spark, tmp_path):
    rows = derived(spark)
    warc.write_warc(rows.repartition(2), str(tmp_path / "w"))
    records, broken = warc.read_warc(spark, str(tmp_path / "w"))
    assert broken.count() == 0
    key = "warc-record-id"
    got = sorted((dict((h.key, h.value) for h in r.headers)[key], r.block) for r in records.collect())
    assert got == sorted((r.record_id, r.block) for r in rows.collect())
    (tmp_path / "x.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort\r\n\r\n")
    records, broken = warc.read_warc(spark, str(tmp_path / "x.warc"))
    assert records.count() == 0 and broken.count() == 1


def test_empty_table(spark):
    assert derived(spark, []).count() == 0


def test_noscript_and_template_that_never_close():
    text = lambda page: warc.page_parts(page)[4]
    assert text("<p>a</p><noscript><p>b</p><p>c") == text("<p>a</p><template>b<br>c") == "a\nb\nc"
    assert text("<noscript>a<noscript>b</noscript>c<template>d") == "acd"
    assert text("a<noscript>b<template>c</noscript>d") == text("a<template><noscript>b<i>c</template>d") == "ad"
    assert text("a<noscript>b<script>c</script>d<style>e</style><title>f</title>g") == "abdg"
    assert text("<div>" * 3 + "<template>" * 20_000 + "<br>x" * 20_000 + "</template>" * 20_000 + "y") == "y"
