"""WARC: derivative builder.

From response records it builds, for each, a metadata record (fields read off
the page: title, language, character set, outgoing links, and the source's HTTP
headers) and a conversion record (its plain text). Both name the response in
WARC-Refers-To and keep its target, date and payload digest; each has an id and
a block digest of its own. Record ids follow from the response id and the
record's kind, so a repeated run writes the same records.

Records are rows; ``write_warc`` writes them as .warc files (one per
partition) and ``read_warc`` reads such files back, splitting them at record
ends, so one large file is read by many tasks. A record whose block is not as
long as its Content-Length says goes to the second result of ``read_warc``.

Digests are "sha256:" with lowercase hex.

Defined results: null html is an empty payload, its text empty and its metadata
without page fields; a null url leaves WARC-Target-URI out; a null id counts as
the text "null" in the response id; equal (id, url, html) rows give equal
records; markup that never closes is read as far as it goes; a noscript or
template that never closes hides nothing, while script, style and title follow
HTML's raw-text rule (they hold all that follows); an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches

CRLF = "\r\n"
VERSION = "WARC/1.1"
#: text inside these is no page text
HIDDEN = {"script", "style", "noscript", "template", "title"}
#: of these, text is struck out when the tag closes: where it never does, the text stays
HELD = {"noscript", "template"}
#: these start a new line of text
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}


def response_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(id, record_id, target_uri, date, http_headers, payload, payload_digest): one response record per page."""
    key = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.coalesce("target_uri", F.lit("null")), "payload_digest")
    length = F.octet_length("payload").cast("string")
    return (pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("target_uri"),
                         F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("payload"))
            .withColumn("payload_digest", digest(F.col("payload")))
            .select("id", record_id(F.concat(F.lit("response|"), key)).alias("record_id"), "target_uri", F.lit(date).alias("date"),
                    F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length).alias("http_headers"),
                    "payload", "payload_digest"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def record_id(text: Column) -> Column:
    """A UUID made of a name's hash."""
    h = F.sha2(text, 256)
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), part[0], F.lit("-"), part[1], F.lit("-8"), part[2], F.lit("-a"), part[3], F.lit("-"), part[4], F.lit(">"))


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out, self.title, self.links, self.lang, self.charset = [], [], [], "", ""
        self.hidden, self.marks = [], []           # open hidden tags, and where in ``out`` each opened

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.out.append("\n")
        if tag in HIDDEN:
            self.hidden.append(tag)
            self.marks.append(len(self.out))
        attrs = dict(attrs)
        if tag == "html" and attrs.get("lang"):
            self.lang = attrs["lang"]
        elif tag == "meta" and attrs.get("charset"):
            self.charset = attrs["charset"]
        elif tag in ("a", "area", "link") and attrs.get("href"):
            self.links.append((attrs["href"], f"{tag}/@href"))
        elif tag in ("img", "script", "iframe") and attrs.get("src"):
            self.links.append((attrs["src"], f"{tag}/@src"))

    def handle_startendtag(self, tag, attrs):
        depth = len(self.hidden)
        self.handle_starttag(tag, attrs)
        del self.hidden[depth:], self.marks[depth:]

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.out.append("\n")
        if tag in self.hidden:
            k = len(self.hidden) - 1 - self.hidden[::-1].index(tag)
            held = self.out[self.marks[k]:]
            self.out[self.marks[k]:] = ["\n"] if "\n" in held else []
            del self.hidden[k:], self.marks[k:]

    def handle_data(self, data):
        if all(tag in HELD for tag in self.hidden):
            self.out.append(data)
        elif self.hidden[-1] == "title":
            self.title.append(data)


_BLANK = re.compile(r"\s+")


def one_line(text: str) -> str:
    return _BLANK.sub(" ", text).strip()


def page_parts(html: str) -> tuple[str, str, str, list, str]:
    """(title, language, charset, links, plain text) of a whole page."""
    p = _Page()
    p.feed(html)
    p.close()
    lines = [one_line(x) for x in "".join(p.out).split("\n")]
    return one_line("".join(p.title)), one_line(p.lang), one_line(p.charset), p.links, "\n".join(x for x in lines if x)


def metadata_block(http_headers: str, title: str, lang: str, charset: str, links: list) -> str:
    fields = [("title", title), ("language", lang), ("charset", charset)]
    fields += [("source-header", one_line(h)) for h in (http_headers or "").split(CRLF)]
    fields += [("outlink", f"{one_line(url)} {via}") for url, via in links]
    return "".join(f"{k}: {v}{CRLF}" for k, v in fields if v)


def derive(responses: DataFrame, made: str = "2024-01-02T00:00:00Z") -> DataFrame:
    """(id, record_type, record_id, refers_to, target_uri, date, refers_to_date,
    content_type, payload_digest, block_digest, content_length, headers,
    block): two rows per response."""
    import pyarrow as pa

    kinds = ("metadata", "conversion")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            blocks = []
            for html, http in zip(batch.column("payload").to_pylist(), batch.column("http_headers").to_pylist()):
                title, lang, charset, links, text = page_parts(html or "")
                blocks += [metadata_block(http, title, lang, charset, links), text]
            twice = pa.array([i for i in range(batch.num_rows) for _ in kinds], pa.int64())
            names = [n for n in batch.schema.names if n != "payload"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(twice) for n in names], pa.array(list(kinds) * batch.num_rows, pa.string()),
                                              pa.array(blocks, pa.string())], names=[*names, "record_type", "block"])

    bounded_batches(responses.sparkSession)
    own = responses.select("id", F.col("record_id").alias("refers_to"), "target_uri", F.col("date").alias("refers_to_date"), "http_headers",
                           "payload_digest", "payload")
    kind = own.schema["id"].dataType.simpleString()
    rows = own.mapInArrow(run, f"id {kind}, refers_to string, target_uri string, refers_to_date string, http_headers string, "
                               "payload_digest string, record_type string, block string")
    content = F.when(F.col("record_type") == "metadata", "application/warc-fields").otherwise("text/plain; charset=utf-8")
    rows = (rows.withColumn("record_id", record_id(F.concat_ws("|", "record_type", "refers_to"))).withColumn("date", F.lit(made))
            .withColumn("content_type", content).withColumn("block_digest", digest(F.col("block")))
            .withColumn("content_length", F.octet_length("block").cast("long")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  null where the value is null
    headers = F.concat_ws(CRLF, F.lit(VERSION), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
                          line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")),
                          line("WARC-Date", F.col("date")), line("WARC-Refers-To-Date", F.col("refers_to_date")),
                          line("WARC-Source-Payload-Digest", F.col("payload_digest")), line("WARC-Block-Digest", F.col("block_digest")),
                          line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")))
    return rows.select("id", "record_type", "record_id", "refers_to", "target_uri", "date", "refers_to_date", "content_type",
                       "payload_digest", "block_digest", "content_length", headers.alias("headers"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """One .warc file per partition; each record ends with two line breaks."""
    records.select(F.concat("headers", F.lit(CRLF * 2), "block").alias("value")).write.option("lineSep", CRLF * 2).text(path)


def read_warc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, broken): records as (headers: list of key and value, block)."""
    raw = spark.read.option("lineSep", f"{CRLF * 2}{VERSION}{CRLF}").text(path)
    value = F.regexp_replace("value", f"^{re.escape(VERSION)}\r\n", "")
    at = F.instr(value, CRLF * 2)
    parts = raw.select(F.substring(value, F.lit(1), at - 1).alias("head"), F.encode(F.substring(value, at + 4, F.length(value)), "utf-8").alias("body"))
    pairs = F.transform(F.split("head", CRLF), lambda x: F.struct(F.lower(F.substring_index(x, ":", 1)).alias("key"),
                                                                 F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")))
    length = F.regexp_extract("head", r"(?im)^content-length:[ \t]*(\d+)[ \t]*$", 1)
    found = parts.withColumn("headers", pairs).withColumn("n", length.try_cast("int"))
    rest = F.expr("substring(body, n + 1)")
    whole = F.coalesce((F.octet_length("body") >= F.col("n")) & rest.isin(F.lit(b""), F.lit(b"\r\n\r\n")), F.lit(False))
    records = found.where(whole).select("headers", F.decode(F.expr("substring(body, 1, n)"), "utf-8").alias("block"))
    return records, found.where(~whole).select("head", F.decode("body", "utf-8").alias("body"))
