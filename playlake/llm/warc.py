"""WARC derivatives: from response records to metadata and plain-text conversion records.

A record is a row with its ``header`` (the WARC header lines) and its ``block``. Every response
gives a ``metadata`` record (title, language, links and the headers of the response) and a
``conversion`` record (the page as plain text). Both name the response in ``WARC-Refers-To``, and
repeat its target, its date and its digests.

DataFrame functions only: a record is made from its own row, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import take

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"

#: Patterns in the common subset of Java's and RE2's syntax; removed or replaced in this order.
HIDDEN = (r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>",
          r"(?is)<noscript\b.*?</noscript\s*>", r"(?is)<title\b.*?</title\s*>")
BREAKS = (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|header|footer|aside|main"
          r"|blockquote|pre)\b[^>]*>")
TAG = r"<[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
LANGUAGE = r'(?is)<html\b[^>]*\blang="([^"]*)"'
LINK = r'(?is)<a\b[^>]*\bhref="([^"]*)"'


def record_id(kind: str, *parts: Column) -> Column:
    """A URN that is the same in every run, from the kind of the record and what it is made of."""
    h = F.sha2(F.concat_ws(":", F.lit(kind), *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                    F.substring(h, 21, 12), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; fields whose value is null are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in fields])


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of ``pages`` (``page_id``, ``url``, ``html``): ``page_id``, ``header``, ``block``.

    A null page is an empty one; a null URL has no target line.
    """
    html = F.coalesce("html", F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(CRLF + CRLF))
    rows = take(pages, "page_id", "url", "html").select(
        "page_id", "url", html.alias("html"), F.concat(http, html).alias("block"))
    header = F.concat(F.lit(f"WARC/1.1{CRLF}"), lines(
        ("WARC-Type", F.lit("response")),
        ("WARC-Record-ID", record_id("response", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))),
        ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", digest(F.col("html"))), ("WARC-Block-Digest", digest(F.col("block"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string"))))
    return rows.select("page_id", header.alias("header"), "block")


def field(header: Column, name: str) -> Column:
    """A header field's value; null if it isn't there."""
    found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(header.rlike(rf"(?im)^{name}:"), found)


def plain_text(html: Column) -> Column:
    """The text a reader sees, a line for each block of the page."""
    text = html
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAG, "")
    for name, letter in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(letter))
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of the response records among ``records``.

    Takes ``page_id``, ``header`` and ``block``; other kinds of records and rows without a header
    give nothing. Returns ``page_id``, ``record_type``, ``record_id``, ``refers_to``,
    ``target_uri``, ``source_digest`` (of the response's payload), ``block_digest``,
    ``content_length``, ``header`` and ``block``.

    A response without an HTTP header is taken as a payload alone. Fields that a response lacks
    are left out. A page without text gives a conversion record with an empty block. Repeated
    responses give repeated records. An empty table gives an empty one. Further columns don't
    matter.
    """
    table = take(records, "page_id", "header", "block").where(field(F.col("header"), "WARC-Type") == "response")
    block = F.coalesce("block", F.lit(""))
    http = F.when(block.startswith("HTTP/"), F.substring_index(block, CRLF + CRLF, 1)).otherwise(F.lit(""))
    payload = F.when(F.col("http") != "", F.substring(block, F.length("http") + 5, F.length(block))).otherwise(block)
    parts = (table.withColumn("http", http).withColumn("payload", payload)
             .withColumn("source_id", field(F.col("header"), "WARC-Record-ID"))
             .withColumn("target_uri", field(F.col("header"), "WARC-Target-URI"))
             .withColumn("date", field(F.col("header"), "WARC-Date"))
             .withColumn("source_digest", F.coalesce(field(F.col("header"), "WARC-Payload-Digest"), digest(F.col("payload")))))
    text = plain_text(F.col("payload"))
    links = F.transform(F.regexp_extract_all("payload", F.lit(LINK), 1),
                        lambda link: F.concat(F.lit("outlink: "), link, F.lit(CRLF)))
    title = F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"\s+", " ")
    about = F.concat(
        lines(("title", F.when(title != "", title)),
              ("language", F.when(F.regexp_extract("payload", LANGUAGE, 1) != "", F.regexp_extract("payload", LANGUAGE, 1))),
              ("source-status", F.when(F.col("http") != "", F.regexp_extract("http", r"^HTTP/[0-9.]+ ([0-9]+)", 1))),
              ("source-content-type", field(F.col("http"), "Content-Type")),
              ("source-content-length", field(F.col("http"), "Content-Length")),
              ("source-block-digest", field(F.col("header"), "WARC-Block-Digest"))),
        F.concat_ws("", links))
    made = F.array(F.struct(F.lit("metadata").alias("record_type"), about.alias("block"),
                            F.lit("application/warc-fields").alias("content_type")),
                   F.struct(F.lit("conversion").alias("record_type"), text.alias("block"),
                            F.lit("text/plain; charset=utf-8").alias("content_type")))
    out = (parts.select("page_id", "source_id", "target_uri", "date", "source_digest", F.explode(made).alias("made"))
           .select("page_id", "source_id", "target_uri", "date", "source_digest", "made.*")
           .withColumn("record_id", record_id_of("record_type", "source_id")))
    header = F.concat(F.lit(f"WARC/1.1{CRLF}"), lines(
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("source_id")), ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("date")), ("WARC-Source-Payload-Digest", F.col("source_digest")),
        ("WARC-Block-Digest", digest(F.col("block"))), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.octet_length("block").cast("string"))))
    return out.select("page_id", "record_type", "record_id", F.col("source_id").alias("refers_to"), "target_uri",
                      "source_digest", digest(F.col("block")).alias("block_digest"),
                      F.octet_length("block").cast("long").alias("content_length"), header.alias("header"), "block")


def record_id_of(kind: str, source: str) -> Column:
    """The id of a derived record, from its kind and the id of the record it refers to."""
    return record_id("derived", F.col(kind), F.coalesce(source, F.lit("")))


def serialised(records: DataFrame) -> DataFrame:
    """Each record as it stands in a WARC file: header, blank line, block, two line ends."""
    return records.select("page_id", F.concat("header", F.lit(CRLF), "block", F.lit(CRLF + CRLF)).alias("record"))
