"""WARC derivatives: responses become linked metadata records and plain-text conversion records.

A response is a row (record_id, target_uri, date, http), ``http`` being status line, headers, an empty line and the body.
Each gives one *metadata* record, a JSON object with the source's headers, digests, title and links, and, when its type is
HTML or plain text, one *conversion* record with its text.  Both refer to the response by id, URI and date and repeat its
block and payload digests, so they can be matched with the archive they come from.  Every record is made from its own
response: there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# Elements that end a line of text, and named characters.
_BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|"
    "nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(data: Column) -> Column:
    """``sha1:`` and the base-32 form of the SHA-1 of binary data, twenty bits at a time."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), _HEX, _BASE32))


def record_name(*parts: Column) -> Column:
    """A record id that equal parts always give: the MD5 of them laid out as a UUID."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _numbered(text: Column) -> Column:
    """Replace ``&#65;`` and ``&#x41;`` by their characters; numbers that are no character stay."""
    pattern = r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def one(part: Column) -> Column:
        found = F.regexp_extract(part, pattern, 1)
        is_hex = F.lower(F.substring(found, 1, 1)) == "x"
        code = F.when(is_hex, F.conv(F.substring(found, 2, 6), 16, 10)).otherwise(found).cast("long")
        good = (found != "") & (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(good, F.concat(char, F.regexp_replace(part, pattern, ""))).otherwise(F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#", -1)
    tail = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), one)
    return F.when(F.instr(text, "&#") > 0, F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))).otherwise(text)


def _stripped(html: Column) -> Column:
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<(script|style|template|noscript)\b[^>]*>.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"[\s\u00A0]+", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>", "\n")
    return F.regexp_replace(out, r"<[a-zA-Z/!?][^>]*>", "")


def _tidied(text: Column) -> Column:
    out = _numbered(text)
    for name, char in _NAMED.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, r" +", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), r"^\n+|\n+$", ""))


def with_text(df: DataFrame, html: str, name: str) -> DataFrame:
    """Adds the text of an HTML page: no comments, scripts, styles or tags; block elements end lines; white space is tidied.

    In two steps, so that the result of the first is not computed again wherever the second refers to it.
    """
    return df.withColumn("_stripped", _stripped(F.col(html))).withColumn(name, _tidied(F.col("_stripped"))).drop("_stripped")


def response_records(pages: DataFrame, id_column: str, url_column: str, html_column: str, date: str) -> DataFrame:
    """Pages as the responses of a crawl: (<id>, record_id, target_uri, date, http); a null page has an empty body."""
    html = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "]
    http = F.concat(F.lit(CRLF.join(head)), F.octet_length(html).cast("string"), F.lit(CRLF * 2), html)
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    name = record_name(F.lit("response"), F.col(id_column), url)
    return pages.select(id_column, name.alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"), http.alias("http"))


def derive(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and type, record_id, refers_to, target_uri, date, content_type, block, block_digest,
    source_block_digest, source_payload_digest, header: one or two rows per response.

    ``header`` is the record's whole header; its block follows an empty line.  Missing parts of a response count as empty.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cut = F.instr(F.col("_http"), CRLF * 2)
    rows = responses.select(*keep, *[text(c).alias(f"_{c}") for c in ("record_id", "target_uri", "date", "http")])
    rows = rows.withColumns(
        {
            "_head": F.when(cut > 0, F.substring(F.col("_http"), F.lit(1), cut - 1)).otherwise(F.col("_http")),
            "_body": F.when(cut > 0, F.substring(F.col("_http"), cut + 4, F.length("_http"))).otherwise(F.lit("")),
        }
    )
    lines = F.split("_head", CRLF, -1)
    pairs = F.transform(
        F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda s: F.instr(s, ":") > 0),
        lambda s: F.struct(F.substring_index(s, ":", 1).alias("name"), F.trim(F.regexp_replace(s, "^[^:]*:", "")).alias("value")),
    )
    kind = F.lower(F.trim(F.substring_index(F.get(F.filter(pairs, lambda p: F.lower(p["name"]) == "content-type"), F.lit(0))["value"], ";", 1)))
    rows = rows.withColumns(
        {
            "_status": F.get(lines, F.lit(0)),
            "_headers": pairs,
            "_kind": F.coalesce(kind, F.lit("")),
            "_block_digest": digest(F.col("_http").cast("binary")),
            "_payload_digest": digest(F.col("_body").cast("binary")),
        }
    )
    is_html = F.col("_kind").isin("text/html", "application/xhtml+xml")
    title = F.trim(F.regexp_replace(F.regexp_extract("_body", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1), r"\s+", " "))
    links = F.regexp_extract_all("_body", F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    nothing = F.array().cast("array<string>")
    about = F.struct(
        F.struct(
            F.col("_record_id").alias("WARC-Record-ID"),
            F.col("_target_uri").alias("WARC-Target-URI"),
            F.col("_date").alias("WARC-Date"),
            F.col("_block_digest").alias("WARC-Block-Digest"),
            F.col("_payload_digest").alias("WARC-Payload-Digest"),
            F.octet_length("_http").alias("Content-Length"),
        ).alias("source"),
        F.struct(F.col("_status").alias("status"), F.col("_headers").alias("headers")).alias("http"),
        F.struct(
            F.when(is_html, title).otherwise("").alias("title"), F.when(is_html, links).otherwise(nothing).alias("links")
        ).alias("html"),
    )
    record = lambda name, kind, block: F.struct(
        F.lit(name).alias("type"), F.lit(kind).alias("content_type"), block.alias("block")
    )
    rows = with_text(rows.withColumn("_html", F.when(is_html, F.col("_body"))), "_html", "_text")
    plain = F.when(is_html, F.col("_text")).when(F.col("_kind") == "text/plain", F.col("_body"))
    records = F.array(record("metadata", "application/json", F.to_json(about)), record("conversion", "text/plain", plain))
    rows = rows.select("*", F.inline(records)).where(F.col("block").isNotNull())
    rows = rows.withColumns(
        {"record_id": record_name(F.col("type"), F.col("_record_id")), "block_digest": digest(F.col("block").cast("binary"))}
    )
    header = {
        "WARC-Type": "type",
        "WARC-Record-ID": "record_id",
        "WARC-Date": "_date",
        "WARC-Target-URI": "_target_uri",
        "WARC-Refers-To": "_record_id",
        "WARC-Refers-To-Target-URI": "_target_uri",
        "WARC-Refers-To-Date": "_date",
        "WARC-Block-Digest": "block_digest",
        "X-Source-Block-Digest": "_block_digest",
        "X-Source-Payload-Digest": "_payload_digest",
        "Content-Type": "content_type",
    }
    named = [F.concat(F.lit(f"{k}: "), F.col(c)) for k, c in header.items()]
    size = F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"))
    return rows.select(
        *keep,
        "type",
        "record_id",
        F.col("_record_id").alias("refers_to"),
        F.col("_target_uri").alias("target_uri"),
        F.col("_date").alias("date"),
        "content_type",
        "block",
        "block_digest",
        F.col("_block_digest").alias("source_block_digest"),
        F.col("_payload_digest").alias("source_payload_digest"),
        F.concat_ws(CRLF, F.lit("WARC/1.1"), *named, size).alias("header"),
    )


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one per partition: header, empty line, block, two line ends."""
    whole = F.concat("header", F.lit(CRLF * 2), "block")
    records.select(whole.alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)
