r"""WARC derivatives: metadata and plain-text conversion records from response records.

A response record becomes two more that refer to it: a `metadata` record with what is known
about it (source headers, digests, title, links) and a `conversion` record with the page's text.
Both keep the target URI and date of the response, name it in WARC-Refers-To and carry digests of
their own block.  Records are rows; ``as_warc`` renders them, ``write_warc`` puts them into compressed
files and ``read_warc`` takes the records of such files.  All of it is DataFrame functions.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
_BLANK = "(?is)<!--.*?-->|" + "|".join(
    rf"<{t}\b.*?</{t}\s*>" for t in ("script", "style", "noscript", "template", "head"))
_BREAK = (r"(?i)</?(?:p|div|article|section|main|header|footer|nav|aside|ul|ol|li|table|tr|h[1-6]|"
          r"blockquote|pre|form|br|hr)\b[^>]*>")
# Frequent named character references, looked up first; &nbsp; is a space of the text.
_NAMED = (("nbsp;", " "), ("quot;", '"'), ("apos;", "'"), ("copy;", "©"),
          ("middot;", "·"), ("lt;", "<"), ("gt;", ">"), ("amp;", "&"))
# All names of the HTML standard; then those that it also knows without a semicolon (but for the
# frequent ones, which need theirs here), the longest first.
_REFERENCES = "\1".join(f"{name}\2{char}" for name, char in html5.items() if name.endswith(";"))
_OPEN = sorted((n for n in html5 if not n.endswith(";") and f"{n};" not in dict(_NAMED)), key=lambda n: (-len(n), n))
# Code points 128 to 159 mean those of Windows-1252.
_WINDOWS = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}

_OTHERS = f"&(?!{'|'.join(name for name, _ in _NAMED)})[#a-zA-Z]"

RECORD = ["record_id", "warc_type", "refers_to", "target_uri", "warc_date", "content_type",
          "block_digest", "payload_digest", "content_length", "block"]


def record_id(kind: str, *parts: Column) -> Column:
    """A urn:uuid that follows from the record's kind and source (rebuilding gives it again)."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *parts).cast("binary"))
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
           F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def _octets(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of ``pages(page_id, url, html)``: page_id and the columns of RECORD.

    The block is an HTTP message with its headers; the payload digest is that of the html alone.
    Null url or html are empty; repeated rows give equal records."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), _octets(html).cast("string"), F.lit(CRLF * 2))
    return pages.select("page_id", url.alias("target_uri"), html.alias("html"),
                        F.concat(head, html).alias("block")).select(
        "page_id",
        record_id("response", F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                  F.col("target_uri")).alias("record_id"),
        F.lit("response").alias("warc_type"), F.lit(None).cast("string").alias("refers_to"),
        "target_uri", F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        digest(F.col("block")).alias("block_digest"), digest(F.col("html")).alias("payload_digest"),
        _octets(F.col("block")).alias("content_length"), "block")


def http_headers(block: Column) -> Column:
    """The header part of an HTTP message, without the blank line; empty if there is none."""
    at = F.locate(CRLF * 2, block)
    return F.when(at > 0, F.substr(block, F.lit(1), at - 1)).otherwise(F.lit(""))


def http_body(block: Column) -> Column:
    at = F.locate(CRLF * 2, block)
    return F.when(at > 0, F.substr(block, at + 4)).otherwise(block)


def _numeric(ref: Column) -> Column:
    """Character of a numeric reference ``#8217;`` or ``#x2019;``; U+FFFD for no code point."""
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    short = F.substring(digits, 1, 8)
    code = F.when(F.length(digits) > 8, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(
        F.when(ref.rlike("^#[xX]"), F.conv(short, 16, 10).cast("long")).otherwise(F.try_to_number(short, F.lit("99999999")).cast("long")))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = F.element_at(F.create_map(*[F.lit(x) for kv in _WINDOWS.items() for x in kv]), code.cast("int"))
    return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(code.between(128, 159), F.coalesce(windows, char)).when(code == 160, F.lit(" ")).otherwise(char))


def decoded(text: Column, attribute: bool = False) -> Column:
    """``text`` with its character references decoded, each once.

    Unknown names stay as they are; in an attribute, so do names without a semicolon before
    a letter, a digit or an equals sign."""
    names = F.str_to_map(F.lit(_REFERENCES), F.lit("\1"), F.lit("\2"))
    stop = "(?![0-9A-Za-z=])" if attribute else ""
    open_ = rf"^(?:{'|'.join(_OPEN)}){stop}"

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, "^[A-Za-z][0-9A-Za-z]*;", 0)
        number = F.regexp_extract(part, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
        bare = F.regexp_extract(part, open_, 0)

        def rest(ref: Column) -> Column:
            return F.substr(part, F.length(ref) + 1)
        out = F.when(F.lit(False), part)
        for ref, char in _NAMED:
            out = out.when(part.startswith(ref), F.concat(F.lit(char), F.substr(part, F.lit(len(ref) + 1))))
        known = F.try_element_at(names, name)
        return (out.when(number != "", F.concat(_numeric(number), rest(number)))
                .when((name != "") & known.isNotNull(), F.concat(known, rest(name)))
                .when(bare != "", F.concat(F.try_element_at(names, F.concat(bare, F.lit(";"))), rest(bare)))
                .otherwise(F.concat(F.lit("&"), part)))

    parts = F.split(text, "&")
    return F.when(~text.contains("&"), text).otherwise(F.concat(F.element_at(parts, 1), F.array_join(
        F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), "")))


def _decoded_text(text: Column) -> Column:
    """``decoded``; most pages have frequent references alone, which are cheaper to replace in turn."""
    frequent = text
    for name, char in _NAMED:  # &amp; last: what it leaves isn't decoded again
        frequent = F.replace(frequent, F.lit(f"&{name}"), F.lit(char))
    return F.when(text.rlike(_OTHERS), decoded(text)).otherwise(frequent)


def title(html: Column) -> Column:
    """The page's title, its character references decoded, white space as one space."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)", 1)
    return F.trim(F.regexp_replace(_decoded_text(found), r"\s+", " "))


def links(html: Column) -> Column:
    """The href values of the page's anchors, in page order, once each."""
    found = F.regexp_extract_all(
        html, F.lit(r"""(?i)<a\s(?:[^>]*?[\s"'])?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: decoded(
        F.when(x.rlike("^[\"']"), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x), attribute=True)))


def _untagged(html: Column) -> Column:
    """Scripts, styles, head, comments and tags go, block tags break lines."""
    text = F.regexp_replace(F.regexp_replace(html, _BLANK, ""), _BREAK, "\n")
    return F.regexp_replace(text, r"<[a-zA-Z/!?][^>]*>", "")


def plain_text(untagged: Column) -> Column:
    """The page's text, from what is left without its tags."""
    text = F.regexp_replace(_decoded_text(untagged), r"[ \t\r\f\x0B]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows per response record: page_id and the columns of RECORD.

    ``source`` has page_id and the columns of RECORD; rows that aren't responses are left out.
    The metadata block keeps the source's own headers, HTTP headers and digests as fields; its
    refers_to and that of the conversion are the response's record_id."""
    block = F.coalesce("block", F.lit(""))
    rows = source.where("warc_type = 'response'").select(
        "page_id", "record_id", "target_uri", "warc_date", "block_digest", "payload_digest",
        "content_length", http_headers(block).alias("http"), http_body(block).alias("html"))
    read = (rows.select("*", title(F.col("html")).alias("title"), links(F.col("html")).alias("links"),
                        _untagged(F.col("html")).alias("untagged"))
            .select("*", plain_text(F.col("untagged")).alias("text")).drop("untagged"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit(CRLF))

    http = F.array_join(F.transform(
        F.filter(F.split("http", CRLF), lambda x: x != ""),
        lambda x: F.concat(F.lit("http-header: "), x, F.lit(CRLF))), "")
    metadata = F.concat(
        field("source-record-id", F.col("record_id")),
        field("source-content-length", F.col("content_length")),
        field("source-block-digest", F.col("block_digest")),
        field("source-payload-digest", F.col("payload_digest")), http,
        field("title", F.col("title")),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF))), ""),
        field("conversion-record-id", record_id("conversion", F.col("record_id"))),
        field("conversion-block-digest", digest(F.col("text"))))

    def kind(warc_type: str, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(warc_type).alias("warc_type"),
                        F.lit(content_type).alias("content_type"), block.alias("block"))

    kinds = F.array(kind("metadata", "application/warc-fields", metadata),
                    kind("conversion", "text/plain; charset=utf-8", F.col("text")))
    return (read.select("page_id", "record_id", "target_uri", "warc_date",
                        F.explode(kinds).alias("k"))
            .select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "k.*")
            .select("page_id",
                    F.when(F.col("warc_type") == "metadata",
                           record_id("metadata", F.col("refers_to")))
                    .otherwise(record_id("conversion", F.col("refers_to"))).alias("record_id"),
                    "warc_type", "refers_to", "target_uri", "warc_date", "content_type",
                    digest(F.col("block")).alias("block_digest"),
                    F.lit(None).cast("string").alias("payload_digest"),
                    _octets(F.col("block")).alias("content_length"), "block"))


def as_warc(records: DataFrame) -> DataFrame:
    """``records`` with `warc`: header, blank line, block, two line ends."""
    named = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"),
             ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
             ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"),
             ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"),
             ("Content-Length", "content_length")]
    head = F.concat(F.lit(f"WARC/1.1{CRLF}"), *[F.coalesce(F.concat(
        F.lit(f"{name}: "), F.col(col).cast("string"), F.lit(CRLF)), F.lit("")) for name, col in named])
    return records.withColumn("warc", F.concat(
        head, F.lit(CRLF), F.coalesce("block", F.lit("")), F.lit(CRLF * 2)))


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzip files of concatenated WARC records under ``path``.

    The two line ends that close a record are the files' line separator."""
    record = as_warc(records).select(
        F.expr(f"substring(warc, 1, length(warc) - {len(CRLF) * 2})").alias("warc"))
    record.write.option("compression", "gzip").option("lineSep", CRLF * 2).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files (gzip or plain) under ``path``: page_id (null) and the columns of RECORD.

    Files are read record by record, never whole, whatever a record's kind.  Fields that a record
    lacks are null.  Blocks are text: bytes that aren't UTF-8 become U+FFFD, while digests and
    content_length stay those of the file.  A record without a length, or whose block isn't as long as
    it says (cut off, or holding a line that starts a record), fails the read.  No file gives no rows."""
    begin = CRLF * 2 + "WARC/"
    value, head, raw = F.col("value"), F.col("head"), F.col("raw")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1), F.lit(""))

    rows = (spark.read.option("lineSep", begin).option("recursiveFileLookup", True).text(path)
            .where(value.rlike(r"\S"))
            .select(F.col("_metadata.file_path").alias("file"), value,
                    F.substring_index(value, CRLF * 2, 1).alias("head")))
    size = F.expr("try_cast(size as int)")
    rows = rows.withColumn("size", field("Content-Length")).withColumn(
        "rest", F.substr(value.cast("binary"), F.octet_length(head) + 5)).withColumn(
        "raw", F.substr("rest", F.lit(1), size))
    # What follows the block are the two line ends at the end of a file.
    whole = (F.octet_length(raw) == size) & (F.trim(F.hex(F.substr("rest", size + 1))).rlike("^(0D|0A)*$"))
    block = F.when(F.coalesce(whole, F.lit(False)), F.make_valid_utf8(raw.cast("string"))).otherwise(
        F.raise_error(F.concat(F.lit("a WARC record isn't as long as it says in "), "file")))
    return rows.select(
        F.lit(None).cast("long").alias("page_id"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Type").alias("warc_type"), field("WARC-Refers-To").alias("refers_to"),
        F.coalesce(field("WARC-Target-URI"), F.lit("")).alias("target_uri"), field("WARC-Date").alias("warc_date"),
        field("Content-Type").alias("content_type"), field("WARC-Block-Digest").alias("block_digest"),
        field("WARC-Payload-Digest").alias("payload_digest"), size.cast("long").alias("content_length"),
        block.alias("block"))
