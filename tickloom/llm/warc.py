"""Derived WARC records.

A response record becomes two: a metadata record (``application/warc-fields``) with what is known of
the response, its HTTP header fields and digests, and a conversion record with the plain text of its
HTML. Both refer to the response by its record id and carry its target, date and payload digest.
Everything is a projection: rows are neither joined nor shuffled.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CRLF = "\r\n"

# Elements without readable text, and elements that begin a new line.
SILENT = ("script", "style", "template", "noscript")
BLOCKS = (
    "address|article|aside|blockquote|br|button|caption|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h1|h2|h3|h4|h5|h6|header|hr|legend|li|main|nav|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|"
    "tfoot|th|thead|title|tr|ul"
)

# The rest of a tag: what stands in quotes may hold a closing bracket.
_REST = """[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_HIDDEN = rf"(?is)<({'|'.join(SILENT)})\b{_REST}.*?(?:</\1[^>]*+>|\z)|<!--.*?(?:-->|\z)"
_BLOCK = rf"(?i)</?(?:{BLOCKS})(?:>|[\s/]{_REST})"
_TAG = f"<[!/?a-zA-Z]{_REST}"
# A quote that is never closed: the tag ends at the next bracket all the same.
_BROKEN = "<[!/?a-zA-Z][^>]*+>"
# The named characters most pages keep to, besides &amp;. A blank stands for &nbsp;.
NAMED = (
    ("lt", "<"),
    ("gt", ">"),
    ("quot", '"'),
    ("apos", "'"),
    ("nbsp", " "),
    ("copy", "©"),
    ("middot", "·"),
)

# All names of HTML (some also without their semicolon), and what numbers stand for that are no characters.
NAMES = html5 | {f"{name};": character for name, character in NAMED} | {"nbsp": " "}
_OPEN = sorted((name for name in NAMES if not name.endswith(";")), key=lambda name: (-len(name), name))
_C1 = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}
_NUMBERS = {str(n): chr(n) if c == "\ufffd" else c for n, c in _C1.items()} | {"0": "\ufffd", "160": " "}
_USUAL = "|".join(name for name, _ in (*NAMED, ("amp", "&")))
_UNUSUAL = f"&(?:#[0-9]|#[xX][0-9a-fA-F]|(?!(?:{_USUAL});)(?:[A-Za-z][A-Za-z0-9]*;|{'|'.join(_OPEN)}))"


def digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def record_id(kind: str, source: Column) -> Column:
    """A name that follows from the source record and the kind of the derived one, so a rerun gives the same."""
    raw = F.sha2(F.concat_ws(" ", F.lit(kind), source), 256)
    pieces = [F.substring(raw, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _fixed(table: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _reference(piece: Column) -> Column:
    """What follows an ampersand, with the reference it begins with resolved, if there is one."""
    known = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*;)", 1)
    bare = F.regexp_extract(piece, f"^({'|'.join(_OPEN)})", 1)
    digits = F.regexp_extract(piece, "^#0*([0-9]+);?", 1)
    nibbles = F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]+);?", 1)
    number = F.when(digits != "", F.when(F.length(digits) < 9, digits.cast("long")).otherwise(1 << 30)).otherwise(
        F.when(F.length(nibbles) < 8, F.conv(nibbles, 16, 10).cast("long")).otherwise(1 << 30)
    )
    none = (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    character = F.when(none, "\ufffd").otherwise(F.coalesce(_fixed(_NUMBERS)[number.cast("string")], character))
    rest = F.regexp_replace(piece, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")
    named = _fixed(NAMES)
    return (
        F.when((digits != "") | (nibbles != ""), F.concat(character, rest))
        .when((known != "") & named[known].isNotNull(), F.concat(named[known], F.substr(piece, F.length(known) + 1)))
        .when(bare != "", F.concat(named[bare], F.substr(piece, F.length(bare) + 1)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def _resolved(text: Column) -> Column:
    """Character references resolved, once each; pages with none but usual names take the quick way."""
    usual = text
    for name, character in NAMED:
        usual = F.replace(usual, F.lit(f"&{name};"), F.lit(character))
    usual = F.replace(usual, F.lit("&amp;"), F.lit("&"))
    pieces = F.split(text, "&", -1)
    each = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), _reference), ""))
    return F.when(text.rlike(_UNUSUAL), each).otherwise(usual)


def plain_text(html: Column) -> Column:
    """The text of a page: silent elements, comments and tags out, blocks on lines of their own, blanks joined.

    A silent element or comment that is not closed goes on to the end of the page.
    """
    text = F.regexp_replace(html, _HIDDEN, " ")
    text = F.regexp_replace(text, r"[ \t\r\n]+", " ")
    text = F.regexp_replace(text, _BLOCK, "\n")
    text = F.regexp_replace(F.regexp_replace(text, _TAG, ""), _BROKEN, "")
    # The text is bound, so that it is made once.
    text = F.get(F.transform(F.array(text), _resolved), F.lit(0))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, " *\n *", "\n"), "\n+", "\n"), r"^[ \n]+|[ \n]+$", "")


def _header(fields: list[tuple[str, Column]]) -> Column:
    """Header lines in order; fields without value are left out."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))) for name, value in fields]
    return F.concat(F.lit(VERSION + CRLF), F.concat_ws("", *lines))


def derive_records(
    responses: DataFrame,
    id_column: str = "record_id",
    uri_column: str = "target_uri",
    date_column: str = "date",
    html_column: str = "html",
    http_headers_column: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Two rows per response, ``metadata`` and ``conversion``, with header, block and digests.

    Columns: ``keep``, record_type, record_id, refers_to, target_uri, date, content_type, block, block_bytes,
    block_digest, payload_digest, header. ``payload_digest`` is the response's, so a derived record tells
    which bytes it was made from. ``record_bytes`` of a row gives the record as it stands in a file. A null
    page has no bytes and its conversion is empty; a null target, date or header is left out of the header;
    a response without record id refers to nothing, and its derived records are named after the rest of
    what it has. A page is worked through whole within its row. Repeated responses give repeated records; no rows give no rows; other columns do not matter.
    """
    html = F.coalesce(F.col(html_column), F.lit(""))
    uri, date = F.col(uri_column).cast("string"), F.col(date_column).cast("string")
    http = F.col(http_headers_column).cast("string") if http_headers_column else F.lit(None).cast("string")
    source = F.coalesce(F.col(id_column).cast("string"), F.concat_ws(" ", uri, date, F.sha2(html.cast("binary"), 256)))
    base = responses.select(
        *(F.col(f"`{name}`") for name in keep),
        F.col(id_column).cast("string").alias("refers_to"),
        source.alias("source_name"),
        uri.alias("target_uri"),
        date.alias("date"),
        http.alias("http_headers"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        digest(html).alias("payload_digest"),
        plain_text(html).alias("text"),
    )
    text_digest = digest(F.col("text"))
    fields = [
        ("source-record", F.col("refers_to")),
        ("source-uri", F.col("target_uri")),
        ("source-payload-digest", F.col("payload_digest")),
        ("source-payload-bytes", F.col("payload_bytes").cast("string")),
        # A field for each line, so that they can be taken apart again.
        ("source-http-header", F.regexp_replace(F.regexp_replace("http_headers", r"[\r\n]+\z", ""), r"\r?\n", f"{CRLF}source-http-header: ")),
        ("text-bytes", F.octet_length("text").cast("string")),
        ("text-digest", text_digest),
        ("conversion-record", record_id("conversion", F.col("source_name"))),
    ]
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))) for name, value in fields]
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"),
            record_id("metadata", F.col("source_name")).alias("record_id"),
            F.lit("application/warc-fields").alias("content_type"),
            F.concat_ws("", *lines).alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"),
            record_id("conversion", F.col("source_name")).alias("record_id"),
            F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("text").alias("block"),
        ),
    )
    rows = base.select(*keep, "refers_to", "target_uri", "date", "payload_digest", F.inline(kinds))
    rows = rows.withColumn("block_bytes", F.octet_length("block").cast("long")).withColumn("block_digest", digest(F.col("block")))
    header = _header(
        [
            ("WARC-Type", F.col("record_type")),
            ("WARC-Record-ID", F.col("record_id")),
            ("WARC-Refers-To", F.col("refers_to")),
            ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Date", F.col("date")),
            ("WARC-Payload-Digest", F.col("payload_digest")),
            ("WARC-Block-Digest", F.col("block_digest")),
            ("Content-Type", F.col("content_type")),
            ("Content-Length", F.col("block_bytes").cast("string")),
        ]
    )
    return rows.select(
        *keep, "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block", "block_bytes",
        "block_digest", "payload_digest", header.alias("header"),
    )


def record_bytes() -> Column:
    """A derived row as bytes of a WARC file: header, empty line, block, two line ends."""
    return F.encode(F.concat("header", F.lit(CRLF), "block", F.lit(CRLF * 2)), "UTF-8")
