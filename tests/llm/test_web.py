"""WARC derivatives and URL filters on odd rows."""

import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from tickloom.llm.urls import _blocks, intervals, judge_captures
from tickloom.llm.warc import derive_records, record_bytes

PAGE = '<html><script>x</script><!-- no --><p>One &amp;lt; two</p><div>Three  four<br>five</div></html>'
PAGES = "record_id string, target_uri string, date string, html string, block string"


def test_derived_records_of_odd_pages(spark):
    rows = [("<urn:a>", "http://x/", "2024-01-01T00:00:00Z", PAGE, "clash"), (None, None, None, None, None), ("<urn:b>", "http://y/", None, "", None), ("<urn:b>", "http://y/", None, "", None), ("<urn:c>", "u", None, "word " * 100_000, None)]
    got = derive_records(spark.createDataFrame(rows, PAGES)).withColumn("raw", record_bytes()).collect()
    assert len(got) == 2 * len(rows)
    text = next(r for r in got if r.refers_to == "<urn:a>" and r.record_type == "conversion")
    about = next(r for r in got if r.refers_to == "<urn:a>" and r.record_type == "metadata")
    assert text.block == "One &lt; two\nThree four\nfive"
    assert text.payload_digest == about.payload_digest == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
    assert f"conversion-record: {text.record_id}\r\n" in about.block and "source-uri: http://x/\r\n" in about.block
    for row in got:
        head, body = bytes(row.raw).split(b"\r\n\r\n", 1)
        assert head + b"\r\n" == row.header.encode() and body == row.block.encode() + b"\r\n\r\n"
        assert f"Content-Length: {row.block_bytes}" in row.header and row.block_bytes == len(row.block.encode())
        assert ("WARC-Refers-To" in row.header) == (row.refers_to is not None)
    assert sum(r.block == "" for r in got) == 3
    assert derive_records(spark.createDataFrame([], PAGES)).count() == 0


def test_character_references_are_resolved_once(spark):
    pages = {
        "caf&eacute; &mdash; &rsquo;&hellip;&euro;": "café — ’…€",
        "&#39;&#8217;&#x2019;&#X1F600;&#0065;": "'’’😀A",
        "&#38;lt; &amp;eacute; &amp;#39; &mdash;": "&lt; &eacute; &#39; —",
        "a&#160;b &#150; &#0; &#xD800; &#99999999999;": "a b – \ufffd \ufffd \ufffd",
        "&eacute &copy2 &notit; &unknown; R&D & &; &#; &#x;": "é ©2 ¬it; &unknown; R&D & &; &#; &#x;",
        "AT&amp;T &lt;b&gt; &quot;&middot;&nbsp;&copy;": 'AT&T <b> "· ©',
    }
    rows = [(f"<urn:{n}>", "u", None, f"<p>{page}</p>", None) for n, page in enumerate(pages)]
    got = derive_records(spark.createDataFrame(rows, PAGES)).filter("record_type = 'conversion'")
    assert {r.refers_to: r.block for r in got.collect()} == {f"<urn:{n}>": text for n, text in enumerate(pages.values())}


def test_tags_and_silent_elements(spark):
    pages = {
        '<p title="a>b">x</p>': "x",
        "<p title='a>b' id=\"c>d\">x<b data-x='>'>y</b>": "xy",
        "one<script>if (a < b) { c('</p>') }": "one",
        "one<!-- two <p>three": "one",
        "<textarea>a</textarea><textarea>b</textarea><thead><tr><td>c</td></tr></thead>d": "a\nb\nc\nd",
        '<p title="never closed>x</p><p>y</p>': "x\ny",
        "<SCRIPT type='>'>x</script >a<style>b</STYLE>c": "a c",
        "<noscript><script>x</script></noscript>d 3 < 4 > 2": "d 3 < 4 > 2",
        "<b>" * 20_000 + "deep": "deep",
    }
    rows = [(f"<urn:{n}>", "u", None, page, None) for n, page in enumerate(pages)]
    got = derive_records(spark.createDataFrame(rows, PAGES)).filter("record_type = 'conversion'")
    assert {r.refers_to: r.block for r in got.collect()} == {f"<urn:{n}>": text for n, text in enumerate(pages.values())}


def test_header_lines_stay_apart(spark):
    http = "HTTP/1.1 200 OK\r\nSet-Cookie: a; b\r\nX: 1; 2\r\n\r\n"
    rows = spark.createDataFrame([("<urn:a>", "u", None, "x", http), ("<urn:b>", "u", None, "x", None)], PAGES)
    got = derive_records(rows, http_headers_column="block").filter("record_type = 'metadata'").collect()
    lines = {r.refers_to: [v for k, v in (x.split(": ", 1) for x in r.block.split("\r\n") if x) if k == "source-http-header"] for r in got}
    assert lines == {"<urn:a>": http.split("\r\n")[:3], "<urn:b>": []}


def test_captures_are_judged_by_what_stood_at_the_time(spark):
    entries = [
        ("spam", "Bad.example", "add", "2024-01-02 00:00:00"),
        ("spam", "bad.example", "remove", "2024-01-04 12:00:00"),
        ("spam", "bad.example", "add", "2024-01-04 12:00:00"),
        ("spam", "bad.example", "remove", "2024-01-06 00:00:00"),
        ("allow", "good.bad.example", "add", "2024-01-03 00:00:00"),
        ("spam", None, "add", "2024-01-01 00:00:00"),
        ("spam", "bad.example", "unknown", "2024-01-01 00:00:00"),
        (None, "bad.example", "add", None),
    ]
    lists = spark.createDataFrame(entries, "list string, pattern string, action string, listed_at string")
    captures = [
        (1, "http://bad.example/x", "2024-01-01 23:59:59"),
        (2, "https://user@WWW.Bad.Example.:80/x", "2024-01-02 00:00:00"),
        (3, "http://bad.example", "2024-01-04 13:00:00"),
        (4, "http://bad.example", "2024-01-06 00:00:00"),
        (5, "http://good.bad.example/", "2024-01-05 00:00:00"),
        (6, "http://notbad.example/", "2024-01-05 00:00:00"),
        (7, None, "2024-01-05 00:00:00"),
        (8, "http://bad.example", None),
        (3, "http://bad.example", "2024-01-04 13:00:00"),
        (9, "not a url", "2024-01-05 00:00:00"),
    ]
    frame = spark.createDataFrame(captures, "capture_id long, url string, fetched_at string").withColumn("list", F.lit("clash"))
    got = judge_captures(frame, lists)
    rows = got.collect()
    assert len(rows) == len(captures)
    assert {r.capture_id for r in rows if r.blocked} == {2, 3}
    by_id = {r.capture_id: r for r in rows}
    assert (by_id[5].n_active, by_id[5].blocked_by, by_id[5].allowed) == (2, ["spam"], True)
    assert (by_id[2].host, by_id[7].host, by_id[9].host) == ("www.bad.example", None, None)
    assert judge_captures(frame, lists.limit(0)).filter("blocked").count() == 0
    assert judge_captures(frame.limit(0), lists).count() == 0
    assert intervals(lists).count() == 3


def plain_judge(entries, captures):
    """Active (list, pattern) pairs of every capture, by looking at all entries."""
    out = {}
    for name, host, at in captures:
        labels = host.split(".")
        domains = {".".join(labels[n:]) for n in range(len(labels))}
        active = set()
        for key in {(e[0], e[1]) for e in entries if e[1] in domains}:
            before = [(e[3], e[2] == "add") for e in entries if (e[0], e[1]) == key and e[3] <= at]
            if before and max(before)[1]:
                active.add(key)
        blocked = sorted({key[0] for key in active if key[0] != "allow"})
        out[name] = (len(active), blocked, any(key[0] == "allow" for key in active))
    return out


def test_captures_against_all_entries_with_one_hot_label(spark):
    """A list names a top-level label, most hosts lie below it, and entries stand for hours, days or years."""
    draw = random.Random(3)
    start = dt.datetime(2020, 1, 1)
    patterns = ["com", "a.com", "b.a.com", "x.org", "org", "never.net"]
    entries = [
        (draw.choice(["spam", "adult", "allow"]), draw.choice(patterns), draw.choice(["add", "add", "remove"]), start + dt.timedelta(hours=draw.randrange(40_000)))
        for _ in range(150)
    ]
    hosts = ["a.com"] * 6 + ["b.a.com", "c.b.a.com", "x.org", "y.x.org", "com", "never.net", "else.net"]
    captures = [(n, draw.choice(hosts), start + dt.timedelta(hours=draw.randrange(-2000, 45_000), minutes=n % 60)) for n in range(800)]
    frame = spark.createDataFrame([(n, f"http://{host}/", at) for n, host, at in captures], "capture_id long, url string, fetched_at timestamp")
    lists = spark.createDataFrame(entries, "list string, pattern string, action string, listed_at timestamp")
    got = {r.capture_id: (r.n_active, r.blocked_by, r.allowed) for r in judge_captures(frame, lists).collect()}
    assert got == plain_judge(entries, captures)


def test_blocks_of_days_cover_an_interval_once(spark):
    cases = [(0, 1), (3, 17), (19000, 21000), (7, 7), (9, 4), (1, 65536), (18999, 19000)]
    rows = spark.createDataFrame(cases, "first int, end int").select("first", "end", _blocks(F.col("first"), F.col("end")).alias("b")).collect()
    for row in rows:
        days = sorted(d for b in row.b for d in range(b.block << b.level, (b.block + 1) << b.level))
        assert days == list(range(row.first, row.end)) and len(row.b) <= 34


def test_patterns_without_an_entry_go_before_the_join(spark):
    frame = spark.createDataFrame([(1, "http://a.com/", dt.datetime(2024, 1, 1))], "capture_id long, url string, fetched_at timestamp")
    lists = spark.createDataFrame([("spam", "b.org", "add", dt.datetime(2023, 1, 1))], "list string, pattern string, action string, listed_at timestamp")
    assert [(r.n_active, r.blocked) for r in judge_captures(frame, lists).collect()] == [(0, False)]
