"""SQL (DuckDB) for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_WORDS = f"regexp_extract_all({_folded('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES["op1_decontaminate"] = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
window_of AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS k
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (
    SELECT doc_id, i, n, item FROM (
        SELECT doc_id, i, l.n, array_to_string(w[i : i + l.n - 1], ' ') AS k
        FROM place, (SELECT DISTINCT n FROM window_of) l WHERE i + l.n - 1 <= len(w)) p
    JOIN window_of USING (n, k)),
words_hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _crc_table() -> str:
    """The table of the checksum, from its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(str(value))
    return f"[{', '.join(table)}]::BIGINT[]"


ORACLES["op2_byte_shards"] = f"""
WITH sized AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS raw, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size FROM documents),
bytes AS (
    SELECT doc_id, size, list_transform(range(0, size - 8), lambda i:
        (instr('0123456789ABCDEF', raw[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', raw[2 * i + 2]) - 1)::BIGINT[] AS b
    FROM sized),
summed AS (
    SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x:
        xor(c >> 8, t.crc[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
    FROM bytes, (SELECT {_crc_table()} AS crc) t),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM summed),
cut AS (
    SELECT *, CAST(least(23, (2 * before + size) * 24 // (2 * total)) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

ORACLES["op4_near_dedup"] = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(string_split_regex({_folded('text')}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
own AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
    FROM doc),
shingle AS (SELECT doc_id, len(s) AS n, unnest(s) AS k FROM own),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.k = b.k AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m AS component_id, doc_id = m AS kept
FROM own JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

ORACLES["op5_exact_dedup"] = """
WITH doc AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
same AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM doc GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM doc JOIN same USING (body)
"""


# Fixed values of the page texts, as the test pages need them.
_BLOCKS = (
    "address|article|aside|blockquote|br|button|caption|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h[1-6]|header|hr|legend|li|main|nav|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|tfoot|th|thead|title|tr|ul"
)
_CHARACTERS = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "middot": "·", "amp": "&"}


def _plain(html: str) -> str:
    text = html
    for name in ("script", "style", "template", "noscript"):
        text = f"regexp_replace({text}, '(?is)<{name}[^>]*>.*?</{name}[^>]*>', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<!--.*?-->', ' ', 'g')"
    text = f"regexp_replace({text}, '[ \\t\\r\\n]+', ' ', 'g')"
    text = f"regexp_replace({text}, '(?i)</?({_BLOCKS})(\\s[^>]*)?/?>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[!/?a-zA-Z][^>]*>', '', 'g')"
    for name, character in _CHARACTERS.items():
        text = f"replace({text}, '&{name};', '{character.replace(chr(39), chr(39) * 2)}')"
    text = f"regexp_replace({text}, ' *\\n *', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({text}, '\\n+', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


def _name(kind: str, source: str) -> str:
    h = f"sha256('{kind} ' || {source})"
    pieces = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {pieces} || '>')"


_NL = "chr(13) || chr(10)"


def _fields(fields: list[tuple[str, str]]) -> str:
    return " || ".join(f"coalesce('{name}: ' || {value} || {_NL}, '')" for name, value in fields)


ORACLES["op6_warc_derivatives"] = f"""
WITH page AS (
    SELECT page_id, {_name('response', 'CAST(page_id AS VARCHAR)')} AS refers_to, url AS target_uri,
        strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id * 61), '%Y-%m-%dT%H:%M:%SZ') AS date,
        CAST(strlen(coalesce(html, '')) AS VARCHAR) AS payload_bytes, 'sha256:' || sha256(coalesce(html, '')) AS payload_digest,
        {_plain("coalesce(html, '')")} AS body
    FROM pages),
record AS (
    SELECT *, 'metadata' AS record_type, {_name('metadata', 'refers_to')} AS record_id, 'application/warc-fields' AS content_type,
        {_fields([
            ('source-record', 'refers_to'), ('source-uri', 'target_uri'), ('source-payload-digest', 'payload_digest'),
            ('source-payload-bytes', 'payload_bytes'),
            ('source-http-header', "'HTTP/1.1 200 OK'"),
            ('source-http-header', "'Content-Type: text/html; charset=utf-8'"),
            ('source-http-header', "('Content-Length: ' || payload_bytes)"),
            ('text-bytes', 'CAST(strlen(body) AS VARCHAR)'), ('text-digest', "('sha256:' || sha256(body))"),
            ('conversion-record', _name('conversion', 'refers_to'))])} AS block
    FROM page
    UNION ALL
    SELECT *, 'conversion', {_name('conversion', 'refers_to')}, 'text/plain; charset=utf-8', body FROM page),
digested AS (SELECT *, CAST(strlen(block) AS BIGINT) AS block_bytes, 'sha256:' || sha256(block) AS block_digest FROM record)
SELECT page_id, record_type, record_id, refers_to, target_uri, date, content_type, block, block_bytes, block_digest,
    payload_digest, 'WARC/1.1' || {_NL} || {_fields([
        ('WARC-Type', 'record_type'), ('WARC-Record-ID', 'record_id'), ('WARC-Refers-To', 'refers_to'),
        ('WARC-Target-URI', 'target_uri'), ('WARC-Date', 'date'), ('WARC-Payload-Digest', 'payload_digest'),
        ('WARC-Block-Digest', 'block_digest'), ('Content-Type', 'content_type'),
        ('Content-Length', 'CAST(block_bytes AS VARCHAR)')])} AS header
FROM digested
"""  # fmt: skip


def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(' ', {', '.join(parts)})), 1, 6) AS BIGINT)"


ORACLES["op7_url_filter"] = f"""
WITH capture AS (
    SELECT page_id,
        nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\\.+$', ''), '') AS host,
        TIMESTAMP '2024-01-01' + to_minutes(page_id * 7919 % 43200) AS fetched_at
    FROM pages),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM capture WHERE host IS NOT NULL),
matching AS (SELECT host, unnest(list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i : len(l)], '.'))) AS pattern FROM hosts),
entry AS (
    SELECT list, pattern, CASE WHEN d % 5 < 3 THEN 'add' ELSE 'remove' END AS action,
        TIMESTAMP '2024-01-01' + to_minutes(d % 43200) AS listed_at
    FROM (
        SELECT list, pattern, {_draw('pattern', 'list', 'CAST(n AS VARCHAR)')} AS d
        FROM (SELECT DISTINCT pattern FROM matching WHERE contains(pattern, '.')),
            (SELECT unnest(['adult', 'allow', 'malware', 'spam']) AS list), (SELECT unnest([0, 1, 2]) AS n)
        WHERE {_draw('pattern', 'list')} % 3 = 0)),
moment AS (SELECT list, pattern, listed_at, max(action = 'add') AS added FROM entry GROUP BY ALL),
valid AS (
    SELECT list, pattern, listed_at AS valid_from, lead(listed_at) OVER (PARTITION BY list, pattern ORDER BY listed_at) AS valid_to, added
    FROM moment),
active AS (
    SELECT c.page_id, count(*) AS n_active, max(v.list = 'allow') AS allowed,
        string_agg(DISTINCT CASE WHEN v.list <> 'allow' THEN v.list END, ',' ORDER BY CASE WHEN v.list <> 'allow' THEN v.list END) AS blocked_by
    FROM capture c JOIN matching m USING (host) JOIN valid v ON v.pattern = m.pattern AND v.added
        AND v.valid_from <= c.fetched_at AND (v.valid_to IS NULL OR c.fetched_at < v.valid_to)
    GROUP BY c.page_id)
SELECT page_id, host, fetched_at, CAST(coalesce(n_active, 0) AS BIGINT) AS n_active, coalesce(blocked_by, '') AS blocked_by,
    coalesce(allowed, false) AS allowed, coalesce(blocked_by, '') <> '' AND NOT coalesce(allowed, false) AS blocked
FROM capture LEFT JOIN active USING (page_id)
"""

ORACLES["op8_line_runs"] = """
WITH doc AS (SELECT doc_id, string_split(text, chr(10)) AS own FROM documents),
line AS (
    SELECT doc_id, pos, x, regexp_matches(x, '[^\\x20\\x09-\\x0D]') AS filled
    FROM (SELECT doc_id, unnest(own) AS x, unnest(range(0, len(own))) AS pos FROM doc)),
token AS (
    SELECT doc_id, pos, x, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i,
        row_number() OVER (PARTITION BY x ORDER BY doc_id, pos) > 1 AS gone
    FROM line WHERE filled),
owned AS (
    SELECT doc_id, pos, x, coalesce(max(CASE WHEN filled THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos),
        min(CASE WHEN filled THEN pos END) OVER (PARTITION BY doc_id)) AS owner
    FROM line),
judged AS (
    SELECT o.doc_id, o.pos, o.x, coalesce(t.gone, false) AS gone
    FROM owned o LEFT JOIN token t ON t.doc_id = o.doc_id AND t.pos = o.owner),
pair AS (
    SELECT a.doc_id, a.i, b.doc_id AS other, a.i - b.i AS apart FROM token a JOIN token b ON a.x = b.x
    WHERE a.doc_id <> b.doc_id OR a.i <> b.i),
island AS (
    SELECT doc_id, count(*) AS n
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, apart ORDER BY i) AS k FROM pair)
    GROUP BY doc_id, other, apart, k),
longest AS (SELECT doc_id, max(n) AS n FROM island GROUP BY doc_id),
kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(x, chr(10) ORDER BY pos) FILTER (NOT gone) AS body
    FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(own), 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(l.n, 0) AS BIGINT) AS longest_run, sha256(coalesce(body, '')) AS text_sha256
FROM doc d LEFT JOIN kept k USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""

_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(fields: list[str]) -> str:
    return f"sha256({' || '.join(_FIELD.format(field) for field in fields)})"


_CRC32 = """
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::BIGINT)),
        lambda c, x: xor(c >> 8, t.crc[(xor(c, x) & 255) + 1])), 4294967295::BIGINT)"""

ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE doc AS (
    SELECT *, CAST(doc_id AS VARCHAR) AS d, coalesce('+' || lang, '') AS tree,
        {_leaf(["doc_id", "source", "lang", "n_chars", "text"])} AS leaf,
        {_leaf(["doc_id", "source", "lang", "(n_chars + 1)", "text"])} AS changed
    FROM documents),
placed AS (
    SELECT doc_id, tree, leaf, CASE WHEN {_CRC32} % 7 = 0 THEN changed ELSE leaf END AS claimed,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
    FROM doc, (SELECT {_crc_table()} AS crc) t),
low AS (
    SELECT tree, 0 AS level, idx, n, leaf AS hash FROM placed
    UNION ALL
    SELECT tree, level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM low WHERE n > 1 GROUP BY tree, level, idx // 2),
subroots AS (SELECT tree, level, hash FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n, hash FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY level, idx // 2),
root AS (SELECT hash AS root FROM high WHERE n = 1),
tops AS (SELECT tree, hash AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM subroots),
node AS (
    SELECT p.doc_id, p.tree, p.idx AS spot, l.level, p.idx >> l.level AS i, l.n
    FROM placed p JOIN (SELECT DISTINCT tree, level, n FROM low WHERE n > 1) l USING (tree)
    UNION ALL
    SELECT p.doc_id, p.tree, p.idx, t.height + h.level, t.place >> h.level, h.n
    FROM placed p JOIN tops t USING (tree), (SELECT DISTINCT level, n FROM high WHERE n > 1) h),
every AS (
    SELECT tree, level, idx, hash FROM low WHERE n > 1
    UNION ALL
    SELECT t.tree, t.height + h.level, h.idx, h.hash FROM tops t, high h WHERE h.n > 1),
step AS (
    SELECT n.tree, n.spot, n.level, n.i % 2 = 1 AS is_left, coalesce(e.hash, '') AS sibling
    FROM node n LEFT JOIN every e ON e.tree = n.tree AND e.level = n.level AND e.idx = xor(n.i, 1)),
fold AS (
    SELECT tree, idx AS spot, 0 AS level, claimed AS hash FROM placed
    UNION ALL
    SELECT f.tree, f.spot, f.level + 1, sha256(CASE WHEN s.is_left THEN s.sibling || f.hash ELSE f.hash || s.sibling END)
    FROM fold f JOIN step s ON s.tree = f.tree AND s.spot = f.spot AND s.level = f.level),
ended AS (SELECT tree, spot, max_by(hash, level) AS folded_root FROM fold GROUP BY tree, spot),
proof AS (SELECT tree, spot, sha256(string_agg(sibling, '' ORDER BY level)) AS proof FROM step GROUP BY tree, spot)
SELECT p.doc_id, p.leaf, t.subroot, r.root, coalesce(f.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
FROM placed p JOIN tops t USING (tree) JOIN ended e ON e.tree = p.tree AND e.spot = p.idx
LEFT JOIN proof f ON f.tree = p.tree AND f.spot = p.idx, root r
"""

_MEASURED = """
    (VALUES ('word_length', 1000 * word_chars // n_words, 50), ('symbol_share', 10000 * n_symbols // word_chars, 100),
        ('dup_line_share', 10000 * n_dup_lines // n_lines, 1000), ('repeat_share', 10000 * n_repeat_words // n_words, 1000))
        AS v(measure, value, width)"""


def _fences(name: str, keys: str, least: int) -> str:
    """Fences of the groups by ``keys`` from the buckets of their documents."""
    return f"""
{name}_counts AS (SELECT {keys}, measure, width, bucket, count(*) AS r FROM bucketed GROUP BY ALL),
{name}_ranks AS (
    SELECT *, sum(r) OVER (PARTITION BY {keys}, measure ORDER BY bucket) AS upto, sum(r) OVER (PARTITION BY {keys}, measure) AS n
    FROM {name}_counts),
{name}_quartiles AS (
    SELECT {keys}, measure, width, min(bucket) FILTER (4 * upto >= n) AS q1, min(bucket) FILTER (4 * upto >= 3 * n) AS q3
    FROM {name}_ranks WHERE n >= {least} GROUP BY ALL),
{name} AS (
    SELECT {keys}, measure, q1 - 5 * greatest(q3 - q1, width) AS low, q3 + 5 * greatest(q3 - q1, width) AS high FROM {name}_quartiles)"""


ORACLES["op12_quality_rules"] = f"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS body, coalesce('+' || lang, '') AS lang, coalesce('+' || source, '') AS source FROM documents),
split AS (
    SELECT *, list_filter(string_split_regex(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM doc),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS times
    FROM (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split))),
again AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
counted AS (
    SELECT doc_id, lang, source, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN again USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
measured AS (SELECT b.doc_id, b.lang, b.source, v.* FROM based b, LATERAL (SELECT * FROM {_MEASURED}) v WHERE NOT base_failed),
bucketed AS (SELECT *, 1 AS one, (value >> greatest(length(bin(value)) - 8, 0)) << greatest(length(bin(value)) - 8, 0) AS bucket FROM measured),
{_fences('own', 'lang, source', 200)},
{_fences('wide', 'lang', 200)},
{_fences('overall', 'one', 1)},
outside AS (
    SELECT m.doc_id, string_agg(measure, ',' ORDER BY CASE measure WHEN 'word_length' THEN 1 WHEN 'symbol_share' THEN 2 WHEN 'dup_line_share' THEN 3 ELSE 4 END) AS failed
    FROM measured m LEFT JOIN own o USING (lang, source, measure) LEFT JOIN wide w USING (lang, measure) LEFT JOIN overall a USING (measure)
    WHERE value < coalesce(o.low, w.low, a.low) OR value > coalesce(o.high, w.high, a.high) GROUP BY m.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, coalesce(failed, '') AS failed,
    NOT base_failed AND failed IS NULL AS kept
FROM based LEFT JOIN outside USING (doc_id)
"""

_TERMS = f"regexp_extract_all({_folded('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES["op13_ranked_search"] = f"""
WITH doc AS (SELECT doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM doc),
posting AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM doc) GROUP BY ALL),
weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM posting, total GROUP BY term, n_docs),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN posting USING (term) JOIN weighed USING (term), total GROUP BY item_id, doc_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
