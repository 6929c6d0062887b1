"""Small cases against plain Python: nulls, empty and long texts, ties, repeated rows, empty tables."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import pytest
from corpus_cases import LONG, ODD, sha
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, near
from tickloom.llm.bpe import Encoder, PrefixTable, Recent, encode_texts, read_ranks
from tickloom.llm.components import components
from tickloom.llm.decontaminate import contamination
from tickloom.llm.exact import exact_dedup, unique_rows
from tickloom.llm.langid import predict_language, train_language
from tickloom.llm.near import match_threshold, near_duplicates, shingle_sets
from tickloom.llm.quality import score_quality, train_quality
from tickloom.llm.runs import dedup_lines, maximal_runs
from tickloom.llm.shard import byte_shards

WORDS = [f"word{n}" for n in range(200)]


def text(start, n, step=1):
    return " ".join(WORDS[(start + k * step) % 200] for k in range(n))


# Exact dedup


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_against_grouping(spark, odd, keep):
    got = exact_dedup(odd, keep=keep).collect()
    groups = defaultdict(list)
    for i, t in ODD:
        groups[t or ""].append(i)
    assert len(got) == len(ODD)
    by_sha = {sha(t.encode()): ids for t, ids in groups.items()}
    for row in got:
        ids = by_sha[row.text_sha256]
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        assert (row.keep_id, row.group_size) == (best, len(ids))
    assert sum(row.kept for row in got) == len(groups)


def test_a_group_over_many_partitions_keeps_one_row(spark, documents):
    pairs = [(n, "same text") for n in range(400)] + [(400 + n, f"other {n}") for n in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r.doc_id: r for r in exact_dedup(documents(pairs), keep="largest").collect()}
        rows = unique_rows(documents(pairs), keep="largest").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(got[n].keep_id == 399 and got[n].group_size == 400 for n in range(400))
    assert [n for n in range(400) if got[n].kept] == [399]
    assert sorted(r.doc_id for r in rows) == list(range(399, 450))


def test_unique_rows_keep_all_columns(odd):
    rows = unique_rows(odd)
    assert rows.schema.names == odd.schema.names
    got = rows.collect()
    assert len(got) == len({t or "" for _, t in ODD})
    assert {r.text for r in got if r.doc_id in (4, 9)} == {LONG, dict(ODD[-1:])[9]}
    assert all(r.part == 7 and r.id == "x" for r in got)
    folded = unique_rows(odd, normalise=lambda c: F.lit("all alike"))
    assert [(r.doc_id, r.text) for r in folded.collect()] == [(1, None)]


# Shards


def test_shards_are_contiguous_even_and_gapless(documents):
    pairs = [(n, "x" * (n * 37 % 100)) for n in range(500)] + [(None, None), (3, "again")]
    got = byte_shards(documents(pairs), 7).collect()
    assert len(got) == 502
    total = defaultdict(int)
    slots = defaultdict(list)
    for r in got:
        total[r.shard] += r.size
        slots[r.shard].append((r.slot, r.doc_id))
    assert max(total.values()) - min(total.values()) <= 2 * 108
    ids = [i for s in sorted(slots) for _, i in sorted(slots[s], key=lambda x: x[0])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert all(sorted(n for n, _ in own) == list(range(len(own))) for own in slots.values())
    null = next(r for r in got if r.doc_id is None)
    assert (null.size, null.text_crc32) == (8, 0)
    assert {r.doc_id: r.text_crc32 for r in got}[5] == zlib.crc32(b"x" * 85)


# Decontamination


def brute_contamination(text, items, width):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, names = find(text), set(), set()
    for name, item in items:
        own = find(item)
        n = min(width, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_each_block_of_a_benchmark_is_built_once(spark, documents, monkeypatch):
    """2 MB of items in blocks of 128 KB: no block is much larger, every pass broadcasts one, and all hits are joined."""
    items = [(n, " ".join(f"item{n}word{k}" for k in range(40))) for n in range(3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    sizes, scan = [], decontaminate._scan

    def watched(docs, block, width):
        sizes.append(sum(len(word) + 1 for _, own in block for word in own))
        return scan(docs, block, width)

    monkeypatch.setattr(decontaminate, "_scan", watched)
    docs = [(n, f"clean {n} " + " ".join(items[k][1] for k in range(n, n + 3)) + " end") for n in range(0, 2900, 100)] + [(5000, "clean")]
    got = contamination(documents(docs), bench, block_bytes=128 << 10).collect()
    assert len(sizes) > 10 and sum(sizes) == sum(len(text) + 1 for _, text in items) and max(sizes) < 256 << 10
    for row in got:
        expected = [] if row.doc_id == 5000 else sorted(str(n) for n in range(row.doc_id, row.doc_id + 3))
        assert row["items"] == expected and row.n_hit == 40 * len(expected)
        assert [(s.start, s.end) for s in row.spans] == ([] if not expected else [(len(f"clean {row.doc_id} "), len(dict(docs)[row.doc_id]) - 4)])


def test_a_worker_builds_one_automaton_for_a_block(monkeypatch):
    built = []
    monkeypatch.setattr(decontaminate, "Items", lambda block, width: built.append(block) or len(built))
    monkeypatch.setattr(decontaminate, "_LAST", {})
    block = SimpleNamespace(value=["items"])
    assert [decontaminate._built("one", block, 10) for _ in range(5)] == [1] * 5 and len(built) == 1


def test_contamination_by_a_benchmark_with_other_columns(spark, documents):
    bench = spark.createDataFrame([("i", "one two three", "x", 1, "y")], "item_id string, text string, name string, id int, key string")
    docs = documents([(1, "zero one two three four"), (2, "none"), (None, "one two three")])
    assert {(r.doc_id, r.n_hit, r.contaminated) for r in contamination(docs, bench).collect()} == {(1, 3, True), (2, 0, False), (None, 3, True)}


@pytest.mark.parametrize("block_bytes", [1 << 20, 50])
@pytest.mark.parametrize("width", [1, 3, 10])
def test_contamination_against_brute_force(spark, documents, width, block_bytes):
    items = [(1, text(0, 25)), (2, "Short, item!"), (3, None), (4, "..."), (10, "É été " + text(50, 12, 3)), (5, "a a a a a a a a a a a a")]
    docs = [
        (1, "Intro " + text(5, 14).upper() + ". end"),
        (2, "short ITEM and short-item"),
        (3, text(0, 9)),
        (4, None),
        (5, ""),
        (6, "é Été word é été " + text(50, 12, 3)),
        (7, "a " * 30),
        (8, text(3, 10) + " " + text(8, 11) + " short item"),
        (8, text(3, 10)),
        (9, LONG),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(documents(docs), bench, width=width, block_bytes=block_bytes).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted(
        (i, *brute_contamination(t, items, width)) for i, t in docs
    )
    for row in got:
        assert row.contaminated == (row.n_hit > 0) and row.items_sha256 == sha(",".join(row["items"]).encode())
    spans = {r.doc_id: r.spans for r in got if width == 10}
    if spans:
        a = spans[1][0]
        assert docs[0][1][a.start : a.end] == text(5, 14).upper()


def test_an_empty_benchmark_hits_nothing(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(odd, none).filter("contaminated").count() == 0
    assert contamination(empty, none).count() == 0


# Near-duplicates


def brute_components(pairs, width, percent):
    def shingles(t):
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if len(own) < width:
            return {tuple(own)} if own else set()
        return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}

    sets = {i: shingles(t) for i, t in pairs}
    label = {i: i for i in sets}
    links = [
        (a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_near_duplicates_against_brute_force(documents):
    pairs, n = [], 0
    for family in range(12):
        base = [f"f{family}w{k}" for k in range(60)]
        for copy in range(8):
            own = list(base)
            for k in range(copy):
                own[(7 * k + 11 * family) % 60] = f"changed{family}x{k}" if copy % 2 else f"changed{n}x{k}"
            pairs.append((n, " ".join(own)))
            n += 1
    pairs += [(200, None), (201, ""), (202, "two words"), (203, "TWO \x0b words"), (204, " "), (205, " "), (206, "one two three four"), (207, "a " * 5000)]
    got = {r.doc_id: r for r in near_duplicates(documents(pairs), words=4).collect()}
    want = brute_components(pairs, 4, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("members", [1, 3, 1024])
def test_long_postings_in_blocks_lose_no_link(documents, monkeypatch, members):
    """Families that share two thirds of their words, so that members of several meet in the same postings."""
    monkeypatch.setattr(near, "MEMBERS", members)
    common, pairs = [f"shared{k}" for k in range(80)], []
    for family in range(9):
        for copy in range(5):
            pairs.append((len(pairs) * 7 % 45, " ".join([*common, *(f"f{family}w{k}" for k in range(38)), f"c{copy}", f"d{copy}"])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(pairs), words=4).collect()}
    assert got == brute_components(pairs, 4, 80)
    assert len({component for _, component in got.values()}) == 9


def test_near_duplicates_judge_each_text_of_an_id(documents):
    one, two = text(0, 60), text(100, 80)
    rows = [(5, one), (6, one), (6, two), (7, two + " more"), (8, one), (None, two), (6, two)]
    got = near_duplicates(documents(rows), key_column="key")
    assert got.columns == ["doc_id", "key", "n_shingles", "component_id", "kept"]
    found = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got.collect()))
    assert found == [
        (0, 76, 6, False), (5, 56, 5, True), (6, 56, 5, False), (6, 76, 6, True), (6, 76, 6, True), (7, 77, 6, False), (8, 56, 5, False),
    ]


def test_near_duplicates_of_odd_and_empty_tables(odd, empty):
    got = near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert [r.component_id for r in by_id[5]] == [4]
    assert [(r.component_id, r.kept) for r in by_id[6]] == [(6, True)] * 2
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in by_id[None] if r.component_id) == [(1, 6, False)]
    assert [(r.n_shingles, r.kept) for r in by_id[1] + by_id[2] + by_id[3]] == [(0, True)] * 3
    assert near_duplicates(empty).count() == 0


def test_shingles_of_texts_together_and_alone():
    texts = [t.encode() for t in ("a b c d e", "", "x", " a\tB\nc d  e ", LONG, "tail word")]
    together = shingle_sets(texts, 3)
    assert [own.tolist() for own in together] == [shingle_sets([t], 3)[0].tolist() for t in texts]
    assert together[0].tolist() == together[3].tolist() and len(together[1]) == 0


def test_match_threshold_leaves_out_less_than_the_chance_given():
    assert match_threshold(64, 0.8) == 30
    assert match_threshold(64, 1.0) == 64


def test_components_of_a_chain_and_a_star(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, 100 + n) for n in range(1, 30)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Line runs


def tokens(text):
    """(line, begin, end) of the lines that are not blank, with the blank ones that go with them."""
    own = text.split("\n")
    filled = [n for n, x in enumerate(own) if x.strip(" \t\n\x0b\f\r")]
    return [(own[n], 0 if not k else n, (filled[k + 1] if k + 1 < len(filled) else len(own))) for k, n in enumerate(filled)]


def brute_lines(pairs):
    """Later copies of every repeated run go, of whatever length; and the longest run that stands elsewhere."""
    docs = [(i, text, tokens(text)) for i, text in sorted(pairs)]
    runs = [(tuple(t[0] for t in own[s : e + 1]), i, s, e) for i, _, own in docs for s in range(len(own)) for e in range(s, len(own))]
    first, times, gone, longest = {}, Counter(run[0] for run in runs), defaultdict(set), Counter()
    for key, i, s, e in runs:
        if first.setdefault(key, (i, s)) != (i, s):
            gone[i].update(range(s, e + 1))
        if times[key] > 1:
            longest[i] = max(longest[i], len(key))
    out = {}
    for i, text, own in docs:
        lost = {n for t in gone[i] for n in range(own[t][1], own[t][2])}
        left = [x for n, x in enumerate(text.split("\n")) if n not in lost]
        out[i] = (text.count("\n") + 1, len(lost), longest[i], "\n".join(left))
    return out


def brute_maximal(pairs):
    """(id, first line, end line, length) of the longest runs from each place, without rests of longer ones."""
    docs = {i: tokens(text) for i, text in pairs}
    lines = {i: [t[0] for t in own] for i, own in docs.items()}
    places = [(i, n) for i in docs for n in range(len(docs[i]))]

    def common(i, n, j, m):
        size = 0
        while n + size < len(lines[i]) and m + size < len(lines[j]) and lines[i][n + size] == lines[j][m + size]:
            size += 1
        return size

    longest = {p: max((common(*p, *q) for q in places if q != p), default=0) for p in places}
    runs = [(i, n, size) for (i, n), size in longest.items() if size and longest.get((i, n - 1), 0) <= size]
    return sorted((i, docs[i][n][1], docs[i][n + size - 1][2], size) for i, n, size in runs)


DRAW = random.Random(5)
LICENCE = "All rights reserved."
A, B, C = "alpha line here", "beta", "gamma gamma gamma"
LINE_CASES = {
    "runs": [
        (1, "\n".join([A, B, C, "own one"])),
        (2, "\n".join(["x", A, B, C, "y"])),
        (3, "\n".join(["long", B, "own", "long"])),
        (4, "\n".join([B, B, B, C])),
        (5, "\n".join([A, B])),
        (6, "\n".join([A, B, C, "own two"])),
        (7, ""),
        (8, "\n" * 120),
        (9, "\n".join([C, A, B, C, A, B, C, A, B, C])),
        (12, "\n".join(f"line {n} of many" for n in range(40))),
        (13, "\n".join(f"line {n} of many" for n in range(3, 37))),
        (14, "\n".join(["x", A, B, "z"])),
    ],
    "blank lines": [
        (1, f"one\n{LICENCE}\n\n\ntail"),
        (2, f"two\n{LICENCE}\n\nown"),
        (3, LICENCE),
        (6, " \t"),
        (8, "\n\n"),
        (9, f"\n\n \n\ntail\n\n{LICENCE}"),
        (10, "\n\n \n\ntail\n\n\nx\nx\nx\n"),
        (11, "\n" * 70 + "x"),
        (12, "y" + "\n" * 70 + "x" + "\n" * 3),
        (13, "\x0b\nx\n\u00a0\n"),
    ],
    "one line over and over": [(1, "\n".join(["x"] * 37)), (2, "\n".join(["x"] * 5 + ["y"] + ["x"] * 4))],
    "drawn": [(n, "\n".join(DRAW.choice(["a", "b", "b", "c", "", f"own {n}"]) for _ in range(25))) for n in range(12)],
}


@pytest.mark.parametrize("name", LINE_CASES)
def test_line_runs_against_brute_force(documents, name):
    pairs = LINE_CASES[name]
    rows = dedup_lines(documents(pairs)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.longest_run, r.text) for r in rows} == brute_lines(pairs)
    found = maximal_runs(documents(pairs)).collect()
    assert sorted((r.doc_id, r.first_line, r.end_line, r.lines) for r in found) == brute_maximal(pairs)


def test_whole_copies_of_a_text(documents):
    pairs = [(4, "short"), (5, "short"), (6, f"{LICENCE}\n\nown"), (7, f"{LICENCE}\n\nown"), (8, LICENCE), (9, " \n "), (10, " \n ")]
    got = {r.doc_id: (r.n_removed, r.longest_run, r.text) for r in dedup_lines(documents(pairs)).collect()}
    assert got == {
        4: (0, 1, "short"), 5: (1, 1, ""), 6: (0, 2, pairs[2][1]), 7: (3, 2, ""), 8: (1, 1, ""), 9: (0, 0, " \n "), 10: (0, 0, " \n "),
    }


def test_empty_tables_of_shards_and_copies(empty):
    assert byte_shards(empty, 4).count() == exact_dedup(empty).count() == unique_rows(empty).count() == 0


def test_a_very_long_text_is_a_shard_row(documents):
    rows = byte_shards(documents([(1, LONG * 20), (2, "x"), (3, None)]), 3).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {1: (len(LONG) * 20 + 8, zlib.crc32((LONG * 20).encode())), 2: (9, zlib.crc32(b"x")), 3: (8, 0)}


def test_line_runs_with_text_ids(spark):
    rows = spark.createDataFrame([("b", "x\ny"), ("a", "x\nz"), (None, "x")], "doc_id string, text string")
    assert {r.doc_id: r.text for r in dedup_lines(rows).collect()} == {"a": "x\nz", "b": "y", None: ""}


def test_line_runs_of_odd_and_empty_tables(odd, empty):
    rows = dedup_lines(odd).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r for r in rows}
    assert (got[1].n_lines, got[1].text) == (0, None) and got[2].n_lines == 1
    assert (got[4].n_removed, got[5].n_removed, got[5].text) == (0, 1, "")
    # The end of the text is a blank line, which goes with the third copy.
    assert (got[9].n_lines, got[9].n_removed, got[9].text) == (4, 3, ODD[-1][1].split("\n")[0])
    assert dedup_lines(empty).count() == 0


# Models


def test_quality_separates_and_stays_defined(spark, documents, odd, empty):
    good = [(n, ". ".join(text(n * 7 % 190, 9, 3).capitalize() for _ in range(6))) for n in range(0, 120)]
    bad = [(n, " ".join(w.upper() + "!!" for w in text(n % 190, 40).split())) for n in range(120, 200)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(5, None), (None, 1)], "doc_id long, quality int")
    docs = documents(good + bad)
    model = train_quality(docs, labels)
    got = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    assert min(got[i] for i, _ in good) > 0.5 > max(got[i] for i, _ in bad)
    scored = score_quality(odd, model)
    assert scored.columns.count("score") == 1 and scored.filter("score between 0 and 1").count() == len(ODD)
    assert score_quality(empty, model).count() == 0
    none = train_quality(docs, labels.filter("quality = 1"))
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}


def test_language_by_kernel(documents, odd, empty):
    sounds = {"aa": ["ba", "la", "ma", "ta"], "oo": ["kro", "wo", "zo", "tro"]}
    pairs = []
    for n in range(160):
        own = sounds["aa" if n % 2 else "oo"]
        pairs.append((n, " ".join(own[(n + k) % 4] + own[(n * k + k) % 4] for k in range(12))))
    docs = documents(pairs).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "aa").otherwise("oo"))
    model = train_language(docs)
    got = {r.doc_id: r for r in predict_language(docs, model).collect()}
    assert all(r.lang_pred == ("aa" if i % 2 else "oo") and 0.5 < r.score <= 1 for i, r in got.items())
    strange = {r.doc_id: r for r in predict_language(odd, model).collect()}
    assert {strange[i].lang_pred for i in (1, 2, 3)} == {"und"} and strange[1].score == 0
    assert strange[4].lang_pred in ("aa", "oo")
    assert predict_language(empty, model).count() == 0
    assert train_language(empty) is None
    assert {r.lang_pred for r in predict_language(docs, None).collect()} == {"und"}


# Tokens


@pytest.fixture(scope="module")
def public():
    tokens = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = read_ranks(tokens.path("byte_bpe_50k.tiktoken"))
    return tokens, ranks, tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_like_the_public_library(public, odd):
    tokens, ranks, library = public
    got = encode_texts(odd, tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN, keep_ids=True).collect()
    assert len(got) == len(ODD)
    assert sorted((str(r.doc_id), r.token_ids) for r in got) == sorted((str(i), library.encode_ordinary(t or "")) for i, t in ODD)
    assert sorted(r.decoded_sha256 for r in got) == sorted(sha((t or "").encode()) for _, t in ODD)
    for r in got:
        assert r.n_tokens == len(r.token_ids) and r.ids_sha256 == sha(" ".join(map(str, r.token_ids)).encode())


def test_appends_and_edits_give_the_table_of_the_whole(public):
    _, ranks, _ = public
    vocabulary = Encoder(ranks, r"(?s).+").vocabulary
    raw = b"  internationalisation of the the aaaaaaaa 12345 " * 8
    table = PrefixTable(vocabulary)
    for at in range(0, len(raw), 7):
        table.append(raw[at : at + 7])
    assert table.last == PrefixTable(vocabulary, raw).last
    for start, stop, new in ((0, 3, b"x"), (40, 40, b"!!"), (100, 130, b""), (len(raw), len(raw), b"end"), (17, 18, b"N")):
        edited = PrefixTable(vocabulary, raw)
        worked = edited.replace(start, stop, new)
        assert edited.last == PrefixTable(vocabulary, raw[:start] + new + raw[stop:]).last
        assert worked <= len(edited.raw) - start
    near = PrefixTable(vocabulary, b"some words " * 400)
    assert near.replace(20, 21, b"e") < 400


def test_small_memories_do_not_change_the_tokens(public, monkeypatch):
    tokens, ranks, library = public
    encoder = Encoder(ranks, tokens.PATTERN)
    encoder._printed.size = encoder._beginnings.size = 3
    monkeypatch.setattr("tickloom.llm.bpe.PAIRS_KEPT", 2)
    for line in (LONG[:3000], "ABC abc  \n\n x" * 20):
        assert encoder.printed(line)[1] == " ".join(map(str, library.encode_ordinary(line)))
    memory = Recent(len, 2)
    assert [memory[k] for k in ("a", "bb", "ccc", "a", "dddd", "a")] == [1, 2, 3, 1, 4, 1]
