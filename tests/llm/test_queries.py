"""The registered queries: against their SQL, or against the data they learn from."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm.bpe import read_ranks
from tickloom.llm.queries import ORACLES, QUERIES
from tickloom.llm.tables import read

WITHOUT_SQL = {"op3_quality", "op9_language", "op10_byte_bpe"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_line_runs_use_no_python(spark, sf_dir):
    plan = QUERIES["op8_line_runs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_quality_on_rows_never_learned_from(spark, sf_dir):
    scored = QUERIES["op3_quality"](spark, sf_dir)
    assert scored.count() == read(spark, sf_dir, "documents").count()
    known = scored.filter("held_out").join(read(spark, sf_dir, "labels"), "doc_id")
    right = known.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.98


def test_language_on_rows_never_learned_from(spark, sf_dir):
    found = QUERIES["op9_language"](spark, sf_dir)
    known = found.filter("held_out").join(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    assert known.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.98


def encoder():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_of_whole_documents(spark, sf_dir):
    library = encoder()
    texts = {r.doc_id: r.text for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    for row in QUERIES["op10_byte_bpe"](spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def docs_of(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def brute_near(texts):
    """Ids that stay: the smallest of every group of texts linked by five-word shingle sets that are alike by 0.8."""
    sets = {}
    for i, text in texts.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(own[n : n + 5]) for n in range(max(1, len(own) - 4))} if own else set()
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small < 80 * large:
                continue
            meet = len(sets[a] & sets[b])
            if 100 * meet >= 80 * (len(sets[a]) + len(sets[b]) - meet):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i for i in texts if top(i) == i}


def test_pipeline_stages_take_effect(spark, sf_dir, con):
    docs = read(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out = corpus_pipeline.stored(out, "test-stage")
        assert out.columns == docs.columns
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        docs = out
    quality, exact, near, clean = kept.values()
    assert quality >= exact >= near >= clean and len(clean) < len(near) < len(exact) < len(quality)

    rejected = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    good = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    assert len(rejected & quality) <= 0.02 * len(rejected) and len(good - quality) <= 0.02 * len(good)

    con.execute("CREATE OR REPLACE TEMP TABLE judged AS SELECT unnest(?) AS doc_id", [sorted(quality)])
    firsts = con.execute("SELECT min(doc_id) FROM documents JOIN judged USING (doc_id) GROUP BY text").fetchall()
    assert exact == {r[0] for r in firsts}
    hit = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op1_decontaminate']}) WHERE contaminated").fetchall()}
    assert clean == near - hit

    texts = {r.doc_id: r.text for r in docs_of(spark, sf_dir).collect()}
    assert near == brute_near({i: texts[i] for i in exact})

    library = encoder()
    for row in corpus_pipeline.run(spark, sf_dir).select("doc_id", "token_ids").collect():
        assert row.token_ids == library.encode_ordinary(texts[row.doc_id] or "")
    last = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in last.select("doc_id").collect()} == clean
    assert last.filter(F.size("token_ids") != F.col("n_tokens")).count() == 0
