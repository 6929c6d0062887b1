"""The stages of the pipeline on odd rows: null ids, ids with several texts, repeated rows."""

from collections import Counter

import pytest
from corpus_cases import ODD
from pyspark.sql import functions as F

import corpus_pipeline

ITEM = " ".join(f"item{n}" for n in range(14))
COPIED = " ".join(f"copied{n}" for n in range(50))
CLEAN = " ".join(f"clean{n}" for n in range(50))
LABELS = "doc_id long, quality int"


def worth(n):
    """A text that is labelled good (odd) or bad (even)."""
    good = " ".join(f"A sentence of plain words about subject {n} and the {n % 7} others it names." for _ in range(6))
    return good if n % 2 else f"buy!! now!! {'| ' * 30} $$$ win {n} win win win !!!! " * 4


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with one benchmark item."""
    made = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([("i", ITEM)], "item_id string, text string").write.parquet(f"{made}/benchmark.parquet")
    spark.createDataFrame([(100 + n, n % 2) for n in range(60)], LABELS).write.parquet(f"{made}/labels.parquet")
    return made


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    """Tables without a row."""
    made = str(tmp_path_factory.mktemp("bare"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{made}/benchmark.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{made}/labels.parquet")
    return made


def pairs(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_contaminated_rows_go_and_no_others(spark, documents, folder):
    bad = [(None, f"x {ITEM} y"), (1, ITEM), (20, f"{ITEM} z"), (20, f"{ITEM} z")]
    good = [*ODD, (20, CLEAN), (None, CLEAN)]
    out = corpus_pipeline.decontaminate(spark, documents(bad + good), folder)
    assert out.columns == documents([]).columns
    assert pairs(out) == Counter(good)


def test_near_copies_go_and_no_others(spark, documents, folder):
    gone = [(None, COPIED), (31, COPIED.upper()), (33, COPIED + " more"), (34, CLEAN + " more")]
    stay = [(30, COPIED), (31, CLEAN), (None, None), (35, None), (36, "")]
    out = corpus_pipeline.near(spark, documents(gone + stay), folder)
    assert out.columns == documents([]).columns
    assert pairs(out) == Counter(stay)


def test_exact_copies_go_and_each_text_stays(spark, documents, folder):
    out = corpus_pipeline.exact(spark, documents(ODD), folder)
    assert len(out.collect()) == len({text or "" for _, text in ODD})
    assert {text or "" for _, text in pairs(out)} == {text or "" for _, text in ODD}


def test_every_odd_row_gets_its_tokens(spark, documents, folder):
    out = corpus_pipeline.tokens(spark, documents(ODD), folder).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in ODD)
    assert all(len(r.token_ids) == r.n_tokens for r in out)


def test_quality_goes_by_the_text_alone(spark, documents, folder):
    known = [(100 + n, worth(n)) for n in range(60)]
    rows = [*known, (None, worth(3)), (None, worth(4)), (7, worth(5)), (7, worth(6)), *ODD]
    docs = documents(rows).withColumn("quality_score", F.lit(2.0))
    out = corpus_pipeline.quality(spark, docs, folder)
    assert out.columns == docs.columns
    kept = pairs(out)
    judged = [row for row in rows if row not in ODD]
    assert [row for row in judged if (row in kept) != (row[1] in {worth(n) for n in range(1, 60, 2)})] == []
    # Rows with the same text share their fate, under whatever id.
    for text in {text for _, text in rows}:
        assert len({kept[row] > 0 for row in rows if (row[1] or "") == (text or "")}) == 1
    assert all(kept[row] in (0, rows.count(row)) for row in rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_every_stage_takes_empty_tables(spark, documents, folder, bare, name, stage):
    for tables in (folder, bare):
        out = stage(spark, documents([]), tables)
        assert out.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents([]).columns


def test_nothing_goes_without_labels_and_items(spark, documents, bare):
    for stage in (corpus_pipeline.quality, corpus_pipeline.decontaminate):
        assert pairs(stage(spark, documents(ODD), bare)) == Counter(ODD)


def test_which_of_equal_texts_stays(spark, documents, folder):
    rows = [(9, "same"), (3, "same"), (None, "same"), (5, ""), (4, None), (None, "alone")]
    assert pairs(corpus_pipeline.exact(spark, documents(rows), folder)) == Counter([(3, "same"), (4, None), (None, "alone")])
