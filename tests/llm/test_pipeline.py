"""Every stage against its operator's brute-force twin, on what the stage before kept."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from eventloom.llm.queries import table
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_mixing, test_sharding, test_simhash


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        out.append((before, docs))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_return_documents(outputs):
    for before, after in outputs[:-1]:
        assert after.columns == before.columns


def test_language_stage_keeps_clean_documents(outputs):
    before, after = outputs[0]
    assert sum(ids(after).values()) >= 0.97 * before.count()
    assert set(ids(after)) <= set(ids(before))


def test_one_document_of_each_group_stays(outputs):
    before, after = outputs[1]
    prints = {r.doc_id: test_simhash.plain_fingerprint(r.text) for r in before.collect()}
    roots = test_simhash.smallest_reachable(prints, 3)
    assert ids(after) == Counter(set(roots.values()))


def test_contaminated_documents_go(spark, outputs):
    before, after = outputs[2]
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    judged = test_decontaminate.brute_force([(r.doc_id, r.text) for r in before.collect()], items)
    assert ids(after) == Counter(doc for doc, _, hit, _ in judged if not hit)


def test_mixture_is_drawn(outputs):
    before, after = outputs[3]
    rows = test_mixing.brute_force([(r.doc_id, r.text, r.source) for r in before.collect()])
    assert ids(after) == +Counter({r[0]: r[5] for r in rows})


def test_shards_hold_all_rows(outputs):
    before, after = outputs[4]
    assert after.columns == [*before.columns, "shard", "slot"]
    assert ids(after) == ids(before)
    test_sharding.check_law(after.collect(), 16)


def test_odd_rows_pass_all_stages(spark, odd, documents, tmp_path):
    docs = documents.unionByName(odd.select(documents.columns))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0


def test_texts_that_share_an_id_are_judged_apart(spark, documents):
    clean = [r.text for r in documents.where("lang = 'en' and n_chars between 300 and 3000").orderBy("doc_id").limit(40).collect()]
    prints = {t: test_simhash.plain_fingerprint(t) for t in clean}
    apart = [t for t in prints if all(t == o or ((prints[t] ^ prints[o]) & (1 << 64) - 1).bit_count() > 3 for o in prints)][:6]
    assert len(apart) == 6
    rows = [(7, apart[0]), (7, apart[1]), (7, apart[1]), (None, apart[2]), (None, apart[3]), (8, apart[4]), (9, apart[4])]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], documents.schema)
    docs = docs.selectExpr("*", "'x' AS text_mark", "'y' AS score", "'z' AS predicted", "'w' AS row")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["simhash_near_dedup"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    left = [(7, apart[0]), (7, apart[1]), (None, apart[2]), (None, apart[3]), (8, apart[4])]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(left)
    assert {(r.text_mark, r.score, r.predicted, r.row) for r in kept.collect()} == {("x", "y", "z", "w")}

    item = next(r.text for r in table(spark, SMALL, "benchmark").collect() if len(r.text.split()) >= 12)
    dirty = spark.createDataFrame([(7, item, "en", "a", 1, "x", "y", "z", "w"), (None, item, "en", "a", 1, "x", "y", "z", "w")], docs.schema)
    clean_rows = stages["decontamination"](spark, docs.union(dirty), SMALL)
    assert Counter((r.doc_id, r.text) for r in clean_rows.collect()) == Counter(
        (r.doc_id, r.text) for r in stages["decontamination"](spark, docs, SMALL).collect()
    )
    assert all(r.text != item for r in clean_rows.collect()) and clean_rows.count() > 0

    spoken = stages["language_id"](spark, docs, SMALL)
    assert spoken.columns == docs.columns and {(r.score, r.predicted) for r in spoken.collect()} == {("y", "z")}


def test_empty_documents_pass_all_stages(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
