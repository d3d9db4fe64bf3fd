import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from strata.llm.common import staged

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "personal_data", "packing"]


def test_all_but_the_last_return_the_columns_of_documents(steps):
    assert all(d.columns == COLUMNS and d.dtypes == steps[0].dtypes for d in steps[:-1])


def test_filters_keep_rows_unchanged_and_most_good_labels(spark, steps):
    rows = [{tuple(r) for r in d.collect()} for d in steps[:4]]
    assert rows[0] > rows[1] >= rows[2] >= rows[3]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    kept = {r[0] for r in rows[2]}
    assert len(good & kept) >= 0.95 * len(good) and len(bad & kept) <= 0.5 * len(bad)


def test_base_rules_take_effect(steps):
    for r in steps[2].collect():
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) >= 10


def test_one_document_of_each_group_stays(steps):
    from strata.llm.jaccard_join import near_duplicates

    groups = {}
    for r in near_duplicates(steps[2]).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(min(g) for g in groups.values())


def test_personal_data_is_replaced_and_the_rest_is_kept(steps):
    before, after = ({r.doc_id: r for r in d.collect()} for d in steps[3:5])
    assert before.keys() == after.keys()
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(email.search(r.text) for r in before.values())
    for key, r in after.items():
        assert not email.search(r.text) and r.n_chars == len(r.text)
        if r.text == before[key].text:
            assert (r.lang, r.source) == (before[key].lang, before[key].source)


def test_packing_holds_every_document(steps):
    packed = steps[5].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in steps[4].collect()}
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    total = sum(used.values())
    assert max(used.values()) <= 2048 and len(used) <= 1.02 * -(-total // 2048) + 1


def test_edge_rows_pass_every_stage(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), f"edge-{name}")
            assert docs.columns == edge_docs.columns
        assert stage is not None and corpus_pipeline.packing(spark, docs, SF).select(F.sum("length")).first() is not None


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got.select(key).collect()) == sorted(steps[5].select(key).collect())


def test_filters_decide_by_row_and_copies_go_whatever_their_key(spark):
    def prose(c):
        return " ".join(f"{c}{i}" for i in range(40))

    texts = [(None, prose("a")), (None, prose("b")), (None, "x"), (7, prose("c")), (7, "y y"), (7, prose("d")), (None, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(k), t) for k, t in texts if t and len(t) > 3)
    texts = [(None, prose("a"))] * 3 + [(5, prose("b")), (None, prose("b")), (None, prose("b") + " tail")] + [(7, prose("c"))] * 2 + [(7, prose("d")), (7, prose("e"))]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("None", prose("a")), ("5", prose("b"))] + [("7", prose(c)) for c in "cde"])
