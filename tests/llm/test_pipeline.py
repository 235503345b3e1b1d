"""The pipeline, stage by stage against plain definitions over the same rows."""

import pytest

import corpus_pipeline
from ledgerlift.llm import registry
from ledgerlift.llm.common import written
from test_best_fit import check_rows
from test_jaccard_join import brute_force


@pytest.fixture(scope="module")
def outputs(spark, sf_dir, documents):
    found, docs = [documents], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(outputs, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "line_dedup", "jaccard_join", "best_fit_packing",
    ]
    assert all(df.columns == documents.columns for df in outputs[:-1])
    assert all(df.schema == documents.schema for df in outputs[:-1])


def test_rules_keep_what_the_operator_keeps(spark, sf_dir, outputs):
    kept = registry.queries()["op6_quality_rules"](spark, sf_dir).where("kept")
    assert set(texts(outputs[1])) == {r.doc_id for r in kept.collect()}


def test_filters_keep_clean_documents(spark, sf_dir, outputs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = texts(outputs[1]), texts(outputs[2])
    assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
    clean = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.99 * len(clean)
    assert sum(labels.get(i) == 0 for i in after) <= 0.2 * sum(q == 0 for q in labels.values())


def test_line_dedup_removes_lines_alone(outputs):
    before, after = texts(outputs[2]), texts(outputs[3])
    assert set(before) == set(after)
    sites = {}
    for r in before.values():
        for line in r.text.split("\n"):
            sites.setdefault(line.strip(" "), set()).add(r.source)
    for i, r in after.items():
        spread = [
            x
            for x in before[i].text.split("\n")
            if (len(x.split()) >= 3 or len(x.strip(" ")) >= 20) and len(sites[x.strip(" ")]) >= 5
        ]
        rest = "\n".join(x for x in before[i].text.split("\n") if x not in spread)
        whole = 9 * (len(before[i].text) - len(rest)) > 8 * len(before[i].text)
        assert r.text == (before[i].text if whole or not spread else rest)
        assert r.n_chars == len(r.text)


def test_one_of_each_group_stays(outputs):
    before, after = texts(outputs[3]), texts(outputs[4])
    labels = brute_force([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {label for _, _, label in labels}
    assert all(after[i] == before[i] for i in after)
    assert len(after) < len(before)


def test_packing_holds_all_that_is_left(outputs):
    check_rows(outputs[5].collect(), [(i, r.text) for i, r in texts(outputs[4]).items()], 2048)


def test_run_gives_the_last_stage(spark, sf_dir, outputs):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert sorted(ran) == sorted(outputs[5].select(*columns).collect())


def test_odd_rows(spark, sf_dir, odd_documents, documents):
    columns = documents.columns
    long_enough = documents.limit(40)
    odd = odd_documents.select(*columns).unionByName(long_enough).unionByName(long_enough.limit(5))
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    assert docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), sf_dir).count() == 0


def test_same_id_other_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text + " x"), (2, text), (None, text), (1, "other words here now")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(got) == 2 and (1, "other words here now") in got
    assert {i for i, _ in got} == {1}



def test_near_copies_share_four_fifths_of_five_words(spark):
    words = [f"w{i}" for i in range(102)]
    rows = [(1, " ".join(words[:60])), (2, " ".join(words[:72])), (3, " ".join(words[:60] + words[72:]))]
    assert {label for _, _, label in brute_force(rows, 4, 85)} == {1, 2, 3}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {label for _, _, label in brute_force(rows, 5, 80)}
    assert kept == {1, 3}
