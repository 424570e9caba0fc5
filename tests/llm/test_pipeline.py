"""The pipeline, and every query of the package, over small tables."""

import corpus_pipeline
import pytest

from termloom.llm.queries import QUERIES


def test_stages_work_on_what_the_one_before_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns and 0 < after.count() <= left
            assert after.exceptAll(docs).count() == 0
            docs, left = after, after.count()
        else:
            assert after.select("doc_id").distinct().count() == left
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, whole.collect())) == sorted(map(str, after.select(whole.columns).collect()))


def test_pipeline_of_odd_rows(spark, odd, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
    left = []
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        left.append(sorted((r.doc_id or 0 for r in docs.collect())))
    # without text or letters there is no language; one word, or one sentence of many copies, is no good text
    assert left[0] == [0, 4, 5, 5, 6, 7, 8, 8]
    assert set(left[1]) <= set(left[0]) and not set(left[1]) & {0, 4, 5, 6}
    assert left[2] == sorted(set(left[1]))[:1] or left[2] == left[1]
    packed = corpus_pipeline.packing(spark, odd, "")
    assert sorted({r.doc_id or 0 for r in packed.collect()}) == [0, 1, 2, 3, 4, 5, 6, 7, 8]


@pytest.mark.parametrize("name", QUERIES)
def test_queries_run(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
