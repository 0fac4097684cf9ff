"""The stages, against their operators run by hand and the rules that hold between them."""

import os

import pytest

from odd_rows import nothing, odd  # noqa: F401

import corpus_pipeline
from touchline.session import stage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        found = stage(step(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert found.columns == docs.columns
        seen[name] = (docs, found)
        docs = found
    ids = {name: {r.doc_id for r in found.select("doc_id").collect()} for name, (_, found) in seen.items()}
    first = {r.doc_id for r in seen["quality"][0].select("doc_id").collect()}
    good = {k for k in first if k in labels and labels[k].quality == 1}
    assert len(good - ids["quality"]) <= 0.05 * len(good)
    assert ids["toxicity"] <= ids["quality"] and ids["near_duplicates"] <= ids["toxicity"]
    assert ids["personal_data"] == ids["near_duplicates"] == ids["packing"]
    texts = [r.text for r in seen["near_duplicates"][1].collect()]
    assert len(texts) == len(set(texts))
    assert not any("@mail" in r.text for r in seen["personal_data"][1].collect())


def test_odd_tables(spark, odd, nothing, tmp_path):
    """Nulls, blanks, a very long text, repeated rows and columns of clashing names go through all stages; so do empty tables, and no labels."""
    labels = spark.createDataFrame([(k, 1, 0) for k in range(8)], "doc_id bigint, quality int, toxic int")
    for name, docs, known in (("odd", odd, labels), ("unlabelled", odd, labels.limit(0)), ("nothing", nothing, labels)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        known.write.parquet(f"{folder}/labels.parquet")
        kept = docs
        for stage_name, step in corpus_pipeline.STAGES[:-1]:
            found = stage(step(spark, kept, folder), f"odd-{stage_name}")
            assert found.columns == docs.columns
            if stage_name == "toxicity" and name != "odd":
                assert found.count() == docs.count()
            kept = found
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
        pieces = packed.groupBy("doc_id").count().count()
        assert pieces == kept.select("doc_id").distinct().count()
        if name == "unlabelled":
            # Six rows have words of their own or none: copies, and texts without a word, are one each.
            assert kept.count() == len({(r.text or "").strip() for r in docs.collect()})


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
