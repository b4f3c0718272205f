from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from rivulet.llm.queries import QUERIES
from rivulet.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows that each stage hands on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_stages_hand_on_documents(kept):
    for frame in kept[1:-1]:
        assert frame.schema == kept[0].schema or frame.dtypes == kept[0].dtypes
    counts = [f.count() for f in kept]
    assert counts[0] > counts[1] > counts[2] >= counts[3] > counts[4] == counts[5] > 0


def test_run_equals_the_stages(spark, kept):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, kept[-1].collect()))


def test_near_copies_are_gone(kept):
    prints = [fingerprint(r.text.encode()) for r in kept[3].collect()]
    assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(prints) for b in prints[:i])
    texts = {r.doc_id: r.text for r in kept[2].collect()}
    assert all(texts[r.doc_id] == r.text for r in kept[3].collect())


def test_clean_documents_stay(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    good = {r.doc_id for r in labels.collect()}
    first = {r.doc_id: r.text for r in kept[0].collect()}
    long = {i for i in good if len(first[i].split()) >= 10}
    repeated = {r.doc_id for r in QUERIES["op2_quality_bands"][0](spark, SF).where("base_failed").collect()}
    assert long - repeated <= {r.doc_id for r in kept[1].collect()}


def test_line_dedup_writes_the_new_length(kept):
    for r in kept[2].collect():
        assert r.n_chars == len(r.text)


def test_odd_tables(spark, docs, clashing, empty):
    for frame in (docs, clashing, empty):
        now = frame
        for name, stage in P.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == frame.columns, name
        assert P.STAGES[-1][1](spark, now, SF).count() == now.count()
    assert P.quality_rules(spark, docs.withColumn("text", F.lit(None).cast("string")), SF).count() == 0
