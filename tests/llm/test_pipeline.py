"""The pipeline: every stage's decisions, against the operators' own rules."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sylvan.llm import quality, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The documents before the first stage and after each."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(root / str(k)))
        out.append(spark.read.parquet(str(root / str(k))))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, staged):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_classifier", "simhash_near_dedup", "pii", "packing"]
    first, clean, good, single, private, packed = staged
    assert all(df.columns == first.columns for df in staged[:5])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    documents = first.select("doc_id", "text")
    toxic = toxicity.score_documents(documents, toxicity.fit(first, labels)).where("not is_toxic")
    assert ids(clean) == ids(toxic)
    scored = quality.score_documents(clean.select("doc_id", "text"), quality.fit(first, labels)).where("is_good")
    assert ids(good) == ids(scored)
    groups = defaultdict(set)
    for r in good.select("doc_id", "text").collect():
        groups[simhash.fingerprint(r["text"], 3)].add(r["doc_id"])
    assert len(ids(single)) <= len(groups) and ids(single) <= {min(g) for g in groups.values()}
    assert ids(private) == ids(single) == ids(packed)
    assert not private.where(F.col("text").rlike(r"[A-Za-z0-9]@[a-z0-9]+\.example\.com")).count()
    total = packed.agg(F.sum("length")).first()[0]
    assert total / (1024 * packed.select("sequence_id").distinct().count()) > 0.95


def test_run_gives_the_last_stage(spark, staged):
    rows = lambda df: sorted(tuple(r) for r in df.drop("ids").collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(staged[-1])


def test_odd_documents_go_through(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_docs.columns
    assert {r["doc_id"] for r in corpus_pipeline.pack(spark, docs, SF).collect()} == ids(docs)


def test_empty_table_goes_through(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_entry_guard():
    source = open("__spark_entry__.py").read()
    assert len(re.findall("except ImportError", source)) == 1
