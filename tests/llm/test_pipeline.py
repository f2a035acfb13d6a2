import pytest

import corpus_pipeline
from voltseries.llm import language_id, mixing, ngram_join, packing, pii

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and result of every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), stage(spark, docs, FOLDER).schema)
        out.append((name, docs))
    return out


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_order_and_columns(stages):
    assert [n for n, _ in stages[1:]] == ["language_id", "ngram_jaccard_join", "pii", "source_mixing", "packing"]
    assert all(f.columns == stages[0][1].columns for _, f in stages[1:-1])
    assert {"doc_id", "text", "bucket", "batch"} <= set(stages[-1][1].columns)


def test_each_stage_works_on_all_of_its_predecessor(spark, stages):
    frames = [f for _, f in stages]
    found = {r["doc_id"]: r for r in language_id.identify_documents(frames[0]).collect()}
    kept = [r["doc_id"] for r in frames[1].collect()]
    assert sorted(kept) == sorted(i for i, r in found.items() if r["accepted"])
    components = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_classes(frames[1]).collect()}
    left = sorted(r["doc_id"] for r in frames[2].collect())
    assert left == sorted(set(components.values())) and len(left) < len(kept)
    before, after = ({r["doc_id"]: r["text"] for r in f.collect()} for f in frames[2:4])
    cipher = pii.Cipher(pii.DEFAULT_KEY)
    assert after == {i: pii.pseudonymised(t, cipher) for i, t in before.items()}
    drawn = {r["doc_id"]: len(r["shards"]) for r in mixing.mix(frames[3]).collect()}
    assert sorted(r["doc_id"] for r in frames[4].collect()) == sorted(i for i, k in drawn.items() for _ in range(k))
    words = sum(len(t.split()) for t in (r["text"] or "" for r in frames[4].collect()))
    assert sum(r["n_tokens"] for r in frames[5].collect()) == words
    assert frames[5].columns == packing.pack(frames[4]).columns


def test_run_equals_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "n_tokens", "bucket", "text"]
    assert rows(found.select(*key)) == rows(stages[-1][1].select(*key))


def test_edges_pass_all_stages(spark, documents, edge_rows):
    docs = documents(edge_rows).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() > 0


def test_no_documents(spark, documents):
    docs = documents([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
