"""The pipeline stage by stage: each against its own input."""

import corpus_pipeline as P
from pyspark.sql import functions as F
from tests.llm.conftest import documents
from tests.llm.test_jaccard import brute as components
from tests.llm.test_jaccard import few_copies, moved, shingles
from tests.llm.test_suffix import brute as cuts

from cohortlens.llm import jaccard_join as J
from cohortlens.llm import mixing, tokens
from cohortlens.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, names = documents(spark, SF), []
    columns = docs.columns
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF), "test-stage")
        names.append(name)
        if name != "packing":
            assert out.columns == columns and out.schema == docs.schema
        before = {r.doc_id: r for r in docs.collect()}
        after = out.collect()
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            clean = [i for i in before if labels.get(i) == 0]
            assert sum(r.doc_id in set(clean) for r in after) >= 0.97 * len(clean)
        elif name == "near_duplicates":
            want = {c for _, _, c in components([(r.doc_id, r.text) for r in before.values()])}
            assert {r.doc_id for r in after} == want and len(after) == len(want)
        elif name == "repeated_passages":
            want = cuts(sorted((r.doc_id, r.text) for r in before.values()))
            for r in after:
                spans, kept = want[(r.doc_id, before[r.doc_id].text)]
                assert r.text == kept.decode("utf-8", "ignore") and r.n_chars == len(r.text)
            gone = set(before) - {r.doc_id for r in after}
            assert all(not want[(i, before[i].text)][1].strip() for i in gone)
        elif name == "mixing":
            total = docs.agg(F.sum(mixing.size_of())).first()[0]
            assert abs(out.agg(F.sum(mixing.size_of())).first()[0] - total) <= 2 * mixing.BLOCK_WORDS
        else:
            encoder = tokens.Encoder(tokens.vocabulary_path())
            ids = sum(len(encoder.encode(r.text)) + 1 for r in docs.collect())
            assert sum(r.length for r in after) == ids and {r.doc_id for r in after} == set(before)
        docs = out
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]


def test_run_is_its_stages(spark):
    rows = P.run(spark, SF).collect()
    docs = documents(spark, SF)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "test-run")
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))


def test_edges_pass_through(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            out = written(stage(spark, docs, SF), "test-edges")
            assert name == "packing" or out.columns == edge_docs.columns
            docs = out
    assert docs.count() == 0


def test_near_duplicates_sends_ngrams_without_their_class(spark, monkeypatch):
    """What the stage sends to find shared n-grams is bounded by the n-grams, however many groups there are."""
    rows, sent = few_copies(), []

    def watched(df, name):
        if name == "jaccard-classes":
            sent.append(moved(df)[1])
        return written(df, name)
    monkeypatch.setattr(J, "written", watched)
    monkeypatch.setattr(J, "GROUP_BYTES", 9000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    assert J.group_count(docs, J.GROUP_BYTES) > 35
    kept = P.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(1000))
    grams = sum(len(s) for s in {frozenset(shingles(t)) for _, t in rows})
    assert sent[0] < 14 * grams, sent[0] / grams
    docs.unpersist()
