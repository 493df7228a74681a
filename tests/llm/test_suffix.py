"""Operator 10 against a table of all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import documents, words

from cohortlens.llm import suffix_dedup as S


def brute(rows, window=100):
    """rows (doc_id, text), each distinct document once, in order: {(doc_id, text): (spans, kept)}."""
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            x = b[i:i + window]
            if x in seen:
                gone[i:i + window] = b"\1" * window
            else:
                seen.add(x)
        edges = [i for i in range(len(b) + 1) if (i < len(b) and gone[i]) != (i > 0 and gone[i - 1])]
        out[(d, t)] = (list(zip(edges[::2], edges[1::2], strict=True)), bytes(c for c, g in zip(b, gone, strict=True)
                                                                             if not g))
    return out


def ordered(spark, rows):
    """Distinct documents in the operator's order."""
    df = spark.createDataFrame(list(dict.fromkeys(rows)), "doc_id long, text string")
    return [(r.doc_id, r.text) for r in df.selectExpr(
        "doc_id", "text", "doc_id is null as n", "xxhash64(cast(coalesce(text, '') as binary)) & 2147483647 as t")
        .collect() and sorted(df.selectExpr("doc_id", "text", "doc_id is null as n",
                                            "xxhash64(cast(coalesce(text, '') as binary)) & 2147483647 as t").collect(),
                              key=lambda r: (r.n, r.doc_id or 0, -1 - r.t if r.n else r.t))]


def check(spark, df, window=100, **options):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(ordered(spark, rows), window)
    got = S.remove_repeats(df, window=window, **options).collect()
    expected = sorted(((i is None, i or 0), len((t or "").encode()), s, k) for i, t in rows for s, k in [want[(i, t)]])
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, [tuple(x) for x in r.spans], bytes(r.kept))
                  for r in got) == expected
    assert all(r.n_removed == r.n_bytes - len(r.kept) and r.n_spans == len(r.spans) for r in got)


def test_query_matches_table_of_windows(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in documents(spark, sf).collect())
    want = brute(rows)
    got = {r.doc_id: r for r in S.op10_suffix_dedup(spark, sf).collect()}
    for d, t in rows:
        spans, kept = want[(d, t)]
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(t.encode()), len(t.encode()) - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("spread", [20_000, 1])
def test_edges(spark, edge_docs, spread):
    check(spark, edge_docs, spread=spread)


def test_empty(spark, no_docs):
    assert S.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("spread", [20_000, 2])
def test_shared_passages_and_periodic_texts(spark, spread):
    rng = random.Random(3)
    passages = [words(rng, 30) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = [words(rng, rng.randint(3, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(20)
            parts += [p[a:a + rng.randint(60, 160)], words(rng, rng.randint(0, 5))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 400), (101, "a" * 700), (102, "abc" * 100 + passages[0]), (103, "a" * 99), (104, "a" * 100)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spread=spread)


def test_shorter_window(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 60, "ab")) for i in range(20)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), window=12, gram=6)


def test_cut_repeats_keeps_columns(spark, edge_docs):
    out = S.cut_repeats(edge_docs)
    assert out.columns == edge_docs.columns
    got = {r.size: r for r in out.collect()}  # size numbers the rows of the fixture
    assert got[0].text == edge_docs.where("size = 0").first().text and got[0].row == "x"
    assert 1 not in got and 7 not in got      # whole copies: nothing is left
    assert got[4].text == "" and got[5].text == ""
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_texts_without_id_whose_hashes_share_31_bits(spark):
    """Two documents of null id that agree in the lowest 31 bits of their hash are still two."""
    passage = words(random.Random(11), 60)
    texts = spark.range(300_000).selectExpr(
        f"concat(substr(sha2(string(id), 512), 1, 20 + int(id % 90)), '{passage}', sha2(string(-id), 256)) as text")
    low = "xxhash64(cast(text as binary)) & 2147483647"
    pairs = [r.same for r in texts.selectExpr("text", f"{low} as low").groupBy("low").agg(
        F.collect_set("text").alias("same")).where("size(same) = 2").collect()]
    edge = len(passage)
    own = [(x, y) for x, y in pairs  # that share no window beside the passage, so that their order does not matter
           if x[x.index(passage) - 1] != y[y.index(passage) - 1]
           and x[x.index(passage) + edge] != y[y.index(passage) + edge] and x.index(passage) != y.index(passage)]
    assert own
    check(spark, spark.createDataFrame([(1, passage), *((None, t) for t in own[0])], "doc_id long, text string"))


@pytest.mark.parametrize("spread", [20_000, 1])
def test_many_groups(spark, edge_docs, spread, monkeypatch):
    """Groups are counted from the bytes of the texts; the result does not depend on their number."""
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").unionByName(
        edge_docs.select("doc_id", "text"))
    monkeypatch.setattr(S, "GROUP_BYTES", 20_000)
    assert S.group_count(docs, S.GROUP_BYTES) > 10
    check(spark, docs, spread=spread)
