"""Operator 13 against a plain descent, and what moves when weights change."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import documents

from cohortlens.llm import hash_tree as H


def plain(key, leaves):
    """Descend region, rack and shard with plain dictionaries."""
    live = [x for x in leaves if x.weight > 0]
    for name in (lambda x: x.region, lambda x: f"{x.region}/{x.rack}", lambda x: f"{x.region}/{x.rack}/{x.shard}"):
        weight = Counter()
        for x in live:
            weight[name(x)] += x.weight

        def draw(node, weight=weight):
            bits = int(hashlib.md5(f"{H.SEED}|{node}|{key}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 0.5) / 2 ** 52) / weight[node]
        best = min(weight, key=lambda n: (draw(n), n))
        live = [x for x in live if name(x) == best]
    return live[0].shard


UNEVEN = [H.Leaf("a", "x", 0, 1.0), H.Leaf("a", "x", 1, 3.0), H.Leaf("a", "y", 2, 2.0), H.Leaf("b", "x", 3, 4.0),
          H.Leaf("b", "z", 4, 0.0), H.Leaf("c", "w", 5, 0.5)]


@pytest.mark.parametrize("leaves", [H.layout(1), H.layout(5), H.layout(8), H.layout(11), UNEVEN])
def test_descent(spark, leaves):
    rows = spark.range(400).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.shard for r in H.place(rows, leaves).collect()}
    assert got == {k: plain(k, leaves) for k in range(400)}


def test_shares_follow_weights(spark):
    n = 40_000
    rows = H.place(spark.range(n).withColumnRenamed("id", "doc_id"), UNEVEN).groupBy("shard").count().collect()
    total = sum(x.weight for x in UNEVEN)
    got = {r.shard: r["count"] for r in rows}
    assert 4 not in got
    for x in UNEVEN:
        share = x.weight / total
        assert abs(got.get(x.shard, 0) - n * share) < 5 * math.sqrt(n * share * (1 - share)) + 1


def test_movement_stays_in_changed_subtrees(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    at = {x.shard: (x.region, x.rack) for x in UNEVEN}
    heavier = [x._replace(weight=6.0) if x.shard == 1 else x for x in UNEVEN]
    moved = H.place(H.place(rows, UNEVEN, out="old"), heavier, out="new").where("old <> new").collect()
    assert moved
    for r in moved:  # into the changed shard's region, rack or shard; never between two unchanged places
        assert at[r.new][0] == "a"
        if at[r.old][0] == "a":
            assert at[r.new][1] == "x"
            if at[r.old][1] == "x":
                assert r.new == 1
    for n in (8, 9, 12):  # one more shard takes rows only into itself
        both = H.place(H.place(rows, H.layout(n), out="old"), H.layout(n + 1), out="new")
        changed = both.where("old <> new")
        assert changed.where(F.col("new") != n).count() == 0
        assert abs(changed.count() - 20_000 / (n + 1)) < 5 * math.sqrt(20_000 / (n + 1))


def test_query_matches_sql_and_contract(spark):
    sf = "/root/testdata/sf0.001"
    df = H.op13_sharding(spark, sf)
    rows = [r.asDict() for r in df.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(H.oracle())
    assert [d[0] for d in cur.description] == df.columns
    assert sorted(tuple(r.values()) for r in rows) == sorted(cur.fetchall())
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf).collect()}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], H.SHARDS)
    slots = Counter((r["shard"], r["slot"]) for r in rows)
    per_shard = Counter(r["shard"] for r in rows)
    assert slots == Counter((s, i) for s, n in per_shard.items() for i in range(n))


def test_edges_and_native(spark, edge_docs, no_docs, tmp_path):
    placed = H.place(edge_docs.withColumn("shard", F.lit("x")), H.layout(8))
    assert set(placed.columns) == {*edge_docs.columns, "shard"} and placed.count() == edge_docs.count()
    assert placed.where("doc_id is null").select("shard").distinct().count() == 1
    assert placed.where("doc_id = 15").select("shard").distinct().count() == 1
    assert H.number_slots(H.place(no_docs, H.layout(3)), ["doc_id"]).count() == 0
    same = spark.createDataFrame([(None, None)] * 500 + [(7, "é")] * 300, "doc_id long, text string")
    same.repartition(4).write.parquet(f"{tmp_path}/sf/documents.parquet")
    rows = H.op13_sharding(spark, f"{tmp_path}/sf").collect()
    by = Counter(r.shard for r in rows)
    assert Counter((r.shard, r.slot) for r in rows) == Counter((s, i) for s, n in by.items() for i in range(n))
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {(None, 1, 0), (7, 3, zlib.crc32("é".encode()))}
    plan = H.op13_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for bad in ([], [H.Leaf("a", "b", 0, 0.0)], [H.Leaf("a", "b", 0), H.Leaf("a", "c", 0)], [H.Leaf("a", "b", 0, -1.0)]):
        with pytest.raises(ValueError):
            H.place_column(F.lit("x"), bad)
