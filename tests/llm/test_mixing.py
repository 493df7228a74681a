"""Operator 5 against plain apportionment."""

import collections
import random
from fractions import Fraction

from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.llm.conftest import documents

from cohortlens.llm import mixing as M


def plain_targets(sizes):
    """sizes: [(source, size)] in order; share, stop, share the excess again until none is above its stop."""
    weight = [i % 3 + 1 for i in range(len(sizes))]
    total = sum(s for _, s in sizes)
    fixed = {}
    while True:
        rest = total - sum(fixed.values())
        w = sum(x for i, x in enumerate(weight) if i not in fixed)
        over = [i for i in range(len(sizes)) if i not in fixed and rest * weight[i] > 3 * sizes[i][1] * w]
        if not over:
            return [float(fixed[i] if i in fixed else Fraction(rest * weight[i], w)) for i in range(len(sizes))]
        fixed.update({i: 3 * sizes[i][1] for i in over})


def plain_sainte_lague(claims, seats):
    won = [0] * len(claims)
    for _ in range(seats):
        best = max((i for i in range(len(claims)) if claims[i] > 0), key=lambda i: (Fraction(claims[i], 2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_targets(spark):
    rng = random.Random(1)
    for n in (1, 2, 7, 23):
        sizes = [(f"s{i:02d}", rng.choice([0, 1, 5, 40, 1000, 20_000])) for i in range(n)]
        df = spark.createDataFrame([(s, v) for s, v in sizes] + [(None, 17)], "source string, source_size long")
        got = {r.source: r.target for r in M.targets(df).collect()}
        want = plain_targets([*sizes, (None, 17)])
        assert all(abs(got[s] - t) < 1e-6 * max(1, t) for (s, _), t in zip([*sizes, (None, 17)], want, strict=True))


def test_highest_quotients(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(12):
        claims = [rng.choice([0, 1, 2, 3, 10, 50, 50, 400, 3000]) for _ in range(rng.randint(1, 15))]
        seats = rng.choice([0, 1, 7, 40, 200])
        if not sum(claims):
            claims[0] = 1
        rows += [(g, i, c, seats) for i, c in enumerate(claims)]
        want.update({(g, i): v for i, v in enumerate(plain_sainte_lague(claims, seats))})
    df = spark.createDataFrame(rows, "g int, i int, claim long, seats long")
    got = {(r.g, r.i): r.blocks for r in M.highest_quotients(df, "claim", "seats", [F.col("i")], ["g"]).collect()}
    assert got == want


def check(rows):
    """Contract of the query."""
    size, taken, source_size, target = (collections.Counter() for _ in range(4))
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        source_size[r.source], target[r.source] = r.source_size, r.target
    assert source_size == size
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    for s, t in zip(order, plain_targets([(s, size[s]) for s in order]), strict=True):
        assert abs(target[s] - t) < 1e-6 * max(1, t)
        assert abs(taken[s] - t) <= 1.5 * M.BLOCK_WORDS


def test_query(spark):
    rows = M.op5_mixing(spark, "/root/testdata/sf0.01").collect()
    check(rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, M.op5_mixing(spark, "/root/testdata/sf0.01").collect()))
    sizes = {r.doc_id: r.size for r in rows}
    for r in documents(spark, "/root/testdata/sf0.001").collect()[:5]:
        assert r.doc_id in sizes


def test_many_shards_and_edges(spark, edge_docs, no_docs):
    mixed = M.mix(edge_docs, shard_rows=2)
    assert mixed.columns == [c for c in edge_docs.columns if c != "size"] + ["size", "source_size", "target", "taken"]
    check(mixed.collect())
    check(M.mix(documents(spark, "/root/testdata/sf0.001").drop("size"), shard_rows=3).collect())
    assert M.mix(no_docs).count() == 0


def test_rows_without_an_id_are_spread(spark):
    """A source of null ids, and one of a single id, fill their shards evenly; equal rows still take alike in sum."""
    rows = [(None, "a", f"word{i} x y z") for i in range(1000)] + [(7, "b", f"other{i} x") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    check(M.mix(df, shard_rows=20).collect())
    h = M.F.xxhash64(M.F.lit(M.SEED), "doc_id", M.text_tag())
    per = df.groupBy("source", M.F.pmod(M.F.xxhash64(h), M.F.lit(50)).alias("shard")).count().groupBy("source").agg(
        M.F.count(M.F.lit(1)).alias("n"), M.F.max("count").alias("most")).collect()
    assert all(r.n == 50 and r.most < 60 for r in per)


def test_native(spark):
    plan = M.op5_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_apply_mix(spark, edge_docs):
    docs = documents(spark, "/root/testdata/sf0.001")
    taken = M.mix(docs.select("doc_id", "source", "text")).select("doc_id", "taken", "size")
    out = M.apply_mix(docs)
    assert out.columns == docs.columns
    got = out.groupBy("doc_id").agg(F.sum(M.size_of()).alias("words"), F.count(F.lit(1)).alias("n"))
    assert taken.join(got, "doc_id", "left").where(F.coalesce("words", F.lit(0)) != F.col("taken")).count() == 0
    whole = docs.select("doc_id", F.col("text").alias("full"))
    assert out.join(whole, "doc_id").where("not startswith(full, text)").count() == 0
    assert out.where("n_chars <> length(text)").count() == 0
    assert M.apply_mix(edge_docs).columns == edge_docs.columns
    assert isinstance(Window, type)
