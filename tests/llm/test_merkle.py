"""Operator 12 against a plain tree built in memory, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in M.FIELDS))


def tree(hashes):
    levels = [list(hashes)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i, fold):
    proof = []
    for level in levels[:-1]:
        run, slot = level[i // 8 * 8:i // 8 * 8 + 8], i % 8
        proof += run[:slot] + run[slot + 1:]
        fold = h(*run[:slot], fold, *run[slot + 1:])
        i //= 8
    return proof, fold


def plain(rows, tamper):
    """The rows of the query from plain lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), leaf(tamper(r)), r["doc_id"]))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([g[2] for g in sorted(groups[x], key=lambda g: g[:4])]) for x in order}
    top = tree([trees[x][-1][0] for x in order])
    out = []
    for at, x in enumerate(order):
        for i, g in enumerate(sorted(groups[x], key=lambda g: g[:4])):
            proof, fold = path(trees[x], i, g[3])
            more, fold = path(top, at, fold)
            out.append((g[4], g[2], trees[x][-1][0], top[-1][0], h(*proof, *more), fold, fold == top[-1][0]))
    return out


def lowered(r):
    hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
    text = r["text"]
    if hit and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return r | {"text": text}


def run(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/sf/documents.parquet")
    return M.op12_merkle_manifest(spark, f"{tmp_path}/sf")


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("counts", [[1], [7], [8], [9], [65], [1, 1], [520, 1, 8, 64, 17, 2, 1, 3, 9, 70]])
def test_plain_tree(spark, tmp_path, counts):
    rng = random.Random(sum(counts))
    rows, i = [], 0
    for k, n in enumerate(counts):
        lang = None if k == 2 else f"l{k}" if k else "é"
        for _ in range(n):
            i += 1
            rows.append((i if rng.random() < 0.9 else None, rng.choice([None, "", "Ab Ç", "XyZ" * 30, f"T{i}"]), lang,
                         rng.choice([None, "s", "ü"]), rng.choice([None, 3, -5])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = run(spark, df, tmp_path).collect()
    assert key(got) == key(plain([r.asDict() for r in df.collect()], lowered))


def test_edges(spark, edge_docs, no_docs, tmp_path):
    got = run(spark, edge_docs, tmp_path / "a")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert key(got.collect()) == key(plain([r.asDict() for r in edge_docs.collect()], lowered))
    assert run(spark, no_docs, tmp_path / "b").count() == 0


def test_climb_gives_real_proofs(spark, edge_docs):
    """Unchanged rows verify; the siblings of a leaf have the hash that the digest names; the limit is put back."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "77")
    try:
        rows = M.climb(M.build(edge_docs), siblings=True).collect()
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "77"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert len(rows) == edge_docs.count() and all(r.verified and r.folded_root == r.root for r in rows)
    assert all(len(r.siblings) % 64 == 0 and h(r.siblings) == r.proof_sha256 for r in rows)


def test_changed_rows_are_found(spark, edge_docs):
    kept = {c: F.col(c) for c in M.FIELDS}
    changed = kept | {"n_chars": F.when(F.col("doc_id") == 7, F.lit(-1)).otherwise(F.col("n_chars"))}
    rows = M.climb(M.build(edge_docs, edge_docs.select("lang", "doc_id", M.leaf_hash(kept).alias("leaf"),
                                                       M.leaf_hash(changed).alias("fold")))).collect()
    assert {r.doc_id for r in rows if not r.verified} == {7}


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = M.op12_merkle_manifest(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(M.oracle())
    assert [d[0] for d in cur.description] == df.columns
    rows = df.collect()
    assert key(rows) == key(cur.fetchall())
    assert {r.verified for r in rows} == {True, False}
