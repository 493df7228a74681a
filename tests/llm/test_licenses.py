"""Operator 8 against its SQL and a small tree of files."""

import math

import duckdb
import pytest

from cohortlens.llm import licenses as L


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    df = L.op8_license_scan(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(L.oracle())
    assert [d[0] for d in cur.description] == df.columns

    def norm(rows):
        return sorted(tuple("" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert norm(map(tuple, df.collect())) == norm(cur.fetchall())


def plain(text, template, df, n):
    """Cosine of two texts from plain dictionaries."""
    known = {t for _, b in L.TEMPLATES for t in L.terms(b)}
    idf = lambda t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 if t in known else math.log(1 + n) + 1
    a, b = L.terms(text), L.terms(template)
    norm = lambda x: math.sqrt(sum((x.count(t) * idf(t)) ** 2 for t in set(x)))
    return sum(a.count(t) * b.count(t) * idf(t) ** 2 for t in set(a)) / norm(a) / norm(b) if a else 0.0


def test_tree(spark):
    files = [
        ("LICENSE", "Released under the MIT License."), ("a/x.py", "print(1)"),
        ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/y.py", "import os"), ("a/b/c/z.py", "# Licensed under the Apache License, Version 2.0.\n" + "import os, sys\n" * 40),
        ("a/b/c/d/w.py", None), ("q", ""), (None, "All rights reserved."), (None, None),
        ("a/b/zz", "This work is licensed under the GNU General Public License, version 2."), ("a/x.py", "print(1)"),
        ("v/long.txt", "word " * 50_000 + "\nLicensed under CC BY-NC 4.0.\n" + "word " * 1000),
    ]
    df = spark.createDataFrame([(p, t, "keep", 3) for p, t in files], "path string, text string, own_license string, k int")
    rows = L.license_scan(df).collect()
    assert len(rows) == len(files) and rows[0].asDict().keys() == {"path", "k", *L.OWN}
    got = {r.path: r for r in rows if r.path}
    assert got["a/x.py"].license == "mit" and got["a/x.py"].inherited_from == ""
    assert got["a/b/y.py"].inherited_license == "gpl-2.0" and got["a/b/y.py"].inherited_from == "a/b"  # tie: by name
    assert (got["a/b/c/z.py"].own_license, got["a/b/c/z.py"].license) == ("apache-2.0", "apache-2.0")
    assert got["a/b/c/z.py"].inherited_license == "gpl-2.0"
    assert got["a/b/c/d/w.py"].license == "gpl-2.0" and got["q"].license == "mit"
    assert got["v/long.txt"].own_license == "cc-by-nc-4.0" and got["v/long.txt"].file_license is None
    assert sorted((r.license, r.inherited_license) for r in rows if r.path is None and r.license) == [
        ("all-rights-reserved", None)]
    n = len(files)
    counts = {}
    for _, t in files:
        for w in set(L.terms(t or "")):
            counts[w] = counts.get(w, 0) + 1
    line = "# Licensed under the Apache License, Version 2.0."
    assert abs(got["a/b/c/z.py"].own_score - plain(line, L.TEMPLATES[1][1], counts, n)) < 1e-8


def test_empty_and_native(spark, edge_docs):
    files = edge_docs.selectExpr("source as path", "text", "doc_id")
    assert L.license_scan(files).count() == edge_docs.count()
    assert L.license_scan(files.limit(0)).count() == 0
    plan = L.op8_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
