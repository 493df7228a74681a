"""Operator 11 against all pairs of words, the gram bound against every edit, and the query against its SQL."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import spelling as S


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]
        if i < len(word):
            yield word[:i] + word[i + 1:]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain(counts):
    """The rows of the query from a dictionary of counts, by all pairs."""
    words = sorted(counts)
    others = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(others[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(others[w]), counts[form[w]] if form[w] else None))
    return out


def vocabulary(rng, n, letters, longest=9):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, longest))) for _ in range(n)}
    for w in rng.sample(sorted(words), n // 3):
        words |= {x for x in rng.sample(list(edits(w, letters)), 3) if len(x) >= 5}
    return {w: rng.choice([3, 3, 4, 7, 20, 300]) for w in words}


@given(st.text("abc", min_size=5, max_size=12), st.sets(st.text("abc", min_size=2, max_size=4), max_size=25))
@settings(max_examples=150, deadline=None)
def test_an_edit_changes_no_more_grams_than_the_bound(word, grams):
    grams = {g[:k]: 1 for g in grams for k in range(2, len(g) + 1)}  # a dictionary holds the beginnings of its grams
    for known, qmax in ((grams, S.QMAX), (grams, S.QMIN)):
        chosen = S.decompose(word, known, qmax)
        kept = S.uncovered(chosen)
        bound = S.affected(len(word), chosen, kept, qmax)
        for other in edits(word, "abcd"):
            theirs = S.uncovered(S.decompose(other, known, qmax))
            same = {("<", other[:e]) for _, e in theirs} | {(">", other[p:]) for p, _ in theirs}
            mine = [(p, e) for p, e in kept if ("<", word[:e]) in same or (">", word[p:]) in same]
            assert len(kept) - len(mine) <= bound
        if qmax == S.QMIN:
            assert bound < len(kept)


@given(st.text("abé", min_size=5, max_size=9), st.sets(st.text("abé", min_size=2, max_size=4), max_size=20), st.integers(0, 9**6))
@settings(max_examples=150, deadline=None)
def test_near_words_share_a_list(word, grams, seed):
    rng = random.Random(seed)
    known = {g[:k]: rng.randint(1, 9) for g in sorted(grams) for k in range(2, len(g) + 1)}
    mine = set(S.lists_of(word, known))
    keys = {k for k, _ in mine}
    for other in edits(word, "abéz"):
        if other != word and len(other) >= 5:
            assert keys & {k for k, _ in S.lists_of(other, known)}


@pytest.mark.parametrize("longest", [4, 200])
def test_all_pairs(spark, longest):
    rng = random.Random(longest)
    counts = vocabulary(rng, 200, "abcé") | {"x" * i: 3 for i in (63, 64, 65, 66, 300, 301)} | {
        "x" * 300 + c: 3 for c in "abcdefg"} | {"x" * 63 + "y": 9, "y" + "x" * 64: 4}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = S.near_pairs(words, longest).collect()
    want = {(a, b) for a in counts for b in counts if near(a, b) and (len(a), a) < (len(b), b)}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want
    assert all((r.n_a, r.n_b) == (counts[r.a], counts[r.b]) for r in got)


def test_forms_and_roots(spark):
    rng = random.Random(5)
    counts = vocabulary(rng, 250, "abcd", 7)
    chain = ["qqqqq", "qqqqr", "qqqrr", "qqrrr", "qrrrr", "rrrrr", "rrrrs"]
    counts |= {w: 3 * 2 ** i for i, w in enumerate(chain)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(map(tuple, S.variants(words).collect())) == plain(counts)
    assert S.variants(words.limit(0)).count() == 0


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_words_of_texts(spark, edge_docs, no_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert {r.word: r.n for r in S.count_words(edge_docs).collect()} == plain_counts(rows)
    assert S.count_words(no_docs).count() == 0
    rng = random.Random(3)
    text = "".join(rng.choice("abÀé÷日 č.-Z") for _ in range(20_000)).encode()
    for size in (1, 7, 100, 5000):
        parts = list(S.pieces(text, size))
        assert b"".join(parts) == text
        assert [x for p in parts for x in S.RUN.findall(S.lowered(p))] == S.RUN.findall(S.lowered(text))
    many = [(i % 50 if i % 7 else None, "Lettre À part éteint word words wordé " * (i % 3)) for i in range(500)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    assert {r.word: r.n for r in S.count_words(df).collect()} == plain_counts(many)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = S.op11_spelling(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(S.oracle())
    assert [d[0] for d in cur.description] == df.columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, cur.fetchall()))
