import random

import pytest


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls everywhere, repeated rows, ties, copies, very long texts and clashing column names."""
    rng = random.Random(7)
    base = words(rng, 120)
    parts = base.split(" ")
    near = " ".join(parts[:60] + ["zzzz"] + parts[61:])
    long = words(rng, 30_000)
    passage = words(rng, 70)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", None),
        (4, None, None, None), (5, "", "de", "b"), (6, " \n\t ", "de", "b"), (None, base, "en", "a"),
        (None, None, None, "a"), (7, "one two three", "en", "b"), (8, "One  two\nTHREE", "en", "b"),
        (9, long, "fr", "c"), (10, long[:90_000], "fr", "c"), (11, words(rng, 40) + " " + passage, "en", "a"),
        (12, passage + "\n" + words(rng, 40), "en", "c"), (13, "é" * 400, "fr", "b"), (14, "x" * 5000, "en", "b"),
        (15, words(rng, 300), "en", "é"), (15, words(rng, 200), "en", "z"), (16, "日本語 " * 50, None, "z"),
        (17, "<|endoftext|> don't  we'll\n\n  ok", "en", "a"), (18, "...", "en", "a"),
    ]
    rows = [(i, t, lang, s, len(t) if t else 0, k, 1.5, "x", None) for k, (i, t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "size int, statistic double, row string, tag string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
