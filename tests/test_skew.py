"""One key / value holding a third of all rows: results must stay exact (checked by brute force)."""

import random


from cohortlens.operators import cohort, ranking
from cohortlens.operators.clean import dedup_row_number
from cohortlens.operators.latest import latest_per_key


def _perf_rows(n=3000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        emp = "hot" if i % 3 == 0 else f"e{rng.randint(0, 200)}"
        year = None if rng.random() < 0.05 else rng.randint(2015, 2024)
        rating = None if rng.random() < 0.1 else rng.randint(1, 5)
        rows.append((emp, year, rating, i))
    return rows


def _desc_nulls_first(v):
    return (0, 0) if v is None else (1, -v)


def test_latest_per_key_hot_employee(spark):
    rows = _perf_rows()
    df = spark.createDataFrame(rows, "employee_id string, year int, rating int, src_id long")
    got = {r.employee_id: (r.year, r.rating) for r in latest_per_key(df, tie_break=("src_id",)).collect()}
    best = {}
    for e, y, r, s in rows:
        k = (_desc_nulls_first(y), _desc_nulls_first(r), s)
        if e not in best or k < best[e][0]:
            best[e] = (k, (y, r))
    assert got == {e: v for e, (_, v) in best.items()}


def test_dedup_hot_key(spark):
    rows = _perf_rows(seed=9)
    df = spark.createDataFrame(rows, "employee_id string, year int, rating int, src_id long")
    got = {r.employee_id: (r.year, r.rating, r.src_id) for r in dedup_row_number(df, ["employee_id"]).collect()}

    def asc_nulls_last(v):
        return (1, 0) if v is None else (0, v)
    best = {}
    for e, y, r, s in rows:
        k = (asc_nulls_last(y), asc_nulls_last(r), s)
        if e not in best or k < best[e][0]:
            best[e] = (k, (y, r, s))
    assert got == {e: v for e, (_, v) in best.items()}


def test_rank_statistics_hot_value(spark):
    rng = random.Random(13)
    rows = []
    for i in range(3000):
        v = 42.0 if i % 3 == 0 else float(rng.randint(0, 100))
        rows.append(("m", v, 1 if rng.random() < (0.6 if v > 50 else 0.3) else 0, i))
    df = spark.createDataFrame(rows, "metric string, value double, label int, id long")
    u = cohort.mann_whitney_u(df.select("metric", "value", "label"), buckets=8).collect()[0].u_stat
    pos = [v for _, v, y, _ in rows if y == 1]
    neg = [v for _, v, y, _ in rows if y == 0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    assert abs(u - brute) < 1e-6
    auc = ranking.roc_auc(df, "value", "label", buckets=8).collect()[0].roc_auc
    assert abs(auc - brute / (len(pos) * len(neg))) < 1e-12
    # precision@10 with the hot value straddling no cut, and @50 with the cut inside the hot tie group
    top = ranking.top_fraction(df, "value", "label", "id", (0.1, 0.5), buckets=8).collect()[0]
    order = sorted(rows, key=lambda r: (-r[1], r[3]))
    for k, name in ((0.1, "prec_10"), (0.5, "prec_50")):
        m = max(1, -(-int(k * 1000000) * len(rows) // 1000000))
        assert abs(getattr(top, name) - sum(r[2] for r in order[:m]) / m) < 1e-12


def test_top_fraction_hot_tie_per_key_both_cuts_inside(spark):
    """Per key, a third of all rows share one score and both cuts (10 %, 50 %) fall inside that mixed tie
    group; string ids with duplicates. The tie rows are ranked over several range partitions."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rng.choice(["x", "y"])
        s = 7.0 if g == "hot" else float(rng.randint(0, 40))
        rows.append((g, f"id{rng.randint(0, 800)}", 1 if rng.random() < 0.4 else 0, s))
    df = spark.createDataFrame(rows, "g string, id string, label int, score double")
    got = {r.g: r for r in ranking.top_fraction(df, "score", "label", "id", (0.1, 0.5), ["g"], buckets=6,
                                                with_counts=True).collect()}
    for g in ("hot", "x", "y"):
        rs = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[3], r[1], -r[2]))
        P = sum(r[2] for r in rs)
        assert got[g].n == len(rs) and got[g].n_pos == P
        for k, name in ((0.1, "10"), (0.5, "50")):
            m = max(1, -(-int(k * 1000000) * len(rs) // 1000000))
            hits = sum(r[2] for r in rs[:m])
            assert abs(getattr(got[g], f"prec_{name}") - hits / m) < 1e-12
            assert abs(getattr(got[g], f"capt_{name}") - hits / P) < 1e-12
