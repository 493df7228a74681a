import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cohort, ranking
from cohortlens.operators.latest import latest_per_key, pivot_wide
from cohortlens.operators.merge import upsert_by_key
from cohortlens.operators.prefix import rank_rows
from cohortlens.operators.quality import check_unique
from cohortlens.operators.scale import scale_columns
from cohortlens.plans import score_v2 as v2
from cohortlens.plans.weights import MAIN_WEIGHTS


def test_latest_per_key_nulls_first(spark):
    df = spark.createDataFrame([("e1", 2020, None, 1), ("e1", 2020, 5, 2), ("e1", 2019, 5, 3)],
                               "employee_id string, year int, rating int, src_id long")
    r = latest_per_key(df, tie_break=("src_id",)).collect()
    assert len(r) == 1 and r[0].rating is None and r[0].year == 2020


def test_scaling_constant_column(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0), (3, None)], "id int, x double")
    out = scale_columns(df, [("z", "x", "z"), ("zclip", "x", "zc"), ("minmax", "x", "mm")]).orderBy("id").collect()
    assert [r.z for r in out] == [0.0, 0.0, 0.0]
    assert [r.zc for r in out] == [0.0, 0.0, None]
    assert [r.mm for r in out] == [0.0, 0.0, 0.0]


def _long(rows):
    return rows


def test_cohens_d_rules(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 0), ("a", 3.0, 0),
                                ("b", 2.0, 1), ("b", 2.0, 1), ("b", 2.0, 0), ("b", 2.0, 0)],
                               "metric string, value double, label int")
    r = {x.metric: x for x in cohort.cohort_compare(df).collect()}
    assert r["a"].cohens_d is None
    assert r["b"].cohens_d == 0.0


def test_mwu_identical_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 0), ("b", 1.0, 1), ("b", 2.0, 1)],
                               "metric string, value double, label int")
    r = {x.metric: x for x in cohort.mann_whitney_u(df, buckets=4).collect()}
    assert r["a"].p_mwu == 1.0
    assert r["b"].p_mwu is None


def test_mwu_matches_bruteforce(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 20, 300).astype(float)
    y = rng.integers(3, 25, 200).astype(float)
    rows = [("m", float(v), 1) for v in x] + [("m", float(v), 0) for v in y]
    df = spark.createDataFrame(rows, "metric string, value double, label int")
    r = cohort.mann_whitney_u(df, buckets=5).collect()[0]
    allv = np.concatenate([x, y])
    order = allv.argsort(kind="mergesort")
    ranks = np.empty(len(allv))
    sv = allv[order]
    i = 0
    while i < len(sv):
        j = i
        while j + 1 < len(sv) and sv[j + 1] == sv[i]:
            j += 1
        ranks[order[i:j + 1]] = (i + j) / 2.0 + 1
        i = j + 1
    u1 = ranks[: len(x)].sum() - len(x) * (len(x) + 1) / 2
    assert abs(r.u_stat - u1) < 1e-6


def test_chi2_yates_and_degenerate(spark):
    rows = [("A", 1)] * 10 + [("A", 0)] * 20 + [("B", 1)] * 20 + [("B", 0)] * 10
    df = spark.createDataFrame(rows, "cat string, label int")
    r = cohort.chi2_test(df, "cat").collect()[0]
    assert abs(r.chi2 - 5.4) < 1e-9 and abs(r.cramers_v - 0.3) < 1e-9 and r.dof == 1
    one = spark.createDataFrame([("A", 1), ("A", 0)], "cat string, label int")
    assert cohort.chi2_test(one, "cat").collect()[0].chi2 is None


def test_chi2_zero_cells_match_grid(spark):
    rows = [("A", 1)] * 5 + [("B", 0)] * 7 + [("C", 1)] * 3 + [("C", 0)] * 4
    df = spark.createDataFrame(rows, "cat string, label int")
    r = cohort.chi2_test(df, "cat").collect()[0]
    obs = np.array([[0, 5], [7, 0], [4, 3]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert abs(r.chi2 - ((obs - e) ** 2 / e).sum()) < 1e-9


def _scores(spark, ys, ss, ids=None):
    ids = ids or list(range(len(ys)))
    return spark.createDataFrame(list(zip(ids, ys, ss)), "id long, label int, score double")


def test_precision_capture_ties_and_cut(spark):
    df = _scores(spark, [1, 0, 0, 0, 0, 0, 0, 0, 0, 0], [5.0, 5.0] + [1.0] * 8, ids=[2, 1, 3, 4, 5, 6, 7, 8, 9, 10])
    r = ranking.top_fraction(df, "score", "label", "id", (0.1,), buckets=3).collect()[0]
    assert r.prec_10 == 0.0            # tie at the cut: id 1 (label 0) comes first
    none = _scores(spark, [0] * 10, [float(i) for i in range(10)])
    assert ranking.top_fraction(none, "score", "label", "id", (0.1,)).collect()[0].capt_10 is None


def test_average_precision_and_ties(spark):
    ap = ranking.average_precision(_scores(spark, [1, 0, 1], [3.0, 2.0, 1.0]), "score", "label").collect()[0].pr_auc
    assert abs(ap - (0.5 * 1 + 0.5 * 2 / 3)) < 1e-12
    tied = ranking.average_precision(_scores(spark, [1, 0, 0, 1], [1.0] * 4), "score", "label").collect()[0].pr_auc
    assert abs(tied - 0.5) < 1e-12


def test_auc_ks_extremes(spark):
    perfect = _scores(spark, [1, 1, 0, 0], [4.0, 3.0, 2.0, 1.0])
    r = ranking.evaluate_all(perfect, "score", "label", "id").collect()[0]
    assert r.roc_auc == 1.0 and r.ks == 1.0
    tied = _scores(spark, [1, 0, 1, 0], [1.0] * 4)
    r = ranking.evaluate_all(tied, "score", "label", "id").collect()[0]
    assert r.roc_auc == 0.5 and r.ks == 0.0


def test_auc_invariants(spark):
    rng = random.Random(3)
    ys = [rng.randint(0, 1) for _ in range(400)]
    ss = [round(rng.random() * 10, 1) for _ in range(400)]
    df = _scores(spark, ys, ss)
    a = ranking.roc_auc(df, "score", "label", buckets=7).collect()[0].roc_auc
    neg = df.withColumn("score", -F.col("score"))
    b = ranking.roc_auc(neg, "score", "label", buckets=7).collect()[0].roc_auc
    cube = df.withColumn("score", F.pow("score", 3) + 1)
    c = ranking.roc_auc(cube, "score", "label", buckets=7).collect()[0].roc_auc
    assert abs(a + b - 1) < 1e-12 and abs(a - c) < 1e-12
    full = ranking.top_fraction(df, "score", "label", "id", (1.0,)).collect()[0]
    assert full.capt_100 == 1.0
    trap = ranking.roc_auc_trapezoid(df, "score", "label").collect()[0].auc
    assert abs(trap - a) < 1e-12


def test_rank_rows_exact_with_hot_value(spark):
    rng = random.Random(11)
    n = 3000
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else rng.choice(["a", "b"])
        s = 7.0 if i % 2 == 0 else float(rng.randint(0, 50))   # one score holds half the rows
        rows.append((g, s, i))
    df = spark.createDataFrame(rows, "g string, s double, id long")
    got = {(r.g, r.id): r.rank for r in rank_rows(df, [F.col("s").desc(), F.col("id")], ["g"], buckets=6).collect()}
    expect = {}
    for g in {"hot", "a", "b"}:
        sub = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))
        for k, r in enumerate(sub):
            expect[(g, r[2])] = k + 1
    assert got == expect


def test_pivot_requires_unique(spark):
    df = spark.createDataFrame([("e", "SEA", 1), ("e", "SEA", 2)], "employee_id string, pillar_code string, score int")
    with pytest.raises(ValueError):
        check_unique(df, ["employee_id", "pillar_code"])
    ok = spark.createDataFrame([("e", "SEA", 1)], "employee_id string, pillar_code string, score int")
    assert pivot_wide(ok, "employee_id", "pillar_code", "score", ["SEA", "CEX"]).collect()[0].CEX is None


def test_comp_component_v2(spark):
    w = v2.weights_frame(spark, v2.COMP_WEIGHTS_V2)
    codes = list(v2.COMP_WEIGHTS_V2)
    rows = [("sea", "SEA", 5)] + [("ones", c, 1) for c in codes] + [("fives", c, 5) for c in codes] + [("odd", "XYZ", 5)]
    df = spark.createDataFrame(rows, "employee_id string, pillar_code string, score int")
    r = {x.employee_id: x.comp_score for x in v2.comp_component_v2(df, w).collect()}
    assert r == {"sea": 0.3, "ones": 0.0, "fives": 1.0, "odd": 0.0}


def test_disc_bonus(spark):
    df = spark.createDataFrame([("SI", 0.60), ("SI", 0.59), ("DC", 0.9), (None, 0.9)], "disc string, comp double")
    got = [r[0] for r in df.select(v2.disc_bonus_expr(F.col("disc"), F.col("comp"))).collect()]
    assert got == [0.02, 0.0, 0.0, 0.0]


def test_psy_component_v2_missing_is_neutral(spark):
    psych = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 3.0), ("c", 5.0, 1.0)],
                                  "employee_id string, pauli double, faxtor double")
    papi = spark.createDataFrame([("a", 3, 4), ("c", 5, None)], "employee_id string, Papi_P int, Papi_W int")
    r = {x.employee_id: x.psy_score for x in v2.psy_component_v2(psych, papi).collect()}
    assert r["b"] == 0.5 and r["c"] == 0.5 and r["a"] != 0.5


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    inc = spark.createDataFrame([(2, "B"), (4, "D")], "k int, v string")
    once = upsert_by_key(t, inc, ["k"])
    twice = upsert_by_key(once, inc, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_main_weights_are_the_points_inside_the_context_range():
    levels = ((0.45, 0.50, 0.55), (0.20, 0.25, 0.30), (0.10, 0.15, 0.20))
    want = [p for p in itertools.product(*levels) if 0.05 <= 1.0 - (p[0] + p[1] + p[2]) <= 0.20]
    assert list(MAIN_WEIGHTS) == want and len(want) == 17


def test_top_fraction_ranks_rows_only_for_a_mixed_tie_at_the_cut(spark, monkeypatch):
    """Distinct scores (or a single-label tie) at the cut need no row ranking; a mixed tie does."""
    calls = []
    orig = ranking.rank_rows

    def spy(*a, **kw):
        calls.append(1)
        return orig(*a, **kw)

    monkeypatch.setattr(ranking, "rank_rows", spy)
    distinct = spark.createDataFrame([(i, i % 2, float(i)) for i in range(40)], "id long, label int, score double")
    r = ranking.top_fraction(distinct, "score", "label", "id", (0.1,)).collect()[0]
    assert calls == [] and r.prec_10 == 0.5  # top 4 by score: ids 39, 38, 37, 36
    one_label_tie = spark.createDataFrame([(i, 1 if i >= 30 else 0, 1.0 if i >= 30 else float(i) / 100) for i in range(40)],
                                          "id long, label int, score double")
    assert ranking.top_fraction(one_label_tie, "score", "label", "id", (0.1,)).collect()[0].prec_10 == 1.0
    assert calls == []
    mixed_tie = spark.createDataFrame([(i, i % 2, 1.0 if i >= 30 else float(i) / 100) for i in range(40)],
                                      "id long, label int, score double")
    r = ranking.top_fraction(mixed_tie, "score", "label", "id", (0.1,)).collect()[0]
    assert calls == [1] and r.prec_10 == 0.5  # first 4 of the tie by id: 30, 31, 32, 33


def test_chi2_counts_zero_cells_without_losing_digits(spark):
    """A category that lacks a label, at small and at very large counts; no zero cell leaves no remainder."""
    def plain(table):
        n = sum(map(sum, table))
        r, c = [sum(x) for x in table], [sum(x) for x in zip(*table, strict=True)]
        return sum((table[i][j] - r[i] * c[j] / n) ** 2 / (r[i] * c[j] / n) for i in range(len(r)) for j in range(len(c)))
    tables = {"zero": [[30, 0, 5], [10, 20, 0], [7, 8, 9]], "full": [[3, 4], [5, 6], [7, 9]]}
    rows = [(g, f"c{i}", j) for g, t in tables.items() for i, x in enumerate(t) for j, k in enumerate(x) for _ in range(k)]
    got = {r.g: r for r in cohort.chi2_test(spark.createDataFrame(rows, "g string, cat string, label int"), "cat",
                                            groups=["g"]).collect()}
    for g, t in tables.items():
        assert abs(got[g].chi2 - plain(t)) < 1e-9 * plain(t)
    assert got["zero"].dof == 4 and got["full"].dof == 2


def test_erfc_to_thirteen_digits(spark):
    import math

    from cohortlens.functions.distributions import erfc
    xs = [-3.0, -0.5, 0.0, 1e-9, 0.3, 1.0, 1.9999, 2.0, 2.5, 4.0, 8.0, 20.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc("x").alias("y"))
    for r in df.collect():
        assert abs(r.y - math.erfc(r.x)) <= 1e-12 * math.erfc(r.x)


def test_rank_metrics_have_no_split_array_and_one_data_sized_checkpoint(spark, monkeypatch):
    sizes = []
    real = ranking.cut_lineage

    def spy(df):
        sizes.append(df.columns)
        return real(df)
    monkeypatch.setattr(ranking, "cut_lineage", spy)
    from cohortlens.operators import prefix
    monkeypatch.setattr(prefix, "cut_lineage", spy)
    df = spark.createDataFrame([(i, i % 3 == 0, i % 7, i % 50 / 10) for i in range(400)],
                               "id long, label boolean, g long, score double").withColumn("label", F.col("label").cast("int"))
    distinct = df.withColumn("score", F.col("score") + F.col("id") / 1e4)
    out = ranking.evaluate_all(distinct, "score", "label", "id", keys=["g"])
    assert len(sizes) == 2 and "_bucket" in sizes[0] and "_bucket" not in sizes[1]  # the curve, then one row per key
    plan = out._jdf.queryExecution().toString()
    assert "percentile" not in plan and "_splits" not in plan
    assert out.count() == 7
