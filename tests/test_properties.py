"""Property checks against brute force (plain Python), on random data with many ties."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortlens.operators import cohort, ranking

rows_st = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=60)


def brute(rows, ks=(0.1, 0.3)):
    ys = [y for y, _ in rows]
    ss = [float(s) for _, s in rows]
    P = sum(ys)
    N = len(ys) - P
    out = {}
    if P and N:
        pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0
                    for a, ya in zip(ss, ys) if ya for b, yb in zip(ss, ys) if not yb)
        out["roc_auc"] = pairs / (P * N)
        xs = sorted(set(ss))
        out["ks"] = max(abs(sum(1 for s, y in zip(ss, ys) if y and s <= x) / P
                            - sum(1 for s, y in zip(ss, ys) if not y and s <= x) / N) for x in xs)
    if P:
        ap, prev = 0.0, 0
        for t in sorted(set(ss), reverse=True):
            tp = sum(1 for s, y in zip(ss, ys) if y and s >= t)
            pp = sum(1 for s in ss if s >= t)
            ap += (tp - prev) / P * tp / pp
            prev = tp
        out["pr_auc"] = ap
    order = sorted(range(len(ss)), key=lambda i: (-ss[i], i))
    for k in ks:
        m = max(1, math.ceil(k * len(ss)))
        hits = sum(ys[i] for i in order[:m])
        out[f"prec_{int(round(k * 100))}"] = hits / m
        out[f"capt_{int(round(k * 100))}"] = hits / P if P else None
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_ranking_metrics_match_bruteforce(spark, rows):
    df = spark.createDataFrame([(i, y, float(s)) for i, (y, s) in enumerate(rows)], "id long, label int, score double")
    got = ranking.evaluate_all(df, "score", "label", "id", ks=(0.1, 0.3), buckets=3).collect()[0].asDict()
    exp = brute(rows)
    for key, val in got.items():
        if key in exp:
            if exp[key] is None:
                assert val is None, key
            else:
                assert abs(val - exp[key]) < 1e-9, (key, val, exp[key])
        else:
            assert val is None, key   # one class only -> NULL


def test_chi2_symmetric(spark):
    rows = [("A", "x")] * 7 + [("A", "y")] * 3 + [("B", "x")] * 2 + [("B", "y")] * 9 + [("C", "y")] * 4
    df = spark.createDataFrame(rows, "a string, b string")
    ab = cohort.chi2_test(df, "a", "b").collect()[0]
    ba = cohort.chi2_test(df, "b", "a").collect()[0]
    assert abs(ab.chi2 - ba.chi2) < 1e-9 and ab.dof == ba.dof and abs(ab.cramers_v - ba.cramers_v) < 1e-12


keyed_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 12), st.integers(0, 1),
                              st.integers(0, 3)), min_size=1, max_size=80)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=keyed_st)
def test_top_fraction_keyed_string_ids_match_bruteforce(spark, rows):
    """Per key, string ids (string order), duplicate ids with both labels, NULL keys left out:
    top m rows by (score desc, id asc, label desc)."""
    data = [(g, str(i), y, float(s)) for g, i, y, s in rows]
    df = spark.createDataFrame(data, "g string, id string, label int, score double")
    ks = (0.1, 0.5)
    got = {r.g: r.asDict() for r in ranking.top_fraction(df, "score", "label", "id", ks, ["g"], buckets=2,
                                                         with_counts=True).collect()}
    groups = sorted({g for g, *_ in data if g is not None})
    assert sorted(got) == groups
    for g in groups:
        rs = sorted([r for r in data if r[0] == g], key=lambda r: (-r[3], r[1], -r[2]))
        P = sum(r[2] for r in rs)
        assert got[g]["n"] == len(rs) and got[g]["n_pos"] == P
        for k in ks:
            m = min(len(rs), max(1, math.ceil(k * len(rs))))
            hits = sum(r[2] for r in rs[:m])
            name = int(round(k * 100))
            assert abs(got[g][f"prec_{name}"] - hits / m) < 1e-12
            assert got[g][f"capt_{name}"] == (None if P == 0 else hits / P) or \
                abs(got[g][f"capt_{name}"] - hits / P) < 1e-12
