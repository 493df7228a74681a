"""Exact U, the census of keys, kept latest rows, bucketed tables, fallbacks of the bundle, order of the reports."""

import itertools
import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortlens.functions.distributions import mwu_exact_p
from cohortlens.operators import cohort, quality
from cohortlens.operators.latest import desc_nulls_first, first_per_key, update_latest
from cohortlens.plans import catalog_load, etl
from cohortlens.plans.inputs import CoreBundle
from cohortlens.sources.schemas import CORE
from cohortlens.sources.versions import VersionedTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- exact U

def enumerated_p(high, low):
    ranks = {v: i + 1 for i, v in enumerate(sorted(high + low))}
    n1, n0 = len(high), len(low)
    u = sum(ranks[v] for v in high) - n1 * (n1 + 1) / 2
    u = min(u, n1 * n0 - u)
    every = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, n1 + n0 + 1), n1)]
    return min(1.0, 2 * sum(x <= u for x in every) / len(every))


def test_exact_p_lists_every_arrangement(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k, (n1, n0) in enumerate([(1, 1), (1, 5), (2, 2), (3, 4), (4, 3), (5, 5), (8, 9), (7, 2), (6, 11), (8, 8)]):
        values = rng.sample(range(1000), n1 + n0)
        rows += [(f"m{k:02d}", float(v), int(i < n1)) for i, v in enumerate(values)]
        want[f"m{k:02d}"] = enumerated_p(values[:n1], values[n1:])
    got = {r.metric: r.p_mwu for r in cohort.mann_whitney_u(
        spark.createDataFrame(rows, "metric string, value double, label int")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[m] - want[m]) < 1e-12 for m in want)


def test_exact_p_at_its_limits(spark):
    """Nothing overlaps: 2 / C(n, m). Ties and larger groups take the asymptotic form."""
    p = spark.range(1).select(mwu_exact_p(F.lit(0.0), F.lit(8.0), F.lit(250.0)).alias("p")).first().p
    arrangements = 1.0
    for i in range(8):
        arrangements *= (250 + 8 - i) / (8 - i)
    assert abs(p * arrangements / 2 - 1) < 1e-9
    rows = [("tied", float(v), y) for v, y in ((1, 1), (2, 1), (2, 0), (3, 0))]
    rows += [("large", float(v), v % 2) for v in range(18)]
    got = {r.metric: r.p_mwu for r in cohort.mann_whitney_u(
        spark.createDataFrame(rows, "metric string, value double, label int")).collect()}
    assert abs(got["large"] - 0.7239) < 5e-3      # the exact value is 0.7304
    assert abs(got["tied"] - 0.4142) < 5e-3       # z = 1 / sqrt(4 / 12 * (5 - 6 / 12))


# ---------------------------------------------------------------- census of keys

def test_every_table_is_scanned_once(spark, sf_small):
    census = quality.key_census(catalog_load._frames(spark, sf_small), catalog_load.RULES)
    plan = census._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?/(\w+)\.parquet", plan)
    assert sorted(scans) == sorted(catalog_load.RULES)
    assert "Join" not in plan
    orphans = plan_of(quality.orphan_keys(catalog_load._census(spark, sf_small)))
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)[^\n]*LeftAnti", orphans)) == 1
    assert "FileScan" not in orphans


def test_constraint_queries_find_something(spark, sf_small):
    orphans = E.queries()["quality_foreign_keys"](spark, sf_small).collect()
    assert {(r.table_name, r.column_name) for r in orphans} >= {("lineitem", "l_partkey"), ("orders", "o_custkey")}
    counts = {(r.table_name, r.kind, r.subject): r for r in E.queries()["quality_constraints"](spark, sf_small).collect()}
    assert counts["orders", "key", "o_orderkey"].n_null > 0 and counts["orders", "key", "o_orderkey"].n_repeated == 1
    assert counts["customer", "unique", "c_mktsegment"].n_repeated > 0 and counts["nation", "length", "n_name"].n_long > 0


def test_census_counts_typed_groups(spark):
    """Text is made of the groups only, and a column under two rules is one grouping set; every count is the brute force one."""
    rows = [(i % 7 if i % 5 else None, i % 3, "long" if i % 4 else None) for i in range(60)]
    rules = {"t": quality.TableRules(("a", "b"), {"a": "u"}, ("c",), {"c": 3}), "u": quality.TableRules(("a",))}
    t = spark.createDataFrame(rows, "a int, b int, c string")
    census = quality.key_census({"t": t, "u": t.select("a")}, rules)
    want = Counter()
    for a, b, c in rows:
        both = {k: v for k, v in (("a", a), ("b", b)) if v is not None}
        want["t", "key", "a,b", None, json.dumps(both, separators=(",", ":")), a is None, 0] += 1
        want["t", "ref", "a", "u", a if a is None else str(a), a is None, 0] += 1
        want["t", "unique", "c", None, c, c is None, 0] += 1
        want["t", "length", "c", None, c, c is None, int(c is not None)] += 1
        want["u", "key", "a", None, a if a is None else str(a), a is None, 0] += 1
    got = Counter({(r.table_name, r.kind, r.subject, r.ref, r.id, r.null_part, int(r.n_long > 0)): r.n for r in census.collect()})
    assert got == want and all(r.n_long in (0, r.n) for r in census.collect())
    counts = plan_of(quality.census_counts(census))
    assert "to_json" not in counts.lower()


def test_constraints_keep_no_copy_of_the_census(spark, sf_small):
    assert "Scan ExistingRDD" not in plan_of(E.queries()["quality_constraints"](spark, sf_small))


def test_orphans_need_no_keys_that_nothing_refers_to(spark, sf_small):
    kept = {(r.table_name, r.kind, r.subject) for r in catalog_load._census(spark, sf_small).select("table_name", "kind", "subject").distinct().collect()}
    refs = {(t, "ref", c) for t, r in catalog_load.RULES.items() for c in r.refers}
    assert kept == refs | {(t, "key", catalog_load.RULES[t].keys[0]) for t in ("orders", "part", "supplier", "customer", "nation")}


def test_report_from_a_census(spark):
    """Each rule broken once, by tables that hold a NULL key, a key twice, lost references and a long code."""
    def table(name, rows):
        return spark.createDataFrame(rows, CORE[name])
    none = [None] * 10
    core = {
        "dim_grades": table("dim_grades", [("1", "III"), ("2", "III"), ("3", None)]),
        "dim_competency_pillars": table("dim_competency_pillars", [("SEA", "Social"), ("LONGER", "x")]),
        "employees": table("employees", [("e1", "A", *none[:7], "1", *none[:3]), ("e1", "B", *none[:7], "9", *none[:3]),
                                         (None, "C", *none[:7], None, *none[:3])]),
        "papi_scores": table("papi_scores", [("e1", "Papi_N", 1), ("e2", "Papi_N", 1), ("e2", None, 1), (None, "Papi_N", 2)]),
        "competencies_yearly": table("competencies_yearly", [("e1", "SEA", 2020, 3), ("e1", "XX", 2020, 3), ("e1", "SEA", 2020, 4)]),
    }
    got = {(r.check, r.subject): r.n for r in etl.quality_report(core).collect()}
    want = {("row_count", "dim_grades"): 3, ("null_name", "dim_grades"): 1, ("name_of_two_ids", "dim_grades"): 1,
            ("long_code", "dim_competency_pillars"): 1, ("long_code", "competencies_yearly"): 0,
            ("row_count", "employees"): 3, ("duplicate_key", "employees"): 2, ("duplicate_key", "dim_grades"): 0,
            ("null_fk", "grade_id"): 1, ("null_fk", "area_id"): 3, ("orphan_fk", "grade_id"): 1, ("orphan_fk", "pillar_code"): 1,
            ("orphan_employee", "papi_scores"): 2, ("orphan_employee", "competencies_yearly"): 0,
            ("duplicate_key", "papi_scores"): 2, ("duplicate_key", "competencies_yearly"): 1}
    assert {k: got.get(k) for k in want} == want
    assert ("orphan_fk", "area_id") not in got  # there is no table of areas to refer to


# ---------------------------------------------------------------- kept latest rows

def test_kept_latest_equals_the_recomputation(spark, tmp_path):
    rng = random.Random(8)
    rows = [(f"e{rng.randint(0, 60)}", rng.choice([None, 2019, 2020, 2021]), rng.choice([None, 1, 3, 5]), i) for i in range(600)]
    df = spark.createDataFrame(rows, catalog_load.LATEST)
    order = [*desc_nulls_first("year", "rating"), F.col("src_id").asc()]
    kept = VersionedTable(spark, str(tmp_path / "kept"), catalog_load.LATEST)
    for lo in range(0, 600, 200):
        update_latest(kept, df.where(f"src_id >= {lo} and src_id < {lo + 200}"), ["employee_id"], order)
    assert sorted(map(tuple, kept.read().collect())) == sorted(map(tuple, first_per_key(df, ["employee_id"], order).collect()))
    before = set(kept.files())
    update_latest(kept, spark.createDataFrame([("new", 2030, 5, 900)], catalog_load.LATEST), ["employee_id"], order)
    assert before <= set(kept.files())


# ---------------------------------------------------------------- bucketed tables

def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    rows = {"employees": [(f"e{i}", f"N{i}", *[None] * 7, "1", None, None, i) for i in range(300)],
            "performance_yearly": [(f"e{i}", 2020 + y, (i + y) % 5 + 1) for i in range(300) for y in range(3)],
            "competencies_yearly": [(f"e{i}", c, 2020 + y, (i * 3 + y) % 5 + 1) for i in range(300) for c in ("SEA", "CEX") for y in range(2)],
            "strengths": [(f"e{i}", 1, "Context" if i % 3 else "Learner") for i in range(300)]}
    plain = {t: spark.createDataFrame(r, CORE[t]) for t, r in rows.items()}
    try:
        b = CoreBundle(spark, etl.bucket_core(plain, str(tmp_path / "bucketed"), 4, "cl_test_"))
        auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for df in (b.perf_latest, b.comp_latest, b.labels.join(b.comp_latest, "employee_id"),
                       b.labels.join(b.comp_wide(("SEA", "CEX")), "employee_id")
                       .join(b.strengths.groupBy("employee_id").count(), "employee_id")):
                assert "Exchange" not in plan_of(df), plan_of(df)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        same = CoreBundle(spark, plain)
        for name in ("perf_latest", "comp_latest"):
            assert sorted(getattr(b, name).collect()) == sorted(getattr(same, name).collect())
    finally:
        for t in rows:
            spark.sql(f"DROP TABLE IF EXISTS cl_test_{t}")


# ---------------------------------------------------------------- fallbacks

def test_bundle_without_optional_tables(spark):
    e = spark.createDataFrame([("e1", "A", 3)], "employee_id string, fullname string, years_of_service_months int")
    b = CoreBundle(spark, {"employees": e})
    assert b.strengths.columns == ["employee_id", "theme", "rank"] and b.strengths.count() == 0
    assert b.papi_wide(["Papi_P"]).count() == 0 and b.psych_fixed.count() == 0
    row = b.employees_org.first()
    assert row.fullname == "A" and row.grade is None and row.education is None
    with pytest.raises(KeyError):
        b.perf_latest


# ---------------------------------------------------------------- order

def test_unsorted_neighbours(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.randint(0, 50), i) for i in range(500)], "a int, b int").repartition(6)
    in_order = df.orderBy("a", "b")
    assert quality.unsorted_neighbours(in_order, [F.col("a"), F.col("b")]).count() == 0
    assert quality.unsorted_neighbours(in_order, [-F.col("a")]).count() > 0
    assert quality.unsorted_neighbours(df.sortWithinPartitions("a", "b"), [F.col("a")]).count() > 0  # only across partitions
    assert quality.unsorted_neighbours(df.limit(0), [F.col("a")]).count() == 0


def falling(*names):
    return lambda r: [(r[n] is None, -(r[n] or 0)) for n in names]


ORDERS = {
    "report_competency": falling("cohens_d", "delta"), "report_papi": falling("cohens_d"),
    "report_cognitive": falling("cohens_d"), "report_strengths": falling("delta_pct"), "report_disc": falling("pct_high"),
    "report_mbti_dimensions": lambda r: [r.dimension, r.dimension.index(r.letter)],
    "report_mbti_types": falling("pct_high", "n"),
    "report_contextual": lambda r: [r.factor, falling("pct_high")(r)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_their_order(spark, sf_small, name):
    # the types with enough people to report begin at the next size
    sf = "/root/testdata/sf0.01" if name == "report_mbti_types" else sf_small
    rows = E.queries()[name](spark, sf).collect()
    keys = [ORDERS[name](r) for r in rows]
    assert keys == sorted(keys) and len({repr(k) for k in keys}) > 1


def test_top_rows_come_in_order(spark, sf_small):
    df = E.queries()["top_n"](spark, sf_small)
    column = next(c for c, t in df.dtypes if t == "double")
    values = [r[column] for r in df.collect()]
    assert values in (sorted(values), sorted(values, reverse=True)) and len(values) > 1
