"""CSV staging -> core Parquet: cleaning, dedup, idempotent upsert, quality report."""

import pytest
from pyspark.errors import AnalysisException

from cohortlens.plans.etl import build_core, clean_table, load_staging, quality_report


def _write(d, name, text):
    (d / f"{name}.csv").write_text(text)


def test_build_core_and_upsert(spark, tmp_path):
    stg = tmp_path / "stg"
    stg.mkdir()
    core = str(tmp_path / "core")
    _write(stg, "dim_grades", "grade_id,name\n1,III\n 2 , IV \n2,IV\n,V\n")
    _write(stg, "dim_competency_pillars", 'pillar_code,pillar_label\nsea ,Social\nLIE,"Lead, Inspire & Empower"\n')
    _write(stg, "employees",
           "employee_id,fullname,nip,company_id,area_id,position_id,department_id,division_id,directorate_id,"
           "grade_id,education_id,major_id,years_of_service_months\n"
           " e1 ,Ann ,n1,,,,,,,1,,,24.5\n"
           "e2,Bob,n2,,,,,,,9,,,\n"
           "  ,Nobody,n3,,,,,,,1,,,12\n")
    _write(stg, "performance_yearly", "employee_id,rating,year\ne1,5,2023\ne1,4,2023\ne2, 3 ,2022.0\ne2,4,\n")
    _write(stg, "competencies_yearly", "employee_id,score,pillar_code,year\ne1,4,sea,2023\ne1,2, SEA ,2023\n")
    tables = ["dim_grades", "dim_competency_pillars", "employees", "performance_yearly", "competencies_yearly"]
    out = build_core(spark, str(stg), core, tables)
    grades = sorted(tuple(r) for r in out["dim_grades"].collect())
    assert grades == [("1", "III"), ("2", "IV")]
    emp = {r.employee_id: r for r in out["employees"].collect()}
    assert set(emp) == {"e1", "e2"} and emp["e1"].years_of_service_months == 25 and emp["e1"].fullname == "Ann"
    perf = sorted((r.employee_id, r.year, r.rating) for r in out["performance_yearly"].collect())
    assert perf == [("e1", 2023, 4), ("e2", 2022, 3)]        # NULL year rejected, one row per key
    comp = [(r.pillar_code, r.score) for r in out["competencies_yearly"].collect()]
    assert comp == [("SEA", 2)]
    # same input again: unchanged; a new batch updates matching keys and keeps the rest
    before = sorted(out["performance_yearly"].collect())
    again = build_core(spark, str(stg), core, tables)
    assert sorted(again["performance_yearly"].collect()) == before
    _write(stg, "performance_yearly", "employee_id,rating,year\ne2,5,2022\ne3,1,2021\n")
    upd = build_core(spark, str(stg), core, ["performance_yearly"])
    perf = sorted((r.employee_id, r.year, r.rating) for r in upd["performance_yearly"].collect())
    assert perf == [("e1", 2023, 4), ("e2", 2022, 5), ("e3", 2021, 1)]
    fresh = {t: spark.read.parquet(f"{core}/{t}") for t in tables}
    rep = {(r.check, r.subject): r.n for r in quality_report(fresh).collect()}
    assert rep[("row_count", "employees")] == 2
    assert rep[("orphan_fk", "grade_id")] == 1               # e2 has grade 9
    assert rep[("null_fk", "company_id")] == 2
    assert rep[("orphan_employee", "performance_yearly")] == 1  # e3 is not an employee
    assert rep[("duplicate_key", "performance_yearly")] == 0
    assert rep[("orphan_fk", "pillar_code")] == 0 and rep[("long_code", "competencies_yearly")] == 0
    assert rep[("null_name", "dim_grades")] == 0 and rep[("name_of_two_ids", "dim_grades")] == 0


def test_reports_on_core_tables(spark, tmp_path):
    """Reports and scores run unchanged over real core tables built from CSV."""
    from cohortlens.plans import reports, score_v2 as v2
    from cohortlens.plans.inputs import CoreBundle

    stg = tmp_path / "stg"
    stg.mkdir()
    core = str(tmp_path / "core")
    _write(stg, "dim_grades", "grade_id,name\n1,III\n2,IV\n")
    _write(stg, "employees", "employee_id,fullname,nip,company_id,area_id,position_id,department_id,division_id,"
           "directorate_id,grade_id,education_id,major_id,years_of_service_months\n"
           + "".join(f"e{i},N{i},n{i},,,,,,,{1 + i % 2},,,{i * 7}\n" for i in range(40)))
    _write(stg, "performance_yearly", "employee_id,rating,year\n" + "".join(f"e{i},{1 + i % 5},2023\n" for i in range(40)))
    _write(stg, "competencies_yearly", "employee_id,score,pillar_code,year\n"
           + "".join(f"e{i},{1 + (i * 3) % 5},{c},2023\n" for i in range(40) for c in ("SEA", "CEX")))
    _write(stg, "strengths", "employee_id,rank,theme\n" + "".join(f"e{i},1,{'Context' if i % 3 else 'Learner'}\n"
                                                                  for i in range(40)))
    _write(stg, "papi_scores", "employee_id,scale_code,score\n" + "".join(f"e{i},Papi_P,{i % 9}\n" for i in range(40)))
    _write(stg, "profiles_psych", "employee_id,pauli,faxtor,disc,disc_word,mbti,iq,gtq,tiki\n"
           + "".join(f"e{i},{i / 3:.2f},{50 - i},{'si' if i % 2 else ''},{'' if i % 2 else 'Dominant-Steadiness'},"
                     f"{'ENTP' if i % 2 else 'isfj'},100,20,5\n" for i in range(40)))
    tables = ["dim_grades", "employees", "performance_yearly", "competencies_yearly", "strengths",
              "papi_scores", "profiles_psych"]
    b = CoreBundle(spark, build_core(spark, str(stg), core, tables))
    comp = {r.pillar_code: r for r in reports.report_competency(b).collect()}
    assert set(comp) == {"SEA", "CEX"} and comp["SEA"].n_high + comp["SEA"].n_non == 40
    ctx = {(r.factor, r.category) for r in reports.report_contextual(b).collect()}
    assert ("grade", "III") in ctx and ("grade", "IV") in ctx
    parts = v2.score_v2_parts(b.comp_latest, b.strengths, b.psych_fixed, b.papi_wide(["Papi_P", "Papi_W"]),
                              v2.weights_frame(spark, v2.COMP_WEIGHTS_V2))
    s = v2.success_score_v2(parts).collect()
    assert len(s) == 40 and min(r.success_v2 for r in s) == 0.0 and max(r.success_v2 for r in s) == 1.0
    disc = {r.employee_id: r.disc for r in b.psych_fixed.collect()}
    assert disc["e1"] == "SI" and disc["e0"] == "DS"


def test_load_through_a_uri_and_missing_files(spark, tmp_path):
    stg = tmp_path / "stg"
    stg.mkdir()
    _write(stg, "dim_grades", "grade_id,name\n1,III\n2, \n")
    _write(stg, "strengths", "employee_id,rank,theme\ne1,1, \ne1,1,Context\ne1,2,\ne2,1,Learner\n")
    uri = f"file://{stg}"
    out = build_core(spark, uri, str(tmp_path / "core"), ["dim_grades", "strengths"])
    assert [tuple(r) for r in out["dim_grades"].collect()] == [("1", "III")]  # a blank name is rejected
    assert sorted((r.employee_id, r["rank"], r.theme) for r in out["strengths"].collect()) == [
        ("e1", 1, "Context"), ("e2", 1, "Learner")]                           # a blank theme never wins
    with pytest.raises(AnalysisException):
        load_staging(spark, uri, ["dim_grades", "employees"])
    staged = load_staging(spark, uri, ["dim_grades", "employees"], may_be_missing=["employees"])
    assert staged["dim_grades"].count() == 2 and staged["employees"].count() == 0


def test_survivors_prefer_real_values(spark):
    raw = spark.createDataFrame([("e1", None, "2020"), ("e1", "3", "2020")], "employee_id string, rating string, year string")
    rows = clean_table("performance_yearly", raw).collect()
    assert [(r.employee_id, r.year, r.rating) for r in rows] == [("e1", 2020, 3)]
