"""Versioned tables: broken writes, merges by touched files, conflicts, and what a load leaves behind."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import etl
from cohortlens.sources import versions as V
from cohortlens.sources.readers import read_or_empty, scan_csv_text
from cohortlens.sources.schemas import CORE, STAGING

SCHEMA = CORE["performance_yearly"]


def frame(spark, rows, parts=1):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def broken(spark, rows):
    """A frame whose last rows fail while they are written."""
    bad = F.when(F.col("rating") < 0, F.raise_error(F.lit("broken write"))).otherwise(F.col("rating"))
    return spark.createDataFrame(rows, SCHEMA).withColumn("rating", bad.cast("int"))


@pytest.mark.parametrize("by", [(), ("year",)])
def test_a_broken_write_leaves_the_old_rows(spark, tmp_path, by):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA, by)
    old = [("e1", 2020, 3), ("e2", 2021, 4), ("e3", 2021, None)]
    t.overwrite(frame(spark, old))
    for write in (t.overwrite, lambda df: t.upsert(df, ["employee_id", "year"])):
        with pytest.raises(Exception, match="broken write"):
            write(broken(spark, [("e1", 2020, 5), ("e9", 2022, -1)]))
        assert rows_of(t.read()) == rows_of(frame(spark, old)) and t.versions() == [1]
        assert rows_of(spark.read.parquet(t.path).select(*SCHEMA.fieldNames())) == rows_of(frame(spark, old))


def test_a_write_that_breaks_before_the_switch(spark, tmp_path, monkeypatch):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA)
    t.overwrite(frame(spark, [("e1", 2020, 3)]))

    def stop(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(t, "_commit", stop)
    with pytest.raises(KeyboardInterrupt):
        t.upsert(frame(spark, [("e1", 2020, 5)]), ["employee_id", "year"])
    monkeypatch.undo()
    assert rows_of(t.read()) == [("e1", 2020, 3)]
    assert t.vacuum() >= 1 and rows_of(t.read()) == [("e1", 2020, 3)]
    assert len([x for x in os.listdir(t.path) if x.startswith("batch=")]) == 1


@pytest.mark.parametrize("by", [(), ("year",)])
def test_a_merge_leaves_other_files_untouched(spark, tmp_path, by):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA, by)
    t.overwrite(frame(spark, [(f"e{i}", 2020 + i % 3, i % 5) for i in range(200)], parts=8))
    before = set(t.files())
    stamps = {f: os.stat(f"{t.path}/{f}").st_mtime_ns for f in before}
    assert len(before) >= 8
    t.upsert(frame(spark, [("e7", 2021, 99)]), ["employee_id", "year"])
    after = set(t.files())
    assert len(before - after) == 1 and all(os.stat(f"{t.path}/{f}").st_mtime_ns == stamps[f] for f in before)
    got = {(r.employee_id, r.year): r.rating for r in t.read().collect()}
    assert len(got) == 200 == t.read().count() and got["e7", 2021] == 99
    t.upsert(frame(spark, [("new", 2020, 1), ("new2", 2031, None)]), ["employee_id", "year"])
    assert after < set(t.files()) and t.read().count() == 202  # keys that the table lacks touch no file
    assert t.versions() == [1, 2, 3] and t.read(1).where("rating = 99").count() == 0
    t.vacuum(keep=2)
    assert t.versions() == [2, 3] and t.read(2).count() == 200 and not any(
        os.path.exists(f"{t.path}/{f}") for f in before - after)


def test_merge_keeps_one_row_per_key_and_is_idempotent(spark, tmp_path):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA)
    batch = frame(spark, [("a", 2020, 2), ("a", 2020, 1), ("b", 2020, None)])
    t.upsert(batch, ["employee_id", "year"])
    once = rows_of(t.read())
    assert once == [("a", 2020, 1), ("b", 2020, None)]
    t.upsert(batch, ["employee_id", "year"])
    assert rows_of(t.read()) == once
    t.upsert(frame(spark, []), ["employee_id", "year"])
    assert rows_of(t.read()) == once
    t.overwrite(t.read().where("employee_id = 'b'"))  # a rewrite may read the table itself
    assert rows_of(t.read()) == [("b", 2020, None)]
    t.overwrite(frame(spark, []))
    assert t.read().count() == 0 and t.read().schema == SCHEMA


def test_of_two_writers_one_finds_the_version_taken(spark, tmp_path):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA)
    t.overwrite(frame(spark, [("a", 2020, 1)]))
    files = t.files()
    t._commit(files, 1)
    with pytest.raises(V.VersionConflict):
        t._commit(files, 1)
    assert t.versions() == [1, 2] and rows_of(t.read()) == [("a", 2020, 1)]
    with pytest.raises(ValueError):
        t.read(9)


def test_partition_filter_reaches_the_files(spark, tmp_path):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA, ["year"])
    t.overwrite(frame(spark, [(f"e{i}", 2020 + i % 3, i % 5) for i in range(30)]))
    t.upsert(frame(spark, [("e1", 2021, 9)]), ["employee_id", "year"])
    df = t.read().where("year = 2021")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and df.count() == 10


def test_load_breaks_midway_and_is_repeated(spark, tmp_path):
    """A table that fails to clean leaves the earlier tables new, itself and the later ones as they were."""
    stg, core = tmp_path / "stg", str(tmp_path / "core")
    stg.mkdir()
    (stg / "dim_grades.csv").write_text("grade_id,name\n1,III\n")
    (stg / "performance_yearly.csv").write_text("employee_id,rating,year\ne1,5,2023\n")
    tables = ["dim_grades", "performance_yearly"]
    etl.build_core(spark, str(stg), core, tables)
    (stg / "dim_grades.csv").write_text("grade_id,name\n1,IX\n")
    (stg / "performance_yearly.csv").write_text("employee_id,rating,year\ne1,4,2023\ne2,many,2023\n")
    with pytest.raises(Exception):
        etl.build_core(spark, str(stg), core, tables)
    now = {t: rows_of(V.read_current(spark, f"{core}/{t}", CORE[t])) for t in tables}
    assert now == {"dim_grades": [("1", "IX")], "performance_yearly": [("e1", 2023, 5)]}
    (stg / "performance_yearly.csv").write_text("employee_id,rating,year\ne1,4,2023\ne2,1,2023\n")
    out = etl.build_core(spark, str(stg), core, tables)
    assert rows_of(out["performance_yearly"]) == [("e1", 2023, 4), ("e2", 2023, 1)]
    (stg / "performance_yearly.csv").write_text("employee_id,rating,year\ne7,2,2020\n")
    out = etl.rebuild_core(spark, str(stg), core, tables)
    assert rows_of(out["performance_yearly"]) == [("e7", 2020, 2)]


def test_tables_of_plain_files_are_adopted(spark, tmp_path):
    t = V.VersionedTable(spark, str(tmp_path / "perf"), SCHEMA, ["year"])
    frame(spark, [("a", 2020, 1), ("b", 2021, 2)]).write.partitionBy("year").parquet(t.path)
    etl.adopt_plain_files(t)
    t.upsert(frame(spark, [("a", 2020, 7)]), ["employee_id", "year"])
    t.vacuum()
    assert rows_of(t.read()) == [("a", 2020, 7), ("b", 2021, 2)]
    assert rows_of(V.read_current(spark, str(tmp_path / "none"), SCHEMA)) == []


def test_quoted_line_breaks(spark, tmp_path):
    stg = tmp_path / "stg"
    stg.mkdir()
    (stg / "dim_competency_pillars.csv").write_text(
        'pillar_code,pillar_label\nLIE,"Lead,\nInspire ""&""\r\nEmpower"\nSEA,Social\n')
    got = scan_csv_text(spark, str(stg / "dim_competency_pillars.csv"), STAGING["dim_competency_pillars"]).collect()
    assert [tuple(r) for r in got][1] == ("SEA", "Social") and got[0].pillar_label.startswith('Lead,\nInspire "&"')
    out = etl.build_core(spark, str(stg), str(tmp_path / "core"), ["dim_competency_pillars"])
    assert out["dim_competency_pillars"].count() == 2


def test_read_or_empty_keeps_the_declared_columns(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x")], "employee_id string, rank int, other string").write.parquet(f"{tmp_path}/t")
    df = read_or_empty(spark, f"{tmp_path}/t", STAGING["strengths"].__class__(
        [f for f in CORE["strengths"].fields]))
    assert df.columns == ["employee_id", "rank", "theme"] and rows_of(df) == [("a", 1, None)]
