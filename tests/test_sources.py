from cohortlens.sources.readers import read_or_empty, scan_csv_text
from cohortlens.sources.schemas import STAGING


def test_scan_csv_text(spark, tmp_path):
    p = tmp_path / "dim_competency_pillars.csv"
    p.write_text('pillar_code,pillar_label\nLIE,"Lead, Inspire & Empower"\n sea ,""\n')
    rows = scan_csv_text(spark, str(p), STAGING["dim_competency_pillars"]).collect()
    assert rows[0].pillar_label == "Lead, Inspire & Empower"
    assert rows[1].pillar_code == " sea " and rows[1].pillar_label is None


def test_read_or_empty(spark, tmp_path):
    df = read_or_empty(spark, str(tmp_path / "missing.parquet"), STAGING["strengths"])
    assert df.count() == 0 and df.columns == ["employee_id", "rank", "theme"]
