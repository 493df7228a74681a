"""Named projections over the core tables (the reference's named SELECT lists), as DataFrame
functions; column pruning reaches the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame

PERF_ALL = ("employee_id", "year", "rating")
COMP_ALL = ("employee_id", "pillar_code", "year", "score")
PILLAR_LABELS = ("pillar_code", "pillar_label")
EMP_ORG_MIN = ("employee_id", "fullname", "years_of_service_months", "grade_id", "education_id", "major_id")
PAPI = ("employee_id", "scale_code", "score")
PSYCH = ("employee_id", "pauli", "faxtor", "disc", "mbti", "iq", "gtq", "tiki")
PSYCH_FULL = ("employee_id", "pauli", "faxtor", "disc", "disc_word", "mbti", "iq", "gtq", "tiki")


def project(df: DataFrame, cols, keep_if_present: bool = True) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns] if keep_if_present else cols)


def perf_all(df: DataFrame) -> DataFrame:
    return project(df, PERF_ALL)


def comp_all(df: DataFrame) -> DataFrame:
    return project(df, COMP_ALL)


def pillar_labels(df: DataFrame) -> DataFrame:
    return project(df, PILLAR_LABELS)


def employees_org_min(df: DataFrame) -> DataFrame:
    return project(df, EMP_ORG_MIN)


def papi_scores(df: DataFrame) -> DataFrame:
    return project(df, PAPI)


def psych(df: DataFrame, with_word: bool = False) -> DataFrame:
    """Both projections: without ``disc_word`` (the named query) and with it (the full fetcher)."""
    return project(df, PSYCH_FULL if with_word else PSYCH)
