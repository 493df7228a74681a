"""Declared staging (all text) and core (typed) schemas, and conforming a frame to a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType

NUM = DecimalType(38, 10)


def _text(*cols: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


DIMENSIONS = ("companies", "areas", "positions", "departments", "divisions", "directorates",
              "grades", "education", "majors")


def _dim_key(name: str) -> str:
    return {"companies": "company_id", "education": "education_id"}.get(name, name.rstrip("s") + "_id")


STAGING = {f"dim_{d}": _text(_dim_key(d), "name") for d in DIMENSIONS}
STAGING.update({
    "dim_competency_pillars": _text("pillar_code", "pillar_label"),
    "employees": _text("employee_id", "fullname", "nip", "company_id", "area_id", "position_id", "department_id",
                       "division_id", "directorate_id", "grade_id", "education_id", "major_id",
                       "years_of_service_months"),
    "profiles_psych": _text("employee_id", "pauli", "faxtor", "disc", "disc_word", "mbti", "iq", "gtq", "tiki"),
    "papi_scores": _text("employee_id", "scale_code", "score"),
    "strengths": _text("employee_id", "rank", "theme"),
    "performance_yearly": _text("employee_id", "rating", "year"),
    "competencies_yearly": _text("employee_id", "score", "pillar_code", "year"),
})


def _typed(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I = StringType(), IntegerType()
CORE = {f"dim_{d}": _typed((_dim_key(d), S), ("name", S)) for d in DIMENSIONS}
CORE.update({
    "dim_competency_pillars": _typed(("pillar_code", S), ("pillar_label", S)),
    "employees": _typed(("employee_id", S), ("fullname", S), ("nip", S), ("company_id", S), ("area_id", S),
                        ("position_id", S), ("department_id", S), ("division_id", S), ("directorate_id", S),
                        ("grade_id", S), ("education_id", S), ("major_id", S), ("years_of_service_months", I)),
    "profiles_psych": _typed(("employee_id", S), ("pauli", NUM), ("faxtor", NUM), ("disc", S), ("disc_word", S),
                             ("mbti", S), ("iq", NUM), ("gtq", I), ("tiki", I)),
    "papi_scores": _typed(("employee_id", S), ("scale_code", S), ("score", I)),
    "strengths": _typed(("employee_id", S), ("rank", I), ("theme", S)),
    "performance_yearly": _typed(("employee_id", S), ("year", I), ("rating", I)),
    "competencies_yearly": _typed(("employee_id", S), ("pillar_code", S), ("year", I), ("score", I)),
})
PRIMARY_KEYS = {
    **{f"dim_{d}": (_dim_key(d),) for d in DIMENSIONS},
    "dim_competency_pillars": ("pillar_code",),
    "employees": ("employee_id",),
    "profiles_psych": ("employee_id",),
    "papi_scores": ("employee_id", "scale_code"),
    "strengths": ("employee_id", "rank"),
    "performance_yearly": ("employee_id", "year"),
    "competencies_yearly": ("employee_id", "pillar_code", "year"),
}


def conform_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to the declared type; absent -> typed NULL."""
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add each absent column with its default (a literal or ``(value, type)``); present ones are kept."""
    out = df
    for name, spec in defaults.items():
        if name in df.columns:
            continue
        value, typ = spec if isinstance(spec, tuple) else (spec, None)
        c = F.lit(value)
        out = out.withColumn(name, c.cast(typ) if typ else c)
    return out
