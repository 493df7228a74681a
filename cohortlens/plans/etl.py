"""End-to-end load: staging CSV (all text) -> cleaned, typed, deduplicated core Parquet tables,
merged into what is already there (upsert by primary key), plus a quality report.

Each table is one lazy plan: CSV scan -> clean -> one row per key -> merge -> write. The merge rewrites only the files
that hold keys of the batch, and the new files become the table in one step (``sources/versions.py``): a load that
breaks midway leaves every table as it was or as it is to be. The jobs run while the functions are called.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import blank_to_null, text_to_int_rounded
from cohortlens.operators import clean, quality
from cohortlens.session import cut_lineage
from cohortlens.sources.readers import scan_csv_text
from cohortlens.sources.schemas import CORE, DIMENSIONS, PRIMARY_KEYS, STAGING
from cohortlens.sources.versions import VersionedTable, read_current

EMPLOYEE_FKS = ("company_id", "area_id", "position_id", "department_id", "division_id", "directorate_id",
                "grade_id", "education_id", "major_id")
FK_DIMS = {"company_id": "dim_companies", "area_id": "dim_areas", "position_id": "dim_positions",
           "department_id": "dim_departments", "division_id": "dim_divisions",
           "directorate_id": "dim_directorates", "grade_id": "dim_grades", "education_id": "dim_education",
           "major_id": "dim_majors"}
# yearly facts are partitioned by year, so a filter on year prunes whole folders
PARTITION_BY = {"performance_yearly": ("year",), "competencies_yearly": ("year",)}
LOAD_ORDER = (*[f"dim_{d}" for d in DIMENSIONS], "dim_competency_pillars", "employees", "profiles_psych",
              "papi_scores", "strengths", "performance_yearly", "competencies_yearly")


def clean_employees(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """Names are trimmed (kept even when blank), foreign keys blank -> NULL, tenure rounded to int,
    blank employee ids rejected, one row per employee."""
    typed = raw.select(
        F.trim("employee_id").alias("employee_id"), F.trim("fullname").alias("fullname"), F.trim("nip").alias("nip"),
        *[blank_to_null(c).alias(c) for c in EMPLOYEE_FKS],
        text_to_int_rounded("years_of_service_months", on_error).alias("years_of_service_months"),
    ).where(F.col("employee_id") != "")
    return clean.dedup_row_number(typed, ["employee_id"])


def clean_table(name: str, raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """Staging rows of table ``name`` -> typed core rows (column order of the core schema)."""
    if name == "dim_competency_pillars":
        out = clean.clean_pillars(raw)
    elif name.startswith("dim_"):
        key = raw.columns[0]
        out = clean.clean_dim(raw, key)
    elif name == "employees":
        out = clean_employees(raw, on_error)
    elif name == "profiles_psych":
        out = clean.clean_psych(raw, on_error)
    elif name == "papi_scores":
        out = clean.clean_fact(raw, ["employee_id", "scale_code"], [], ["score"], on_error=on_error)
    elif name == "strengths":
        out = clean.clean_strengths(raw, on_error)
    elif name == "performance_yearly":
        out = clean.clean_fact(raw, ["employee_id"], ["year"], ["rating"], on_error=on_error)
    elif name == "competencies_yearly":
        out = clean.clean_fact(raw, ["employee_id"], ["year"], ["score"], upper_keys=["pillar_code"],
                               on_error=on_error)
    else:
        raise KeyError(name)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in CORE[name].fields])


def load_staging(spark: SparkSession, staging_dir: str, tables: Iterable[str] = LOAD_ORDER,
                 may_be_missing: Iterable[str] = ()) -> dict[str, DataFrame]:
    """``<staging_dir>/<table>.csv`` for every table, found and read by Spark (any path Spark can open).

    A missing file is an error, unless the table is named in ``may_be_missing``: then its frame is empty.
    """
    out, missing = {}, set(may_be_missing)
    for t in tables:
        try:
            out[t] = scan_csv_text(spark, _join(staging_dir, f"{t}.csv"), STAGING[t])
        except AnalysisException as exc:
            if t not in missing or exc.getCondition() != "PATH_NOT_FOUND":
                raise
            out[t] = spark.createDataFrame([], STAGING[t])
    return out


def _join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def core_table(spark: SparkSession, core_dir: str, name: str) -> VersionedTable:
    return VersionedTable(spark, _join(core_dir, name), CORE[name], PARTITION_BY.get(name, ()))


def build_core(spark: SparkSession, staging_dir: str, core_dir: str, tables: Iterable[str] = LOAD_ORDER,
               on_error: str = "raise", may_be_missing: Iterable[str] = (), keep_versions: int = 1) -> dict[str, DataFrame]:
    """Clean every staging table and upsert it into ``<core_dir>/<table>``. Re-running with the same input leaves the
    tables unchanged. Returns the core tables as lazy frames.

    A table that breaks while it is written keeps its old rows. With ``keep_versions`` of 1 superseded files go once the
    new version is in place; a reader that is still on them needs 2.
    """
    staged = load_staging(spark, staging_dir, tables, may_be_missing)
    result = {}
    for t in tables:
        table = core_table(spark, core_dir, t)
        adopt_plain_files(table)
        table.upsert(clean_table(t, staged[t], on_error), PRIMARY_KEYS[t])
        table.vacuum(keep_versions)
        result[t] = table.read()
    return result


def rebuild_core(spark: SparkSession, staging_dir: str, core_dir: str, tables: Iterable[str] = LOAD_ORDER,
                 on_error: str = "raise", may_be_missing: Iterable[str] = (), keep_versions: int = 1) -> dict[str, DataFrame]:
    """As :func:`build_core`, but the staging rows replace the tables: the old rows are not merged."""
    staged = load_staging(spark, staging_dir, tables, may_be_missing)
    result = {}
    for t in tables:
        table = core_table(spark, core_dir, t)
        table.overwrite(clean_table(t, staged[t], on_error))
        table.vacuum(keep_versions)
        result[t] = table.read()
    return result


def adopt_plain_files(table: VersionedTable) -> None:
    """Make a table that an earlier release wrote as plain Parquet files the first version."""
    if not table.versions():
        plain = read_current(table.spark, table.path, table.schema)
        if not plain.isEmpty():
            table.overwrite(plain)


FACTS = ("profiles_psych", "papi_scores", "strengths", "performance_yearly", "competencies_yearly")
PILLARS = "dim_competency_pillars"


def core_rules() -> dict[str, quality.TableRules]:
    """The constraints of the core schema."""
    rules = {f"dim_{d}": quality.TableRules(PRIMARY_KEYS[f"dim_{d}"], unique=("name",)) for d in DIMENSIONS}
    rules[PILLARS] = quality.TableRules(PRIMARY_KEYS[PILLARS], lengths={"pillar_code": 3})
    rules["employees"] = quality.TableRules(PRIMARY_KEYS["employees"], refers=FK_DIMS)
    rules.update({t: quality.TableRules(PRIMARY_KEYS[t], refers={"employee_id": "employees"}) for t in FACTS})
    rules["competencies_yearly"] = quality.TableRules(
        PRIMARY_KEYS["competencies_yearly"], refers={"employee_id": "employees", "pillar_code": PILLARS},
        lengths={"pillar_code": 3})
    return rules


def quality_report(core: dict[str, DataFrame]) -> DataFrame:
    """(check, subject, n): row counts per table, duplicate primary keys, NULL foreign keys on employees, foreign keys
    without a matching dimension row (true orphans), and the column rules of the dimensions: names missing or given
    to two ids, pillar codes longer than three characters.

    Every table is scanned once, for a census of its keys that all checks share; references to absent tables are not judged.
    """
    rules = {t: r for t, r in core_rules().items() if t in core}
    census = cut_lineage(quality.key_census(core, rules))
    counts, orphans = quality.census_counts(census), quality.orphan_keys(census)
    checks = []  # (check, subject, table, kind, column, measure)
    for t, r in rules.items():
        key = ",".join(r.keys)
        checks += [("row_count", t, t, "key", key, "n_rows"), ("duplicate_key", t, t, "key", key, "n_repeated")]
        for c in r.unique:
            checks += [(f"null_{c}", t, t, "unique", c, "n_null"), (f"{c}_of_two_ids", t, t, "unique", c, "n_repeated")]
        checks += [("long_code", t, t, "length", c, "n_long") for c in r.lengths]
        if t == "employees":
            checks += [("null_fk", c, t, "ref", c, "n_null") for c in r.refers]
        for c, ref in r.refers.items():
            if ref in core:
                checks.append(("orphan_employee", t, t, "orphan", c, "n") if ref == "employees" else
                              ("orphan_fk", c, t, "orphan", c, "n"))
    wanted = core[next(iter(rules))].sparkSession.createDataFrame(checks, "check string, subject string, table_name string, "
                                                                  "kind string, column_name string, measure string")
    found = counts.select("table_name", "kind", F.col("subject").alias("column_name"), F.explode(F.array(*(
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("n")) for m in ("n_rows", "n_null", "n_repeated", "n_long")))).alias("x")) \
        .select("table_name", "kind", "column_name", "x.*")
    lost = orphans.groupBy("table_name", "column_name").agg(F.sum("n").alias("n")) \
        .select("table_name", F.lit("orphan").alias("kind"), "column_name", F.lit("n").alias("measure"), "n")
    on = ["table_name", "kind", "column_name", "measure"]
    return wanted.join(found.unionByName(lost), on, "left") \
        .select("check", "subject", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def bucket_core(core: dict[str, DataFrame], path: str, buckets: int, prefix: str = "core_") -> dict[str, DataFrame]:
    """Save the employee tables as catalog tables bucketed and sorted by employee, under ``path``.

    Joins of these tables on the employee, and windows and aggregates per employee (latest rating, latest competency,
    wide scales), then need no exchange: the shuffle is paid once at the load. The other tables are returned as they are.
    """
    out = dict(core)
    for t, df in core.items():
        if "employee_id" in df.columns:
            name = f"{prefix}{t}"
            df.write.mode("overwrite").bucketBy(buckets, "employee_id").sortBy("employee_id") \
                .option("path", _join(path, t)).saveAsTable(name)
            out[t] = df.sparkSession.table(name)
    return out
