"""Input bundle for the analyses: the fixture model plus derived frames (latest rating, latest
competencies, cleaned DISC, employees with dimension names). Everything stays lazy; callers that
reuse a frame several times in one action can ``persist`` it."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import label_cohort
from cohortlens.operators.clean import fix_disc
from cohortlens.operators.latest import latest_per_key, latest_per_key_code, pivot_wide
from cohortlens.sources import fixtures as fx
from cohortlens.sources import projections as pj
from cohortlens.sources.schemas import CORE
from cohortlens.sources.tables import read_table


ORG_NAMES = ("company", "area", "position", "department", "division", "directorate", "grade", "education", "major")


@dataclass
class Bundle:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    @cached_property
    def employees(self) -> DataFrame:
        return fx.fx_employees(self.spark, self.sf_dir)

    @cached_property
    def performance(self) -> DataFrame:
        return fx.fx_performance(self.spark, self.sf_dir)

    @cached_property
    def competencies(self) -> DataFrame:
        return fx.fx_competencies(self.spark, self.sf_dir)

    @cached_property
    def papi(self) -> DataFrame:
        return fx.fx_papi(self.spark, self.sf_dir)

    @cached_property
    def strengths(self) -> DataFrame:
        return fx.fx_strengths(self.spark, self.sf_dir)

    @cached_property
    def psych(self) -> DataFrame:
        return fx.fx_psych(self.spark, self.sf_dir)

    # ---- derived -----------------------------------------------------------------------------
    @cached_property
    def perf_latest(self) -> DataFrame:
        """employee_id, year, rating of the latest year (NULLs first, as PostgreSQL DESC)."""
        return latest_per_key(self.performance, tie_break=("src_id",))

    @cached_property
    def labels(self) -> DataFrame:
        """employee_id, rating, is_high for the latest rating."""
        return self.perf_latest.select("employee_id", "rating", label_cohort("rating").alias("is_high"))

    @cached_property
    def comp_latest(self) -> DataFrame:
        """Long form of the latest competency score per (employee, pillar)."""
        return latest_per_key_code(self.competencies)

    def comp_wide(self, codes=fx.PILLAR_CODES) -> DataFrame:
        return pivot_wide(self.comp_latest, "employee_id", "pillar_code", "score", codes)

    def papi_wide(self, codes) -> DataFrame:
        """Selected PAPI scales as columns, population = employees with any PAPI row."""
        return pivot_wide(self.papi, "employee_id", "scale_code", "score", codes)

    @cached_property
    def psych_fixed(self) -> DataFrame:
        return fix_disc(self.psych)

    @cached_property
    def employees_org(self) -> DataFrame:
        """Star join: employee ids -> grade, education names (major is a name already)."""
        grades = fx.dim_frame(self.spark, fx.GRADES, "grade_id", "grade")
        edu = fx.dim_frame(self.spark, fx.EDUCATION, "education_id", "education")
        e = self.employees
        return (e.join(F.broadcast(grades), "grade_id", "left")
                 .join(F.broadcast(edu), "education_id", "left")
                 .select("employee_id", "fullname", "education", "grade", "major", "years_of_service_months",
                         "grade_id", "education_id", "area_id"))

    @cached_property
    def employees_org_all(self) -> DataFrame:
        """Star join of all nine dimensions; the larger names come from driver tables, joined without a hint."""
        e = self.employees.withColumnRenamed("major", "major_name").withColumn("major", F.col("major_name"))
        grades = fx.dim_frame(self.spark, fx.GRADES, "grade_id", "grade")
        edu = fx.dim_frame(self.spark, fx.EDUCATION, "education_id", "education")
        e = e.join(F.broadcast(grades), "grade_id", "left").join(F.broadcast(edu), "education_id", "left")
        for name, (table, key, value) in fx.DIMENSION_TABLES.items():
            d = read_table(self.spark, self.sf_dir, table, [key, value]) \
                .select(F.col(key).cast("string").alias(f"{name}_id"), F.col(value).alias(name))
            e = e.join(d, f"{name}_id", "left")
        return e.select("employee_id", "fullname", *ORG_NAMES, "years_of_service_months")

    @cached_property
    def pillar_labels(self) -> DataFrame:
        return fx.dim_frame(self.spark, fx.PILLAR_LABELS, "pillar_code", "pillar_label")


DIM_OF = {"company": ("dim_companies", "company_id"), "area": ("dim_areas", "area_id"),
          "position": ("dim_positions", "position_id"), "department": ("dim_departments", "department_id"),
          "division": ("dim_divisions", "division_id"), "directorate": ("dim_directorates", "directorate_id"),
          "grade": ("dim_grades", "grade_id"), "education": ("dim_education", "education_id"),
          "major": ("dim_majors", "major_id")}


OPTIONAL = ("strengths", "papi_scores", "profiles_psych")  # an analysis goes on without these


class CoreBundle(Bundle):
    """The same analyses over real core tables (e.g. the output of ``plans.etl.build_core``) instead of
    the fixture model: ``tables`` maps core table names to DataFrames."""

    def __init__(self, spark: SparkSession, tables: dict):
        super().__init__(spark, "")
        self.tables = tables

    def _t(self, name: str) -> DataFrame:
        """A core table; the optional ones are empty, with their columns, where the load lacks them."""
        if name not in self.tables and name in OPTIONAL:
            return self.spark.createDataFrame([], CORE[name])
        return self.tables[name]

    @cached_property
    def employees(self) -> DataFrame:
        return self._t("employees")

    @cached_property
    def performance(self) -> DataFrame:
        return pj.perf_all(self._t("performance_yearly")).withColumn("src_id", F.lit(0).cast("long"))

    @cached_property
    def competencies(self) -> DataFrame:
        return pj.comp_all(self._t("competencies_yearly"))

    @cached_property
    def papi(self) -> DataFrame:
        return pj.papi_scores(self._t("papi_scores"))

    @cached_property
    def strengths(self) -> DataFrame:
        return self._t("strengths").select("employee_id", "theme", "rank")

    @cached_property
    def psych(self) -> DataFrame:
        p = pj.psych(self._t("profiles_psych"), with_word=True)
        num = ("pauli", "faxtor", "iq", "gtq", "tiki")
        return p.select("employee_id", *[F.col(c).cast("double").alias(c) if c in num else F.col(c)
                                         for c in p.columns if c != "employee_id"])

    @cached_property
    def employees_org(self) -> DataFrame:
        """Star join: employee ids -> grade, education and major names from the core dimensions.

        Employee tables without some of these ids give NULL names for them.
        """
        return self._star(pj.employees_org_min(self.employees), ("grade", "education", "major")) \
            .withColumn("area_id", F.lit(None).cast("string"))

    @cached_property
    def employees_org_all(self) -> DataFrame:
        """Star join: the names of all nine dimensions."""
        return self._star(self.employees, ORG_NAMES).select("employee_id", "fullname", *ORG_NAMES,
                                                            "years_of_service_months")

    def _star(self, e: DataFrame, names) -> DataFrame:
        for name in names:
            dim, key = DIM_OF[name]
            if dim in self.tables and key in e.columns:
                # no hint: the planner broadcasts a dimension whose measured size is small
                d = self._t(dim).select(F.col(key), F.col("name").alias(name))
                e = e.join(d, key, "left")
            else:
                e = e.withColumn(name, F.lit(None).cast("string"))
        return e

    @cached_property
    def pillar_labels(self) -> DataFrame:
        if "dim_competency_pillars" in self.tables:
            return pj.pillar_labels(self._t("dim_competency_pillars"))
        return super().pillar_labels
