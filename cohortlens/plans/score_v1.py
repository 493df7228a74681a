"""Composite score v1 (legacy): z-scored competency pillars, theme presence, pauli + PAPI, a tenure
uplift; parts full-outer-joined, missing parts 0, weighted sum, optional min-max."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.scale import attach_scalars, minmax_expr, scale_columns, with_scalars, z_expr
from cohortlens.session import cut_lineage
from cohortlens.sources.schemas import ensure_columns

# --- fixed values (v1 rule) ---------------------------------------------------------------------
COMP_WEIGHTS_V1 = {"SEA": 0.22, "CEX": 0.17, "VCU": 0.12, "STO": 0.12, "CSI": 0.11,
                   "QDD": 0.08, "GDR": 0.07, "LIE": 0.05, "IDS": 0.03, "FTC": 0.03}
PSY_WEIGHTS_V1 = {"pauli": 0.6, "Papi_P": 0.3, "Papi_S": -0.05, "Papi_G": -0.05}
THEME_WEIGHTS_V1 = {"Futuristic": 0.40, "Intellection": 0.35, "Context": 0.25}
MAIN_WEIGHTS_V1 = {"competency": 0.50, "strengths": 0.25, "psychometric": 0.15, "context": 0.10}
YOS_THRESHOLD_YEARS, YOS_UPLIFT = 10.0, 0.05
# ------------------------------------------------------------------------------------------------


def comp_component_v1(comp_latest: DataFrame, weights: dict = COMP_WEIGHTS_V1) -> DataFrame:
    """employee_id, comp_score = sum_c w_c * z_c; z per pillar over the employees having it
    (ddof 0, a constant pillar -> 0); codes without a weight add 0; NULLs skipped.

    The statistics of the pillars (one entry per code) go to the rows as one map value, so no row is
    shuffled by its pillar code.
    """
    v = F.col("score").cast("double")
    stats = comp_latest.where(F.col("pillar_code").isin(*weights)).groupBy("pillar_code").agg(
        F.avg(v).alias("m"), F.stddev_pop(v).alias("sd"))
    by_code = stats.agg(F.map_from_entries(F.collect_list(F.struct("pillar_code", F.struct("m", "sd")))).alias("_stats"))
    w = F.create_map(*[F.lit(x) for c, x in weights.items() for x in (c, float(x))]) if weights else F.lit(None)
    j = with_scalars(comp_latest, by_code)
    own = F.element_at("_stats", F.col("pillar_code"))
    z = z_expr("score", own["m"], own["sd"])
    weighted = F.coalesce(F.element_at(w, F.col("pillar_code")), F.lit(0.0)) * z
    return j.groupBy("employee_id").agg(F.coalesce(F.sum(weighted), F.lit(0.0)).alias("comp_score"))


def strengths_component_v1(strengths: DataFrame, weights: dict = THEME_WEIGHTS_V1) -> DataFrame:
    """employee_id (employees with any strengths row), str_score = sum_t w_t * z(holds theme t).

    One aggregate gives a 0/1 flag per weighted theme; z is over all these employees (ddof 0), and 0
    for a theme that all or none hold.
    """
    flags = {f"_t{i}": t for i, t in enumerate(weights)}
    held = strengths.where(F.col("employee_id").isNotNull()).groupBy("employee_id").agg(
        F.lit(0.0).alias("_none"), *[F.max(F.when(F.col("theme") == t, 1.0).otherwise(0.0)).alias(c) for c, t in flags.items()])
    z = scale_columns(held, [("z", c, f"z{c}") for c in flags])
    score = reduce(lambda a, b: a + b, [F.lit(float(weights[t])) * F.col(f"z{c}") for c, t in flags.items()], F.col("_none"))
    return z.select("employee_id", score.alias("str_score"))


def psy_component_v1(psych: DataFrame, papi_wide: DataFrame, weights: dict = PSY_WEIGHTS_V1) -> DataFrame:
    """Employees of either table; every weighted measure (absent or missing: 0) z-scored (ddof 0), weighted sum."""
    cols = list(weights)
    own = ensure_columns(psych, {c: (0.0, "double") for c in cols if c not in papi_wide.columns})
    sides = [t.select("employee_id", *[F.col(c).cast("double") if c in t.columns else F.lit(None).cast("double").alias(c)
                                       for c in cols]) for t in (own, papi_wide)]
    j = parts_full_outer(sides)
    z = scale_columns(j, [("z", c, f"z_{c}") for c in cols])
    expr = reduce(lambda a, b: a + b, [F.lit(float(weights[c])) * F.col(f"z_{c}") for c in cols])
    return z.select("employee_id", expr.alias("psy_score"))


def context_uplift(emp_org: DataFrame, threshold_years: float = YOS_THRESHOLD_YEARS,
                   uplift: float = YOS_UPLIFT) -> DataFrame:
    """employee_id, ctx_adj = uplift when tenure (months/12, NULL -> 0) exceeds the threshold."""
    if "years_of_service_months" not in emp_org.columns:
        return emp_org.select("employee_id", F.lit(0.0).alias("ctx_adj"))
    yrs = F.coalesce(F.col("years_of_service_months").cast("double"), F.lit(0.0)) / 12.0
    return emp_org.select("employee_id",
                          F.when(yrs > threshold_years, F.lit(uplift)).otherwise(F.lit(0.0)).alias("ctx_adj"))


def parts_full_outer(parts: list[DataFrame], fill: float = 0.0) -> DataFrame:
    """Parts with one row per employee, aligned on employee_id over the employees of any part; missing -> ``fill``.

    A union and one aggregate: a single exchange however many parts there are.
    """
    vals = list(dict.fromkeys(c for p in parts for c in p.columns if c != "employee_id"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy("employee_id").agg(*[F.coalesce(F.max(c), F.lit(fill)).alias(c) for c in vals])


def success_score_v1(comp_latest: DataFrame, strengths: DataFrame, psych: DataFrame, papi_wide: DataFrame,
                     emp_org: DataFrame, w_main: dict = MAIN_WEIGHTS_V1, minmax: bool = True,
                     w_comp: dict = COMP_WEIGHTS_V1, w_psy: dict = PSY_WEIGHTS_V1,
                     w_themes: dict = THEME_WEIGHTS_V1) -> DataFrame:
    """employee_id, success_score (min-max when asked), comp_score, str_score, psy_score, ctx_adj."""
    parts = parts_full_outer([comp_component_v1(comp_latest, w_comp), psy_component_v1(psych, papi_wide, w_psy),
                              strengths_component_v1(strengths, w_themes), context_uplift(emp_org)])
    score = (F.lit(w_main["competency"]) * F.col("comp_score") + F.lit(w_main["strengths"]) * F.col("str_score")
             + F.lit(w_main["psychometric"]) * F.col("psy_score") + F.lit(w_main["context"]) * F.col("ctx_adj"))
    s = parts.withColumn("success_score", score)
    if minmax:
        s = cut_lineage(s)  # feeds both the min/max aggregate and the rows
        s = attach_scalars(s, F.min("success_score").alias("_lo"), F.max("success_score").alias("_hi")) \
            .withColumn("success_score", minmax_expr("success_score", F.col("_lo"), F.col("_hi")))
    return s.select("employee_id", "success_score", "comp_score", "str_score", "psy_score", "ctx_adj")
