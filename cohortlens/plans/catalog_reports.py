"""Catalogue: reports R1-R8 on the fixture model."""

from __future__ import annotations

from cohortlens.plans import reports
from cohortlens.plans.catalog_scores import V2, eval_frame_v2
from cohortlens.plans.catalog_stats import _bin_sql, _group_prec_sql, chi2_grid_sql
from cohortlens.plans.catalog_etl import MBTI_SQL
from cohortlens.plans.inputs import Bundle
from cohortlens.plans.oracle_sql import mwu_sql
from cohortlens.plans.registry import query


def cohort_sql(src: str) -> str:
    """Oracle for cohort_compare + p_mwu; src has metric, v, y."""
    base = f"""
SELECT metric, mh AS mean_high, mn AS mean_non, mh - mn AS delta,
  CASE WHEN nh < 2 OR nn < 2 THEN NULL WHEN pooled IS NULL OR pooled = 0 OR isnan(pooled) THEN 0.0
       ELSE (mh - mn) / pooled END AS cohens_d, nh AS n_high, nn AS n_non
FROM (SELECT *, sqrt(((nh - 1) * vh + (nn - 1) * vn) / (nh + nn - 2)) AS pooled FROM (
  SELECT metric, avg(CASE WHEN y = 1 THEN v END) AS mh, avg(CASE WHEN y <> 1 THEN v END) AS mn,
         count(CASE WHEN y = 1 THEN v END) AS nh, count(CASE WHEN y <> 1 THEN v END) AS nn,
         var_samp(CASE WHEN y = 1 THEN v END) AS vh, var_samp(CASE WHEN y <> 1 THEN v END) AS vn
  FROM ({src}) s GROUP BY metric) a) b"""
    return f"SELECT a.*, b.p_mwu FROM ({base}) a LEFT JOIN ({mwu_sql(src, ['metric'])}) b ON a.metric = b.metric"


COMP_SRC = ("SELECT c.pillar_code AS metric, CAST(c.score AS DOUBLE) AS v, l.is_high AS y "
            "FROM comp_latest c JOIN lab l ON c.employee_id = l.employee_id")


@query("report_competency",
       "pillar_code:s, pillar_label:s, mean_high:d, mean_non:d, delta:d, cohens_d:d, p_mwu:d, n_high:l, n_non:l",
       f"SELECT r.metric AS pillar_code, d.pillar_label, r.mean_high, r.mean_non, r.delta, r.cohens_d, r.p_mwu, "
       f"r.n_high, r.n_non FROM ({cohort_sql(COMP_SRC)}) r LEFT JOIN pillar_dim d ON r.metric = d.pillar_code")
def q_report_competency(spark, sf_dir):
    return reports.report_competency(Bundle(spark, sf_dir))


PAPI_SRC = ("SELECT p.scale_code AS metric, CAST(p.score AS DOUBLE) AS v, l.is_high AS y "
            "FROM fx_papi p JOIN lab l ON p.employee_id = l.employee_id")


@query("report_papi", "scale:s, mean_high:d, mean_non:d, delta:d, cohens_d:d, p_mwu:d",
       f"SELECT metric AS scale, mean_high, mean_non, delta, cohens_d, p_mwu FROM ({cohort_sql(PAPI_SRC)}) r")
def q_report_papi(spark, sf_dir):
    return reports.report_papi(Bundle(spark, sf_dir))


COG_SRC = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST(p.{m} AS DOUBLE) AS v, l.is_high AS y FROM fx_psych p "
    f"JOIN lab l ON p.employee_id = l.employee_id" for m in reports.COGNITIVE_METRICS)


@query("report_cognitive", "metric:s, mean_high:d, mean_non:d, delta:d, cohens_d:d, p_mwu:d",
       f"SELECT metric, mean_high, mean_non, delta, cohens_d, p_mwu FROM ({cohort_sql(COG_SRC)}) r")
def q_report_cognitive(spark, sf_dir):
    return reports.report_cognitive(Bundle(spark, sf_dir))


STR_SRC = "SELECT s.theme, l.is_high AS y FROM fx_strengths s JOIN lab l ON s.employee_id = l.employee_id"


@query("report_strengths", "theme:s, pct_nonhigh:d, pct_high:d, delta_pct:d",
       f"""SELECT theme, coalesce(max(CASE WHEN y = 0 THEN pct END), 0.0) AS pct_nonhigh,
  coalesce(max(CASE WHEN y = 1 THEN pct END), 0.0) AS pct_high,
  coalesce(max(CASE WHEN y = 1 THEN pct END), 0.0) - coalesce(max(CASE WHEN y = 0 THEN pct END), 0.0) AS delta_pct
FROM (SELECT c.theme, c.y, CAST(c.n AS DOUBLE) / t.total * 100.0 AS pct
      FROM (SELECT theme, y, count(*) AS n FROM ({STR_SRC}) s WHERE theme IS NOT NULL GROUP BY theme, y) c
      JOIN (SELECT y, count(*) AS total FROM ({STR_SRC}) s2 WHERE theme IS NOT NULL GROUP BY y) t ON c.y = t.y) x
GROUP BY theme""")
def q_report_strengths(spark, sf_dir):
    return reports.report_strengths(Bundle(spark, sf_dir))


PSY_LAB = ("SELECT p.*, CASE WHEN l.rating = 5 THEN 1 ELSE 0 END AS y FROM psych_fixed p "
           "LEFT JOIN perf_latest l ON p.employee_id = l.employee_id")


def _rates_sql(cat: str, src: str, extra_where: str = "") -> str:
    return (f"SELECT {cat}, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS pct_high, "
            f"avg(CASE WHEN y <> 1 THEN 1.0 ELSE 0.0 END) AS pct_non, count(*) AS n FROM ({src}) s "
            f"WHERE {cat} IS NOT NULL GROUP BY {cat} {extra_where}")


@query("report_disc", "disc:s, pct_high:d, pct_non:d, n:l", _rates_sql("disc", PSY_LAB))
def q_report_disc(spark, sf_dir):
    return reports.report_disc(Bundle(spark, sf_dir))


CHI_SPEC = "chi2:d, dof:i, p_value:d, cramers_v:d, n:l, n_categories:l, n_labels:l"


@query("report_disc_test", CHI_SPEC,
       f"SELECT chi2, dof, p_value, cramers_v, n, n_categories, n_labels FROM "
       f"({chi2_grid_sql(f'SELECT 1 AS test, disc AS cat, y FROM ({PSY_LAB}) p')}) c")
def q_report_disc_test(spark, sf_dir):
    return reports.report_disc_test(Bundle(spark, sf_dir))


MBTI_LONG = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, substr(m, {i + 1}, 1) AS letter, y FROM "
    f"(SELECT {MBTI_SQL} AS m, y FROM ({PSY_LAB}) p) q WHERE m IS NOT NULL"
    for i, d in enumerate(reports.MBTI_DIMENSIONS))


@query("report_mbti_dimensions", "dimension:s, letter:s, pct_high:d, pct_non:d, n:l",
       f"""SELECT dimension, letter, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS pct_high,
  avg(CASE WHEN y <> 1 THEN 1.0 ELSE 0.0 END) AS pct_non, count(*) AS n FROM ({MBTI_LONG}) s
WHERE dimension IN (SELECT dimension FROM ({MBTI_LONG}) s2 GROUP BY dimension
                    HAVING count(DISTINCT letter) >= 2 AND count(DISTINCT y) >= 2)
GROUP BY dimension, letter""")
def q_report_mbti_dims(spark, sf_dir):
    return reports.report_mbti_dimensions(Bundle(spark, sf_dir))


@query("report_mbti_test", "dimension:s, " + CHI_SPEC,
       f"SELECT * FROM ({chi2_grid_sql(f'SELECT dimension, letter AS cat, y FROM ({MBTI_LONG}) m', ('dimension',))}) c")
def q_report_mbti_test(spark, sf_dir):
    return reports.report_mbti_test(Bundle(spark, sf_dir))


@query("report_mbti_types", "mbti:s, pct_high:d, pct_non:d, n:l",
       _rates_sql("mbti", f"SELECT {MBTI_SQL} AS mbti, y FROM ({PSY_LAB}) p", "HAVING count(*) >= 30"))
def q_report_mbti_types(spark, sf_dir):
    return reports.report_mbti_types(Bundle(spark, sf_dir))


CTX_SRC = ("SELECT e.*, l.is_high AS y, CAST(e.years_of_service_months AS DOUBLE) / 12.0 AS yrs "
           "FROM emp_org e JOIN lab l ON e.employee_id = l.employee_id")


@query("report_contextual", "factor:s, category:s, pct_high:d",
       f"""SELECT factor, category, avg(CAST(y AS DOUBLE)) * 100.0 AS pct_high FROM (
  SELECT 'grade' AS factor, grade AS category, y FROM ({CTX_SRC}) a
  UNION ALL SELECT 'education', education, y FROM ({CTX_SRC}) b
  UNION ALL SELECT 'major', major, y FROM ({CTX_SRC}) c
  UNION ALL SELECT 'years_of_service', {_bin_sql('yrs')}, y FROM ({CTX_SRC}) d) s
WHERE category IS NOT NULL GROUP BY factor, category""")
def q_report_contextual(spark, sf_dir):
    return reports.report_contextual(Bundle(spark, sf_dir))


GP_SRC = ("SELECT v2.is_high AS y, v2.success_v2 AS v, v2.employee_id AS id, o.education, o.grade, o.major "
          "FROM eval_v2 v2 LEFT JOIN emp_org o ON v2.employee_id = o.employee_id")


@query("report_group_precision", "factor:s, grp:s, prec_10:d, uplift_vs_base_pp:d, n:l",
       _group_prec_sql(GP_SRC, ["education", "grade", "major"]), V2)
def q_report_group_precision(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return reports.report_group_precision(eval_frame_v2(b), b)
