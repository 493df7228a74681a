"""Catalogue: score v2 / v1 components, evaluation frames and weight search (fixture model)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.columns import label_cohort
from cohortlens.operators.ranking import evaluate_all
from cohortlens.plans import score_v1 as v1
from cohortlens.plans import score_v2 as v2
from cohortlens.plans.inputs import Bundle
from cohortlens.plans.oracle_sql import evaluate_sql
from cohortlens.plans.registry import query
from cohortlens.plans.weights import weight_search_metrics
from cohortlens.session import cut_lineage


def _vals(d: dict, dec: str | None = None) -> str:
    cast = (lambda v: f"CAST({v} AS {dec})") if dec else (lambda v: f"CAST({v} AS DOUBLE)")
    return "(VALUES " + ", ".join(f"('{k}', {cast(v)})" for k, v in d.items()) + ")"


def _in(items) -> str:
    return "(" + ", ".join(f"'{x}'" for x in items) + ")"


# ---- shared oracle CTEs for the v2 score --------------------------------------------------------
def _zclip(c: str, src: str) -> str:
    z = (f"CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN {c} - m_{c} ELSE ({c} - m_{c}) / sd_{c} END")
    return f"CASE WHEN ({z}) < -2 THEN -2.0 WHEN ({z}) > 2 THEN 2.0 ELSE ({z}) END"


V2 = {
    "comp_v2": f"""
SELECT c.employee_id, CAST(coalesce(sum(w.weight * (c.score - 1) * CAST(0.25 AS DECIMAL(3,2))), 0) AS DOUBLE) AS comp_score
FROM comp_latest c LEFT JOIN {_vals(v2.COMP_WEIGHTS_V2, 'DECIMAL(6,4)')} w(pillar_code, weight)
  ON c.pillar_code = w.pillar_code GROUP BY c.employee_id""",
    "str_v2": f"""
SELECT employee_id, CAST(sum(CASE WHEN theme IN {_in(v2.SUCCESS_THEMES)} THEN 1 ELSE 0 END) AS DOUBLE) / 5.0 AS str_score
FROM fx_strengths GROUP BY employee_id""",
    "papi_pw": """
SELECT employee_id, max(CASE WHEN scale_code = 'Papi_P' THEN score END) AS Papi_P,
       max(CASE WHEN scale_code = 'Papi_W' THEN score END) AS Papi_W
FROM fx_papi GROUP BY employee_id""",
    "psy_v2": f"""
SELECT p.employee_id,
  coalesce(CASE WHEN (core + 2.0) / 4.0 < 0 THEN 0.0 WHEN (core + 2.0) / 4.0 > 1 THEN 1.0 ELSE (core + 2.0) / 4.0 END, 0.5) AS psy_score
FROM (
  SELECT a.employee_id,
    0.5 * ({_zclip('pauli', 'a')}) + (-0.25) * ({_zclip('faxtor', 'a')})
    + 0.15 * ({_zclip('Papi_P', 'b')}) + 0.1 * ({_zclip('Papi_W', 'b')}) AS core
  FROM (SELECT employee_id, CAST(pauli AS DOUBLE) AS pauli, CAST(faxtor AS DOUBLE) AS faxtor,
               avg(pauli) OVER () AS m_pauli, stddev_pop(pauli) OVER () AS sd_pauli,
               avg(faxtor) OVER () AS m_faxtor, stddev_pop(faxtor) OVER () AS sd_faxtor FROM psych_fixed) a
  LEFT JOIN (SELECT employee_id, CAST(Papi_P AS DOUBLE) AS Papi_P, CAST(Papi_W AS DOUBLE) AS Papi_W,
               avg(Papi_P) OVER () AS m_Papi_P, stddev_pop(Papi_P) OVER () AS sd_Papi_P,
               avg(Papi_W) OVER () AS m_Papi_W, stddev_pop(Papi_W) OVER () AS sd_Papi_W FROM papi_pw) b
  ON a.employee_id = b.employee_id) p""",
    "parts_v2": f"""
SELECT c.employee_id, c.comp_score, coalesce(s.str_score, 0.0) AS str_score, coalesce(y.psy_score, 0.5) AS psy_score,
  CASE WHEN upper(d.disc) IN {_in(v2.DISC_BONUS_CODES)} AND c.comp_score >= 0.60 THEN 0.02 ELSE 0.0 END AS disc_bonus
FROM comp_v2 c LEFT JOIN str_v2 s ON c.employee_id = s.employee_id
LEFT JOIN psy_v2 y ON c.employee_id = y.employee_id
LEFT JOIN psych_fixed d ON c.employee_id = d.employee_id""",
    "raw_v2": """
SELECT *, 0.5 * comp_score + 0.25 * str_score + 0.2 * psy_score + disc_bonus AS raw FROM parts_v2""",
    "score_v2": """
SELECT employee_id,
  CASE WHEN max(raw) OVER () = min(raw) OVER () THEN 0.0
       ELSE (raw - min(raw) OVER ()) / (max(raw) OVER () - min(raw) OVER ()) END AS success_v2,
  comp_score, str_score, psy_score, disc_bonus FROM raw_v2""",
    "eval_v2": """
SELECT s.*, l.rating, CASE WHEN l.rating = 5 THEN 1 ELSE 0 END AS is_high
FROM score_v2 s LEFT JOIN perf_latest l ON s.employee_id = l.employee_id""",
}


def _v2_parts(b: Bundle):
    return v2.score_v2_parts(b.comp_latest, b.strengths, b.psych_fixed, b.papi_wide(["Papi_P", "Papi_W"]),
                             v2.weights_frame(b.spark, v2.COMP_WEIGHTS_V2))


def eval_frame_v2(b: Bundle):
    """Score + parts + latest rating + label; checkpointed because the ranking metrics read it in
    several passes (distinct-score curve, range-ranked rows, group sizes)."""
    s = v2.success_score_v2(_v2_parts(b))
    lab = b.perf_latest.select("employee_id", "rating")
    return cut_lineage(s.join(lab, "employee_id", "left").withColumn("is_high", label_cohort("rating")))


@query("weighted_sum_long", "employee_id:s, wsum:d",
       f"""SELECT c.employee_id, coalesce(sum(w.weight * c.score), 0) AS wsum
FROM comp_latest c LEFT JOIN {_vals(v2.COMP_WEIGHTS_V2, 'DECIMAL(6,4)')} w(pillar_code, weight)
ON c.pillar_code = w.pillar_code GROUP BY c.employee_id""")
def q_weighted_sum_long(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return v2.weighted_sum_long(b.comp_latest, v2.weights_frame(spark, v2.COMP_WEIGHTS_V2), "employee_id",
                                "pillar_code", F.col("score"), "wsum")


@query("comp_component_v2", "employee_id:s, comp_score:d", "SELECT * FROM comp_v2", V2)
def q_comp_v2(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return v2.comp_component_v2(b.comp_latest, v2.weights_frame(spark, v2.COMP_WEIGHTS_V2))


@query("theme_hit_share", "employee_id:s, str_score:d", "SELECT * FROM str_v2", V2)
def q_theme_hit_share(spark, sf_dir):
    return v2.theme_hit_share(Bundle(spark, sf_dir).strengths)


@query("psy_component_v2", "employee_id:s, psy_score:d", "SELECT * FROM psy_v2", V2)
def q_psy_v2(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return v2.psy_component_v2(b.psych_fixed, b.papi_wide(["Papi_P", "Papi_W"]))


@query("disc_bonus", "employee_id:s, disc:s, comp_score:d, disc_bonus:d",
       "SELECT p.employee_id, d.disc, p.comp_score, p.disc_bonus FROM parts_v2 p "
       "LEFT JOIN psych_fixed d ON p.employee_id = d.employee_id", V2)
def q_disc_bonus(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    parts = _v2_parts(b)
    return parts.join(b.psych_fixed.select("employee_id", "disc"), "employee_id", "left")


@query("score_v2_parts", "employee_id:s, comp_score:d, str_score:d, psy_score:d, disc_bonus:d, raw:d",
       "SELECT * FROM raw_v2", V2)
def q_score_v2_parts(spark, sf_dir):
    return _v2_parts(Bundle(spark, sf_dir))


SCORE_V2_SPEC = "employee_id:s, success_v2:d, comp_score:d, str_score:d, psy_score:d, disc_bonus:d"


@query("success_score_v2", SCORE_V2_SPEC, "SELECT * FROM score_v2", V2)
def q_success_score_v2(spark, sf_dir):
    return v2.success_score_v2(_v2_parts(Bundle(spark, sf_dir)))


@query("score_eval_frame", SCORE_V2_SPEC + ", rating:i, is_high:i", "SELECT * FROM eval_v2", V2)
def q_score_eval_frame(spark, sf_dir):
    return eval_frame_v2(Bundle(spark, sf_dir))


EVAL_SPEC = "roc_auc:d, pr_auc:d, prec_10:d, capt_10:d, prec_20:d, capt_20:d, prec_30:d, capt_30:d, ks:d"


@query("evaluate_success_v2", EVAL_SPEC,
       evaluate_sql("SELECT is_high AS y, success_v2 AS v, employee_id AS id FROM eval_v2", ks=(0.1, 0.2, 0.3)), V2)
def q_evaluate_v2(spark, sf_dir):
    return evaluate_all(eval_frame_v2(Bundle(spark, sf_dir)), "success_v2", "is_high", "employee_id",
                        ks=(0.1, 0.2, 0.3))


# ---- v1 --------------------------------------------------------------------------------------------
def _z(c: str) -> str:
    return f"CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / sd_{c} END"


V1 = {
    "comp_v1": f"""
SELECT c.employee_id, coalesce(sum(coalesce(w.weight, 0.0) *
   CASE WHEN st.sd IS NULL OR st.sd = 0 THEN 0.0 ELSE (c.score - st.m) / st.sd END), 0.0) AS comp_score
FROM comp_latest c
JOIN (SELECT pillar_code, avg(CAST(score AS DOUBLE)) AS m, stddev_pop(CAST(score AS DOUBLE)) AS sd
      FROM comp_latest GROUP BY pillar_code) st ON c.pillar_code = st.pillar_code
LEFT JOIN {_vals(v1.COMP_WEIGHTS_V1)} w(pillar_code, weight) ON c.pillar_code = w.pillar_code
GROUP BY c.employee_id""",
    "str_pairs": "SELECT DISTINCT employee_id, theme FROM fx_strengths WHERE employee_id IS NOT NULL",
    "str_v1": f"""
SELECT e.employee_id, coalesce(sum(
   CASE WHEN t.sd = 0 THEN 0.0 WHEN h.theme IS NOT NULL THEN t.weight * (1 - t.p) / t.sd ELSE t.weight * (-t.p) / t.sd END), 0.0) AS str_score
FROM (SELECT DISTINCT employee_id FROM str_pairs) e
CROSS JOIN (SELECT theme, weight, p, sqrt(p * (1 - p)) AS sd FROM (
    SELECT w.theme, w.weight, CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT employee_id) FROM str_pairs) AS p
    FROM str_pairs s JOIN {_vals(v1.THEME_WEIGHTS_V1)} w(theme, weight) ON s.theme = w.theme
    GROUP BY w.theme, w.weight) x) t
LEFT JOIN str_pairs h ON h.employee_id = e.employee_id AND h.theme = t.theme
GROUP BY e.employee_id
UNION ALL
SELECT employee_id, 0.0 FROM (SELECT DISTINCT employee_id FROM str_pairs)
WHERE NOT EXISTS (SELECT 1 FROM str_pairs s JOIN {_vals(v1.THEME_WEIGHTS_V1)} w(theme, weight) ON s.theme = w.theme)""",
    "papi_psg": """
SELECT employee_id, max(CASE WHEN scale_code = 'Papi_P' THEN score END) AS Papi_P,
       max(CASE WHEN scale_code = 'Papi_S' THEN score END) AS Papi_S,
       max(CASE WHEN scale_code = 'Papi_G' THEN score END) AS Papi_G
FROM fx_papi GROUP BY employee_id""",
    "psy_v1_in": """
SELECT coalesce(a.employee_id, b.employee_id) AS employee_id,
  coalesce(CAST(a.pauli AS DOUBLE), 0.0) AS pauli, coalesce(CAST(b.Papi_P AS DOUBLE), 0.0) AS Papi_P,
  coalesce(CAST(b.Papi_S AS DOUBLE), 0.0) AS Papi_S, coalesce(CAST(b.Papi_G AS DOUBLE), 0.0) AS Papi_G
FROM (SELECT employee_id, pauli FROM fx_psych) a FULL OUTER JOIN papi_psg b ON a.employee_id = b.employee_id""",
    "psy_v1": f"""
SELECT employee_id, 0.6 * ({_z('pauli')}) + 0.3 * ({_z('Papi_P')}) + (-0.05) * ({_z('Papi_S')}) + (-0.05) * ({_z('Papi_G')}) AS psy_score
FROM (SELECT *, avg(pauli) OVER () AS m_pauli, stddev_pop(pauli) OVER () AS sd_pauli,
        avg(Papi_P) OVER () AS m_Papi_P, stddev_pop(Papi_P) OVER () AS sd_Papi_P,
        avg(Papi_S) OVER () AS m_Papi_S, stddev_pop(Papi_S) OVER () AS sd_Papi_S,
        avg(Papi_G) OVER () AS m_Papi_G, stddev_pop(Papi_G) OVER () AS sd_Papi_G FROM psy_v1_in) z""",
    "ctx_v1": """
SELECT employee_id, CASE WHEN coalesce(CAST(years_of_service_months AS DOUBLE), 0.0) / 12.0 > 10.0 THEN 0.05 ELSE 0.0 END AS ctx_adj
FROM emp_org""",
    "parts_v1": """
SELECT coalesce(c.employee_id, p.employee_id, s.employee_id, x.employee_id) AS employee_id,
  coalesce(c.comp_score, 0.0) AS comp_score, coalesce(p.psy_score, 0.0) AS psy_score,
  coalesce(s.str_score, 0.0) AS str_score, coalesce(x.ctx_adj, 0.0) AS ctx_adj
FROM comp_v1 c FULL OUTER JOIN psy_v1 p ON c.employee_id = p.employee_id
FULL OUTER JOIN str_v1 s ON coalesce(c.employee_id, p.employee_id) = s.employee_id
FULL OUTER JOIN ctx_v1 x ON coalesce(c.employee_id, p.employee_id, s.employee_id) = x.employee_id""",
    "raw_v1": """
SELECT employee_id, 0.5 * comp_score + 0.25 * str_score + 0.15 * psy_score + 0.1 * ctx_adj AS success_score,
  comp_score, str_score, psy_score, ctx_adj FROM parts_v1""",
    "score_v1": """
SELECT employee_id, CASE WHEN max(success_score) OVER () = min(success_score) OVER () THEN 0.0
  ELSE (success_score - min(success_score) OVER ()) / (max(success_score) OVER () - min(success_score) OVER ()) END
  AS success_score, comp_score, str_score, psy_score, ctx_adj FROM raw_v1""",
}


def _v1_inputs(b: Bundle):
    return b.comp_latest, b.strengths, b.psych, b.papi_wide(["Papi_P", "Papi_S", "Papi_G"]), b.employees_org


@query("comp_component_v1", "employee_id:s, comp_score:d", "SELECT * FROM comp_v1", V1)
def q_comp_v1(spark, sf_dir):
    return v1.comp_component_v1(Bundle(spark, sf_dir).comp_latest)


@query("strengths_component_v1", "employee_id:s, str_score:d", "SELECT * FROM str_v1", V1)
def q_str_v1(spark, sf_dir):
    return v1.strengths_component_v1(Bundle(spark, sf_dir).strengths)


@query("psy_component_v1", "employee_id:s, psy_score:d", "SELECT * FROM psy_v1", V1)
def q_psy_v1(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return v1.psy_component_v1(b.psych, b.papi_wide(["Papi_P", "Papi_S", "Papi_G"]))


@query("context_uplift", "employee_id:s, ctx_adj:d", "SELECT * FROM ctx_v1", V1)
def q_context_uplift(spark, sf_dir):
    return v1.context_uplift(Bundle(spark, sf_dir).employees_org)


@query("parts_full_outer", "employee_id:s, comp_score:d, psy_score:d, str_score:d, ctx_adj:d",
       "SELECT * FROM parts_v1", V1)
def q_parts_full_outer(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return v1.parts_full_outer([v1.comp_component_v1(b.comp_latest),
                                v1.psy_component_v1(b.psych, b.papi_wide(["Papi_P", "Papi_S", "Papi_G"])),
                                v1.strengths_component_v1(b.strengths), v1.context_uplift(b.employees_org)])


SCORE_V1_SPEC = "employee_id:s, success_score:d, comp_score:d, str_score:d, psy_score:d, ctx_adj:d"


@query("success_score_v1", SCORE_V1_SPEC, "SELECT * FROM score_v1", V1)
def q_success_v1(spark, sf_dir):
    return v1.success_score_v1(*_v1_inputs(Bundle(spark, sf_dir)), minmax=True)


@query("success_score_v1_raw", SCORE_V1_SPEC, "SELECT * FROM raw_v1", V1)
def q_success_v1_raw(spark, sf_dir):
    return v1.success_score_v1(*_v1_inputs(Bundle(spark, sf_dir)), minmax=False)


# fixed values, typed for the oracle: (point, competency, strengths, psychometric)
GRID_SQL = """(SELECT *, CAST(1.0 AS DOUBLE) - (wc + ws + wp) AS wx FROM (
  SELECT a AS grid_id, CAST(b AS DOUBLE) AS wc, CAST(c AS DOUBLE) AS ws, CAST(d AS DOUBLE) AS wp FROM (VALUES
  (1, 0.45, 0.20, 0.15), (2, 0.45, 0.20, 0.20), (3, 0.45, 0.25, 0.15), (4, 0.45, 0.25, 0.20), (5, 0.45, 0.30, 0.10),
  (6, 0.45, 0.30, 0.15), (7, 0.45, 0.30, 0.20), (8, 0.50, 0.20, 0.15), (9, 0.50, 0.20, 0.20), (10, 0.50, 0.25, 0.10),
  (11, 0.50, 0.25, 0.15), (12, 0.50, 0.25, 0.20), (13, 0.50, 0.30, 0.10), (14, 0.55, 0.20, 0.10),
  (15, 0.55, 0.20, 0.15), (16, 0.55, 0.20, 0.20), (17, 0.55, 0.25, 0.10)) v(a, b, c, d)) w) g"""


def eval_frame_v1(b: Bundle):
    """Score v1 with its parts, the latest rating and the label of every scored employee."""
    lab = b.perf_latest.select("employee_id", "rating")
    s = v1.success_score_v1(*_v1_inputs(b))
    return s.join(lab, "employee_id", "left").withColumn("is_high", label_cohort("rating"))


EVAL_V1 = {**V1, "eval_v1": "SELECT s.*, l.rating, CASE WHEN l.rating = 5 THEN 1 ELSE 0 END AS is_high "
                            "FROM score_v1 s LEFT JOIN perf_latest l ON s.employee_id = l.employee_id"}


@query("score_eval_frame_v1", SCORE_V1_SPEC + ", rating:i, is_high:i", "SELECT * FROM eval_v1", EVAL_V1)
def q_score_eval_frame_v1(spark, sf_dir):
    return eval_frame_v1(Bundle(spark, sf_dir))


@query("evaluate_success_v1", EVAL_SPEC,
       evaluate_sql("SELECT is_high AS y, success_score AS v, employee_id AS id FROM eval_v1", ks=(0.1, 0.2, 0.3)), EVAL_V1)
def q_evaluate_v1(spark, sf_dir):
    return evaluate_all(cut_lineage(eval_frame_v1(Bundle(spark, sf_dir))), "success_score", "is_high", "employee_id",
                        ks=(0.1, 0.2, 0.3))


@query("weight_search_metrics", "grid_id:i, roc_auc:d, pr_auc:d, prec_10:d, capt_10:d, prec_20:d, capt_20:d, ks:d",
       evaluate_sql(f"""SELECT g.grid_id, CASE WHEN l.rating = 5 THEN 1 ELSE 0 END AS y,
  g.wc * r.comp_score + g.ws * r.str_score + g.wp * r.psy_score + g.wx * r.ctx_adj AS v, r.employee_id AS id
FROM raw_v1 r LEFT JOIN perf_latest l ON r.employee_id = l.employee_id CROSS JOIN {GRID_SQL}""", keys=["grid_id"]),
       V1)
def q_weight_search(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    parts = v1.success_score_v1(*_v1_inputs(b), minmax=False).drop("success_score")
    lab = b.perf_latest.select("employee_id", "rating")
    labelled = parts.join(lab, "employee_id", "left").select(
        "employee_id", label_cohort("rating").alias("is_high"), "comp_score", "str_score", "psy_score", "ctx_adj")
    return weight_search_metrics(cut_lineage(labelled))
