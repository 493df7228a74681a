"""Composite score v2: competency (weighted latest pillars), strengths (success-theme share),
psychometric (clipped z of pauli, faxtor, Papi_P, Papi_W), a small DISC bonus; min-max to [0, 1]."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import clip
from cohortlens.operators.scale import attach_scalars, broadcast_if_small, minmax_expr, scale_columns
from cohortlens.session import cut_lineage
from cohortlens.sources.schemas import ensure_columns

# --- fixed values (v2 rule) ---------------------------------------------------------------------
COMP_WEIGHTS_V2 = {"SEA": 0.30, "CEX": 0.20, "VCU": 0.15, "STO": 0.10, "CSI": 0.10,
                   "QDD": 0.05, "GDR": 0.04, "LIE": 0.03, "IDS": 0.02, "FTC": 0.01}
SUCCESS_THEMES = ("Futuristic", "Intellection", "Context", "Developer", "Harmony", "Analytical")
DISC_BONUS_CODES = ("SI", "SD", "IS")
PSY_WEIGHTS_V2 = {"pauli": 0.50, "faxtor": -0.25, "Papi_P": 0.15, "Papi_W": 0.10}
MAIN_WEIGHTS_V2 = {"comp": 0.50, "str": 0.25, "psy": 0.20}
DISC_BONUS, DISC_MIN_COMP = 0.02, 0.60
# ------------------------------------------------------------------------------------------------


def weights_frame(spark: SparkSession, weights: dict, key: str = "pillar_code") -> DataFrame:
    """Code -> weight as exact decimals (a handful of fixed rows)."""
    rows = [(k, Decimal(str(v))) for k, v in weights.items()]
    return spark.createDataFrame(rows, f"{key} string, weight decimal(6,4)")


def weighted_sum_long(long: DataFrame, weights: DataFrame, key: str, code: str, value,
                      out: str = "wsum") -> DataFrame:
    """Per key: sum of weight * value over codes; unknown codes and NULL values add 0.
    The weights are broadcast if a count finds them few."""
    j = long.join(broadcast_if_small(weights), code, "left")
    return j.groupBy(key).agg(F.coalesce(F.sum(F.col("weight") * value), F.lit(0)).alias(out))


def comp_component_v2(comp_latest: DataFrame, weights: DataFrame) -> DataFrame:
    """employee_id, comp_score = sum w_c * (score_c - 1) / 4 (missing pillar adds 0).

    Summed in exact decimals, so the bonus threshold (comp >= 0.60) does not depend on summation order.
    """
    val = (F.col("score") - 1) * F.lit(Decimal("0.25"))
    out = weighted_sum_long(comp_latest, weights, "employee_id", "pillar_code", val, "comp_score")
    return out.select("employee_id", F.col("comp_score").cast("double").alias("comp_score"))


def theme_hit_share(strengths: DataFrame, themes=SUCCESS_THEMES, divisor: float = 5.0,
                    max_rank: int | None = None) -> DataFrame:
    """employee_id, str_score = (# rows whose theme is a success theme) / 5.

    No rank filter by default (as the rule is stated, more than 5 rows can exceed 1); ``max_rank``
    keeps only rows with rank <= max_rank."""
    if max_rank is not None:
        strengths = strengths.where(F.col("rank") <= max_rank)
    hit = F.coalesce(F.col("theme").isin(*themes), F.lit(False)).cast("long")
    return strengths.groupBy("employee_id").agg((F.sum(hit) / F.lit(divisor)).alias("str_score"))


def psy_component_v2(psych: DataFrame, papi_wide: DataFrame) -> DataFrame:
    """employee_id (psych population), psy_score in [0, 1]; any missing input -> 0.5.

    Each input is z-scored (ddof 0) over its own table's population and clipped to +-2.
    """
    psych = ensure_columns(psych, {"pauli": (None, "double"), "faxtor": (None, "double")})
    papi_wide = ensure_columns(papi_wide, {"Papi_P": (None, "double"), "Papi_W": (None, "double")})
    pz = scale_columns(psych.select("employee_id", "pauli", "faxtor"),
                       [("zclip", "pauli", "z_pauli"), ("zclip", "faxtor", "z_faxtor")])
    qz = scale_columns(papi_wide.select("employee_id", "Papi_P", "Papi_W"),
                       [("zclip", "Papi_P", "z_pp"), ("zclip", "Papi_W", "z_pw")])
    j = pz.join(qz.select("employee_id", "z_pp", "z_pw").hint("merge"), "employee_id", "left")
    w = PSY_WEIGHTS_V2
    core = (F.lit(w["pauli"]) * F.col("z_pauli") + F.lit(w["faxtor"]) * F.col("z_faxtor")
            + F.lit(w["Papi_P"]) * F.col("z_pp") + F.lit(w["Papi_W"]) * F.col("z_pw"))
    score = clip((core + 2.0) / 4.0, 0.0, 1.0)
    return j.select("employee_id", F.coalesce(score, F.lit(0.5)).alias("psy_score"))


def disc_bonus_expr(disc, comp) -> F.Column:
    cond = F.coalesce(F.upper(disc).isin(*DISC_BONUS_CODES) & (comp >= F.lit(DISC_MIN_COMP)), F.lit(False))
    return F.when(cond, F.lit(DISC_BONUS)).otherwise(F.lit(0.0))


def score_v2_parts(comp_latest: DataFrame, strengths: DataFrame, psych_fixed: DataFrame,
                   papi_wide: DataFrame, weights: DataFrame) -> DataFrame:
    """Base = employees with a competency row; parts left-joined onto it with defaults
    (strengths 0, psychometric 0.5, bonus 0). Columns: employee_id, comp_score, str_score,
    psy_score, disc_bonus, raw.

    The planner rates psychometric rows by the Parquet bytes of their few columns and would broadcast them, a row per
    employee, through the driver and into every task; they are told to shuffle, here and in ``psy_component_v2``.
    """
    comp = comp_component_v2(comp_latest, weights)
    strn = theme_hit_share(strengths)
    psy = psy_component_v2(psych_fixed, papi_wide)
    disc = psych_fixed.select("employee_id", "disc")
    j = (comp.join(strn, "employee_id", "left")
             .join(psy.hint("merge"), "employee_id", "left")
             .join(disc.hint("merge"), "employee_id", "left"))
    m = MAIN_WEIGHTS_V2
    parts = j.select(
        "employee_id", "comp_score",
        F.coalesce("str_score", F.lit(0.0)).alias("str_score"),
        F.coalesce("psy_score", F.lit(0.5)).alias("psy_score"),
        disc_bonus_expr(F.col("disc"), F.col("comp_score")).alias("disc_bonus"),
    )
    raw = (F.lit(m["comp"]) * F.col("comp_score") + F.lit(m["str"]) * F.col("str_score")
           + F.lit(m["psy"]) * F.col("psy_score") + F.col("disc_bonus"))
    return parts.withColumn("raw", raw)


def success_score_v2(parts: DataFrame, materialize: bool = False) -> DataFrame:
    """employee_id, success_v2 (min-max of raw over the base), and the four parts.

    The parts feed both the min/max aggregate and the rows; identical exchanges are reused, so by
    default the parts are not checkpointed here (measured: no gain). Callers that read the score in
    several passes (the ranking metrics) cut lineage on the scored frame instead.
    """
    if materialize:
        parts = cut_lineage(parts)
    s = attach_scalars(parts, F.min("raw").alias("_lo"), F.max("raw").alias("_hi"))
    return s.select("employee_id", minmax_expr("raw", F.col("_lo"), F.col("_hi")).alias("success_v2"),
                    "comp_score", "str_score", "psy_score", "disc_bonus")
