"""Reports R1-R8: cohort comparisons, shares, association tests, context rates, group precision.

Each report is one plan over the bundle; metric loops of the reference become a ``metric`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import bin_right_closed, label_cohort, mbti_letter, mbti_normalise
from cohortlens.operators.cohort import chi2_test, cohort_report, crosstab_rates, rate_by_factor, share_by_cohort
from cohortlens.operators.ranking import precision_at_k_by_group
from cohortlens.plans.inputs import Bundle

COGNITIVE_METRICS = ("pauli", "faxtor", "iq", "gtq", "tiki")
MBTI_DIMENSIONS = ("EI", "SN", "TF", "JP")
CONTEXT_FACTORS = ("grade", "education", "major")


def _labelled(b: Bundle, df: DataFrame, how: str = "inner") -> DataFrame:
    """``df`` with the label of the latest rating.

    The planner rates the exploded scales by the size of their Parquet columns and would broadcast them through the
    driver, so the join is told to shuffle both sides; the labels, one row per employee, are the hashed one.
    """
    lab = b.perf_latest.select("employee_id", "rating").hint("shuffle_hash")
    return df.join(lab, "employee_id", how).withColumn("label", label_cohort("rating"))


def report_competency(b: Bundle) -> DataFrame:
    """pillar_code, pillar_label, mean_high, mean_non, delta, cohens_d, p_mwu, n_high, n_non."""
    long = _labelled(b, b.comp_latest).select(F.col("pillar_code").alias("metric"),
                                              F.col("score").alias("value"), "label")
    r = cohort_report(long).withColumnRenamed("metric", "pillar_code")
    r = r.join(b.pillar_labels, "pillar_code", "left")  # one row per pillar on the left
    return r.select("pillar_code", "pillar_label", "mean_high", "mean_non", "delta", "cohens_d", "p_mwu",
                    "n_high", "n_non").orderBy(F.col("cohens_d").desc(), F.col("delta").desc())


def report_papi(b: Bundle) -> DataFrame:
    """scale, mean_high, mean_non, delta, cohens_d, p_mwu (one row per PAPI scale)."""
    long = _labelled(b, b.papi).select(F.col("scale_code").alias("metric"), F.col("score").alias("value"), "label")
    r = cohort_report(long)
    return r.select(F.col("metric").alias("scale"), "mean_high", "mean_non", "delta", "cohens_d", "p_mwu") \
            .orderBy(F.col("cohens_d").desc())


def report_cognitive(b: Bundle, metrics=COGNITIVE_METRICS) -> DataFrame:
    """metric, mean_high, mean_non, delta, cohens_d, p_mwu for pauli, faxtor, iq, gtq, tiki."""
    ab = _labelled(b, b.psych)
    present = [m for m in metrics if m in ab.columns]
    long = ab.select("label", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                          F.col(m).cast("double").alias("value"))
                                                 for m in present])).alias("_mv")) \
             .select("_mv.metric", "_mv.value", "label")
    return cohort_report(long).select("metric", "mean_high", "mean_non", "delta", "cohens_d", "p_mwu") \
            .orderBy(F.col("cohens_d").desc())


def report_strengths(b: Bundle) -> DataFrame:
    """theme, pct_nonhigh, pct_high, delta_pct (percent of the cohort's theme records)."""
    ab = _labelled(b, b.strengths)
    return share_by_cohort(ab, "theme", "label").select("theme", "pct_nonhigh", "pct_high", "delta_pct") \
            .orderBy(F.col("delta_pct").desc())


def _psych_labelled(b: Bundle) -> DataFrame:
    """Cleaned psych left-joined to the latest rating: employees without rating count as non-high."""
    return _labelled(b, b.psych_fixed, "left")


def report_disc(b: Bundle) -> DataFrame:
    """disc, pct_high, pct_non, n (fractions)."""
    return crosstab_rates(_psych_labelled(b), "disc", "label").select("disc", "pct_high", "pct_non", "n") \
            .orderBy(F.col("pct_high").desc())


def report_disc_test(b: Bundle) -> DataFrame:
    """chi2, dof, p_value, cramers_v, n, n_categories, n_labels for DISC x high."""
    return chi2_test(_psych_labelled(b), "disc", "label")


def _mbti_long(b: Bundle) -> DataFrame:
    p = _psych_labelled(b).select("label", mbti_normalise("mbti").alias("mbti")).where(F.col("mbti").isNotNull())
    dims = F.array(*[F.struct(F.lit(d).alias("dimension"), mbti_letter(F.col("mbti"), i + 1).alias("letter"))
                     for i, d in enumerate(MBTI_DIMENSIONS)])
    return p.select("label", F.explode(dims).alias("_d")).select("_d.dimension", "_d.letter", "label")


def report_mbti_test(b: Bundle) -> DataFrame:
    """Per dimension: chi2 (Yates for 2x2), dof, p_value, cramers_v, n; dimensions with a single
    letter or label give NULL statistics."""
    return chi2_test(_mbti_long(b), "letter", "label", groups=["dimension"])


def report_mbti_dimensions(b: Bundle) -> DataFrame:
    """dimension, letter, pct_high, pct_non, n for dimensions with >= 2 letters and both labels."""
    long = _mbti_long(b)
    rates = long.groupBy("dimension", "letter").agg(
        F.avg((F.col("label") == 1).cast("double")).alias("pct_high"),
        F.avg((F.col("label") != 1).cast("double")).alias("pct_non"),
        F.count(F.lit(1)).alias("n"))
    # a dimension is reported when it has >= 2 letters and both labels; decided from the rates themselves
    ok = rates.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("_nl"),
        F.sum(F.col("pct_high") * F.col("n")).alias("_hi"), F.sum(F.col("pct_non") * F.col("n")).alias("_lo")) \
        .where((F.col("_nl") >= 2) & (F.col("_hi") > 0) & (F.col("_lo") > 0)).select("dimension")
    r = rates.join(ok, "dimension", "left_semi")
    return r.select("dimension", "letter", "pct_high", "pct_non", "n") \
            .orderBy("dimension", F.instr(F.col("dimension"), F.col("letter")))


def report_mbti_types(b: Bundle, min_n: int = 30) -> DataFrame:
    """mbti, pct_high, pct_non, n for types with n >= min_n."""
    p = _psych_labelled(b).select("label", mbti_normalise("mbti").alias("mbti"))
    return crosstab_rates(p, "mbti", "label").where(F.col("n") >= min_n) \
        .select("mbti", "pct_high", "pct_non", "n").orderBy(F.col("pct_high").desc(), F.col("n").desc())


def report_contextual(b: Bundle) -> DataFrame:
    """factor, category, pct_high (percent) for grade, education, major and tenure bins."""
    ab = _labelled(b, b.employees_org)
    ab = ab.withColumn("years_of_service", bin_right_closed(F.col("years_of_service_months").cast("double") / 12.0))
    r = rate_by_factor(ab, [*CONTEXT_FACTORS, "years_of_service"], "label", 100.0)
    return r.select("factor", "category", "pct_high").orderBy(F.col("factor"), F.col("pct_high").desc())


def report_group_precision(eval_frame: DataFrame, b: Bundle, k: float = 0.1, min_n: int = 30) -> DataFrame:
    """factor, grp, prec_10, uplift_vs_base_pp, n: precision@k inside education/grade/major groups."""
    org = b.employees_org.select("employee_id", "education", "grade", "major")
    res = eval_frame.join(org, "employee_id", "left")
    out = precision_at_k_by_group(res, ["education", "grade", "major"], "success_v2", "is_high", "employee_id",
                                  k=k, min_n=min_n)
    return out.orderBy(F.col("factor"), F.col(out.columns[2]).desc())
