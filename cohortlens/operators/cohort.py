"""Cohort comparison and association statistics, all metrics in one job ("stay long").

Input for the two-sample operators is a long frame ``(metric, value, label)`` with label 1 = high cohort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import safe_div
from cohortlens.functions.distributions import chi2_sf, mwu_exact_p, normal_two_sided_p
from cohortlens.operators.prefix import collapse_by_value, running_by_value
from cohortlens.operators.scale import broadcast_if_small, with_scalars
from cohortlens.session import cut_lineage

EXACT_GROUP = 8        # the exact distribution of U is used if one group has at most so many values, all different,
EXACT_CELLS = 2_000    # and the product of the group sizes is at most this


def _hi(label: str):
    return F.col(label) == 1


def cohort_compare(long: DataFrame, metric: str = "metric", value: str = "value", label: str = "label") -> DataFrame:
    """Per metric: mean_high, mean_non, delta, cohens_d, n_high, n_non (NULL values dropped).

    Cohen's d uses the pooled sample variance; fewer than 2 values in either cohort -> NULL;
    pooled sd of 0 or NULL -> 0.0.
    """
    v = F.col(value).cast("double")
    hi, lo = F.when(_hi(label), v), F.when(~_hi(label), v)
    a = long.groupBy(metric).agg(
        F.avg(hi).alias("mean_high"), F.avg(lo).alias("mean_non"),
        F.count(hi).alias("n_high"), F.count(lo).alias("n_non"),
        F.var_samp(hi).alias("_vh"), F.var_samp(lo).alias("_vn"),
    )
    nh, nn = F.col("n_high"), F.col("n_non")
    pooled = F.sqrt(safe_div((nh - 1) * F.col("_vh") + (nn - 1) * F.col("_vn"), nh + nn - 2))
    d = (F.when((nh < 2) | (nn < 2), F.lit(None).cast("double"))
         .when(pooled.isNull() | (pooled == 0) | F.isnan(pooled), F.lit(0.0))
         .otherwise(safe_div(F.col("mean_high") - F.col("mean_non"), pooled)))
    return a.select(metric, "mean_high", "mean_non", (F.col("mean_high") - F.col("mean_non")).alias("delta"),
                    d.alias("cohens_d"), "n_high", "n_non")


def mann_whitney_u(long: DataFrame, metric: str = "metric", value: str = "value", label: str = "label",
                   buckets: int | None = None) -> DataFrame:
    """Per metric: u_stat (U of the high cohort), p_mwu (two-sided), n_high, n_non. An empty cohort gives NULL.

    p is exact for a small group without ties (EXACT_GROUP, EXACT_CELLS), else asymptotic with tie and continuity
    correction.

    Exact average ranks come from the value-collapsed table and a distributed running count.
    """
    g = collapse_by_value(long.select(metric, value, label), [metric], value, label)
    return mann_whitney_collapsed(g, metric, value, buckets)


def mann_whitney_collapsed(g: DataFrame, metric: str, value: str, buckets: int | None = None) -> DataFrame:
    """Mann-Whitney U from a collapsed table (metric, value, pos, n)."""
    r = running_by_value(g, [metric], value, ("n",), buckets=buckets)
    before = F.col("cum_n") - F.col("n")
    rank = before + (F.col("n") + 1) / 2.0
    s = r.groupBy(metric).agg(
        F.sum(F.col("pos") * rank).alias("_r1"),
        F.sum(F.col("pos")).alias("n_high"),
        F.sum("n").alias("_N"),
        F.sum(F.col("n").cast("double") ** 3 - F.col("n")).alias("_ties"),
    )
    return s.select(metric, *_mwu_cols()).select(metric, "u_stat", "p_mwu", "n_high", "n_non")


def _mwu_cols():
    n1 = F.col("n_high").cast("double")
    N = F.col("_N").cast("double")
    n0 = N - n1
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2.0
    u = F.greatest(u1, n1 * n0 - u1)
    mu = n1 * n0 / 2.0
    sigma = F.sqrt(n1 * n0 / 12.0 * ((N + 1) - safe_div(F.col("_ties"), N * (N - 1))))
    z = safe_div(u - mu - 0.5, sigma)
    exact = (F.col("_ties") == 0) & (F.least(n1, n0) <= EXACT_GROUP) & (n1 * n0 <= EXACT_CELLS)
    p = F.when((n1 == 0) | (n0 == 0), F.lit(None).cast("double")) \
         .when(exact, mwu_exact_p(u1, n1, n0)) \
         .when(sigma.isNull() | (sigma <= 0), F.lit(1.0)) \
         .otherwise(normal_two_sided_p(z))
    return [F.when((n1 == 0) | (n0 == 0), F.lit(None).cast("double")).otherwise(u1).alias("u_stat"),
            p.alias("p_mwu"), F.col("n_high"), (F.col("_N") - F.col("n_high")).alias("n_non")]


def cohort_compare_collapsed(g: DataFrame, metric: str, value: str) -> DataFrame:
    """cohort_compare from the collapsed table (metric, value, pos, n): cohort sums give the means,
    then a second pass over the (small) collapsed table gives sum n * (v - mean)^2 per cohort, which is
    numerically stable (no sum-of-squares cancellation)."""
    v = F.col(value).cast("double")
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    s1 = g.groupBy(metric).agg(F.sum(pos).alias("n_high"), F.sum(neg).alias("n_non"),
                               F.sum(v * pos).alias("_sh"), F.sum(v * neg).alias("_sn"))
    s1 = s1.withColumn("mean_high", safe_div(F.col("_sh"), F.col("n_high"))) \
           .withColumn("mean_non", safe_div(F.col("_sn"), F.col("n_non")))
    dev = g.join(broadcast_if_small(s1.select(metric, "mean_high", "mean_non")), metric).groupBy(metric).agg(
        F.sum(pos * (v - F.col("mean_high")) ** 2).alias("_m2h"),
        F.sum(neg * (v - F.col("mean_non")) ** 2).alias("_m2n"))
    a = s1.join(dev, metric)
    nh, nn = F.col("n_high"), F.col("n_non")
    pooled = F.sqrt(safe_div(F.col("_m2h") + F.col("_m2n"), nh + nn - 2))
    d = (F.when((nh < 2) | (nn < 2), F.lit(None).cast("double"))
         .when(pooled.isNull() | (pooled == 0) | F.isnan(pooled), F.lit(0.0))
         .otherwise(safe_div(F.col("mean_high") - F.col("mean_non"), pooled)))
    return a.select(metric, "mean_high", "mean_non", (F.col("mean_high") - F.col("mean_non")).alias("delta"),
                    d.alias("cohens_d"), "n_high", "n_non")


def cohort_report(long: DataFrame, metric: str = "metric", value: str = "value", label: str = "label",
                  buckets: int | None = None) -> DataFrame:
    """cohort_compare + p_mwu for all metrics from ONE scan of the input: both are computed from the
    value-collapsed table (metric, value, positives, rows)."""
    g = cut_lineage(collapse_by_value(long.select(metric, value, label), [metric], value, label))
    base = cohort_compare_collapsed(g, metric, value)
    mw = mann_whitney_collapsed(g, metric, value, buckets).select(metric, "p_mwu")
    return base.join(mw, metric, "left")


def rate_by_category(df: DataFrame, category: str, label: str = "label", scale: float = 1.0) -> DataFrame:
    """Mean of a 0/1 label per category (NULL category dropped), times ``scale``; with n."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg((F.avg(F.col(label).cast("double")) * F.lit(scale)).alias("pct_high"),
                 F.count(F.lit(1)).alias("n")))


def rate_by_factor(df: DataFrame, factors: Sequence[str], label: str = "label", scale: float = 100.0) -> DataFrame:
    """Rates for several factor columns in one aggregate: unpivot once, group by (factor, category)."""
    stacked = df.select(
        F.col(label),
        F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("category"))
                            for f in factors])).alias("_fc"))
    stacked = stacked.select("_fc.factor", "_fc.category", label)
    return (stacked.where(F.col("category").isNotNull()).groupBy("factor", "category")
            .agg((F.avg(F.col(label).cast("double")) * F.lit(scale)).alias("pct_high"),
                 F.count(F.lit(1)).alias("n")))


def crosstab_rates(df: DataFrame, category: str, label: str = "label") -> DataFrame:
    """Row proportions of a category x {0,1} crosstab: pct_high, pct_non (fractions), n.

    Rows with NULL category or label are dropped; both columns exist even when one label is absent.
    """
    d = df.where(F.col(category).isNotNull() & F.col(label).isNotNull())
    return d.groupBy(category).agg(
        F.avg((F.col(label) == 1).cast("double")).alias("pct_high"),
        F.avg((F.col(label) != 1).cast("double")).alias("pct_non"),
        F.count(F.lit(1)).alias("n"))


def share_by_cohort(df: DataFrame, category: str, label: str = "label", scale: float = 100.0) -> DataFrame:
    """Share of each category within each cohort (percent of the cohort's rows), wide, missing -> 0.

    Columns: category, pct_nonhigh, pct_high, delta_pct.
    """
    d = df.where(F.col(category).isNotNull())  # NULL categories are not counted (as a pandas groupby)
    counts = d.groupBy(category, label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(label).agg(F.sum("n").alias("total"))  # from the counts: one row per label value
    pct = counts.join(broadcast_if_small(totals), label).withColumn("pct", safe_div(F.col("n"), F.col("total")) * F.lit(scale))
    wide = pct.groupBy(category).agg(
        F.coalesce(F.max(F.when(F.col(label) == 0, F.col("pct"))), F.lit(0.0)).alias("pct_nonhigh"),
        F.coalesce(F.max(F.when(F.col(label) == 1, F.col("pct"))), F.lit(0.0)).alias("pct_high"))
    return wide.withColumn("delta_pct", F.col("pct_high") - F.col("pct_nonhigh"))


def chi2_test(df: DataFrame, category: str, label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """Chi-square test of independence category x label (+ Cramer's V), per ``groups``.

    Zero cells count, each with its expected count E, without building the category x label grid: the labels a
    category lacks have N minus the totals of those it has, in whole numbers, so nothing is lost at large N. For a
    2x2 table (dof 1) the Yates correction applies; there |O-E| is the same D in all four cells, so
    chi2 = (D - min(0.5, D))^2 * N * sum(1/r) * sum(1/c). A single category or label level -> NULL statistics.
    The label totals go to the categories as one map per group. Columns: groups..., chi2, dof, p_value,
    cramers_v, n, n_categories, n_labels.
    """
    groups = list(groups)
    d = df.where(F.col(category).isNotNull() & F.col(label).isNotNull())
    cells = d.groupBy(*groups, category, F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_o"))
    labels = cells.groupBy(*groups, "_l").agg(F.sum("_o").alias("_c")).groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct("_l", "_c"))).alias("_totals"),
        F.sum("_c").alias("n"), F.count(F.lit(1)).alias("n_labels"), F.sum(F.lit(1.0) / F.col("_c")).alias("_inv_c"))
    rows = cells.groupBy(*groups, category).agg(F.sum("_o").alias("_r"),
                                                F.collect_list(F.struct("_l", "_o")).alias("_cells"))
    full = rows.join(labels, groups) if groups else with_scalars(rows, labels)
    n, r = F.col("n").cast("double"), F.col("_r").cast("double")

    def expected(x):
        return r * F.element_at("_totals", x["_l"]) / n

    def dev(x):
        return F.abs(x["_o"] - expected(x))
    zero = F.lit(0.0)
    observed = F.aggregate("_cells", zero, lambda s, x: s + dev(x) * dev(x) / expected(x))
    lacking = F.col("n") - F.aggregate("_cells", F.lit(0).cast("long"), lambda s, x: s + F.element_at("_totals", x["_l"]))
    stat = full.groupBy(*groups, "n", "n_labels", "_inv_c").agg(
        F.sum(observed + r * lacking / n).alias("_obs"), F.max(F.array_max(F.transform("_cells", dev))).alias("_d"),
        F.count(F.lit(1)).alias("n_categories"), F.sum(F.lit(1.0) / r).alias("_inv_r"))
    yates = (F.col("n_categories") == 2) & (F.col("n_labels") == 2)
    dc = F.col("_d") - F.least(F.lit(0.5), F.col("_d"))
    raw = F.when(yates, dc * dc * n * F.col("_inv_r") * F.col("_inv_c")).otherwise(F.col("_obs"))
    valid = (F.col("n_categories") >= 2) & (F.col("n_labels") >= 2)
    dof = ((F.col("n_categories") - 1) * (F.col("n_labels") - 1)).cast("int")
    k = F.least(F.col("n_categories"), F.col("n_labels")) - 1
    return stat.select(
        *groups, F.when(valid, raw).alias("chi2"), F.when(valid, dof).alias("dof"),
        F.when(valid, chi2_sf(raw, dof)).alias("p_value"),
        F.when(valid, F.sqrt(safe_div(raw, n * k))).alias("cramers_v"),
        F.col("n").cast("long").alias("n"), F.col("n_categories").cast("long").alias("n_categories"),
        F.col("n_labels").cast("long").alias("n_labels"))

