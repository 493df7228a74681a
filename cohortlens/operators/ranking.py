"""Exact ranking metrics of a score against a 0/1 label, per optional key (metric / group / grid id).

All metrics run on the value-collapsed table (one row per distinct score) with distributed running
sums, in one aggregate; precision/capture at K take their cut from the same aggregate and rank by id
(ties broken by id ascending) only the rows of a tie group, holding both labels, that the cut splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import safe_div
from cohortlens.operators.prefix import collapse_by_value, rank_rows, running_by_value
from cohortlens.operators.scale import with_scalars
from cohortlens.session import cut_lineage

CUTS_SENT = 100_000  # cut rows (under 100 bytes each) that are broadcast to find the rows of split ties

def curve_table(df: DataFrame, score: str, label: str, keys: Sequence[str] = (),
                buckets: int | None = None) -> DataFrame:
    """One row per (keys, distinct score): pos, n, cum_pos/cum_n (ascending, inclusive),
    tot_pos/tot_n, and dpos/dn = counts at or above the score (the descending cumulative)."""
    g = collapse_by_value(df.select(*keys, score, label), keys, score, label)
    r = running_by_value(g, keys, score, ("pos", "n"), buckets=buckets)
    return r.withColumn("dpos", F.col("tot_pos") - F.col("cum_pos") + F.col("pos")) \
            .withColumn("dn", F.col("tot_n") - F.col("cum_n") + F.col("n"))


def _summary(ct: DataFrame, keys: Sequence[str], score: str = "", ks: Sequence[float] = ()) -> DataFrame:
    """One row per key from one pass over a curve table: roc_auc, pr_auc (average precision), ks, n, n_pos, and per
    entry i of ``ks`` the struct ``_c<i>``: the one distinct score that holds the m-th row from the top.

    In the struct: m = max(1, ceil(k * n)), the score (cut), how many rows of its tie are in the top (r), positives
    above it, positives and rows of the tie.
    """
    P = F.col("tot_pos").cast("double")
    Nn = (F.col("tot_n") - F.col("tot_pos")).cast("double")
    rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0
    f1 = safe_div(F.col("cum_pos"), P)
    f0 = safe_div(F.col("cum_n") - F.col("cum_pos"), Nn)
    above = F.col("dn") - F.col("n")
    cuts = []
    for i, k in enumerate(ks):
        m = F.least(F.greatest(F.lit(1), F.ceil(F.lit(float(k)) * F.col("tot_n"))), F.col("tot_n"))
        cuts.append(F.max(F.when((above < m) & (m <= F.col("dn")), F.struct(
            F.col(score).alias("cut"), m.alias("m"), (m - above).alias("r"),
            (F.col("dpos") - F.col("pos")).alias("above_pos"), F.col("pos").alias("tie_pos"),
            F.col("n").alias("tie_n")))).alias(f"_c{i}"))
    a = ct.groupBy(*keys, "tot_pos", "tot_n").agg(
        F.sum(F.col("pos") * rank).alias("_r1"),
        F.sum(F.when(P > 0, safe_div(F.col("pos"), P) * safe_div(F.col("dpos"), F.col("dn")))).alias("_ap"),
        F.max(F.when((P > 0) & (Nn > 0), F.abs(f1 - f0))).alias("_ks"), *cuts)
    both = (P > 0) & (Nn > 0)
    u1 = F.col("_r1") - P * (P + 1) / 2.0
    return a.select(
        *keys,
        F.when(both, safe_div(u1, P * Nn)).alias("roc_auc"),
        F.when(P > 0, F.col("_ap")).alias("pr_auc"),
        F.when(both, F.col("_ks")).alias("ks"),
        F.col("tot_n").alias("n"), F.col("tot_pos").alias("n_pos"),
        *[F.col(f"_c{i}") for i in range(len(ks))],
    )


def _threshold_metrics(ct: DataFrame, keys: Sequence[str]) -> DataFrame:
    """roc_auc, pr_auc (average precision), ks per key from a curve table."""
    return _summary(ct, keys)


def roc_auc(df, score, label, keys=(), buckets=None) -> DataFrame:
    return _threshold_metrics(curve_table(df, score, label, keys, buckets), keys).select(*keys, "roc_auc")


def average_precision(df, score, label, keys=(), buckets=None) -> DataFrame:
    return _threshold_metrics(curve_table(df, score, label, keys, buckets), keys).select(*keys, "pr_auc")


def ks_statistic(df, score, label, keys=(), buckets=None) -> DataFrame:
    return _threshold_metrics(curve_table(df, score, label, keys, buckets), keys).select(*keys, "ks")


def _k_name(k: float) -> str:
    return f"{k * 100:.6g}".replace(".", "_")


def _with_top(df: DataFrame, score: str, label: str, id_col: str, ks: Sequence[float], keys: Sequence[str],
              buckets: int | None) -> DataFrame:
    """The summary of every key plus prec_<k> and capt_<k> for every k.

    Every row above the cut is in the top, and of the tie at the cut the first r by id are. Only a tie holding both
    labels needs those rows found, so only its rows are ranked by id, with the distributed ``rank_rows`` (a hot tied
    value is split by id over range partitions).
    """
    keys = list(keys)
    d = df.select(*keys, score, label, id_col).where(F.col(score).isNotNull())
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    # one row per key; read by the check for split ties and by the result
    s = cut_lineage(_summary(curve_table(d, score, label, keys, buckets), keys, score, ks))
    listed = s.select(*keys, F.posexplode(F.array(*[F.col(f"_c{i}") for i in range(len(ks))])).alias("_ki", "_c"))
    mixed = listed.where("_c.tie_pos > 0 and _c.tie_pos < _c.tie_n")
    n_mixed = mixed.count()
    names = [f"_t{i}" for i in range(len(ks))]
    if n_mixed:
        # distinct names on the cut side, so the join needs no qualified (self-join) references
        m = mixed.select(*[F.col(k).alias(f"_jk{i}") for i, k in enumerate(keys)], "_ki", F.col("_c.cut").alias("_cut"),
                         F.col("_c.r").alias("_r"))
        m = F.broadcast(m) if n_mixed <= CUTS_SENT else m
        cond = [F.col(k) == F.col(f"_jk{i}") for i, k in enumerate(keys)] + [F.col(score) == F.col("_cut")]
        rows = d.join(m, cond).select(*keys, "_ki", "_r", id_col, label)
        ranked = rank_rows(rows, [F.col(id_col).asc(), F.col(label).desc()], [*keys, "_ki"], buckets)
        tie = ranked.where(F.col("rank") <= F.col("_r")).groupBy(*keys).agg(
            *[F.sum(F.when(F.col("_ki") == i, F.col(label).cast("long")).otherwise(0)).alias(n)
              for i, n in enumerate(names)])
        s = s.join(tie, keys, "left") if keys else with_scalars(s, tie)
    else:
        s = s.select("*", *[F.lit(0).cast("long").alias(n) for n in names])
    out = []
    for i, k in enumerate(ks):
        c = F.col(f"_c{i}")
        in_tie = F.when(c["tie_pos"] == 0, F.lit(0)).when(c["tie_pos"] == c["tie_n"], c["r"]) \
            .otherwise(F.coalesce(F.col(names[i]), F.lit(0)))
        hits = c["above_pos"] + in_tie
        out += [safe_div(hits, c["m"]).alias(f"prec_{_k_name(k)}"),
                F.when(F.col("n_pos") > 0, safe_div(hits, F.col("n_pos"))).alias(f"capt_{_k_name(k)}")]
    return s.select(*keys, "roc_auc", "pr_auc", "ks", "n", "n_pos", *out)


def top_fraction(df: DataFrame, score: str, label: str, id_col: str, ks: Sequence[float] = (0.1, 0.2),
                 keys: Sequence[str] = (), buckets: int | None = None, with_counts: bool = False) -> DataFrame:
    """precision@k and capture@k per key for every k: top m = max(1, ceil(k*n)) rows by
    (score desc, id asc, label desc). Columns: keys..., prec_<k>, capt_<k> (capture NULL without
    positives), plus n and n_pos when ``with_counts``. Rows with a NULL score or NULL key are left out."""
    a = _with_top(df, score, label, id_col, ks, keys, buckets)
    cols = [c for k in ks for c in (f"prec_{_k_name(k)}", f"capt_{_k_name(k)}")]
    return a.select(*keys, *cols, *(["n", "n_pos"] if with_counts else []))


def precision_at_k(df, score, label, id_col, k=0.1, keys=(), buckets=None) -> DataFrame:
    return top_fraction(df, score, label, id_col, (k,), keys, buckets).select(*keys, f"prec_{_k_name(k)}")


def capture_at_k(df, score, label, id_col, k=0.1, keys=(), buckets=None) -> DataFrame:
    return top_fraction(df, score, label, id_col, (k,), keys, buckets).select(*keys, f"capt_{_k_name(k)}")


def evaluate_all(df: DataFrame, score: str, label: str, id_col: str, keys: Sequence[str] = (),
                 ks: Sequence[float] = (0.1, 0.2), with_ks: bool = True, buckets: int | None = None) -> DataFrame:
    """roc_auc, pr_auc, prec_/capt_ for each k, and ks, one row per key, all from one pass over one curve table."""
    a = _with_top(df, score, label, id_col, ks, keys, buckets)
    cols = ["roc_auc", "pr_auc"] + [c for k in ks for c in (f"prec_{_k_name(k)}", f"capt_{_k_name(k)}")]
    return a.select(*keys, *cols, *(["ks"] if with_ks else []))


def roc_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score (descending thresholds) plus the (0, 0) start point,
    whose threshold is NULL. Collinear points are kept (the area is the same)."""
    ct = curve_table(df, score, label, keys, buckets)
    P = F.col("tot_pos").cast("double")
    Nn = (F.col("tot_n") - F.col("tot_pos")).cast("double")
    point = F.struct(F.col(score).cast("double").alias("threshold"),
                     F.when(Nn > 0, safe_div(F.col("dn") - F.col("dpos"), Nn)).alias("fpr"),
                     F.when(P > 0, safe_div(F.col("dpos"), P)).alias("tpr"))
    start = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return _with_end(ct, keys, point, start)


def roc_auc_trapezoid(df: DataFrame, score: str, label: str, keys: Sequence[str] = (),
                      buckets: int | None = None) -> DataFrame:
    """Trapezoid area under the ROC points. Each distinct score adds the trapezoid between the point
    above it and its own point, (neg/Nn) * (tpr_prev + tpr) / 2, so no ordered window is needed."""
    ct = curve_table(df, score, label, keys, buckets)
    P = F.col("tot_pos").cast("double")
    Nn = (F.col("tot_n") - F.col("tot_pos")).cast("double")
    neg = (F.col("n") - F.col("pos")).cast("double")
    tpr, tpr_prev = safe_div(F.col("dpos"), P), safe_div(F.col("dpos") - F.col("pos"), P)
    a = ct.groupBy(*keys, "tot_pos", "tot_n").agg(F.sum(safe_div(neg, Nn) * (tpr + tpr_prev) / 2.0).alias("_a"))
    return a.select(*keys, F.when((P > 0) & (Nn > 0), F.col("_a")).alias("auc"))


def pr_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the final (recall 0, precision 1) point
    with a NULL threshold. All thresholds are kept."""
    ct = curve_table(df, score, label, keys, buckets)
    P = F.col("tot_pos").cast("double")
    point = F.struct(F.col(score).cast("double").alias("threshold"),
                     safe_div(F.col("dpos"), F.col("dn")).alias("precision"),
                     F.when(P > 0, safe_div(F.col("dpos"), P)).otherwise(F.lit(1.0)).alias("recall"))
    end = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall"))
    return _with_end(ct, keys, point, end)


def _with_end(ct: DataFrame, keys: Sequence[str], point: Column, end: Column) -> DataFrame:
    """One point per row of the curve table; the row of the highest score brings the curve's end point as well."""
    highest = F.col("dn") == F.col("n")
    return ct.select(*keys, F.explode(F.when(highest, F.array(point, end)).otherwise(F.array(point))).alias("_p")) \
        .select(*keys, "_p.*")


def precision_at_k_by_group(df: DataFrame, group_cols: Sequence[str], score: str, label: str, id_col: str,
                            k: float = 0.1, min_n: int = 30, buckets: int | None = None) -> DataFrame:
    """Precision@k inside each group of each factor, groups with n >= min_n, uplift over the global
    base rate in percentage points. Output: factor, grp, prec_<k>, uplift_vs_base_pp, n.

    All factors in one job: rows are unpivoted to (factor, grp) once; NULL groups are dropped.
    """
    name = _k_name(k)
    stacked = df.select(
        score, label, id_col,
        F.explode(F.array(*[F.struct(F.lit(g).alias("factor"), F.col(g).cast("string").alias("grp"))
                            for g in group_cols])).alias("_fg"),
    ).select("_fg.factor", "_fg.grp", score, label, id_col).where(F.col("grp").isNotNull())
    top = top_fraction(stacked, score, label, id_col, (k,), ["factor", "grp"], buckets, with_counts=True)
    base = df.agg(F.avg((F.col(label) == 1).cast("double")).alias("_base"))  # one row
    res = with_scalars(top.where(F.col("n") >= min_n), base)
    return res.select("factor", "grp", F.col(f"prec_{name}"),
                      ((F.col(f"prec_{name}") - F.col("_base")) * 100.0).alias("uplift_vs_base_pp"), "n")
