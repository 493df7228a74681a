"""Catalogue: cohort statistics, association tests, scaling and ranking metrics on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.columns import YOS_LABELS, bin_right_closed, clip
from cohortlens.operators import cohort, ranking
from cohortlens.operators.scale import minmax01, zscore, zscore_clip
from cohortlens.plans.oracle_sql import curve_sql, evaluate_sql, mwu_sql, threshold_sql, top_sql, chi2_sf_sql
from cohortlens.plans.registry import query
from cohortlens.sources.tables import read_table

LI_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


# ---- inputs ---------------------------------------------------------------------------------------
def lineitem_long(spark, sf_dir):
    """(metric, value, label): four lineitem measures, label = returned ('R')."""
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", *LI_METRICS])
    lab = F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).cast("int").alias("label")
    mv = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in LI_METRICS])
    return li.select(lab, F.explode(mv).alias("_mv")).select("_mv.metric", "_mv.value", "label")


LI_LONG_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS v, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y "
    f"FROM lineitem" for m in LI_METRICS)


def orders_customers(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.withColumn("label", F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).cast("int"))


OC_SQL = ("SELECT o.*, c.c_mktsegment, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y "
          "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")


def lineitem_parts(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    j = li.join(p, li["l_partkey"] == p["p_partkey"]).join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select("p_type", F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).cast("int").alias("label"))


LP_SQL = ("SELECT p_type, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y FROM lineitem "
          "JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey")


def docs_scored(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars", "lang", "source"])
    return lab.join(d, "doc_id").select("doc_id", F.col("quality").cast("int").alias("label"),
                                        F.col("n_chars").cast("double").alias("score"), "lang", "source")


DOCS_SQL = ("SELECT quality AS y, CAST(n_chars AS DOUBLE) AS v, doc_id AS id, lang, source "
            "FROM labels JOIN documents USING (doc_id)")
ORD_SQL = ("SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y, o_totalprice AS v, "
           "o_orderkey AS id, o_orderstatus FROM orders")


def orders_scored(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"])
    return o.select(F.col("o_orderkey").alias("id"),
                    F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).cast("int").alias("label"),
                    F.col("o_totalprice").alias("score"), "o_orderstatus")


# ---- two-sample statistics ------------------------------------------------------------------------
COHORT_SQL = f"""
SELECT metric, mh AS mean_high, mn AS mean_non, mh - mn AS delta,
  CASE WHEN nh < 2 OR nn < 2 THEN NULL WHEN pooled IS NULL OR pooled = 0 OR isnan(pooled) THEN 0.0
       ELSE (mh - mn) / pooled END AS cohens_d, nh AS n_high, nn AS n_non
FROM (SELECT *, sqrt(((nh - 1) * vh + (nn - 1) * vn) / (nh + nn - 2)) AS pooled FROM (
  SELECT metric, avg(CASE WHEN y = 1 THEN v END) AS mh, avg(CASE WHEN y <> 1 THEN v END) AS mn,
         count(CASE WHEN y = 1 THEN v END) AS nh, count(CASE WHEN y <> 1 THEN v END) AS nn,
         var_samp(CASE WHEN y = 1 THEN v END) AS vh, var_samp(CASE WHEN y <> 1 THEN v END) AS vn
  FROM ({LI_LONG_SQL}) s GROUP BY metric) a) b"""


@query("cohort_compare", "metric:s, mean_high:d, mean_non:d, delta:d, cohens_d:d, n_high:l, n_non:l", COHORT_SQL)
def q_cohort_compare(spark, sf_dir):
    return cohort.cohort_compare(lineitem_long(spark, sf_dir))


# the logarithm shows small p-values that six decimals would round to 0
@query("mann_whitney_u", "metric:s, u_stat:d, p_mwu:d, log10_p:d, n_high:l, n_non:l",
       f"SELECT *, CASE WHEN p_mwu > 0 THEN log10(p_mwu) END AS log10_p FROM ({mwu_sql(LI_LONG_SQL, ['metric'])}) m")
def q_mann_whitney(spark, sf_dir):
    m = cohort.mann_whitney_u(lineitem_long(spark, sf_dir))
    return m.withColumn("log10_p", F.when(F.col("p_mwu") > 0, F.log10("p_mwu")))


@query("cohort_report", "metric:s, mean_high:d, mean_non:d, delta:d, cohens_d:d, p_mwu:d, n_high:l, n_non:l",
       f"SELECT a.*, b.p_mwu FROM ({COHORT_SQL}) a JOIN ({mwu_sql(LI_LONG_SQL, ['metric'])}) b ON a.metric = b.metric")
def q_cohort_report(spark, sf_dir):
    return cohort.cohort_report(lineitem_long(spark, sf_dir))


# customers of a nation and segment, by the parity of half their key: groups of some six balances, so U has its exact
# distribution; the oracle lists every arrangement of a group's ranks and counts those with a U as small
BALANCE_SQL = ("SELECT concat(c_nationkey, '/', c_mktsegment, '/', c_custkey % 2) AS metric, c_acctbal AS v, "
               "CAST((c_custkey // 2) % 2 AS INTEGER) AS y FROM customer")
EXACT_SQL = f"""
WITH g AS (
  SELECT metric, count(*) AS n, sum(y) AS n1, count(DISTINCT v) AS d FROM ({BALANCE_SQL}) b GROUP BY metric),
small AS (
  SELECT * FROM g WHERE d = n AND least(n1, n - n1) BETWEEN 1 AND 8 AND n <= 20),
arrangement AS (
  SELECT metric, n, n1, unnest(range(0, CAST(1 AS BIGINT) << CAST(n AS INTEGER))) AS mask FROM small),
placed AS (
  SELECT metric, list_sum(list_transform(range(0, n), lambda i: CASE WHEN (mask >> CAST(i AS INTEGER)) & 1 = 1 THEN i + 1 ELSE 0 END))
         - n1 * (n1 + 1) / 2 AS u FROM arrangement WHERE bit_count(mask) = n1),
approx AS ({mwu_sql(BALANCE_SQL, ['metric'])}),
exact AS (
  SELECT p.metric, least(1.0, 2.0 * count(CASE WHEN p.u <= least(a.u_stat, a.n_high * a.n_non - a.u_stat) THEN 1 END) / count(*)) AS p
  FROM placed p JOIN approx a USING (metric) GROUP BY p.metric)
SELECT a.metric, a.u_stat, coalesce(e.p, a.p_mwu) AS p_mwu, a.n_high, a.n_non FROM approx a LEFT JOIN exact e USING (metric)"""


@query("mann_whitney_exact", "metric:s, u_stat:d, p_mwu:d, n_high:l, n_non:l", EXACT_SQL)
def q_mann_whitney_exact(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])
    group = F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment", (F.col("c_custkey") % 2).cast("string"))
    return cohort.mann_whitney_u(c.select(group.alias("metric"), F.col("c_acctbal").alias("value"),
                                          (F.floor(F.col("c_custkey") / 2) % 2).cast("int").alias("label")))


# ---- rates, crosstabs, shares, chi-square -----------------------------------------------------------
@query("rate_by_category", "c_mktsegment:s, pct_high:d, n:l",
       f"SELECT c_mktsegment, avg(CAST(y AS DOUBLE)) AS pct_high, count(*) AS n FROM ({OC_SQL}) s "
       f"WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment")
def q_rate_by_category(spark, sf_dir):
    return cohort.rate_by_category(orders_customers(spark, sf_dir), "c_mktsegment")


@query("rate_by_factor", "factor:s, category:s, pct_high:d, n:l",
       f"""SELECT factor, category, avg(CAST(y AS DOUBLE)) * 100.0 AS pct_high, count(*) AS n FROM (
  SELECT 'c_mktsegment' AS factor, c_mktsegment AS category, y FROM ({OC_SQL}) a
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, y FROM ({OC_SQL}) b) s
WHERE category IS NOT NULL GROUP BY factor, category""")
def q_rate_by_factor(spark, sf_dir):
    return cohort.rate_by_factor(orders_customers(spark, sf_dir), ["c_mktsegment", "o_orderstatus"])


@query("crosstab_rates", "p_type:s, pct_high:d, pct_non:d, n:l",
       f"SELECT p_type, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS pct_high, "
       f"avg(CASE WHEN y <> 1 THEN 1.0 ELSE 0.0 END) AS pct_non, count(*) AS n FROM ({LP_SQL}) s "
       f"WHERE p_type IS NOT NULL GROUP BY p_type")
def q_crosstab_rates(spark, sf_dir):
    return cohort.crosstab_rates(lineitem_parts(spark, sf_dir), "p_type")


@query("share_by_cohort", "p_type:s, pct_nonhigh:d, pct_high:d, delta_pct:d",
       f"""SELECT p_type, coalesce(max(CASE WHEN y = 0 THEN pct END), 0.0) AS pct_nonhigh,
  coalesce(max(CASE WHEN y = 1 THEN pct END), 0.0) AS pct_high,
  coalesce(max(CASE WHEN y = 1 THEN pct END), 0.0) - coalesce(max(CASE WHEN y = 0 THEN pct END), 0.0) AS delta_pct
FROM (SELECT c.p_type, c.y, CAST(c.n AS DOUBLE) / t.total * 100.0 AS pct
      FROM (SELECT p_type, y, count(*) AS n FROM ({LP_SQL}) s WHERE p_type IS NOT NULL GROUP BY p_type, y) c
      JOIN (SELECT y, count(*) AS total FROM ({LP_SQL}) s2 WHERE p_type IS NOT NULL GROUP BY y) t ON c.y = t.y) x
GROUP BY p_type""")
def q_share_by_cohort(spark, sf_dir):
    return cohort.share_by_cohort(lineitem_parts(spark, sf_dir), "p_type")


def chi2_grid_sql(src: str, keys=("test",)) -> str:
    """Oracle chi-square on the explicit category x label grid (zero cells included)."""
    kp = ", ".join(keys)
    on = " AND ".join(f"r.{k} = c.{k}" for k in keys)
    return f"""
SELECT {kp}, CASE WHEN nc >= 2 AND nl >= 2 THEN chi2 END AS chi2,
  CASE WHEN nc >= 2 AND nl >= 2 THEN CAST((nc - 1) * (nl - 1) AS INTEGER) END AS dof,
  CASE WHEN nc >= 2 AND nl >= 2 THEN {chi2_sf_sql('chi2', '(nc - 1) * (nl - 1)')} END AS p_value,
  CASE WHEN nc >= 2 AND nl >= 2 THEN sqrt(chi2 / (n * (least(nc, nl) - 1))) END AS cramers_v,
  n, nc AS n_categories, nl AS n_labels
FROM (
  SELECT {kp}, nc, nl, n, sum(dv * dv / e) AS chi2 FROM (
    SELECT f.*, CASE WHEN (nc - 1) * (nl - 1) = 1 THEN abs(o - e) - least(0.5, abs(o - e)) ELSE abs(o - e) END AS dv
    FROM (SELECT g.*, coalesce(cl.o, 0) AS o, d.nc, d.nl, d.n, CAST(g.r AS DOUBLE) * g.c / d.n AS e
          FROM (SELECT r.{kp.replace(', ', ', r.')}, r.cat, c.y, r.r, c.c
                FROM (SELECT {kp}, cat, count(*) AS r FROM ({src}) s WHERE cat IS NOT NULL AND y IS NOT NULL GROUP BY {kp}, cat) r
                JOIN (SELECT {kp}, y, count(*) AS c FROM ({src}) s WHERE cat IS NOT NULL AND y IS NOT NULL GROUP BY {kp}, y) c
                ON {on}) g
          JOIN (SELECT {kp}, count(DISTINCT cat) AS nc, count(DISTINCT y) AS nl, count(*) AS n
                FROM ({src}) s WHERE cat IS NOT NULL AND y IS NOT NULL GROUP BY {kp}) d
            ON {' AND '.join(f'g.{k} = d.{k}' for k in keys)}
          LEFT JOIN (SELECT {kp}, cat, y, count(*) AS o FROM ({src}) s WHERE cat IS NOT NULL AND y IS NOT NULL
                     GROUP BY {kp}, cat, y) cl
            ON {' AND '.join(f'g.{k} = cl.{k}' for k in keys)} AND g.cat = cl.cat AND g.y = cl.y) f) h
  GROUP BY {kp}, nc, nl, n) z"""


CHI_SPEC = "test:s, chi2:d, dof:i, p_value:d, cramers_v:d, n:l, n_categories:l, n_labels:l"
CHI_SRC = (f"SELECT 'segment' AS test, c_mktsegment AS cat, y FROM ({OC_SQL}) a UNION ALL "
           f"SELECT 'status_f', CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'other' END, y FROM ({OC_SQL}) b")


@query("chi2_cramers_v", CHI_SPEC, chi2_grid_sql(CHI_SRC))
def q_chi2(spark, sf_dir):
    oc = orders_customers(spark, sf_dir)
    tests = F.array(
        F.struct(F.lit("segment").alias("test"), F.col("c_mktsegment").alias("cat")),
        F.struct(F.lit("status_f").alias("test"),
                 F.when(F.col("o_orderstatus") == "F", F.lit("F")).otherwise(F.lit("other")).alias("cat")))
    long = oc.select("label", F.explode(tests).alias("_t")).select("_t.test", "_t.cat", "label")
    return cohort.chi2_test(long, "cat", "label", groups=["test"])


# ---- scaling ---------------------------------------------------------------------------------------
def _bin_sql(x: str) -> str:
    edges = (0.0, 2.0, 5.0, 10.0, 20.0, 40.0)
    whens = []
    for i in range(1, len(edges)):
        lo, hi = edges[i - 1], edges[i]
        cond = f"{x} >= {lo} AND {x} <= {hi}" if i == 1 else f"{x} > {lo} AND {x} <= {hi}"
        whens.append(f"WHEN {cond} THEN '{YOS_LABELS[i - 1]}'")
    return f"CASE {' '.join(whens)} END"


ACCT_YEARS = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal / 250.0 END"


def _acct(spark, sf_dir, div):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    return c.select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("c_acctbal") / div).alias("x"))


@query("bin_right_closed", "c_custkey:l, x:d, bin:s",
       f"SELECT c_custkey, x, {_bin_sql('x')} AS bin FROM (SELECT c_custkey, {ACCT_YEARS} AS x FROM customer) s")
def q_bin(spark, sf_dir):
    return _acct(spark, sf_dir, 250.0).withColumn("bin", bin_right_closed("x"))


@query("clip_values", "c_custkey:l, x:d, clipped:d",
       "SELECT c_custkey, x, CASE WHEN x < 0 THEN 0.0 WHEN x > 5 THEN 5.0 ELSE x END AS clipped FROM "
       "(SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal / 1000.0 END AS x FROM customer) s")
def q_clip(spark, sf_dir):
    return _acct(spark, sf_dir, 1000.0).withColumn("clipped", clip("x", 0.0, 5.0))


@query("zscore", "o_orderkey:l, x:d, z:d",
       """SELECT o_orderkey, x, CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (x - m) / sd END AS z FROM (
  SELECT o_orderkey, x, avg(x) OVER () AS m, stddev_pop(x) OVER () AS sd FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders) a) b""")
def q_zscore(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    x = o.select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("double"))
                 .otherwise(F.col("o_totalprice")).alias("x"))
    return zscore(x, "x", "z")


@query("zscore_clip", "event_id:l, x:d, z_clip:d",
       """SELECT event_id, x, CASE WHEN z < -2 THEN -2.0 WHEN z > 2 THEN 2.0 ELSE z END AS z_clip FROM (
  SELECT event_id, x, CASE WHEN sd IS NULL OR sd = 0 THEN x - m ELSE (x - m) / sd END AS z FROM (
    SELECT event_id, x, avg(x) OVER () AS m, stddev_pop(x) OVER () AS sd FROM (
      SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS x FROM events) a) b) c""")
def q_zscore_clip(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "value"])
    x = e.select("event_id", F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
                 .otherwise(F.col("value")).alias("x"))
    return zscore_clip(x, "x", "z_clip")


@query("minmax01", "c_custkey:l, c_acctbal:d, minmax:d",
       """SELECT c_custkey, c_acctbal, CASE WHEN hi = lo THEN 0.0 ELSE (c_acctbal - lo) / (hi - lo) END AS minmax
FROM (SELECT c_custkey, c_acctbal, min(c_acctbal) OVER () AS lo, max(c_acctbal) OVER () AS hi FROM customer) s""")
def q_minmax(spark, sf_dir):
    return minmax01(read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"]), "c_acctbal", "minmax")


# ---- ranking metrics -------------------------------------------------------------------------------
def _docs(spark, sf_dir):
    return docs_scored(spark, sf_dir)


@query("roc_auc", "roc_auc:d", f"SELECT roc_auc FROM ({threshold_sql(DOCS_SQL)}) t")
def q_roc_auc(spark, sf_dir):
    return ranking.roc_auc(_docs(spark, sf_dir), "score", "label")


@query("average_precision", "pr_auc:d", f"SELECT pr_auc FROM ({threshold_sql(DOCS_SQL)}) t")
def q_ap(spark, sf_dir):
    return ranking.average_precision(_docs(spark, sf_dir), "score", "label")


@query("ks_statistic", "ks:d", f"SELECT ks FROM ({threshold_sql(DOCS_SQL)}) t")
def q_ks(spark, sf_dir):
    return ranking.ks_statistic(_docs(spark, sf_dir), "score", "label")


@query("precision_at_k", "prec_10:d", f"SELECT prec_10 FROM ({top_sql(DOCS_SQL, (), (0.1,))}) t")
def q_prec(spark, sf_dir):
    return ranking.precision_at_k(_docs(spark, sf_dir), "score", "label", "doc_id", 0.1)


@query("capture_at_k", "capt_10:d", f"SELECT capt_10 FROM ({top_sql(DOCS_SQL, (), (0.1,))}) t")
def q_capt(spark, sf_dir):
    return ranking.capture_at_k(_docs(spark, sf_dir), "score", "label", "doc_id", 0.1)


@query("roc_curve", "threshold:d, fpr:d, tpr:d",
       f"""SELECT v AS threshold, CASE WHEN tn - tp > 0 THEN ((tn - cum_n + t) - (tp - cum_p + p)) / (tn - tp) END AS fpr,
  CASE WHEN tp > 0 THEN (tp - cum_p + p) / tp END AS tpr FROM ({curve_sql(DOCS_SQL)}) c
UNION ALL SELECT NULL, 0.0, 0.0""")
def q_roc_curve(spark, sf_dir):
    return ranking.roc_curve(_docs(spark, sf_dir), "score", "label")


@query("roc_auc_trapezoid", "auc:d",
       f"""SELECT CASE WHEN max(tp) > 0 AND max(tn) - max(tp) > 0 THEN
  sum((t - p) / (tn - tp) * ((tp - cum_p + p) / tp + (tp - cum_p) / tp) / 2.0) END AS auc FROM ({curve_sql(DOCS_SQL)}) c""")
def q_roc_trap(spark, sf_dir):
    return ranking.roc_auc_trapezoid(_docs(spark, sf_dir), "score", "label")


@query("pr_curve", "threshold:d, precision:d, recall:d",
       f"""SELECT v AS threshold, (tp - cum_p + p) / (tn - cum_n + t) AS precision,
  CASE WHEN tp > 0 THEN (tp - cum_p + p) / tp ELSE 1.0 END AS recall FROM ({curve_sql(DOCS_SQL)}) c
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_curve(spark, sf_dir):
    return ranking.pr_curve(_docs(spark, sf_dir), "score", "label")


EVAL_SPEC = "roc_auc:d, pr_auc:d, prec_10:d, capt_10:d, prec_20:d, capt_20:d, ks:d"


@query("evaluate_all", EVAL_SPEC, evaluate_sql(DOCS_SQL))
def q_evaluate_all(spark, sf_dir):
    return ranking.evaluate_all(_docs(spark, sf_dir), "score", "label", "doc_id")


@query("evaluate_orders", EVAL_SPEC, evaluate_sql(ORD_SQL))
def q_evaluate_orders(spark, sf_dir):
    return ranking.evaluate_all(orders_scored(spark, sf_dir), "score", "label", "id")


@query("evaluate_by_status", "o_orderstatus:s, " + EVAL_SPEC, evaluate_sql(ORD_SQL, ["o_orderstatus"]))
def q_evaluate_by_status(spark, sf_dir):
    return ranking.evaluate_all(orders_scored(spark, sf_dir), "score", "label", "id", keys=["o_orderstatus"])


def _group_prec_sql(src: str, factors) -> str:
    stacked = " UNION ALL ".join(f"SELECT '{f}' AS factor, CAST({f} AS VARCHAR) AS grp, y, v, id FROM ({src}) s{i}"
                                 for i, f in enumerate(factors))
    stacked = f"SELECT * FROM ({stacked}) st WHERE grp IS NOT NULL"
    return f"""SELECT t.factor, t.grp, t.prec_10, (t.prec_10 - b.base) * 100.0 AS uplift_vs_base_pp, z.n
FROM ({top_sql(stacked, ['factor', 'grp'], (0.1,))}) t
JOIN (SELECT factor, grp, count(*) AS n FROM ({stacked}) q GROUP BY factor, grp) z ON t.factor = z.factor AND t.grp = z.grp
CROSS JOIN (SELECT avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS base FROM ({src}) q2) b
WHERE z.n >= 30"""


GROUP_SPEC = "factor:s, grp:s, prec_10:d, uplift_vs_base_pp:d, n:l"


@query("precision_at_k_by_group", GROUP_SPEC, _group_prec_sql(DOCS_SQL, ["lang", "source"]))
def q_prec_by_group(spark, sf_dir):
    return ranking.precision_at_k_by_group(_docs(spark, sf_dir), ["lang", "source"], "score", "label", "doc_id")


@query("precision_at_k_by_status", GROUP_SPEC, _group_prec_sql(ORD_SQL, ["o_orderstatus"]))
def q_prec_by_status(spark, sf_dir):
    return ranking.precision_at_k_by_group(orders_scored(spark, sf_dir), ["o_orderstatus"], "score", "label", "id")


@query("top_n", "o_orderkey:l, o_totalprice:d",
       "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def q_top_n(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20)
