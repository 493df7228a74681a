"""SQL text generators for the DuckDB oracle of the rank statistics (kept next to each other so the
catalogue can state each oracle in a line)."""

from __future__ import annotations

from collections.abc import Sequence


def _k(keys: Sequence[str]):
    kp = ", ".join(keys)
    return (f"PARTITION BY {kp}" if keys else ""), (f"GROUP BY {kp}" if keys else ""), (f"{kp}, " if keys else "")


def curve_sql(src: str, keys: Sequence[str] = ()) -> str:
    """src has columns keys..., y (0/1), v (score). One row per distinct v with cumulative counts."""
    pk, _, sk = _k(keys)
    g = (f"SELECT {sk}v, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS t "
         f"FROM ({src}) s0 WHERE v IS NOT NULL GROUP BY {sk}v")
    return (f"SELECT *, sum(t) OVER ({pk} ORDER BY v) AS cum_n, sum(p) OVER ({pk} ORDER BY v) AS cum_p, "
            f"sum(p) OVER ({pk}) AS tp, sum(t) OVER ({pk}) AS tn FROM ({g}) g0")


def threshold_sql(src: str, keys: Sequence[str] = ()) -> str:
    _, gb, sk = _k(keys)
    return f"""SELECT {sk}
  CASE WHEN max(tp) > 0 AND max(tn) - max(tp) > 0 THEN
    (sum(p * (cum_n - t + (t + 1) / 2.0)) - max(tp) * (max(tp) + 1) / 2.0) / (max(tp) * (max(tn) - max(tp))) END AS roc_auc,
  CASE WHEN max(tp) > 0 THEN sum(p / tp * ((tp - cum_p + p) / (tn - cum_n + t))) END AS pr_auc,
  CASE WHEN max(tp) > 0 AND max(tn) - max(tp) > 0 THEN
    max(abs(cum_p / tp - (cum_n - cum_p) / (tn - tp))) END AS ks,
  max(tn) AS n, max(tp) AS n_pos
FROM ({curve_sql(src, keys)}) c0 {gb}"""


def kname(k: float) -> str:
    return f"{k * 100:.6g}".replace(".", "_")


def top_sql(src: str, keys: Sequence[str] = (), ks=(0.1, 0.2)) -> str:
    pk, gb, sk = _k(keys)
    r = (f"SELECT {sk}y, row_number() OVER ({pk} ORDER BY v DESC, id ASC, y DESC) AS rn, "
         f"count(*) OVER ({pk}) AS n, sum(y) OVER ({pk}) AS np FROM ({src}) s1 WHERE v IS NOT NULL")
    cols = []
    for k in ks:
        m = f"greatest(1, ceil(CAST({k} AS DOUBLE) * n))"
        hits = f"CAST(sum(CASE WHEN rn <= {m} THEN y ELSE 0 END) AS DOUBLE)"
        cols.append(f"{hits} / least(max({m}), max(n)) AS prec_{kname(k)}")
        cols.append(f"CASE WHEN max(np) > 0 THEN {hits} / max(np) END AS capt_{kname(k)}")
    return f"SELECT {sk}{', '.join(cols)} FROM ({r}) r0 {gb}"


def evaluate_sql(src: str, keys: Sequence[str] = (), ks=(0.1, 0.2), with_ks: bool = True) -> str:
    cols = ["roc_auc", "pr_auc"] + [c for k in ks for c in (f"prec_{kname(k)}", f"capt_{kname(k)}")]
    if with_ks:
        cols.append("ks")
    kp = ", ".join(f"a.{k}" for k in keys)
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys) or "TRUE"
    sel = (kp + ", " if keys else "") + ", ".join(cols)
    return (f"SELECT {sel} FROM ({threshold_sql(src, keys)}) a JOIN ({top_sql(src, keys, ks)}) b ON {on}")


def mwu_sql(src: str, keys: Sequence[str] = ("metric",)) -> str:
    """src: keys..., v, y. u_stat (high cohort), p_mwu (asymptotic, tie + continuity corrected)."""
    pk, gb, sk = _k(keys)
    c = curve_sql(src, keys)
    agg = (f"SELECT {sk}sum(p * (cum_n - t + (t + 1) / 2.0)) AS r1, sum(p) AS n1, sum(t) AS nn, "
           f"sum(t * t * t - t) AS ties FROM ({c}) c0 {gb}")
    u1 = "(r1 - n1 * (n1 + 1) / 2.0)"
    n0 = "(nn - n1)"
    sigma = f"sqrt(n1 * {n0} / 12.0 * ((nn + 1) - ties / (nn * (nn - 1))))"
    z = f"((greatest({u1}, n1 * {n0} - {u1}) - n1 * {n0} / 2.0 - 0.5) / {sigma})"
    return f"""SELECT {sk}
  CASE WHEN n1 = 0 OR {n0} = 0 THEN NULL ELSE {u1} END AS u_stat,
  CASE WHEN n1 = 0 OR {n0} = 0 THEN NULL WHEN {sigma} IS NULL OR {sigma} <= 0 THEN 1.0
       ELSE least(greatest({erfc_sql(f'{z} / sqrt(2.0)')}, 0.0), 1.0) END AS p_mwu,
  n1 AS n_high, {n0} AS n_non
FROM ({agg}) a0"""


def erfc_sql(x: str) -> str:
    """Complementary error function by Simpson's rule: 2 / sqrt(pi) * exp(-z^2) * integral of exp(-u^2 - 2zu), u from
    0 to 6.5 in 4,000 steps."""
    z = f"abs({x})"
    u = "(i * 6.5 / 4000)"
    weight = "(CASE WHEN i = 0 OR i = 4000 THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    area = (f"(SELECT sum({weight} * exp(-CAST({u} AS DOUBLE) * {u} - 2.0 * {z} * {u})) * 6.5 / 4000 / 3 "
            "FROM range(0, 4001) simpson(i))")
    ans = f"(2.0 / sqrt(pi()) * exp(-{z} * {z}) * {area})"
    return f"(CASE WHEN ({x}) >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def chi2_sf_sql(x: str, k: str) -> str:
    """Upper tail of chi-square, integer dof, as a correlated aggregate over generate_series."""
    even = (f"(SELECT exp(-({x}) / 2.0) * sum(exp(i * ln(({x}) / 2.0) - lgamma(i + 1))) "
            f"FROM range(0, CAST(({k}) / 2 AS BIGINT)) r(i))")
    t0 = f"(sqrt(2.0 * ({x}) / pi()) * exp(-({x}) / 2.0))"
    odd_terms = (f"(SELECT coalesce(sum({t0} * exp(i * ln({x}) - (lgamma(2 * i + 2) - i * ln(2.0) - lgamma(i + 1)))), 0.0) "
                 f"FROM range(0, CAST((({k}) - 1) / 2 AS BIGINT)) r(i))")
    odd = f"({erfc_sql(f'sqrt(({x}) / 2.0)')} + {odd_terms})"
    res = (f"(CASE WHEN ({x}) IS NULL OR ({k}) IS NULL THEN NULL WHEN ({x}) <= 0 THEN 1.0 "
           f"WHEN ({k}) % 2 = 0 THEN {even} ELSE {odd} END)")
    return f"least(greatest({res}, 0.0), 1.0)"
