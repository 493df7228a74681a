"""Weight search: v1 scores under a list of main weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ranking import evaluate_all

# --- fixed values: main weights (competency, strengths, psychometric) ---------------------------
# Levels 0.45/0.50/0.55, 0.20/0.25/0.30 and 0.10/0.15/0.20, with context as what is left to 1 between 0.05
# and 0.20 in IEEE doubles: five combinations on the boundary fall outside by rounding and are not points.
MAIN_WEIGHTS = (
    (0.45, 0.20, 0.15), (0.45, 0.20, 0.20), (0.45, 0.25, 0.15), (0.45, 0.25, 0.20), (0.45, 0.30, 0.10),
    (0.45, 0.30, 0.15), (0.45, 0.30, 0.20), (0.50, 0.20, 0.15), (0.50, 0.20, 0.20), (0.50, 0.25, 0.10),
    (0.50, 0.25, 0.15), (0.50, 0.25, 0.20), (0.50, 0.30, 0.10), (0.55, 0.20, 0.10), (0.55, 0.20, 0.15),
    (0.55, 0.20, 0.20), (0.55, 0.25, 0.10),
)
# ------------------------------------------------------------------------------------------------


def score_grid(parts: DataFrame, points=MAIN_WEIGHTS) -> DataFrame:
    """Every employee scored under every point of ``points``: (grid_id from 1, employee_id, score) plus the
    label columns carried by ``parts``."""
    keep = [c for c in parts.columns if c not in ("comp_score", "str_score", "psy_score", "ctx_adj")]
    literal = F.array(*[F.struct(*[F.lit(w).alias(n) for n, w in zip(("c", "s", "p"), point, strict=True)])
                        for point in points])
    g = parts.select("*", F.posexplode(literal).alias("_at", "_w"))
    context = F.lit(1.0) - (F.col("_w.c") + F.col("_w.s") + F.col("_w.p"))
    score = (F.col("_w.c") * F.col("comp_score") + F.col("_w.s") * F.col("str_score")
             + F.col("_w.p") * F.col("psy_score") + context * F.col("ctx_adj"))
    return g.select((F.col("_at") + 1).alias("grid_id"), *keep, score.alias("score"))


def weight_search_metrics(parts_labelled: DataFrame, label: str = "is_high", id_col: str = "employee_id",
                          ks=(0.1, 0.2)) -> DataFrame:
    """Metrics (roc_auc, pr_auc, precision/capture at k, ks) for every lattice point, one job."""
    scored = score_grid(parts_labelled)
    return evaluate_all(scored, "score", label, id_col, keys=["grid_id"], ks=ks)
