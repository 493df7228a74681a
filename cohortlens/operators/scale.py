"""Population scaling: z-score (ddof 0), z-score clipped to +-2, min-max to [0, 1].

Population statistics are one global aggregate (exactly one row) attached to every row with a
broadcast; grouped statistics (per metric/pillar/theme) are joined on their key instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import clip, safe_div


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row frame (a global aggregate) to each row of ``df`` as a scalar
    subquery: computed once, inlined as a value, no join. Several columns of the same aggregate are
    merged into one subquery by the optimizer."""
    return df.select("*", *[one_row.select(F.col(c)).scalar().alias(c) for c in one_row.columns])


SMALL_ROWS = 100_000  # rows of a few numbers each: some ten MB at most


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count finds at most ``rows`` of them, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def attach_scalars(df: DataFrame, *aggs: Column) -> DataFrame:
    """Attach global aggregates of ``df`` (no grouping key, so exactly one row) to each of its rows."""
    return with_scalars(df, df.agg(*aggs))


def _stats(c: str, prefix: str):
    return [F.avg(F.col(c).cast("double")).alias(f"{prefix}_mean"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"{prefix}_sd"),
            F.min(F.col(c).cast("double")).alias(f"{prefix}_min"),
            F.max(F.col(c).cast("double")).alias(f"{prefix}_max")]


def z_expr(c: str, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd; a constant or empty column -> 0.0 for every row including NULLs."""
    x = F.col(c).cast("double")
    return F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise(safe_div(x - mean, sd))


def zclip_expr(c: str, mean: Column, sd: Column, lim: float = 2.0) -> Column:
    """z clipped to [-lim, lim]; a constant column gives x - mean (0, NULL kept)."""
    x = F.col(c).cast("double")
    z = F.when(sd.isNull() | (sd == 0), x - mean).otherwise(safe_div(x - mean, sd))
    return clip(z, -lim, lim)


def minmax_expr(c: str, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min); constant or empty -> 0.0 for every row including NULLs."""
    x = F.col(c).cast("double")
    return F.when(lo.isNull() | hi.isNull() | (hi == lo), F.lit(0.0)).otherwise(safe_div(x - lo, hi - lo))


def scale_columns(df: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Apply several scalings in one pass. ``specs`` = [(kind, input column, output column)],
    kind in {"z", "zclip", "minmax"}. One global aggregate for all inputs, one broadcast."""
    inputs = sorted({c for _, c, _ in specs})
    aggs = [a for i, c in enumerate(inputs) for a in _stats(c, f"_s{i}")]
    out = attach_scalars(df, *aggs)
    for kind, c, name in specs:
        p = f"_s{inputs.index(c)}"
        mean, sd, lo, hi = (F.col(f"{p}_{s}") for s in ("mean", "sd", "min", "max"))
        expr = {"z": lambda: z_expr(c, mean, sd), "zclip": lambda: zclip_expr(c, mean, sd),
                "minmax": lambda: minmax_expr(c, lo, hi)}[kind]()
        out = out.withColumn(name, expr)
    drop = [f"_s{i}_{s}" for i in range(len(inputs)) for s in ("mean", "sd", "min", "max")]
    return out.drop(*drop)


def zscore(df: DataFrame, c: str, out: str = "z") -> DataFrame:
    return scale_columns(df, [("z", c, out)])


def zscore_clip(df: DataFrame, c: str, out: str = "z_clip") -> DataFrame:
    return scale_columns(df, [("zclip", c, out)])


def minmax01(df: DataFrame, c: str, out: str = "minmax") -> DataFrame:
    return scale_columns(df, [("minmax", c, out)])
