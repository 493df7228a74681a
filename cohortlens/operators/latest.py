"""Latest record per key and long -> wide pivots."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

if TYPE_CHECKING:
    from cohortlens.sources.versions import VersionedTable


def desc_nulls_first(*cols: str) -> list[Column]:
    """PostgreSQL ``ORDER BY c DESC`` puts NULLs first; Spark's default is NULLS LAST."""
    return [F.col(c).desc_nulls_first() for c in cols]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rn: str = "_rn") -> DataFrame:
    """Keep the first row per key under ``order``.

    ``row_number() ... = 1`` plans as WindowGroupLimit on both sides of the shuffle, so each map task
    ships at most one row per key: a hot key is reduced before the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def latest_per_key(perf: DataFrame, key: str = "employee_id", year: str = "year", value: str = "rating",
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest row per key: year desc NULLS FIRST, value desc NULLS FIRST, then ``tie_break`` asc."""
    order = desc_nulls_first(year, value) + [F.col(c).asc() for c in tie_break]
    return first_per_key(perf, [key], order).select(key, year, value)


def latest_per_key_code(df: DataFrame, keys: Sequence[str] = ("employee_id", "pillar_code"), year: str = "year",
                        value: str = "score", tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest value per (key, code), the long form of the wide pivot."""
    order = desc_nulls_first(year, value) + [F.col(c).asc() for c in tie_break]
    return first_per_key(df, list(keys), order).select(*keys, value)


def update_latest(kept: VersionedTable, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> int:
    """Bring a kept table of the best row per key up to date with a batch of new rows; returns its version.

    ``order`` is that of :func:`first_per_key`. The batch is reduced to its best row per key, compared with the kept row of
    that key only, and merged in; neither earlier batches nor files without a key of the batch are read whole.
    """
    columns = kept.schema.fieldNames()
    best = cut_lineage(first_per_key(batch.select(*columns), keys, order))  # feeds the lookup and the merge
    before = kept.read().join(best.select(*keys), list(keys), "left_semi")
    return kept.upsert(first_per_key(before.unionByName(best), keys, order), keys)


def pivot_wide(long: DataFrame, key: str, code: str, value: str, codes: Sequence[str]) -> DataFrame:
    """Long -> wide with a known value list (no extra distinct job); missing cell -> NULL.

    (key, code) should be unique (see ``quality.check_unique``); of duplicates the largest value is kept. One aggregate
    with a group per key: ``GroupedData.pivot`` would group by (key, code) first, a group per row, in the scanning tasks.
    """
    return long.groupBy(key).agg(*[F.max(F.when(F.col(code) == c, F.col(value))).alias(c) for c in codes])
