"""Distributed running sums and row ranks without a global (un-partitioned) window.

Two building blocks shared by the rank statistics (Mann-Whitney U, ROC-AUC, average precision, KS,
curves) and the top-fraction metrics (precision/capture at K, which rank only the tie group at their cut):

``running_by_value``
    Input is a *collapsed* table: one row per (keys..., value) with additive measures (e.g. positives
    and rows per distinct score). ``repartitionByRange`` on (keys..., value) gives each partition a
    contiguous run, whatever the number of keys and however many values one key has; the totals of
    each (key, partition) give the offsets, and a window partitioned by (keys, partition) adds the
    running sum inside. A heavy single value is one row after the collapse (map-side partial
    aggregation), so it cannot skew the window.

``rank_rows``
    Exact 1-based row rank within groups under a composite order (e.g. score desc, id asc) for data
    that cannot be collapsed because ties must be broken row by row. ``repartitionByRange`` samples
    range boundaries on the full composite key (so one hot score is split by id), rows are sorted
    inside each range partition, and the position inside the partition is read from
    ``monotonically_increasing_id`` (partition id in the upper bits, record number in the lower 33).
    Per-(partition, group) counts give the offsets. No row leaves its partition after the range shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage, default_buckets

_LOW33 = (1 << 33) - 1


def collapse_by_value(df: DataFrame, keys: Sequence[str], value: str, label: str) -> DataFrame:
    """(keys..., value, pos, n): positives and rows per distinct value; NULL values are dropped."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value)
            .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")))


def running_by_value(g: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str] = ("pos", "n"),
                     buckets: int | None = None) -> DataFrame:
    """Add ``cum_<m>`` (running sum over ascending value, inclusive) and ``tot_<m>`` per key.

    ``g`` must hold one row per (keys, value). Descending running sums follow as ``tot_m - cum_m + m``.
    The range-partitioned rows are checkpointed once: the totals and the rows must see the same bounds.
    """
    keys = list(keys)
    b = buckets or default_buckets(g.sparkSession)
    ranged = cut_lineage(g.repartitionByRange(b, *keys, value).withColumn("_bucket", F.spark_partition_id()))
    # a partition holds a contiguous run of (keys, value): at most #keys + #partitions totals in all
    totals = ranged.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_b_{m}") for m in measures])
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # one row per partition
    before = wk.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys, "_bucket",
        *[F.coalesce(F.sum(f"_b_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_b_{m}").over(wk).alias(f"tot_{m}") for m in measures])
    rows = ranged.join(totals, [*keys, "_bucket"])
    run = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*g.columns, *[(F.col(f"_off_{m}") + F.sum(m).over(run)).alias(f"cum_{m}") for m in measures],
                       *[F.col(f"tot_{m}") for m in measures])


def rank_rows(df: DataFrame, order: Sequence[Column], groups: Sequence[str] = (),
              buckets: int | None = None, rank_col: str = "rank", materialize: bool = True) -> DataFrame:
    """Exact 1-based rank within ``groups`` under ``order`` (the order must be total, e.g. end with an id)."""
    groups = list(groups)
    b = buckets or default_buckets(df.sparkSession)
    sort_keys = [F.col(g) for g in groups] + list(order)
    ranged = (df.repartitionByRange(b, *sort_keys)
              .sortWithinPartitions(*sort_keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_mid", 33)) \
                   .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33))).drop("_mid")
    if materialize:
        # Both the counts and the rows must see the same range bounds. They do when Spark reuses the
        # one range exchange, but a second exchange would sample its own bounds, and with an
        # unordered upstream the samples can differ. A reliable checkpoint makes it hold by construction.
        ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    wg = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))  # tiny: #partitions rows
    counts = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(wg.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    out = ranged.join(counts.select("_part", *groups, "_off", "_first"), ["_part", *groups])
    return out.withColumn(rank_col, F.col("_off") + F.col("_pos") - F.col("_first") + 1) \
              .drop("_part", "_pos", "_off", "_first")
