"""Upsert by primary key as a frame (``INSERT ... ON CONFLICT (pk) DO UPDATE``); ``sources/versions.py`` writes one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortlens.operators.clean import dedup_row_number


def upsert_by_key(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``incoming``, plus ``incoming`` (one row per key).

    Idempotent: applying the same incoming batch twice gives the same table. The anti join shuffles
    both sides on the key; AQE splits a skewed key on the target side. On a table format with MERGE
    the same contract is ``MERGE INTO t USING s ON pk WHEN MATCHED UPDATE WHEN NOT MATCHED INSERT``.
    """
    keys = list(keys)
    kept = target.join(incoming.select(*keys), keys, "left_anti")  # an anti join needs no distinct keys
    return kept.unionByName(dedup_row_number(incoming, keys).select(*target.columns))
