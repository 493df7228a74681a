"""Cleaning raw text rows into typed rows: blank handling, rounding casts, required keys, dedup.

Dedup keeps one row per key with ``row_number() = 1`` over a *full* tie-break (all other columns),
so the survivor is deterministic; it plans as WindowGroupLimit before and after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import (
    blank_to_null, disc_code_from_word, disc_label_from_code, strip_ws, text_to_decimal, text_to_int_rounded,
    upper_code, DISC_PLACEHOLDERS,
)
from cohortlens.operators.latest import first_per_key


def required_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose keys are all non-blank (``NULLIF(TRIM(k),'') IS NOT NULL``)."""
    cond = None
    for k in keys:
        c = blank_to_null(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def dedup_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; default order = every other column ascending, NULLs last, so that a real value survives
    a missing one and the survivor is the same on every run."""
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, list(keys), list(order))


def distinct_on_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """``DISTINCT ON (keys)``: first row per typed key; same operator as ``dedup_row_number``."""
    return dedup_row_number(df, keys, order)


def clean_dim(raw: DataFrame, key: str, name: str = "name") -> DataFrame:
    """Dimension: both columns trimmed and required, then one row per id (smallest name)."""
    d = required_keys(raw, [key, name]).select(F.trim(key).alias(key), F.trim(name).alias(name))
    return d.groupBy(key).agg(F.min(name).alias(name))


def clean_pillars(raw: DataFrame) -> DataFrame:
    """Competency pillars: code upper-cased and trimmed, label trimmed, one row per code."""
    d = raw.select(upper_code("pillar_code").alias("pillar_code"),
                   blank_to_null("pillar_label").alias("pillar_label")).where(F.col("pillar_code").isNotNull())
    return dedup_row_number(d, ["pillar_code"], [F.col("pillar_label").asc_nulls_last()])


def clean_fact(raw: DataFrame, text_keys: Sequence[str], int_keys: Sequence[str], int_values: Sequence[str],
               text_values: Sequence[str] = (), upper_keys: Sequence[str] = (), on_error: str = "raise") -> DataFrame:
    """Generic fact cleaner: text keys trimmed, code keys upper-cased, integer keys/values rounded,
    rows with a NULL key part rejected, one row per typed key."""
    cols = [blank_to_null(k).alias(k) for k in text_keys]
    cols += [upper_code(k).alias(k) for k in upper_keys]
    cols += [text_to_int_rounded(k, on_error).alias(k) for k in int_keys]
    cols += [text_to_int_rounded(v, on_error).alias(v) for v in int_values]
    cols += [blank_to_null(v).alias(v) for v in text_values]
    typed = raw.select(*cols)
    keys = [*text_keys, *upper_keys, *int_keys]
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return dedup_row_number(typed.where(cond), keys)


def clean_strengths(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """Strengths: employee, rank and theme are all required; one row per (employee, rank), the smallest theme."""
    return clean_fact(required_keys(raw, ["theme"]), ["employee_id"], ["rank"], [], text_values=["theme"],
                      on_error=on_error)


def clean_psych(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """Psychometric profile: numeric scores as decimals, gtq/tiki rounded to int, one row per employee."""
    typed = raw.select(
        blank_to_null("employee_id").alias("employee_id"),
        text_to_decimal("pauli", on_error).alias("pauli"),
        text_to_decimal("faxtor", on_error).alias("faxtor"),
        blank_to_null("disc").alias("disc"),
        blank_to_null("disc_word").alias("disc_word"),
        blank_to_null("mbti").alias("mbti"),
        text_to_decimal("iq", on_error).alias("iq"),
        text_to_int_rounded("gtq", on_error).alias("gtq"),
        text_to_int_rounded("tiki", on_error).alias("tiki"),
    ).where(F.col("employee_id").isNotNull())
    return dedup_row_number(typed, ["employee_id"])


def fix_disc(df: DataFrame, disc: str = "disc", word: str = "disc_word") -> DataFrame:
    """Normalise DISC codes and labels.

    (1) a missing/blank code takes the code mapped from the normalised word; (2) codes are
    upper-cased and stripped, placeholders -> NULL; (3) a missing/blank word takes the code's label.
    Codes without a label (e.g. IC, CI) pass through with a NULL label.
    """
    if disc not in df.columns:
        df = df.withColumn(disc, F.lit(None).cast("string"))
    if word not in df.columns:
        df = df.withColumn(word, F.lit(None).cast("string"))
    d_empty = F.col(disc).isNull() | (strip_ws(disc) == "")
    code = F.when(d_empty, disc_code_from_word(word)).otherwise(F.col(disc))
    code = strip_ws(F.upper(code))
    code = F.when(code.isin(*DISC_PLACEHOLDERS), F.lit(None).cast("string")).otherwise(code)
    df = df.withColumn(disc, code)
    w_empty = F.col(word).isNull() | (strip_ws(word) == "")
    return df.withColumn(word, F.when(w_empty, disc_label_from_code(disc)).otherwise(F.col(word)))
