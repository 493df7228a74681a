"""Scalar column expressions: cleaning, casting, labelling, clipping, binning, DISC/MBTI normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for identical results) -----------------------------
# DISC long-form words (normalised: stripped, lower-case, en/em dash -> '-', spaces removed) -> code.
DISC_WORD_TO_CODE = {
    "dominant-conscientious": "DC",
    "dominantsteadiness": "DS",
    "dominant-steadiness": "DS",
    "steadiness-conscientious": "SC",
    "steadinessinfluencer": "SI",
    "steadiness-influencer": "SI",
    "influencer-steadiness": "IS",
    "influencersteadiness": "IS",
    "influencer-dominant": "ID",
    "influencerdominant": "ID",
    "dominant-influencer": "DI",
    "dominantinfluencer": "DI",
    "conscientious-dominant": "CD",
    "conscientiousdominant": "CD",
    "steadiness-dominant": "SD",
    "steadinessdominant": "SD",
    "conscientious-steadiness": "CS",
    "conscientioussteadiness": "CS",
}
# DISC code -> standard label (the separator is an en dash).
DISC_CODE_TO_LABEL = {
    "DC": "Dominant–Conscientious",
    "DS": "Dominant–Steadiness",
    "SC": "Steadiness–Conscientious",
    "SI": "Steadiness–Influencer",
    "IS": "Influencer–Steadiness",
    "ID": "Influencer–Dominant",
    "DI": "Dominant–Influencer",
    "CD": "Conscientious–Dominant",
    "SD": "Steadiness–Dominant",
    "CS": "Conscientious–Steadiness",
}
# Placeholder strings that mean "missing" once a code is upper-cased.
DISC_PLACEHOLDERS = ("", "NAN", "NONE")
# Years-of-service bins: right-closed, lowest edge included; labels as the reference prints them.
YOS_EDGES = (0.0, 2.0, 5.0, 10.0, 20.0, 40.0)
YOS_LABELS = ("(-0.001, 2.0]", "(2.0, 5.0]", "(5.0, 10.0]", "(10.0, 20.0]", "(20.0, 40.0]")
# ----------------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c, trim: bool = True) -> Column:
    """``NULLIF(TRIM(c), '')``: trim strips spaces only, as SQL TRIM does."""
    c = _col(c)
    return F.nullif(F.trim(c) if trim else c, F.lit(""))


def strip_ws(c) -> Column:
    """Strip all leading/trailing Unicode whitespace (``str.strip()``), not only spaces."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def text_to_decimal(c, on_error: str = "raise") -> Column:
    """Text -> DECIMAL(38,10) after blank-to-NULL. ``on_error='null'`` turns bad text into NULL."""
    v = blank_to_null(c)
    if on_error == "null":
        return v.try_cast("decimal(38,10)")
    return v.cast("decimal(38,10)")


def text_to_int_rounded(c, on_error: str = "raise") -> Column:
    """Text -> numeric -> INT, rounding half away from zero (``'2.5'::NUMERIC::INT = 3``).

    A plain cast truncates, so we round the decimal first. Bad text raises under ANSI mode
    (like the SQL cast) unless ``on_error='null'``.
    """
    return F.round(text_to_decimal(c, on_error)).cast("int")


def safe_div(a, b) -> Column:
    """a / b with a zero denominator giving NULL (ANSI mode raises on division by zero)."""
    return _col(a) / F.nullif(_col(b), F.lit(0))


def upper_code(c) -> Column:
    """``UPPER(TRIM(c))`` with blank -> NULL."""
    return blank_to_null(F.upper(F.trim(_col(c))), trim=False)


def label_cohort(rating="rating", high_value: int = 5) -> Column:
    """1 when rating equals the high value, else 0; a NULL rating counts as 0."""
    return F.coalesce(_col(rating) == F.lit(high_value), F.lit(False)).cast("int")


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest/least`` would skip the NULL)."""
    c = _col(c)
    out = c
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def bin_right_closed(c, edges: Sequence[float] = YOS_EDGES, labels: Sequence[str] | None = YOS_LABELS) -> Column:
    """Fixed-edge binning, right-closed, lowest edge included; out of range or NULL -> NULL.

    Returns the label (or the 1-based bin number when ``labels`` is None).
    """
    c = _col(c)
    names = list(labels) if labels is not None else list(range(1, len(edges)))
    expr = None
    for i in range(1, len(edges)):
        lo, hi = edges[i - 1], edges[i]
        cond = (c >= F.lit(lo)) & (c <= F.lit(hi)) if i == 1 else (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(names[i - 1])) if expr is None else expr.when(cond, F.lit(names[i - 1]))
    return expr


def _literal_map(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def disc_word_key(word) -> Column:
    """Normalise a DISC word: strip, lower, en/em dash -> '-', remove spaces."""
    w = F.lower(strip_ws(_col(word)))
    w = F.regexp_replace(w, "[–—]", "-")
    return F.regexp_replace(w, " ", "")


def disc_code_from_word(word) -> Column:
    return F.element_at(_literal_map(DISC_WORD_TO_CODE), disc_word_key(word))


def disc_label_from_code(code) -> Column:
    return F.element_at(_literal_map(DISC_CODE_TO_LABEL), _col(code))


def mbti_normalise(c) -> Column:
    """strip + upper; keep only a full match of [EI][SN][TF][JP], else NULL."""
    s = F.upper(strip_ws(_col(c)))
    return F.when(s.rlike(r"^[EI][SN][TF][JP]\z"), s)


def mbti_letter(c, position: int) -> Column:
    """Letter at 1-based position of an already normalised MBTI type."""
    return F.substring(_col(c), position, 1)
