"""Column-level functions (pure ``pyspark.sql.Column`` expressions, JVM side, codegen friendly)."""

from cohortlens.functions.columns import (  # noqa: F401
    blank_to_null,
    strip_ws,
    text_to_int_rounded,
    text_to_decimal,
    upper_code,
    label_cohort,
    clip,
    bin_right_closed,
    YOS_EDGES,
    YOS_LABELS,
    disc_code_from_word,
    disc_label_from_code,
    mbti_normalise,
    mbti_letter,
)
from cohortlens.functions.distributions import erfc, chi2_sf, normal_two_sided_p  # noqa: F401
