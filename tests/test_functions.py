import math

import pytest

from cohortlens.functions import (bin_right_closed, blank_to_null, chi2_sf, clip, erfc, label_cohort,
                                  mbti_normalise, text_to_int_rounded)
from cohortlens.operators.clean import fix_disc


def col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_text_to_int_rounded(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), (" 7 ",), ("",), ("  ",), (None,)], "t string")
    assert col(df.select(text_to_int_rounded("t").alias("v")), "v") == [3, -3, 7, None, None, None]


def test_text_to_int_bad_text(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    with pytest.raises(Exception):
        df.select(text_to_int_rounded("t")).collect()
    assert col(df.select(text_to_int_rounded("t", on_error="null").alias("v")), "v") == [None]


def test_blank_to_null(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" a ",)], "t string")
    assert col(df.select(blank_to_null("t").alias("v")), "v") == [None, None, None, "a"]


def test_label_cohort(spark):
    df = spark.createDataFrame([(5,), (4,), (None,)], "rating int")
    assert col(df.select(label_cohort("rating").alias("v")), "v") == [1, 0, 0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (9.0,), (None,)], "x double")
    assert col(df.select(clip("x", -2, 2).alias("v")), "v") == [-2, 0, 2, None]


def test_bin_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (2.01,), (5.0,), (40.0,), (40.1,), (None,)], "x double")
    got = col(df.select(bin_right_closed("x", labels=None).alias("b")), "b")
    assert got == [1, 1, 2, 2, 5, None, None]


def test_mbti_normalise(spark):
    df = spark.createDataFrame([(" entp ",), ("INFTJ",), ("ABCD",), ("istj\n",)], "m string")
    assert col(df.select(mbti_normalise("m").alias("v")), "v") == ["ENTP", None, None, "ISTJ"]


def test_disc_normalise(spark):
    df = spark.createDataFrame([
        (None, "Steadiness – Influencer"), (" sc ", None), ("IC", None), (None, "dominantconscientious"),
        ("  ", "dominant-conscientious"), ("nan", None)], "disc string, disc_word string")
    rows = fix_disc(df).collect()
    assert [r.disc for r in rows] == ["SI", "SC", "IC", None, "DC", None]
    assert rows[1].disc_word == "Steadiness–Conscientious"
    assert rows[2].disc_word is None
    assert rows[0].disc_word == "Steadiness – Influencer"


def test_erfc_and_chi2_tail(spark):
    df = spark.createDataFrame([(0.5, 4.67, 11), (1.5, 5.4, 1), (-0.7, 3.0, 2)], "e double, x double, k int")
    rows = df.select(erfc("e").alias("erfc"), chi2_sf("x", "k").alias("p")).collect()
    for r, e in zip(rows, (0.5, 1.5, -0.7)):
        assert abs(r.erfc - math.erfc(e)) < 2e-7
    assert round(rows[0].p, 4) == 0.9461          # published DISC test: chi2 4.67, dof 11
    assert abs(rows[2].p - math.exp(-1.5)) < 1e-12
