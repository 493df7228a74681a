"""The HR-shaped model built from the driver tables (employees, performance, competencies, PAPI,
strengths, psychometrics). Same rows as the SQL views in FIXTURES.md, written with the DataFrame API.

Every view is derived from the driver tables, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.session import spread
from cohortlens.sources.tables import read_table

# --- fixed values used to derive the fixture views ---------------------------------------------
PILLAR_CODES = ("SEA", "CEX", "VCU", "STO", "CSI", "QDD", "GDR", "LIE", "IDS", "FTC")
PAPI_SCALES = ("N", "G", "A", "L", "P", "I", "T", "V", "O", "B", "S", "X", "C", "D", "R", "Z", "E", "K", "F", "W")
STRENGTHS_HELD = 5  # the modelled source lists an employee's five leading themes only
FIXTURE_THEMES = ("Futuristic", "Intellection", "Context", "Developer", "Harmony", "Analytical",
                  "Learner", "Ideation", "Consistency", "Empathy", "Command", "Significance")
DISC_FIXTURE_CODES = ("DC", "DS", "DI", "SD", "SI", "SC", "IS", "ID", "IC", "CD", "CS", "CI")
DISC_FIXTURE_WORDS = ("Steadiness – Influencer", "dominantinfluencer", " Conscientious—Dominant", "unknown")
# ----------------------------------------------------------------------------------------------


def _arr(values) -> F.Column:
    return F.array(*[F.lit(v) for v in values])


def fx_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("employee_id"),
        F.col("c_name").alias("fullname"),
        (F.col("c_nationkey") % 4 + 1).cast("string").alias("area_id"),
        (F.col("c_nationkey") % 5).cast("string").alias("company_id"),
        F.col("c_nationkey").cast("string").alias("position_id"),
        (k % 11).cast("string").alias("department_id"),
        (k % 50).cast("string").alias("division_id"),
        (k % 6).cast("string").alias("directorate_id"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise((k % 3 + 1).cast("string")).alias("grade_id"),
        (k % 4 + 1).cast("string").alias("education_id"),
        F.col("c_mktsegment").alias("major"),
        ((k * 37) % 500).cast("int").alias("years_of_service_months"),
    )


def fx_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return o.select(
        F.col("o_custkey").cast("string").alias("employee_id"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.when(F.col("o_orderkey") % 29 == 0, F.lit(None).cast("int"))
         .otherwise(F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")).alias("rating"),
        F.col("o_orderkey").alias("src_id"),
    )


def _lineitem_orders(spark: SparkSession, sf_dir: str, li_cols) -> DataFrame:
    """Lineitems with their order's customer.

    The planner would sort both sides, most of what a task of the scores holds; the smaller, two numbers an order, is
    hashed instead.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", *li_cols])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return li.join(o.hint("shuffle_hash"), li["l_orderkey"] == o["o_orderkey"])


def fx_competencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lineitem_orders(spark, sf_dir, ["l_partkey", "l_quantity", "l_shipdate"])
    return j.select(
        F.col("o_custkey").cast("string").alias("employee_id"),
        F.element_at(_arr(PILLAR_CODES), (F.col("l_partkey") % 10 + 1).cast("int")).alias("pillar_code"),
        F.year("l_shipdate").cast("int").alias("year"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("score"),
    )


def fx_papi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x scale index i (the 20 scales), minus the (c + i) % 11 == 0 holes.

    The keys are dealt out before they become 20 rows each.
    """
    c = spread(read_table(spark, sf_dir, "customer", ["c_custkey"]))
    k, i = F.col("c_custkey"), F.col("i")
    x = c.select("c_custkey", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(len(PAPI_SCALES) - 1).cast("bigint")))
                 .alias("i"))
    return x.where((k + i) % 11 != 0).select(
        k.cast("string").alias("employee_id"),
        F.concat(F.lit("Papi_"), F.element_at(_arr(PAPI_SCALES), (i + 1).cast("int"))).alias("scale_code"),
        (F.lit(1) + (k * 7 + i * i * 13 + k * i) % 9).cast("int").alias("score"),
    )


def fx_strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lineitem_orders(spark, sf_dir, ["l_partkey"])
    # counted on the numeric keys (customer, theme index) and named afterwards: both maps are one-to-one
    counted = j.groupBy("o_custkey", (F.col("l_partkey") % 12 + 1).cast("int").alias("_t")) \
        .agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("o_custkey").cast("string").alias("employee_id"),
                F.element_at(_arr(FIXTURE_THEMES), F.col("_t")).alias("theme"), "n")
    # at most 12 rows per employee after the aggregate, so the window partition is small
    w = Window.partitionBy("employee_id").orderBy(F.col("n").desc(), F.col("theme"))
    return counted.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= STRENGTHS_HELD) \
        .select("employee_id", "theme", F.col("rn").cast("int").alias("rank"))


def fx_psych(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    k = F.col("c_custkey")
    code = F.element_at(_arr(DISC_FIXTURE_CODES), (k % 12 + 1).cast("int"))
    word = F.element_at(_arr(DISC_FIXTURE_WORDS), (k % 4 + 1).cast("int"))
    mb = F.concat(
        F.substring(F.lit("EI"), (k % 2 + 1).cast("int"), 1),
        F.substring(F.lit("SN"), (k % 7 % 2 + 1).cast("int"), 1),
        F.substring(F.lit("TF"), (k % 3 % 2 + 1).cast("int"), 1),
        F.substring(F.lit("JP"), (k % 5 % 2 + 1).cast("int"), 1),
    )
    null_s = F.lit(None).cast("string")
    return c.select(
        k.cast("string").alias("employee_id"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") / 100).alias("pauli"),
        (F.lit(40) + (k * 31) % 41).cast("double").alias("faxtor"),
        (F.lit(80) + (k * 17) % 61).cast("double").alias("iq"),
        (F.lit(15) + (k * 11) % 25).cast("int").alias("gtq"),
        (F.lit(1) + k % 10).cast("int").alias("tiki"),
        F.when(k % 13 == 0, null_s).when(k % 7 == 0, F.concat(F.lit(" "), F.lower(code), F.lit(" "))).otherwise(code).alias("disc"),
        F.when(k % 13 == 0, word).otherwise(null_s).alias("disc_word"),
        F.when(k % 19 == 0, F.lit("INFTJ")).when(k % 20 == 0, F.lit(" entp ")).otherwise(mb).alias("mbti"),
    )


# --- fixed values: dimension lookups, id -> name ------------------------------------------------
GRADES = (("1", "III"), ("2", "IV"), ("3", "V"))
EDUCATION = (("1", "D3"), ("2", "S1"), ("3", "S2"), ("4", "SMA"))
PILLAR_LABELS = (
    ("GDR", "Growth Drive & Resilience"),
    ("CEX", "Curiosity & Experimentation"),
    ("IDS", "Insight & Decision Sharpness"),
    ("QDD", "Quality Delivery Discipline"),
    ("STO", "Synergy & Team Orientation"),
    ("SEA", "Social Empathy & Awareness"),
    ("VCU", "Value Creation for Users"),
    ("LIE", "Lead, Inspire & Empower"),
    ("FTC", "Forward Thinking & Clarity"),
    ("CSI", "Commercial Savvy & Impact"),
)


# dimension name -> (driver table, key column, name column)
DIMENSION_TABLES = {"company": ("region", "r_regionkey", "r_name"), "area": ("region", "r_regionkey", "r_name"),
                    "position": ("nation", "n_nationkey", "n_name"), "department": ("supplier", "s_suppkey", "s_name"),
                    "division": ("part", "p_partkey", "p_name"), "directorate": ("region", "r_regionkey", "r_name")}


def dim_frame(spark: SparkSession, rows, key: str, name: str) -> DataFrame:
    """A dimension table (a handful of rows, fixed); joined with an explicit broadcast."""
    return spark.createDataFrame(list(rows), f"{key} string, {name} string")
