"""Catalogue: reads, cleaning casts, dedup, upsert, quality checks, latest-per-key, joins, DISC/MBTI."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortlens.functions.columns import blank_to_null, label_cohort, mbti_letter, mbti_normalise, text_to_int_rounded
from cohortlens.operators import clean, merge, quality
from cohortlens.operators.latest import pivot_wide
from cohortlens.plans.inputs import Bundle
from cohortlens.plans.registry import query
from cohortlens.sources import fixtures as fx
from cohortlens.sources.projections import employees_org_min
from cohortlens.sources.readers import read_or_empty, scan_project, sql_read
from cohortlens.sources.schemas import CORE, conform_to_schema, ensure_columns
from cohortlens.sources.tables import TABLES, read_table

B2N = "NULLIF(TRIM({x}), '')"


def b2n(x: str) -> str:
    return B2N.format(x=x)


def round_int(x: str) -> str:
    return f"CAST(round(CAST({b2n(x)} AS DECIMAL(38,10))) AS INTEGER)"


# ---- reads -----------------------------------------------------------------------------------------
@query("scan_project", "c_custkey:l, c_name:s, c_mktsegment:s", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_scan_project(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return scan_project(c, ["c_custkey", "c_name", "c_mktsegment", "c_phone"], keep_if_present=True)


@query("sql_read", "c_custkey:l, c_acctbal:d", "SELECT c_custkey, c_acctbal FROM customer")
def q_sql_read(spark, sf_dir):
    read_table(spark, sf_dir, "customer").createOrReplaceTempView("cohortlens_customer")
    return sql_read(spark, "SELECT c_custkey, c_acctbal FROM cohortlens_customer")


@query("read_or_empty", "employee_id:s, pauli:d", "SELECT employee_id, pauli FROM fx_psych")
def q_read_or_empty(spark, sf_dir):
    schema = StructType([StructField("employee_id", StringType()), StructField("pauli", DoubleType())])
    missing = read_or_empty(spark, f"{sf_dir}/no_such_table.parquet", schema)
    return missing.unionByName(fx.fx_psych(spark, sf_dir).select("employee_id", "pauli"))


@query("core_schema_conform", "employee_id:s, pauli:d, faxtor:d, disc:s, disc_word:s, mbti:s, iq:d, gtq:i, tiki:i",
       "SELECT employee_id, CAST(pauli AS DECIMAL(38,10)) AS pauli, CAST(faxtor AS DECIMAL(38,10)) AS faxtor, disc, "
       "disc_word, mbti, CAST(iq AS DECIMAL(38,10)) AS iq, gtq, tiki FROM fx_psych")
def q_conform(spark, sf_dir):
    return conform_to_schema(fx.fx_psych(spark, sf_dir), CORE["profiles_psych"])


# ---- cleaning --------------------------------------------------------------------------------------
SEG_TEXT = ("CASE WHEN c_custkey % 7 = 0 THEN '   ' WHEN c_custkey % 5 = 0 THEN '' "
            "ELSE concat('  ', c_mktsegment, ' ') END")


def _seg_text():
    k = F.col("c_custkey")
    return F.when(k % 7 == 0, F.lit("   ")).when(k % 5 == 0, F.lit("")) \
            .otherwise(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))


@query("blank_to_null", "c_custkey:l, raw:s, clean:s",
       f"SELECT c_custkey, raw, {b2n('raw')} AS clean FROM (SELECT c_custkey, {SEG_TEXT} AS raw FROM customer) s")
def q_blank_to_null(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return c.select("c_custkey", _seg_text().alias("raw")).withColumn("clean", blank_to_null("raw"))


QTY_TEXT = ("concat(' ', CAST(CASE WHEN l_linenumber % 3 = 0 THEN -l_quantity / 2 ELSE l_quantity / 2 END AS VARCHAR), ' ')")


@query("text_to_int_rounded", "l_orderkey:l, l_linenumber:i, txt:s, val:i",
       f"SELECT l_orderkey, l_linenumber, txt, {round_int('txt')} AS val FROM "
       f"(SELECT l_orderkey, l_linenumber, {QTY_TEXT} AS txt FROM lineitem) s")
def q_text_to_int(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    half = F.when(F.col("l_linenumber") % 3 == 0, -F.col("l_quantity") / 2).otherwise(F.col("l_quantity") / 2)
    t = li.select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), half.cast("string"), F.lit(" ")).alias("txt"))
    return t.withColumn("val", text_to_int_rounded("txt"))


KEY_TEXT = ("CASE WHEN c_custkey % 9 = 0 THEN '  ' WHEN c_custkey % 10 = 0 THEN '' "
            "ELSE CAST(c_custkey AS VARCHAR) END")


@query("required_keys", "key_text:s, c_name:s",
       f"SELECT key_text, c_name FROM (SELECT {KEY_TEXT} AS key_text, c_name FROM customer) s "
       f"WHERE {b2n('key_text')} IS NOT NULL")
def q_required_keys(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    t = c.select(F.when(k % 9 == 0, F.lit("  ")).when(k % 10 == 0, F.lit("")).otherwise(k.cast("string"))
                 .alias("key_text"), "c_name")
    return clean.required_keys(t, ["key_text"])


@query("ensure_columns", "employee_id:s, iq:d, extra_score:d, note:s",
       "SELECT employee_id, iq, 0.0 AS extra_score, CAST(NULL AS VARCHAR) AS note FROM fx_psych")
def q_ensure_columns(spark, sf_dir):
    p = fx.fx_psych(spark, sf_dir).select("employee_id", "iq")
    return ensure_columns(p, {"iq": (0.0, "double"), "extra_score": (0.0, "double"), "note": (None, "string")})


DIM_RAW = """SELECT concat(' ', CAST(c_custkey AS VARCHAR), ' ') AS raw_id,
  CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE concat(c_name, '  ') END AS raw_name FROM customer
UNION ALL SELECT CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE CAST(c_custkey AS VARCHAR) END, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END FROM customer"""


@query("clean_dim", "customer_id:s, name:s",
       f"""SELECT customer_id, name FROM (
  SELECT customer_id, name, row_number() OVER (PARTITION BY customer_id ORDER BY name) AS rn
  FROM (SELECT DISTINCT {b2n('raw_id')} AS customer_id, {b2n('raw_name')} AS name FROM ({DIM_RAW}) r) d
  WHERE customer_id IS NOT NULL AND name IS NOT NULL) x WHERE rn = 1""")
def q_clean_dim(spark, sf_dir):
    return clean.clean_dim(_dim_raw(spark, sf_dir), "customer_id")


def _dim_raw(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    k = F.col("c_custkey")
    a = c.select(F.concat(F.lit(" "), k.cast("string"), F.lit(" ")).alias("customer_id"),
                 F.when(k % 4 == 0, F.lit("  ")).otherwise(F.concat(F.col("c_name"), F.lit("  "))).alias("name"))
    b = c.select(F.when(k % 5 == 0, F.lit("  ")).otherwise(k.cast("string")).alias("customer_id"),
                 F.when(k % 6 != 0, F.col("c_mktsegment")).alias("name"))
    return a.unionByName(b)


STRENGTHS_RAW = """SELECT concat(employee_id, ' ') AS employee_id, concat(CAST(rank AS VARCHAR), '.0') AS rank, theme FROM fx_strengths
UNION ALL SELECT employee_id, CAST(rank AS VARCHAR), CASE WHEN rank % 2 = 0 THEN '  ' END FROM fx_strengths
UNION ALL SELECT CASE WHEN rank = 3 THEN ' ' ELSE employee_id END, CAST(rank AS VARCHAR), concat(' ', theme, 'Z ') FROM fx_strengths"""


@query("clean_strengths", "employee_id:s, rank:i, theme:s",
       f"""SELECT employee_id, rank, theme FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, rank ORDER BY theme) AS rn FROM (
    SELECT {b2n('employee_id')} AS employee_id, {round_int('rank')} AS rank, {b2n('theme')} AS theme FROM ({STRENGTHS_RAW}) r) t
  WHERE employee_id IS NOT NULL AND rank IS NOT NULL AND theme IS NOT NULL) x WHERE rn = 1""")
def q_clean_strengths(spark, sf_dir):
    s = fx.fx_strengths(spark, sf_dir)
    rank = F.col("rank").cast("string")
    a = s.select(F.concat("employee_id", F.lit(" ")).alias("employee_id"), F.concat(rank, F.lit(".0")).alias("rank"), "theme")
    b = s.select("employee_id", rank.alias("rank"), F.when(F.col("rank") % 2 == 0, F.lit("  ")).alias("theme"))
    c = s.select(F.when(F.col("rank") == 3, F.lit(" ")).otherwise(F.col("employee_id")).alias("employee_id"),
                 rank.alias("rank"), F.concat(F.lit(" "), F.col("theme"), F.lit("Z ")).alias("theme"))
    return clean.clean_strengths(a.unionByName(b).unionByName(c))


@query("clean_pillars", "pillar_code:s, pillar_label:s",
       f"""SELECT pillar_code, pillar_label FROM (
  SELECT pillar_code, pillar_label, row_number() OVER (PARTITION BY pillar_code ORDER BY pillar_label ASC NULLS LAST) rn
  FROM (SELECT NULLIF(upper(TRIM(raw_code)), '') AS pillar_code, {b2n('raw_label')} AS pillar_label
        FROM (SELECT concat(' ', lower(pillar_code), ' ') AS raw_code, concat('Pillar ', pillar_code, ' ') AS raw_label
              FROM fx_competencies) r) d WHERE pillar_code IS NOT NULL) x WHERE rn = 1""")
def q_clean_pillars(spark, sf_dir):
    comp = fx.fx_competencies(spark, sf_dir)
    raw = comp.select(F.concat(F.lit(" "), F.lower("pillar_code"), F.lit(" ")).alias("pillar_code"),
                      F.concat(F.lit("Pillar "), F.col("pillar_code"), F.lit(" ")).alias("pillar_label"))
    return clean.clean_pillars(raw)


PAPI_RAW = """SELECT concat(employee_id, ' ') AS employee_id, scale_code,
  CASE WHEN score % 4 = 0 THEN concat(CAST(score AS VARCHAR), '.5') ELSE CAST(score AS VARCHAR) END AS score FROM fx_papi
UNION ALL SELECT employee_id, scale_code, ' 9 ' FROM fx_papi WHERE score % 3 = 0"""


@query("clean_fact", "employee_id:s, scale_code:s, score:i",
       f"""SELECT employee_id, scale_code, score FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, scale_code ORDER BY score ASC NULLS LAST) AS rn FROM (
    SELECT {b2n('employee_id')} AS employee_id, {b2n('scale_code')} AS scale_code, {round_int('score')} AS score
    FROM ({PAPI_RAW}) r) t WHERE employee_id IS NOT NULL AND scale_code IS NOT NULL) x WHERE rn = 1""")
def q_clean_fact(spark, sf_dir):
    p = fx.fx_papi(spark, sf_dir)
    a = p.select(F.concat(F.col("employee_id"), F.lit(" ")).alias("employee_id"), "scale_code",
                 F.when(F.col("score") % 4 == 0, F.concat(F.col("score").cast("string"), F.lit(".5")))
                 .otherwise(F.col("score").cast("string")).alias("score"))
    b = p.where(F.col("score") % 3 == 0).select("employee_id", "scale_code", F.lit(" 9 ").alias("score"))
    return clean.clean_fact(a.unionByName(b), text_keys=["employee_id", "scale_code"], int_keys=[], int_values=["score"])


PSYCH_TEXT_COLS = ("pauli", "faxtor", "disc", "disc_word", "mbti", "iq", "gtq", "tiki")


@query("clean_psych", "employee_id:s, pauli:d, faxtor:d, disc:s, disc_word:s, mbti:s, iq:d, gtq:i, tiki:i",
       f"""SELECT employee_id, pauli, faxtor, disc, disc_word, mbti, iq, gtq, tiki FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY pauli NULLS LAST, faxtor NULLS LAST,
     disc NULLS LAST, disc_word NULLS LAST, mbti NULLS LAST, iq NULLS LAST, gtq NULLS LAST, tiki NULLS LAST) rn
  FROM (SELECT {b2n('employee_id')} AS employee_id, CAST({b2n('pauli')} AS DECIMAL(38,10)) AS pauli,
          CAST({b2n('faxtor')} AS DECIMAL(38,10)) AS faxtor, {b2n('disc')} AS disc, {b2n('disc_word')} AS disc_word,
          {b2n('mbti')} AS mbti, CAST({b2n('iq')} AS DECIMAL(38,10)) AS iq, {round_int('gtq')} AS gtq,
          {round_int('tiki')} AS tiki
        FROM (SELECT concat(' ', employee_id) AS employee_id, CAST(round(pauli, 4) AS VARCHAR) AS pauli,
                CAST(faxtor AS VARCHAR) AS faxtor, disc, disc_word, mbti, CAST(iq AS VARCHAR) AS iq,
                CAST(gtq AS VARCHAR) AS gtq, CAST(tiki AS VARCHAR) AS tiki FROM fx_psych) r) t
  WHERE employee_id IS NOT NULL) x WHERE rn = 1""")
def q_clean_psych(spark, sf_dir):
    p = fx.fx_psych(spark, sf_dir)
    raw = p.select(F.concat(F.lit(" "), F.col("employee_id")).alias("employee_id"),
                   F.round("pauli", 4).cast("string").alias("pauli"),
                   *[F.col(c).cast("string").alias(c) for c in PSYCH_TEXT_COLS[1:]])
    return clean.clean_psych(raw)


# ---- dedup -----------------------------------------------------------------------------------------
LI_COLS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_linestatus", "l_shipdate")
LI_OUT = "l_orderkey:l, l_linenumber:i, l_partkey:l, l_suppkey:l, l_quantity:d, l_extendedprice:d, l_discount:d, l_tax:d, l_returnflag:s, l_linestatus:s"


@query("dedup_row_number", LI_OUT,
       f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in LI_COLS)}) AS rn FROM lineitem) x WHERE rn = 1""")
def q_dedup(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *LI_COLS])
    return clean.dedup_row_number(li, ["l_orderkey", "l_linenumber"])


@query("distinct_on_first", "l_orderkey:l, l_linenumber:i, l_partkey:l, l_quantity:d, l_extendedprice:d",
       f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST,
    {', '.join(c + ' ASC NULLS FIRST' for c in LI_COLS if c != 'l_shipdate')}) AS rn FROM lineitem) x WHERE rn = 1""")
def q_distinct_on(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *LI_COLS])
    order = [F.col("l_shipdate").desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in LI_COLS if c != "l_shipdate"]
    return clean.distinct_on_first(li, ["l_orderkey", "l_linenumber"], order) \
                .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


# ---- upsert ----------------------------------------------------------------------------------------
# An incremental load split by business date (no id subsets): the target holds the orders placed
# before LOAD_CUT; the incoming batch re-delivers every order placed from BATCH_FROM on with a new
# status and price. Orders in [BATCH_FROM, LOAD_CUT) are updates, later ones are inserts.
LOAD_CUT, BATCH_FROM = "1999-01-01", "1998-07-01"
UPSERT_TARGET = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders "
                 f"WHERE o_orderdate < TIMESTAMP '{LOAD_CUT}'")
UPSERT_INCOMING = ("SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice "
                   f"FROM orders WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}'")


def _upsert_inputs(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    target = o.where(F.col("o_orderdate") < LOAD_CUT).drop("o_orderdate")  # pushed to the Parquet scan
    incoming = o.where(F.col("o_orderdate") >= BATCH_FROM).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return target, incoming


@query("upsert_by_key", "o_orderkey:l, o_custkey:l, o_orderstatus:s, o_totalprice:d",
       f"""SELECT * FROM ({UPSERT_TARGET}) t WHERE NOT EXISTS (
  SELECT 1 FROM ({UPSERT_INCOMING}) i WHERE i.o_orderkey = t.o_orderkey)
UNION ALL {UPSERT_INCOMING}""")
def q_upsert(spark, sf_dir):
    target, incoming = _upsert_inputs(spark, sf_dir)
    return merge.upsert_by_key(target, incoming, ["o_orderkey"])


# ---- quality ---------------------------------------------------------------------------------------
@query("quality_unique_key", "l_orderkey:l, l_linenumber:i, n:l",
       "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q_unique(spark, sf_dir):
    return quality.quality_unique_key(read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"]),
                                      ["l_orderkey", "l_linenumber"])


@query("quality_orphans", "l_orderkey:l, l_linenumber:i, l_partkey:l",
       "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE l_partkey IS NOT NULL AND NOT EXISTS ("
       "SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)")
def q_orphans(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    return quality.quality_orphans(li, read_table(spark, sf_dir, "part", ["p_partkey"]), "l_partkey", "p_partkey")


@query("quality_pillar_key", "pillar_code:s, n:l",
       "SELECT pillar_code, count(*) AS n FROM fx_competencies c WHERE pillar_code IS NOT NULL AND NOT EXISTS ("
       "SELECT 1 FROM pillar_dim d WHERE d.pillar_code = c.pillar_code) GROUP BY pillar_code")
def q_pillar_key(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return quality.quality_orphans(b.competencies, b.pillar_labels, "pillar_code") \
        .groupBy("pillar_code").agg(F.count(F.lit(1)).alias("n"))


NOT_NULL = ("employee_id", "grade_id", "education_id", "fullname")


@query("quality_not_null", "column_name:s, n:l",
       " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n FROM fx_employees WHERE {c} IS NULL"
                          for c in NOT_NULL))
def q_not_null(spark, sf_dir):
    return quality.quality_not_null(fx.fx_employees(spark, sf_dir), NOT_NULL)


@query("quality_unique_name", "name:s, n:l",
       f"SELECT name, count(*) AS n FROM (SELECT {b2n('raw_name')} AS name FROM ({DIM_RAW}) r) d "
       "WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1")
def q_unique_name(spark, sf_dir):
    raw = _dim_raw(spark, sf_dir)
    return quality.quality_unique_value(raw.select(blank_to_null("name").alias("name")), "name")


@query("quality_code_length", "mbti:s, n:l",
       "SELECT mbti, count(*) AS n FROM fx_psych WHERE length(mbti) > 4 GROUP BY mbti")
def q_code_length(spark, sf_dir):
    return quality.quality_length(fx.fx_psych(spark, sf_dir), "mbti", 4)


@query("quality_rejected_rows", "reason:s, n:l",
       f"""SELECT CASE WHEN {b2n('raw_id')} IS NULL THEN 'blank customer_id' WHEN {b2n('raw_name')} IS NULL THEN 'blank name'
  ELSE 'accepted' END AS reason, count(*) AS n FROM ({DIM_RAW}) r GROUP BY 1""")
def q_rejected(spark, sf_dir):
    return quality.rejected_rows(_dim_raw(spark, sf_dir), ["customer_id", "name"])


@query("quality_second_names", "customer_id:s, kept:s, n_values:l",
       f"""SELECT customer_id, min(name) AS kept, count(DISTINCT name) AS n_values FROM (
  SELECT {b2n('raw_id')} AS customer_id, {b2n('raw_name')} AS name FROM ({DIM_RAW}) r) d
  WHERE customer_id IS NOT NULL AND name IS NOT NULL GROUP BY customer_id HAVING count(DISTINCT name) > 1""")
def q_second_names(spark, sf_dir):
    return quality.second_values(_dim_raw(spark, sf_dir), "customer_id", "name")


ABSENT = "staging_talent"


@query("quality_table_list", "table_name:s, present:s, row_count:l",
       " UNION ALL ".join([f"SELECT '{t}' AS table_name, 'true' AS present, count(*) AS row_count FROM {t}" for t in TABLES]
                          + [f"SELECT '{ABSENT}', 'false', NULL"]) + " ORDER BY table_name")
def q_table_list(spark, sf_dir):
    return quality.table_list(spark, sf_dir, [*TABLES, ABSENT])


NULL_COLS = ("grade_id", "area_id", "education_id", "major", "years_of_service_months")


@query("quality_null_counts", "n_rows:l, " + ", ".join(f"null_{c}:l" for c in NULL_COLS),
       "SELECT count(*) AS n_rows, " + ", ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_{c}"
                                                 for c in NULL_COLS) + " FROM fx_employees")
def q_null_counts(spark, sf_dir):
    return quality.quality_null_counts(fx.fx_employees(spark, sf_dir), NULL_COLS)


FX_VIEWS = ("fx_employees", "fx_performance", "fx_competencies", "fx_papi", "fx_strengths", "fx_psych")


@query("table_row_counts", "table_name:s, row_count:l",
       " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (*TABLES, *FX_VIEWS)))
def q_row_counts(spark, sf_dir):
    tables = {t: read_table(spark, sf_dir, t) for t in TABLES}
    tables.update({v: getattr(fx, v)(spark, sf_dir) for v in FX_VIEWS})
    return quality.table_row_counts(tables)


@query("value_counts", "disc:s, n:l",
       "SELECT disc, count(*) AS n FROM fx_psych GROUP BY disc ORDER BY n DESC, disc ASC NULLS FIRST LIMIT 50")
def q_value_counts(spark, sf_dir):
    return quality.value_counts(fx.fx_psych(spark, sf_dir), "disc", 50)


# ---- latest, pivots, joins, labels -----------------------------------------------------------------
@query("latest_per_key", "employee_id:s, year:i, rating:i", "SELECT * FROM perf_latest")
def q_latest(spark, sf_dir):
    return Bundle(spark, sf_dir).perf_latest


@query("latest_per_key_code", "employee_id:s, pillar_code:s, score:i", "SELECT * FROM comp_latest")
def q_latest_code(spark, sf_dir):
    return Bundle(spark, sf_dir).comp_latest


@query("pivot_latest", "employee_id:s, " + ", ".join(f"{c}:i" for c in fx.PILLAR_CODES),
       "SELECT employee_id, " + ", ".join(f"max(CASE WHEN pillar_code = '{c}' THEN score END) AS {c}"
                                          for c in fx.PILLAR_CODES) + " FROM comp_latest GROUP BY employee_id")
def q_pivot(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return pivot_wide(b.comp_latest, "employee_id", "pillar_code", "score", fx.PILLAR_CODES)


@query("abt_inner", "employee_id:s, rating:i, is_high:i, pillar_code:s, score:i",
       "SELECT l.employee_id, l.rating, l.is_high, c.pillar_code, c.score FROM lab l "
       "JOIN comp_latest c ON l.employee_id = c.employee_id")
def q_abt(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    return b.labels.join(b.comp_latest, "employee_id")


@query("label_left_join", "employee_id:s, rating:i, is_high:i",
       "SELECT p.employee_id, l.rating, CASE WHEN l.rating = 5 THEN 1 ELSE 0 END AS is_high "
       "FROM fx_psych p LEFT JOIN perf_latest l ON p.employee_id = l.employee_id")
def q_label_left(spark, sf_dir):
    b = Bundle(spark, sf_dir)
    j = b.psych.select("employee_id").join(b.perf_latest.select("employee_id", "rating"), "employee_id", "left")
    return j.withColumn("is_high", label_cohort("rating"))


@query("label_cohort", "employee_id:s, src_id:l, rating:i, is_high:i",
       "SELECT employee_id, src_id, rating, CASE WHEN rating = 5 THEN 1 ELSE 0 END AS is_high FROM fx_performance")
def q_label_cohort(spark, sf_dir):
    return fx.fx_performance(spark, sf_dir).withColumn("is_high", label_cohort("rating"))


@query("star_join_org", "employee_id:s, fullname:s, company:s, area:s, position:s, department:s, division:s, "
       "directorate:s, grade:s, education:s, major:s, years_of_service_months:i",
       """SELECT e.employee_id, e.fullname, c.r_name AS company, a.r_name AS area, p.n_name AS position,
  s.s_name AS department, v.p_name AS division, r.r_name AS directorate, e.grade, e.education, e.major,
  e.years_of_service_months
FROM emp_org e LEFT JOIN region c ON CAST(c.r_regionkey AS VARCHAR) = e.company_id
LEFT JOIN region a ON CAST(a.r_regionkey AS VARCHAR) = e.area_id
LEFT JOIN nation p ON CAST(p.n_nationkey AS VARCHAR) = e.position_id
LEFT JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = e.department_id
LEFT JOIN part v ON CAST(v.p_partkey AS VARCHAR) = e.division_id
LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = e.directorate_id""")
def q_star(spark, sf_dir):
    return Bundle(spark, sf_dir).employees_org_all


@query("employees_org_min", "employee_id:s, fullname:s, years_of_service_months:i, grade_id:s, education_id:s",
       "SELECT employee_id, fullname, years_of_service_months, grade_id, education_id FROM fx_employees")
def q_employees_org_min(spark, sf_dir):
    return employees_org_min(fx.fx_employees(spark, sf_dir))


@query("disc_normalise", "employee_id:s, disc:s, disc_word:s", "SELECT employee_id, disc, disc_word FROM psych_fixed")
def q_disc_norm(spark, sf_dir):
    return Bundle(spark, sf_dir).psych_fixed


MBTI_SQL = ("CASE WHEN regexp_full_match(upper(regexp_replace(mbti, '^\\s+|\\s+$', '', 'g')), '[EI][SN][TF][JP]') "
            "THEN upper(regexp_replace(mbti, '^\\s+|\\s+$', '', 'g')) END")


@query("mbti_normalise", "employee_id:s, mbti:s", f"SELECT employee_id, {MBTI_SQL} AS mbti FROM fx_psych")
def q_mbti_norm(spark, sf_dir):
    return fx.fx_psych(spark, sf_dir).select("employee_id", mbti_normalise("mbti").alias("mbti"))


@query("mbti_split", "employee_id:s, EI:s, SN:s, TF:s, JP:s",
       "SELECT employee_id, substr(m, 1, 1) AS EI, substr(m, 2, 1) AS SN, substr(m, 3, 1) AS TF, substr(m, 4, 1) AS JP "
       f"FROM (SELECT employee_id, {MBTI_SQL} AS m FROM fx_psych) s")
def q_mbti_split(spark, sf_dir):
    p = fx.fx_psych(spark, sf_dir).select("employee_id", mbti_normalise("mbti").alias("m"))
    return p.select("employee_id", *[mbti_letter(F.col("m"), i + 1).alias(d) for i, d in enumerate(("EI", "SN", "TF", "JP"))])
