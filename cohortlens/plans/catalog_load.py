"""Catalogue: loads from CSV and back, maintained latest rows, constraint checks over several tables at once."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cohortlens.operators import quality
from cohortlens.operators.latest import desc_nulls_first, update_latest
from cohortlens.plans import etl
from cohortlens.plans.catalog_etl import BATCH_FROM, LOAD_CUT, b2n, round_int
from cohortlens.plans.registry import query
from cohortlens.session import cut_lineage, new_scratch_path
from cohortlens.sources import fixtures as fx
from cohortlens.sources import projections as pj
from cohortlens.sources.tables import read_table
from cohortlens.sources.versions import VersionedTable

# ---- CSV -> core, twice ----------------------------------------------------------------------------
# Ratings of orders, with blanks, in two deliveries by business date, and a dimension whose names hold quotes,
# commas and line breaks.
RATING_TEXT = "CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat({0} - CAST(substr(o_orderpriority, 1, 1) AS INTEGER), '.0') END"
ID_TEXT = "CASE WHEN o_orderkey % 31 = 0 THEN '  ' ELSE concat(' ', o_custkey, ' ') END"
NATION_TEXT = "concat(' ', n_name, chr(10), '\"', n_regionkey, '\", ', n_nationkey, ' ')"


def _delivery_sql(high: int, where: str) -> str:
    return f"""SELECT employee_id, year, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY employee_id, year ORDER BY rating ASC NULLS LAST) AS rn FROM (
    SELECT {b2n('raw_id')} AS employee_id, year, {round_int('raw_rating')} AS rating FROM (
      SELECT {ID_TEXT} AS raw_id, CAST(year(o_orderdate) AS INTEGER) AS year, {RATING_TEXT.format(high)} AS raw_rating
      FROM orders WHERE {where}) r) t WHERE employee_id IS NOT NULL) x WHERE rn = 1"""


FIRST_SQL = _delivery_sql(6, f"o_orderdate < TIMESTAMP '{LOAD_CUT}'")
SECOND_SQL = _delivery_sql(9, f"o_orderdate >= TIMESTAMP '{BATCH_FROM}'")


@query("load_round_trip", "table_name:s, id:s, year:i, value:s", f"""
SELECT 'performance_yearly' AS table_name, employee_id AS id, year, CAST(rating AS VARCHAR) AS value FROM (
  SELECT * FROM ({FIRST_SQL}) a WHERE NOT EXISTS (
    SELECT 1 FROM ({SECOND_SQL}) b WHERE b.employee_id = a.employee_id AND b.year = a.year)
  UNION ALL SELECT * FROM ({SECOND_SQL}) c) p
UNION ALL
SELECT 'dim_positions', CAST(n_nationkey AS VARCHAR), NULL, trim({NATION_TEXT}) FROM nation""")
def q_load_round_trip(spark, sf_dir):
    """Written as CSV, loaded, cleaned and upserted twice; the tables that result."""
    folder = new_scratch_path(spark, "load")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    nations = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("position_id"),
                                                         F.expr(NATION_TEXT).alias("name"))
    core = {}
    for i, (high, rows) in enumerate(((6, orders.where(F.col("o_orderdate") < LOAD_CUT)),
                                      (9, orders.where(F.col("o_orderdate") >= BATCH_FROM)))):
        ratings = rows.select(F.expr(ID_TEXT).alias("employee_id"), F.expr(RATING_TEXT.format(high)).alias("rating"),
                              F.year("o_orderdate").cast("string").alias("year"))
        for name, df in (("performance_yearly", ratings), ("dim_positions", nations)):
            df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/in{i}/{name}.csv")
        core = etl.build_core(spark, f"{folder}/in{i}", f"{folder}/core", ["performance_yearly", "dim_positions"])
    none = F.lit(None).cast("int")
    return core["performance_yearly"].select(F.lit("performance_yearly").alias("table_name"), F.col("employee_id").alias("id"),
                                             "year", F.col("rating").cast("string").alias("value")).unionByName(
        core["dim_positions"].select(F.lit("dim_positions").alias("table_name"), F.col("position_id").alias("id"),
                                     none.alias("year"), F.col("name").alias("value")))


# ---- maintained latest ------------------------------------------------------------------------------
LATEST = StructType([StructField("employee_id", StringType()), StructField("year", IntegerType()),
                     StructField("rating", IntegerType()), StructField("src_id", LongType())])


@query("latest_incremental", "employee_id:s, year:i, rating:i", "SELECT * FROM perf_latest")
def q_latest_incremental(spark, sf_dir):
    """The latest rating per employee, kept up to date with two deliveries instead of computed from all history."""
    rows = fx.fx_performance(spark, sf_dir)
    low = F.coalesce(F.col("rating") <= 3, F.lit(True))
    kept = VersionedTable(spark, new_scratch_path(spark, "latest"), LATEST)
    order = [*desc_nulls_first("year", "rating"), F.col("src_id").asc()]
    for batch in (rows.where(low), rows.where(~low)):
        update_latest(kept, batch, ["employee_id"], order)
        kept.vacuum()
    return kept.read().select("employee_id", "year", "rating")


# ---- all constraints from one census ----------------------------------------------------------------
# The dimensions lack what a partial delivery would: parts of small size, overdrawn suppliers, one market segment. Some
# orders lost their key or their customer.
SETS = {
    "lineitem": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
    "orders": "SELECT CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey END AS o_orderkey, "
              "CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS o_custkey, o_orderpriority FROM orders",
    "customer": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "part": "SELECT p_partkey, p_type FROM part WHERE p_size > 5",
    "supplier": "SELECT s_suppkey, s_nationkey, s_name FROM supplier WHERE s_acctbal >= 0",
    "nation": "SELECT n_nationkey, n_name FROM nation",
}
RULES = {
    "lineitem": quality.TableRules(("l_orderkey", "l_linenumber"), {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"}),
    "orders": quality.TableRules(("o_orderkey",), {"o_custkey": "customer"}, lengths={"o_orderpriority": 6}),
    "customer": quality.TableRules(("c_custkey",), {"c_nationkey": "nation"}, unique=("c_mktsegment",)),
    "part": quality.TableRules(("p_partkey",), unique=("p_type",)),
    "supplier": quality.TableRules(("s_suppkey",), {"s_nationkey": "nation"}, unique=("s_name",)),
    "nation": quality.TableRules(("n_nationkey",), unique=("n_name",), lengths={"n_name": 8}),
}


def _census(spark, sf_dir):
    """The census of the references of the six tables and of the keys they refer to; it is cut off, so that each table is
    scanned once although the orphans are sought in the census itself."""
    return cut_lineage(quality.key_census(_frames(spark, sf_dir), quality.reference_rules(RULES)))


def _frames(spark, sf_dir):
    return {name: spark.sql(sql.replace(f"FROM {name}", "FROM {t}"), t=read_table(spark, sf_dir, name))
            for name, sql in SETS.items()}


def _orphans_sql() -> str:
    out = []
    for name, r in RULES.items():
        for c, ref in r.refers.items():
            key = RULES[ref].keys[0]
            out.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{ref}' AS ref, CAST({c} AS VARCHAR) AS id, "
                       f"count(*) AS n FROM ({SETS[name]}) f WHERE {c} IS NOT NULL AND NOT EXISTS ("
                       f"SELECT 1 FROM ({SETS[ref]}) d WHERE d.{key} = f.{c}) GROUP BY {c}")
    return " UNION ALL ".join(out)


def _counts_sql() -> str:
    out = []
    for name, r in RULES.items():
        for kind, columns, most in (("key", r.keys, None), *(("ref", (c,), None) for c in r.refers),
                                    *(("unique", (c,), None) for c in r.unique), *(("length", (c,), m) for c, m in r.lengths.items())):
            null = " OR ".join(f"{c} IS NULL" for c in columns)
            again = f"(count(*) > 1 AND NOT ({null}))" + (f" OR {null}" if kind == "key" else "")
            long = "0" if most is None else f"count(CASE WHEN length({columns[0]}) > {most} THEN 1 END)"
            out.append(f"SELECT '{name}' AS table_name, '{kind}' AS kind, '{','.join(columns)}' AS subject, count(*) AS n_rows, "
                       f"count(CASE WHEN {null} THEN 1 END) AS n_null, (SELECT count(*) FROM (SELECT {', '.join(columns)} FROM "
                       f"({SETS[name]}) g GROUP BY {', '.join(columns)} HAVING {again}) h) AS n_repeated, {long} AS n_long "
                       f"FROM ({SETS[name]}) t")
    return " UNION ALL ".join(out)


@query("quality_foreign_keys", "table_name:s, column_name:s, ref:s, id:s, n:l", _orphans_sql())
def q_foreign_keys(spark, sf_dir):
    return quality.orphan_keys(_census(spark, sf_dir))


@query("quality_constraints", "table_name:s, kind:s, subject:s, n_rows:l, n_null:l, n_repeated:l, n_long:l", _counts_sql())
def q_constraints(spark, sf_dir):
    return quality.census_counts(quality.key_census(_frames(spark, sf_dir), RULES))  # read once, so not cut off


# ---- the other named projections --------------------------------------------------------------------
@query("perf_all", "employee_id:s, year:i, rating:i", "SELECT employee_id, year, rating FROM fx_performance")
def q_perf_all(spark, sf_dir):
    return pj.perf_all(fx.fx_performance(spark, sf_dir))


@query("comp_all", "employee_id:s, pillar_code:s, year:i, score:i", "SELECT employee_id, pillar_code, year, score FROM fx_competencies")
def q_comp_all(spark, sf_dir):
    return pj.comp_all(fx.fx_competencies(spark, sf_dir))


@query("papi_all", "employee_id:s, scale_code:s, score:i", "SELECT employee_id, scale_code, score FROM fx_papi")
def q_papi_all(spark, sf_dir):
    return pj.papi_scores(fx.fx_papi(spark, sf_dir))


PSYCH_SPEC = "employee_id:s, pauli:d, faxtor:d, disc:s, {word}mbti:s, iq:d, gtq:i, tiki:i"


@query("psych_all", PSYCH_SPEC.format(word=""), "SELECT employee_id, pauli, faxtor, disc, mbti, iq, gtq, tiki FROM fx_psych")
def q_psych_all(spark, sf_dir):
    return pj.psych(fx.fx_psych(spark, sf_dir))


@query("psych_full", PSYCH_SPEC.format(word="disc_word:s, "),
       "SELECT employee_id, pauli, faxtor, disc, disc_word, mbti, iq, gtq, tiki FROM fx_psych")
def q_psych_full(spark, sf_dir):
    return pj.psych(fx.fx_psych(spark, sf_dir), with_word=True)
