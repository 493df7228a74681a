"""Query registry: each query has a Spark builder, an output spec and (optionally) oracle SQL.

The spec (``"name:type, ..."``, type in s=string, d=double rounded to 6 places, l=bigint, i=int)
fixes column names, order and types once; it finalises the Spark frame and wraps the oracle SQL, so
the two sides cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.plans.oracle_ctes import with_ctes

ROUND = 6
QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, list[tuple[str, str]], str | None]] = {}


def parse_spec(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split(","):
        name, typ = part.strip().split(":")
        out.append((name.strip(), typ.strip()))
    return out


def finalize(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for name, typ in spec:
        c = F.col(name)
        if typ == "d":
            cols.append((F.round(c.cast("double"), ROUND) + F.lit(0.0)).alias(name))
        elif typ == "l":
            cols.append(c.cast("bigint").alias(name))
        elif typ == "i":
            cols.append(c.cast("int").alias(name))
        else:
            cols.append(c.cast("string").alias(name))
    return df.select(*cols)


def wrap_sql(sql: str, spec: list[tuple[str, str]], extra: dict[str, str] | None = None) -> str:
    cols = []
    for name, typ in spec:
        q = f'"{name}"'
        if typ == "d":
            cols.append(f"round(CAST({q} AS DOUBLE), {ROUND}) + 0.0 AS {q}")
        elif typ == "l":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif typ == "i":
            cols.append(f"CAST({q} AS INTEGER) AS {q}")
        else:
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
    body = with_ctes(f"SELECT * FROM ({sql.strip().rstrip(';')}) q_inner", extra)
    return f"SELECT {', '.join(cols)} FROM (\n{body}\n) q_outer"


def query(name: str, spec: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    parsed = parse_spec(spec)

    def deco(fn: QueryFn) -> QueryFn:
        sql = wrap_sql(oracle, parsed, extra) if oracle is not None else None
        REGISTRY[name] = (fn, parsed, sql)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    def bind(fn, parsed):
        return lambda spark, sf_dir: finalize(fn(spark, sf_dir), parsed)
    return {name: bind(fn, parsed) for name, (fn, parsed, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, _, sql) in REGISTRY.items() if sql is not None}
