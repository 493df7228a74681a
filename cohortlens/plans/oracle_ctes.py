"""DuckDB oracle text: the fixture views (FIXTURES.md) and derived frames as CTEs.

``with_ctes(sql)`` prepends every CTE the statement mentions (and their dependencies) so each oracle
statement runs on the driver's pre-registered base tables only.
"""

from __future__ import annotations

import re

from cohortlens.functions.columns import DISC_CODE_TO_LABEL, DISC_WORD_TO_CODE
from cohortlens.sources.fixtures import EDUCATION, GRADES, PILLAR_LABELS


def _case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE NULL END)"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _strip(x: str) -> str:
    return STRIP.format(x=x)


_word_key = f"replace(regexp_replace(lower({_strip('disc_word')}), '[–—]', '-', 'g'), ' ', '')"
_disc_filled = (f"CASE WHEN disc IS NULL OR {_strip('disc')} = '' THEN {_case_map(_word_key, DISC_WORD_TO_CODE)} "
                f"ELSE disc END")
_disc_clean = f"{_strip(f'upper({_disc_filled})')}"

CTES: dict[str, str] = {
    "fx_employees": """
SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_name AS fullname,
       CAST(c_nationkey % 4 + 1 AS VARCHAR) AS area_id, CAST(c_nationkey % 5 AS VARCHAR) AS company_id,
       CAST(c_nationkey AS VARCHAR) AS position_id, CAST(c_custkey % 11 AS VARCHAR) AS department_id,
       CAST(c_custkey % 50 AS VARCHAR) AS division_id, CAST(c_custkey % 6 AS VARCHAR) AS directorate_id,
       CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey % 3 + 1 AS VARCHAR) END AS grade_id,
       CAST(c_custkey % 4 + 1 AS VARCHAR) AS education_id,
       c_mktsegment AS major, CAST((c_custkey * 37) % 500 AS INT) AS years_of_service_months
FROM customer""",
    "fx_performance": """
SELECT CAST(o_custkey AS VARCHAR) AS employee_id, CAST(year(o_orderdate) AS INT) AS year,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 6 - CAST(substr(o_orderpriority,1,1) AS INT) END AS rating,
       o_orderkey AS src_id
FROM orders""",
    "fx_competencies": """
SELECT CAST(o_custkey AS VARCHAR) AS employee_id,
       (['SEA', 'CEX', 'VCU', 'STO', 'CSI', 'QDD', 'GDR', 'LIE', 'IDS', 'FTC'])[l_partkey % 10 + 1] AS pillar_code,
       CAST(year(l_shipdate) AS INT) AS year, 1 + CAST(l_quantity AS INT) % 5 AS score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_papi": """
SELECT CAST(c_custkey AS VARCHAR) AS employee_id,
       concat('Papi_', (['N', 'G', 'A', 'L', 'P', 'I', 'T', 'V', 'O', 'B', 'S', 'X', 'C', 'D', 'R', 'Z', 'E', 'K', 'F', 'W'])[i + 1]) AS scale_code,
       CAST(1 + (c_custkey * 7 + i * i * 13 + c_custkey * i) % 9 AS INT) AS score
FROM customer CROSS JOIN range(0, 20) s(i)
WHERE (c_custkey + i) % 11 <> 0""",
    "fx_strengths": """
SELECT employee_id, theme, CAST(rn AS INT) AS rank FROM (
  SELECT employee_id, theme, row_number() OVER (PARTITION BY employee_id ORDER BY n DESC, theme) AS rn FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS employee_id, theme, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN (VALUES (0,'Futuristic'),(1,'Intellection'),(2,'Context'),(3,'Developer'),(4,'Harmony'),(5,'Analytical'),
                 (6,'Learner'),(7,'Ideation'),(8,'Consistency'),(9,'Empathy'),(10,'Command'),(11,'Significance')) t(i,theme)
      ON l_partkey % 12 = t.i
    GROUP BY 1, 2) a) b
WHERE rn <= 5""",
    "fx_psych": """
SELECT CAST(c_custkey AS VARCHAR) AS employee_id,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal / 100 END AS pauli,
       CAST(40 + (c_custkey * 31) % 41 AS DOUBLE) AS faxtor, CAST(80 + (c_custkey * 17) % 61 AS DOUBLE) AS iq,
       CAST(15 + (c_custkey * 11) % 25 AS INT) AS gtq, CAST(1 + c_custkey % 10 AS INT) AS tiki,
       CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat(' ', lower(code), ' ') ELSE code END AS disc,
       CASE WHEN c_custkey % 13 = 0 THEN word ELSE NULL END AS disc_word,
       CASE WHEN c_custkey % 19 = 0 THEN 'INFTJ' WHEN c_custkey % 20 = 0 THEN ' entp ' ELSE mb END AS mbti
FROM (SELECT c_custkey, c_acctbal,
        (['DC', 'DS', 'DI', 'SD', 'SI', 'SC', 'IS', 'ID', 'IC', 'CD', 'CS', 'CI'])[c_custkey % 12 + 1] AS code,
        CASE c_custkey % 4 WHEN 0 THEN 'Steadiness – Influencer' WHEN 1 THEN 'dominantinfluencer' WHEN 2 THEN ' Conscientious—Dominant' ELSE 'unknown' END AS word,
        concat(substr('EI', CAST(c_custkey % 2 + 1 AS INT), 1), substr('SN', CAST(c_custkey % 7 % 2 + 1 AS INT), 1),
               substr('TF', CAST(c_custkey % 3 % 2 + 1 AS INT), 1), substr('JP', CAST(c_custkey % 5 % 2 + 1 AS INT), 1)) AS mb
      FROM customer) c""",
    "perf_latest": """
SELECT employee_id, year, rating FROM (
  SELECT employee_id, year, rating, row_number() OVER (PARTITION BY employee_id
         ORDER BY year DESC NULLS FIRST, rating DESC NULLS FIRST, src_id) AS rn
  FROM fx_performance) x WHERE rn = 1""",
    "lab": """
SELECT employee_id, rating, CASE WHEN rating = 5 THEN 1 ELSE 0 END AS is_high FROM perf_latest""",
    "comp_latest": """
SELECT employee_id, pillar_code, score FROM (
  SELECT employee_id, pillar_code, score, row_number() OVER (PARTITION BY employee_id, pillar_code
         ORDER BY year DESC NULLS FIRST, score DESC NULLS FIRST) AS rn
  FROM fx_competencies) x WHERE rn = 1""",
    "psych_fixed": f"""
SELECT employee_id, pauli, faxtor, iq, gtq, tiki, disc,
       CASE WHEN disc_word_raw IS NULL OR {_strip('disc_word_raw')} = '' THEN {_case_map('disc', DISC_CODE_TO_LABEL)}
            ELSE disc_word_raw END AS disc_word, mbti
FROM (SELECT employee_id, pauli, faxtor, iq, gtq, tiki, mbti, disc_word AS disc_word_raw,
             CASE WHEN {_disc_clean} IN ('', 'NAN', 'NONE') THEN NULL ELSE {_disc_clean} END AS disc
      FROM fx_psych) p""",
    "emp_org": f"""
SELECT e.*, d.education, g.grade
FROM fx_employees e
LEFT JOIN {_values(GRADES, ['grade_id', 'grade'])} ON e.grade_id = t.grade_id
LEFT JOIN (SELECT * FROM {_values(EDUCATION, ['education_id', 'education'])}) d ON e.education_id = d.education_id""",
    "pillar_dim": f"SELECT * FROM {_values(PILLAR_LABELS, ['pillar_code', 'pillar_label'])}",
}
# the grade join above aliases the VALUES list as t; give it its own name
CTES["emp_org"] = CTES["emp_org"].replace(f"LEFT JOIN {_values(GRADES, ['grade_id', 'grade'])} ON e.grade_id = t.grade_id",
                                          f"LEFT JOIN (SELECT * FROM {_values(GRADES, ['grade_id', 'grade'])}) g "
                                          f"ON e.grade_id = g.grade_id")

_ORDER = list(CTES)


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b{re.escape(name)}\b", sql) is not None


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it (transitively) uses, in dependency order.

    ``extra`` adds statement-local CTEs (name -> body) that may use the shared ones.
    """
    defs = dict(CTES)
    order = list(_ORDER)
    if extra:
        defs.update(extra)
        order += [k for k in extra if k not in order]
    needed: set[str] = set()
    frontier = [sql] + ([*extra.values()] if extra else [])
    while frontier:
        text = frontier.pop()
        for name in order:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                frontier.append(defs[name])
    parts = [f"{n} AS ({defs[n].strip()})" for n in order if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" + sql) if parts else sql
