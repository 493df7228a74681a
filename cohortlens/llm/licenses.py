"""Operator 8: license scan by sparse TF-IDF cosine, with inheritance from the nearest ancestor directory.

Each line of a file (a header can stand anywhere) and each whole file is compared with license
templates by the cosine of their TF-IDF vectors. A line at ``HEADER`` or more gives the file its own
license; a whole text at ``FILE`` or more makes it a licence file, which licenses its directory and all
below that have no nearer one. Directories, not files, are joined with their ancestors.

Document frequencies are counted over all files. They are needed for the terms of the templates only:
any other term weighs like one never seen, so nothing grows with the corpus's vocabulary, and what
the driver fetches is one count per template term. The vectors are looked at only where the text has
an anchor, a term without which no cosine can reach the lower threshold: with the other terms alone a
template's vector is too short. That skips no match.

Everything is built from DataFrame functions.

Defined cases: a null or empty text has no license and can inherit one; a null path inherits nothing;
of several licence files in a directory the one with the largest cosine counts, ties to the smaller
license name, then the smaller path; ties between templates go to the smaller name; repeated rows are
judged alike; an empty table gives no rows; further columns are carried through unless they bear one
of the result's names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, written

# Names and statements of public licenses.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
HEADER = 0.75   # least cosine of a line
FILE = 0.6      # least cosine of a whole text
DIGITS = 9      # cosines are compared after rounding to so many places
TERM = r"[\p{L}\p{N}]+"
OWN = ["own_license", "own_score", "file_license", "file_score", "inherited_license", "inherited_from", "license"]


def terms(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


class Weights:
    """Inverse document frequencies of the template terms, and what follows from them."""

    def __init__(self, templates: list[tuple[str, str]], df: dict[str, int], n: int):
        self.templates = [(name, terms(text)) for name, text in templates]
        self.unseen = math.log(1 + n) + 1
        self.idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for _, own in self.templates for t in own}
        self.norm = [math.sqrt(sum((own.count(t) * self.idf[t]) ** 2 for t in set(own)))
                     for _, own in self.templates]

    def anchors(self, least: float) -> list[str]:
        """Terms of which any text with a cosine of ``least`` or more has one."""
        out: set[str] = set()
        for (_, own), norm in zip(self.templates, self.norm, strict=True):
            rest = 1.0
            for t in sorted(set(own), key=lambda x: (-self.idf[x] * own.count(x), x)):
                if math.sqrt(max(rest, 0)) < least - 1e-9:
                    break
                out.add(t)
                rest -= (own.count(t) * self.idf[t] / norm) ** 2
        return sorted(out)

    def best(self, text: Column) -> Column:
        """Struct (minus, license): negative cosine and name of the nearest template; null without a term."""
        idf = F.create_map(*(F.lit(x) for t, v in self.idf.items() for x in (t, v)))
        dots = F.create_map(*(x for t in self.idf for x in (
            F.lit(t), F.array(*(F.lit(own.count(t) * self.idf[t] ** 2) for _, own in self.templates)))))
        words = _terms(text)

        def weight(t: Column) -> Column:
            return F.coalesce(F.element_at(idf, t), F.lit(self.unseen))

        # squared length: terms in order, each run of one term counted as it ends
        run = F.aggregate(
            F.array_sort(words), F.struct(F.lit("").alias("t"), F.lit(0.0).alias("n"), F.lit(0.0).alias("sum")),
            lambda a, t: F.when(t == a["t"], F.struct(a["t"].alias("t"), (a["n"] + 1).alias("n"), a["sum"].alias("sum")))
            .otherwise(F.struct(t.alias("t"), F.lit(1.0).alias("n"),
                                (a["sum"] + F.pow(a["n"] * weight(a["t"]), F.lit(2.0))).alias("sum"))),
            lambda a: a["sum"] + F.pow(a["n"] * weight(a["t"]), F.lit(2.0)))
        dot = F.aggregate(F.filter(words, lambda t: F.map_contains_key(dots, t)),
                          F.array(*(F.lit(0.0) for _ in self.templates)),
                          lambda a, t: F.zip_with(a, F.element_at(dots, t), lambda x, y: x + y))
        def nearest(x: Column) -> Column:
            return F.array_min(F.array(*(  # largest cosine, then smallest name
                F.struct(F.round(-x["dot"][i] / (F.sqrt(x["length"]) * norm), DIGITS).alias("minus"),
                         F.lit(name).alias("license"))
                for i, ((name, _), norm) in enumerate(zip(self.templates, self.norm, strict=True)))))

        # by way of a one-element array, so that length and dot are worked out once
        once = F.transform(F.array(F.struct(run.alias("length"), dot.alias("dot"))), nearest)[0]
        return F.when(F.size(words) > 0, once)


def weights(files: DataFrame, templates: list[tuple[str, str]]) -> Weights:
    """Count the template terms over all rows of ``files`` (text)."""
    known = sorted({t for _, text in templates for t in terms(text)})
    has = F.array_intersect(_terms(F.col("text")), F.array(*map(F.lit, known)))
    counts = files.select(F.explode_outer(has).alias("term")).groupBy("term").count().collect()  # template terms only
    return Weights(templates, {r["term"]: r["count"] for r in counts if r["term"]}, files.count())


def license_scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, header: float = HEADER,
                 file: float = FILE) -> DataFrame:
    """The rows of ``files`` (path, text, ...) without their text, with the columns OWN.

    own_license, own_score: nearest template of the best line; file_license, file_score: of the whole text, for
    licence files; inherited_license, inherited_from: of the nearest directory upwards; license: own, else
    inherited.
    """
    model = weights(files, templates or TEMPLATES)
    anchor = r"(?<![\p{L}\p{N}])(?:" + "|".join(model.anchors(min(header, file))) + r")(?![\p{L}\p{N}])"
    rest = [c for c in files.columns if c not in (*OWN, "text")]
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.lower(x).rlike(anchor))
    line = F.array_min(F.transform(lines, model.best))
    near = F.lower("text").rlike(anchor)
    rows = written(files.select(*rest, F.when(near, line).alias("_line"),
                                F.when(near, model.best(F.col("text"))).alias("_file")), "license-cosines")
    line_ok, file_ok = -F.col("_line.minus") >= header, -F.col("_file.minus") >= file
    rows = rows.select(
        *rest, F.when(line_ok, F.col("_line.license")).alias("own_license"),
        F.when(line_ok, -F.col("_line.minus")).alias("own_score"),
        F.when(file_ok, F.col("_file.license")).alias("file_license"),
        F.when(file_ok, -F.col("_file.minus")).alias("file_score"),
        F.regexp_replace("path", r"/?[^/]*$", "").alias("_dir"))

    licensed = rows.where("file_license is not null and path is not null").groupBy("_dir").agg(
        F.min(F.struct((-F.col("file_score")).alias("s"), F.col("file_license").alias("l"), "path")).alias("best")) \
        .select(F.col("_dir").alias("at"), F.col("best.l").alias("inherited_license"))
    parts = F.filter(F.split("_dir", "/"), lambda x: x != "")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.concat_ws("/", F.slice(parts, 1, i)))
    steps = rows.select("_dir").distinct().where("_dir is not null") \
        .select("_dir", F.posexplode(up).alias("depth", "at"))
    found = steps.join(licensed, "at").groupBy("_dir").agg(
        F.max(F.struct("depth", "at", "inherited_license")).alias("x")) \
        .select("_dir", F.col("x.inherited_license").alias("inherited_license"), F.col("x.at").alias("inherited_from"))
    return rows.join(found, "_dir", "left").select(
        *rest, "own_license", "own_score", "file_license", "file_score", "inherited_license", "inherited_from",
        F.coalesce("own_license", "inherited_license").alias("license"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """The license of every document; its path is source / lang / doc_id."""
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "text")
    files = docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
                        "text")
    return license_scan(files).select("doc_id", "path", "own_license", F.round("own_score", 6).alias("own_score"),
                                      "file_license", F.round("file_score", 6).alias("file_score"),
                                      "inherited_license", "inherited_from", "license")


def oracle() -> str:
    """DuckDB SQL for :func:`op8_license_scan`."""
    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
    return f"""
WITH template(id, license, body) AS (VALUES {rows}),
template_term AS (
  SELECT id, license, term, count(*) AS tf
  FROM (SELECT id, license, unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM template) GROUP BY ALL),
file AS (
  SELECT row_number() OVER () AS r, doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, text
  FROM documents),
df AS (
  SELECT term, count(DISTINCT r) AS df
  FROM (SELECT r, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM file)
  WHERE term IN (SELECT term FROM template_term) GROUP BY term),
n AS (SELECT count(*) AS n FROM file),
idf AS (
  SELECT DISTINCT t.term, ln((1.0 + n.n) / (1 + coalesce(df.df, 0))) + 1 AS idf
  FROM template_term t CROSS JOIN n LEFT JOIN df USING (term)),
template_norm AS (SELECT id, sqrt(sum((tf * idf) ** 2)) AS norm FROM template_term JOIN idf USING (term) GROUP BY id),
unit AS (  -- unit 0 is the whole text, the others its lines
  SELECT r, 0 AS u, text AS body FROM file WHERE text IS NOT NULL
  UNION ALL
  SELECT r, unnest(range(1, len(parts) + 1)) AS u, unnest(parts) AS body
  FROM (SELECT r, string_split(text, chr(10)) AS parts FROM file WHERE text IS NOT NULL)),
unit_term AS (
  SELECT r, u, term, count(*) AS tf
  FROM (SELECT r, u, unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM unit) GROUP BY ALL),
unit_norm AS (
  SELECT r, u, sqrt(sum((tf * coalesce(idf, ln(1.0 + n.n) + 1)) ** 2)) AS norm
  FROM unit_term CROSS JOIN n LEFT JOIN idf USING (term) GROUP BY r, u),
cosine AS (
  SELECT x.r, x.u, t.id, any_value(t.license) AS license,
         round(sum(x.tf * t.tf * idf.idf ** 2) / any_value(un.norm * tn.norm), {DIGITS}) AS score
  FROM unit_term x JOIN template_term t USING (term) JOIN idf USING (term)
  JOIN unit_norm un ON un.r = x.r AND un.u = x.u JOIN template_norm tn ON tn.id = t.id
  GROUP BY x.r, x.u, t.id),
best AS (
  SELECT r, u = 0 AS whole, license, score,
         row_number() OVER (PARTITION BY r, u = 0 ORDER BY score DESC, license) AS place FROM cosine),
judged AS (
  SELECT f.doc_id, f.path, regexp_replace(f.path, '/?[^/]*$', '') AS dir, l.license AS own_license,
         l.score AS own_score, w.license AS file_license, w.score AS file_score
  FROM file f
  LEFT JOIN best l ON l.r = f.r AND NOT l.whole AND l.place = 1 AND l.score >= {HEADER}
  LEFT JOIN best w ON w.r = f.r AND w.whole AND w.place = 1 AND w.score >= {FILE}),
licensed AS (
  SELECT dir AS above, license FROM (
    SELECT dir, file_license AS license,
           row_number() OVER (PARTITION BY dir ORDER BY file_score DESC, file_license, path) AS place
    FROM judged WHERE file_license IS NOT NULL) WHERE place = 1),
upward AS (
  SELECT dir, depth, array_to_string(parts[1:depth], '/') AS above
  FROM (SELECT dir, parts, unnest(range(0, len(parts) + 1)) AS depth
        FROM (SELECT DISTINCT dir, list_filter(string_split(dir, '/'), lambda x: x <> '') AS parts FROM judged))),
inherited AS (
  SELECT dir, license AS inherited_license, above AS inherited_from FROM (
    SELECT u.dir, l.license, u.above, row_number() OVER (PARTITION BY u.dir ORDER BY u.depth DESC) AS place
    FROM upward u JOIN licensed l USING (above)) WHERE place = 1)
SELECT j.doc_id, j.path, j.own_license, round(j.own_score, 6) AS own_score, j.file_license,
       round(j.file_score, 6) AS file_score, i.inherited_license, i.inherited_from,
       coalesce(j.own_license, i.inherited_license) AS license
FROM judged j LEFT JOIN inherited i USING (dir)"""
