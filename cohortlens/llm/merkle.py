"""Operator 12: a Merkle manifest of a dataset, checked by a recursive query that climbs from the leaves.

Every row is a leaf, the hash of its columns. Leaves stand in order of id within their language; eight
consecutive nodes at a time have their hash as parent until one is left, the language's subroot, and the
subroots have a tree of the same kind above them. :func:`build` writes the levels as node rows that name their
parent (``id``, ``up``, ``slot`` in the parent, ``hash``, and ``kids``, the hashes of the children).
:func:`climb` is one Spark recursive query over these rows: each step joins what has been reached with the parent
rows, appends the siblings found there, folds them around the hash that was carried up, and ends at the root.

The leaves of one parent share all siblings above it. They climb together, as one row with at most eight
folds, so what moves a step is an eighth of what rows of single leaves would move.

Order inside a language comes from range partitions and counts (no window over a language); a parent gathers
at most eight rows; joins of the climb have a node row for each key on one side, so a language with most rows
is a skewed join that adaptive execution splits. The driver fetches one number, the largest count.

Defined cases: every null column enters a leaf as ``-``; rows without an id come first; rows with the
same id stand in order of their hashes, and rows alike in every column are leaves of equal hash; a lone leaf
of a language is its subroot, and with one language that is the root; with no siblings the proof is the hash
of nothing; an empty table gives no rows; columns other than the five are not part of the manifest.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, written
from cohortlens.operators.prefix import rank_rows

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOP = "top"  # the tree above the languages; theirs begin with - or =


def sha(text: Column) -> Column:
    """SHA-256 of a text or of bytes, as bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """Hash of the columns in order: - for null, else UTF-8 byte count, colon, value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return sha(F.concat(*(field(c) for c in columns.values())))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


class Manifest(NamedTuple):
    """``runs``: the leaves of a parent together; ``nodes``: all rows above the leaves."""

    runs: DataFrame
    nodes: DataFrame


def _id(level: Column, pos: Column, tree: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), pos.cast("string"), tree)


def _parents(level: DataFrame) -> DataFrame:
    """(tree, n, pos, hash) of a level -> that of the next, with ``kids``; n is the number of nodes of the level."""
    up = level.groupBy("tree", "n", F.floor(F.col("pos") / FANOUT).alias("pos")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("c"))
    kids = F.aggregate("c", F.lit(b""), lambda a, x: F.concat(a, x["hash"]))
    return up.select("tree", F.ceil(F.col("n") / FANOUT).alias("n"), "pos", kids.alias("kids")) \
        .withColumn("hash", sha(hexed(F.col("kids"))))


def _levels(first: DataFrame, most: int, start: int, name: str) -> list[DataFrame]:
    """Levels above ``first`` (tree, n, pos, hash), whose largest tree has ``most`` nodes; each is written."""
    out, level, at = [], first, start
    while most > 1:
        at, most = at + 1, -(-most // FANOUT)
        level = written(_parents(level.where("n > 1").select("tree", "n", "pos", "hash"))
                        .withColumn("level", F.lit(at)), f"merkle-{name}{at}")
        out.append(level)
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build(docs: DataFrame, carried: DataFrame | None = None) -> Manifest:
    """The manifest of ``docs`` (the columns FIELDS).

    ``carried``, if given, has the columns ``lang``, ``doc_id``, ``leaf`` and ``fold`` of the same rows: the leaf on
    record and the hash to carry up in its place, for a table that may have changed.
    """
    if carried is None:
        leaf = leaf_hash({c: F.col(c) for c in FIELDS})
        carried = docs.select("lang", "doc_id", leaf.alias("leaf")).withColumn("fold", F.col("leaf"))
    # null first, then by the bytes of the language: - stands before =
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    rows = written(carried.select(tree.alias("tree"), "doc_id", "leaf", "fold"), "merkle-leaves")
    trees = written(rank_rows(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), [F.col("tree")], rank_col="place")
                    .select("tree", "n", (F.col("place") - 1).alias("place")), "merkle-trees")
    size = trees.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("trees")).collect()[0]  # two numbers

    ranked = rank_rows(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("fold")], ["tree"])
    members = F.sort_array(F.collect_list(F.struct(F.col("rank"), "doc_id", "leaf", "fold")))
    runs = ranked.withColumn("pos", F.floor((F.col("rank") - 1) / FANOUT)).groupBy("tree", "pos") \
        .agg(members.alias("members")).join(trees, "tree")
    kids = F.aggregate("members", F.lit(b""), lambda a, m: F.concat(a, m["leaf"]))
    lone = F.col("n") == 1
    runs = runs.withColumn("kids", kids) \
        .withColumn("hash", F.when(lone, F.col("kids")).otherwise(sha(hexed(F.col("kids"))))) \
        .withColumn("members", F.transform("members", lambda m, j: F.struct(
            m["doc_id"].alias("doc_id"), m["leaf"].alias("leaf"),
            F.when(lone, m["fold"]).otherwise(_folded(F.col("kids"), j, m["fold"])).alias("fold"))))
    runs = written(runs.select("tree", F.ceil(F.col("n") / FANOUT).alias("n"), "pos", "place", "members", "hash"),
                   "merkle-runs")

    levels = _levels(runs, -(-(size["n"] or 0) // FANOUT), 1, "level")
    tops = _union([x.where("n = 1").select("tree", "hash") for x in (runs, *levels)])
    tops = tops.join(trees, "tree").select(F.lit(_TOP).alias("tree"), F.lit(size["trees"]).cast("long").alias("n"),
                                           F.col("place").alias("pos"), "hash")
    above = _levels(tops, size["trees"], 0, "top")

    single = size["trees"] <= 1
    lang_up = F.when(F.col("n") > 1, _id(F.col("level") + 1, F.floor(F.col("pos") / FANOUT), F.col("tree")))
    if not single:
        lang_up = F.coalesce(lang_up, _id(F.lit(1), F.floor(F.col("place") / FANOUT), F.lit(_TOP)))
    slot = F.when(F.col("n") > 1, F.col("pos")).otherwise(F.col("place")) % FANOUT
    top_up = F.when(F.col("n") > 1, _id(F.col("level") + 1, F.floor(F.col("pos") / FANOUT), F.lit(_TOP)))
    own = _id(F.col("level"), F.col("pos"), F.col("tree"))
    nodes = [x.join(trees.select("tree", "place"), "tree").select(
        own.alias("id"), lang_up.alias("up"), slot.cast("int").alias("slot"), "hash", "kids",
        (F.col("n") == 1).alias("subroot")) for x in levels]
    nodes += [x.select(own.alias("id"), top_up.alias("up"), (F.col("pos") % FANOUT).cast("int").alias("slot"), "hash",
                       "kids", F.lit(False).alias("subroot")) for x in above]
    runs = runs.withColumn("level", F.lit(1))
    if not nodes:
        nodes = [runs.limit(0).select(own.alias("id"), lang_up.alias("up"), slot.cast("int").alias("slot"), "hash",
                                      F.col("hash").alias("kids"), F.lit(False).alias("subroot"))]
    return Manifest(runs.select(own.alias("id"), lang_up.alias("up"), slot.cast("int").alias("slot"), "hash",
                                F.when(F.col("n") == 1, F.col("hash")).alias("subroot"), "members"),
                    written(_union(nodes), "merkle-nodes"))


def _folded(kids: Column, slot: Column, fold: Column) -> Column:
    """Hash of the children with the one at ``slot`` replaced."""
    return sha(hexed(F.concat(F.substr(kids, F.lit(1), 32 * slot), fold, F.substr(kids, 32 * slot + 33))))


_CLIMB = """
WITH RECURSIVE climb(members, up, slot, hash, subroot, proof) MAX RECURSION LEVEL 100 AS (
  SELECT members, up, slot, hash, subroot, CAST('' AS BINARY) AS proof FROM {runs}
  UNION ALL
  SELECT transform(c.members, m -> named_struct('doc_id', m.doc_id, 'leaf', m.leaf, 'fold', unhex(sha2(lower(hex(concat(
           substr(n.kids, 1, 32 * c.slot), m.fold, substr(n.kids, 32 * c.slot + 33)))), 256)))),
         n.up, n.slot, n.hash, IF(n.subroot, n.hash, c.subroot),
         concat(c.proof, substr(n.kids, 1, 32 * c.slot), substr(n.kids, 32 * c.slot + 33))
  FROM climb c JOIN {nodes} n ON c.up = n.id
)
SELECT members, hash, subroot, proof FROM climb WHERE up IS NULL"""


@contextmanager
def _unlimited_recursion(spark: SparkSession):
    """A recursive query ends beyond a number of rows in all; the climb has as many as the manifest has nodes."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def climb(manifest: Manifest, siblings: bool = False) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; all hashes in hexadecimal.

    ``siblings`` adds the proof itself: the hashes that folding needs, from the leaf's own siblings upwards, in one
    hexadecimal string. The query runs here, and its result is written, as the session's limit on the rows of a
    recursion is lifted only meanwhile.
    """
    spark = manifest.nodes.sparkSession
    ends = spark.sql(_CLIMB, runs=manifest.runs, nodes=manifest.nodes)
    kids = F.array_join(F.transform("members", lambda m: hexed(m["leaf"])), "")
    rows = ends.select("hash", "subroot", "proof", kids.alias("kids"), F.posexplode("members").alias("slot", "m"))
    own = F.concat(F.substr("kids", F.lit(1), 64 * F.col("slot")), F.substr("kids", 64 * F.col("slot") + 65))
    proof = F.concat(own, hexed(F.col("proof")))
    out = rows.select(
        F.col("m.doc_id").alias("doc_id"), hexed(F.col("m.leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("hash")).alias("root"), F.sha2(proof, 256).alias("proof_sha256"),
        hexed(F.col("m.fold")).alias("folded_root"), (F.col("m.fold") == F.col("hash")).alias("verified"),
        *([proof.alias("siblings")] if siblings else []))
    with _unlimited_recursion(spark):
        return written(out, "merkle-proofs")


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Contract query: the manifest of ``documents``, and the climb with every third text lower-cased."""
    docs = documents(spark, sf_dir, *FIELDS)
    columns = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaf = leaf_hash(columns)
    fold = F.when(tampered, leaf_hash(columns | {"text": text})).otherwise(leaf)
    return climb(build(docs, docs.select("lang", "doc_id", leaf.alias("leaf"), fold.alias("fold"))))


def oracle() -> str:
    """DuckDB SQL for :func:`op12_merkle_manifest`: levels by one recursive query, proofs leaf by leaf by another."""
    from cohortlens.llm import duck

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(**other: str) -> str:
        return "sha256(" + " || ".join(field(other.get(c, c)) for c in FIELDS) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {leaf()} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {duck.crc32("CAST(doc_id AS VARCHAR)")} % {TAMPER_EVERY} = 0
              THEN {leaf(text=lower)} ELSE {leaf()} END AS fold FROM documents),
placed AS (
  SELECT *, coalesce('=' || lang, '-') AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, fold) - 1 AS pos FROM hashed),
leaves AS (SELECT *, row_number() OVER (ORDER BY tree, pos) AS r FROM placed),
built(tree, level, pos, hash, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // {FANOUT}, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + {FANOUT - 1}) // {FANOUT}
  FROM built WHERE n > 1 GROUP BY tree, level, pos // {FANOUT}),
subroots AS (
  SELECT tree, hash, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS trees
  FROM built WHERE n = 1),
tops(level, pos, hash, n) AS (
  SELECT 0, place, hash, trees FROM subroots
  UNION ALL
  SELECT level + 1, pos // {FANOUT}, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + {FANOUT - 1}) // {FANOUT}
  FROM tops WHERE n > 1 GROUP BY level, pos // {FANOUT}),
runs AS (
  SELECT tree, level, pos // {FANOUT} AS run, list(hash ORDER BY pos) AS kids FROM built WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT '{_TOP}', level, pos // {FANOUT}, list(hash ORDER BY pos) FROM tops WHERE n > 1 GROUP BY ALL),
shape AS (
  SELECT tree, max(level) AS height FROM built GROUP BY tree
  UNION ALL SELECT '{_TOP}', max(level) FROM tops),
walk(r, own, tree, level, pos, fold, proof) AS (
  SELECT r, tree, tree, 0, pos, fold, '' FROM leaves
  UNION ALL
  SELECT w.r, w.own, CASE WHEN up THEN '{_TOP}' ELSE w.tree END, CASE WHEN up THEN 0 ELSE w.level + 1 END,
         CASE WHEN up THEN s.place ELSE w.pos // {FANOUT} END,
         CASE WHEN up THEN w.fold ELSE sha256(array_to_string(k.kids[:slot], '') || w.fold || array_to_string(k.kids[slot + 2:], '')) END,
         CASE WHEN up THEN w.proof ELSE w.proof || array_to_string(k.kids[:slot], '') || array_to_string(k.kids[slot + 2:], '') END
  FROM (SELECT w.*, h.height, w.level = h.height AS up, w.pos % {FANOUT} AS slot FROM walk w JOIN shape h USING (tree)
        WHERE w.tree <> '{_TOP}' OR w.level < h.height) w
  LEFT JOIN runs k ON k.tree = w.tree AND k.level = w.level AND k.run = w.pos // {FANOUT} AND NOT w.up
  LEFT JOIN subroots s ON s.tree = w.own AND w.up),
ended AS (
  SELECT w.own, w.fold, w.proof, w.r FROM walk w JOIN shape h ON h.tree = w.tree AND w.level = h.height
  WHERE w.tree = '{_TOP}'),
root AS (SELECT hash FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, s.hash AS subroot, root.hash AS root, sha256(e.proof) AS proof_sha256, e.fold AS folded_root,
       e.fold = root.hash AS verified
FROM leaves l JOIN ended e USING (r) JOIN subroots s ON s.tree = l.tree CROSS JOIN root"""
