"""Operator 13: shards from a hierarchical weighted hash tree (region, rack, shard).

A row starts at the root and goes down three levels. At each level every child draws a number from the
row's key and its own name, an exponential variable divided by the child's weight, and the smallest draw
wins; a child's weight is the sum of the weights below it. So a child receives its share by weight, and
when the weight of one child changes only its own draws move: rows pass between the changed subtrees and
the others, and no row moves between two places whose weights, on every level, stayed as they were.

A shard added inside a rack changes the weights of its rack and region, so both take rows and deal some of
them to the older shards there. A shard that opens a region of its own takes rows only into itself.
:func:`layout` therefore puts the founding shards in regions and racks and gives each later one its
own region: with one more shard, rows move into it or stay.

Placing a row needs no shuffle and nothing but its key and the tree (a literal). Slots number the rows of a
shard in order of id, size and checksum: range partitions on (shard, order) and counts per partition give the
place of each row, so a shard of any size is numbered by many tasks; rows alike in every respect are dealt
out by their place in the scan.

Everything is built from DataFrame functions.

Defined cases: a null key draws like an empty one, so all rows without an id fall into one shard; equal keys
fall into one shard; a null text has size 1 and checksum 0, as an empty one; rows alike in id and text get
neighbouring slots in any order; an empty table gives no rows; a weight of 0 receives nothing, and a tree
without any weight is an error; other columns are carried through by :func:`place` unless they bear the name of
the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import documents
from cohortlens.operators.prefix import rank_rows

SHARDS = 8            # shards of the query, numbered from 0
RACK_SHARDS = 2       # founding shards in a rack
REGION_RACKS = 2      # founding racks in a region
SEED = 20240501
_HEX = 13             # hexadecimal digits of a draw: 52 bits, so that every draw is an exact double


class Leaf(NamedTuple):
    """A shard and where it stands."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def layout(shards: int, founding: int = SHARDS) -> list[Leaf]:
    """The tree of a number of shards: founding ones in racks and regions, each later one in a region of its own."""
    per_region = RACK_SHARDS * REGION_RACKS
    return [Leaf(f"region{s // per_region}", f"rack{s // RACK_SHARDS % REGION_RACKS}", s) if s < founding
            else Leaf(f"added{s}", "rack0", s) for s in range(shards)]


def _children(leaves: Sequence[Leaf]) -> list[dict[str, dict[str, float]]]:
    """Per level, the children of every inner node and their weights; a node's name is its whole path."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    if len({x.shard for x in leaves}) != len(leaves):
        raise ValueError("a shard stands in one place of the tree")
    for leaf in leaves:
        if leaf.weight < 0:
            raise ValueError("weights are 0 or more")
        if leaf.weight == 0:
            continue
        path = ["", leaf.region, f"{leaf.region}/{leaf.rack}", f"{leaf.region}/{leaf.rack}/{leaf.shard}"]
        for level, (above, own) in enumerate(zip(path, path[1:], strict=False)):
            node = levels[level].setdefault(above, {})
            node[own] = node.get(own, 0.0) + leaf.weight
    if not levels[0]:
        raise ValueError("the tree has no weight")
    return levels


def _draw(key: Column, child: Column, weight: Column, seed: int) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), child, key).cast("binary")), 1, _HEX), 16, 10)
    return -F.ln((bits.cast("long").cast("double") + 0.5) / float(2 ** (4 * _HEX))) / weight


def _lowest(table: Column, key: Column, seed: int, node: Column) -> Column:
    """Of a node's children, the name of the one with the smallest draw."""
    draws = F.transform(F.element_at(table, node), lambda c: F.struct(
        _draw(key, c["name"], c["weight"], seed).alias("draw"), c["name"].alias("name")))
    return F.array_min(draws)["name"]


def place_column(key: Column, leaves: Sequence[Leaf], seed: int = SEED) -> Column:
    """The shard of a row by its key: three weighted draws, from the root down."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    at = F.lit("")
    for nodes in _children(leaves):
        table = F.create_map(*(x for above, own in nodes.items() for x in (F.lit(above), F.array(*(
            F.struct(F.lit(name).alias("name"), F.lit(float(w)).alias("weight")) for name, w in own.items())))))

        # by way of a one-element array, so that the node above is worked out once
        at = F.transform(F.array(at), partial(_lowest, table, text, seed))[0]
    return F.substring_index(at, "/", -1).cast("int")


def place(rows: DataFrame, leaves: Sequence[Leaf], key: str = "doc_id", out: str = "shard", seed: int = SEED) -> DataFrame:
    """``rows`` with the shard of each; all other columns stay."""
    return rows.select(*[c for c in rows.columns if c != out], place_column(F.col(key), leaves, seed).alias(out))


def number_slots(placed: DataFrame, order: Sequence[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """Add each row's place in its shard, gapless from 0, in the order of some columns (nulls first)."""
    rows = placed.select(*[c for c in placed.columns if c != out], F.monotonically_increasing_id().alias("_scan"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranked = rank_rows(rows, [*keys, F.col("_scan")], [shard], rank_col="_rank")
    return ranked.withColumn(out, F.col("_rank") - 1).drop("_rank", "_scan")


def op13_sharding(spark, sf_dir: str) -> DataFrame:
    """Contract query: the shard and slot of every document, and its shard if there is one more."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), place_column(F.col("doc_id"), layout(SHARDS)).alias("shard"),
        place_column(F.col("doc_id"), layout(SHARDS + 1)).alias("grown_shard"))
    return number_slots(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def oracle() -> str:
    """DuckDB SQL for :func:`op13_sharding`."""
    from cohortlens.llm import duck

    def tree(shards: int) -> str:
        return ", ".join(f"('{x.region}', '{x.region}/{x.rack}', '{x.region}/{x.rack}/{x.shard}', {x.shard}, {x.weight})"
                         for x in layout(shards))

    def draw(node: str) -> str:
        bits = f"('0x' || substr(md5('{SEED}|' || {node} || '|' || k.key), 1, {_HEX}))::BIGINT"
        return f"-ln(({bits}::DOUBLE + 0.5) / {2 ** (4 * _HEX)}.0) / sum(leaf.weight)"

    def placed(name: str) -> str:
        return f"""
{name}_region AS (
  SELECT key, arg_min(region, (draw, region)) AS region FROM (
    SELECT k.key, leaf.region, {draw('leaf.region')} AS draw FROM keys k CROSS JOIN {name}_leaf leaf
    GROUP BY k.key, leaf.region) GROUP BY key),
{name}_rack AS (
  SELECT key, arg_min(rack, (draw, rack)) AS rack FROM (
    SELECT k.key, leaf.rack, {draw('leaf.rack')} AS draw FROM {name}_region k JOIN {name}_leaf leaf USING (region)
    GROUP BY k.key, leaf.rack) GROUP BY key),
{name} AS (
  SELECT key, arg_min(shard, (draw, node)) AS shard FROM (
    SELECT k.key, leaf.node, leaf.shard, {draw('leaf.node')} AS draw FROM {name}_rack k JOIN {name}_leaf leaf USING (rack)
    GROUP BY k.key, leaf.node, leaf.shard) GROUP BY key)"""
    return f"""
WITH now_leaf(region, rack, node, shard, weight) AS (VALUES {tree(SHARDS)}),
then_leaf(region, rack, node, shard, weight) AS (VALUES {tree(SHARDS + 1)}),
keys AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents),
{placed('now')},
{placed('later').replace('later_leaf', 'then_leaf')},
rows AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, {duck.crc32("coalesce(text, '')")} AS text_crc32,
         coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents)
SELECT r.doc_id, CAST(r.size AS BIGINT) AS size, CAST(r.text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(n.shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY n.shard ORDER BY r.doc_id NULLS FIRST, r.size, r.text_crc32) - 1 AS BIGINT) AS slot,
       CAST(l.shard AS INTEGER) AS grown_shard
FROM rows r JOIN now n USING (key) JOIN later l USING (key)"""
