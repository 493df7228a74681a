"""Operator 5: mix sources to target weights by Sainte-Laguë apportionment.

Words are handed out in blocks of equal size. The blocks of the whole mix are apportioned among the
sources by highest quotients (claim / (2k - 1) for a party's k-th block), then each source's blocks
among its shards in the same way; a shard is a hash class of its documents, so a hot source is many
shards. A shard lays its documents out in a seeded order and takes its blocks from the front, going
round again when the quota exceeds what the shard holds.

Highest quotients are exact and need no loop: with n parties, total claim T and block size B, the
divisor that hands out T/B blocks lies so close to B that party i receives its exact share q_i up to
share_i * n / 2 + 1 blocks. Only the quotients in that belt are listed (about four per party) and
ranked; all below the belt are handed out at once.

Everything is built from DataFrame functions. The windows without a key run over one row per source.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own and
comes last; rows without an id, or of one id, are dealt to shards by their texts; repeated rows are separate rows (ties in the seeded order are broken by size, and equal
rows share alike whichever comes first); with no words at all every target is 0; an empty table
gives no rows; other columns are carried through unchanged unless they bear one of the result's names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, documents, written

BLOCK_WORDS = 16     # words in a block
SHARD_ROWS = 5_000   # documents a shard holds on average
MOST = 3             # a source is repeated at most so often
SEED = 20240501


def size_of(text: str = "text") -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def text_tag(text: str = "text") -> Column:
    """Hash of a text, by which rows without an id, or of one id, are told apart when shards are dealt."""
    return F.xxhash64(F.col(text))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``_sid`` (place by name), ``weight`` and ``target`` to one row per source (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, repeating. The targets share all sizes by weight and stop
    at ``most`` times the source's size; the excess is shared again among the others. In order of size per
    weight, a source is at its stop exactly if the level reached by sharing what is left is above it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rows = sources.withColumn("_sid", F.row_number().over(by_name) - 1) \
        .withColumn("weight", (F.col("_sid") % 3 + 1).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "_sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size, weight = F.col("source_size"), F.col("weight")
    left = F.sum(size).over(everything) - most * F.coalesce(F.sum(size).over(before), F.lit(0))
    weights = F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0))
    rows = rows.withColumn("_level", left.cast("double") / weights)
    rows = rows.withColumn("_free", F.col("_level") * weight <= most * size)
    level = F.max(F.when(F.col("_free"), F.col("_level"))).over(everything)  # that of the first free source
    return rows.withColumn("target", F.when(F.col("_free"), level * weight).otherwise((most * size).cast("double"))) \
        .drop("_level", "_free")


def highest_quotients(parties: DataFrame, claim: str, seats: str, order: list[Column], by: list[str]) -> DataFrame:
    """Add ``blocks``: each party's share of ``seats`` (one value per ``by``) under claim / (2k - 1).

    Equal quotients go in the order of ``order``. Parties without a claim get nothing.
    """
    group = Window.partitionBy(*by)
    total, parties_n = F.sum(claim).over(group), F.count(F.lit(1)).over(group)
    rows = parties.withColumn("_exact", F.when(total > 0, F.col(claim) / total * F.col(seats)).otherwise(0.0)) \
        .withColumn("_belt", F.when(total > 0, F.col(claim) / total * parties_n / 2 + 1.5).otherwise(0.0)) \
        .withColumn("_sure", F.greatest(F.floor(F.col("_exact") - F.col("_belt")), F.lit(0)).cast("long")) \
        .withColumn("_last", F.when(F.col(claim) > 0, F.ceil(F.col("_exact") + F.col("_belt"))).otherwise(0)
                    .cast("long"))
    rest = F.col(seats) - F.sum("_sure").over(group)
    rows = rows.withColumn("_rest", rest)
    belt = rows.withColumn("_k", F.explode_outer(F.when(F.col("_last") > F.col("_sure"),
                                                        F.sequence(F.col("_sure") + 1, F.col("_last")))))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(
        (F.col(claim) / (2 * F.col("_k") - 1)).desc_nulls_last(), *order))
    belt = belt.withColumn("_won", (F.col("_k").isNotNull() & (rank <= F.col("_rest"))).cast("long"))
    return belt.groupBy(*parties.columns).agg((F.max("_sure") + F.sum("_won")).alias("blocks"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, most: int = MOST,
        seed: int = SEED) -> DataFrame:
    """Add size, source_size, target and taken (words the mix takes of the row, repeats counted) to ``docs``."""
    own = ["size", "source_size", "target", "taken"]
    rest = [c for c in docs.columns if c not in own]
    sized = docs.select(*rest, size_of().alias("size"), text_tag().alias("_tag"))
    return _mixed(sized, rest, block_words, shard_rows, most, seed)


def _mixed(sized: DataFrame, rest: list[str], block_words: int, shard_rows: int, most: int, seed: int) -> DataFrame:
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = targets(per_source, most) \
        .withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("_rows") / shard_rows)).cast("int")) \
        .withColumn("_all", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("long"))
    sources = highest_quotients(sources.withColumn("_one", F.lit(0)), "target", "_all", [F.col("_sid")], ["_one"]) \
        .select(F.col("source").alias("_source"), "source_size", "target", "_sid", "_shards",
                F.col("blocks").alias("_source_blocks"))
    sources = written(sources, "mix-sources")  # one row per source, used by both passes below

    rows = sized.join(sources, sized["source"].eqNullSafe(sources["_source"]), "left") \
        .withColumn("_hash", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_tag"))) \
        .withColumn("_shard", F.pmod(F.xxhash64("_hash"), F.col("_shards")).cast("int"))
    shards = rows.groupBy("_sid", "_shard").agg(F.sum("size").alias("_shard_size"),
                                                F.first("_source_blocks").alias("_source_blocks"))
    shards = highest_quotients(shards, "_shard_size", "_source_blocks", [F.col("_shard")], ["_sid"]) \
        .select("_sid", "_shard", "_shard_size",
                F.least(F.col("blocks") * block_words, most * F.col("_shard_size")).alias("_quota"))
    line = Window.partitionBy("_sid", "_shard").orderBy("_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size").over(line), F.lit(0)))
    rows = rows.join(shards, ["_sid", "_shard"], "left")
    rounds = F.when(F.col("_shard_size") > 0, F.floor(F.col("_quota") / F.col("_shard_size"))).otherwise(0)
    partial = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_quota") - rounds * F.col("_shard_size")
                                           - F.col("_start")))
    taken = F.coalesce(rounds * F.col("size") + partial, F.lit(0)).cast("long")
    return rows.select(*rest, "size", "source_size", "target", taken.alias("taken"))


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole repeat and one for a part.

    A part is cut after the word that fills the quota; ``n_chars``, if there is one, is set to its length. Rows of
    size 0 are not taken.
    """
    columns = docs.columns
    mixed = mix(docs.select(F.struct(*columns).alias("row"), "doc_id", "source", "text")) \
        .where("taken > 0").select("row", "size", "taken")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    takes = F.filter(F.concat(F.array_repeat(F.lit(0), whole), F.array(part)), lambda x: (x > 0) | (whole > 0))
    takes = F.when(part == 0, F.array_repeat(F.lit(0), whole)).otherwise(takes)  # 0: the whole text
    rows = mixed.select("row", F.explode(takes).alias("words"))
    ends = F.split(F.col("row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    text = F.when(F.col("words") > 0, F.array_join(F.slice(ends, 1, F.col("words")), "")).otherwise(F.col("row.text"))
    rows = rows.withColumn("text", text)
    new = {"text": F.col("text"),
           "n_chars": F.when(F.col("words") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
           .cast(docs.schema["n_chars"].dataType) if "n_chars" in columns else None}
    return rows.select(*(new[c].alias(c) if new.get(c) is not None else F.col("row")[c].alias(c) for c in columns))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query: what the mix takes of every document."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    sized = written(docs.select("doc_id", "source", size_of().alias("size"), text_tag().alias("_tag")), "mix-sizes")  # texts are read once
    return _mixed(sized, ["doc_id", "source"], BLOCK_WORDS, SHARD_ROWS, MOST, SEED) \
        .select("doc_id", "size", "source_size", "target", "taken", "source")
