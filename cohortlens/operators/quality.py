"""Data quality checks: key uniqueness, orphans, NULL counts, row counts, value frequencies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def quality_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and keys with a NULL part however often they occur: keys..., n."""
    null_part = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null_part)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when (keys) is not unique (run before a pivot that requires it)."""
    dup = quality_unique_key(df, keys).limit(1).count()
    if dup:
        raise ValueError(f"duplicate keys {list(keys)} found")


def quality_orphans(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no match in the dimension (left anti join).

    The dimension is not hinted: AQE broadcasts it only when its measured size is under the threshold.
    """
    dim_key = dim_key or fk
    keys = dim.select(F.col(dim_key).alias("_dk"))  # an anti join needs no distinct
    return fact.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_dk"), "left_anti")


@dataclass(frozen=True)
class TableRules:
    """What is checked of a table: its key, columns that refer to another table's key, unique columns, lengths."""

    keys: tuple[str, ...]
    refers: Mapping[str, str] = field(default_factory=dict)   # column -> table whose (single) key it holds
    unique: tuple[str, ...] = ()
    lengths: Mapping[str, int] = field(default_factory=dict)  # column -> most characters


def key_census(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """(table_name, kind, subject, ref, id, null_part, n, n_long): how often each key, reference and unique value occurs.

    One scan and one aggregate a table: keys, references and unique values are grouping sets over their typed columns,
    so a value that a third of the rows hold is one row after the partial aggregation, and text is made of the groups,
    not of the rows. A key of several columns is written as JSON, a single one as text.
    """
    parts = [_table_census(name, tables[name], r) for name, r in rules.items() if name in tables]
    return reduce(DataFrame.unionByName, parts)


def _table_census(name: str, df: DataFrame, r: TableRules) -> DataFrame:
    entries = [*([("key", r.keys, None, None)] if r.keys else []), *(("ref", (c,), t, None) for c, t in r.refers.items()),
               *(("unique", (c,), None, None) for c in r.unique), *(("length", (c,), None, m) for c, m in r.lengths.items())]
    sets = list(dict.fromkeys(columns for _, columns, _, _ in entries))  # columns under two rules are counted once
    used = list(dict.fromkeys(c for columns in sets for c in columns))
    gid = {columns: sum(1 << i for i, c in enumerate(reversed(used)) if c not in columns) for columns in sets}
    groups = df.groupingSets([list(columns) for columns in sets], *used) \
        .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"))

    def pick(on: str, values: Sequence[tuple[int, Column]]) -> Column:
        return F.coalesce(*[F.when(F.col(on) == k, v) for k, v in values])
    rules_of = pick("_set", [(gid[s], F.array(*[F.lit(i) for i, e in enumerate(entries) if e[1] == s])) for s in sets])
    text = [F.col(c[0]).cast("string") if len(c) == 1 else F.to_json(F.struct(*c)) for _, c, _, _ in entries]
    null_part = [reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]) for _, columns, _, _ in entries]
    long = [F.lit(0) if m is None else F.when(F.length(c[0]) > m, F.col("n")).otherwise(0) for _, c, _, m in entries]
    return groups.withColumn("_rule", F.explode(rules_of)).select(
        F.lit(name).alias("table_name"), pick("_rule", [(i, F.lit(e[0])) for i, e in enumerate(entries)]).alias("kind"),
        pick("_rule", [(i, F.lit(",".join(e[1]))) for i, e in enumerate(entries)]).alias("subject"),
        pick("_rule", [(i, F.lit(e[2]).cast("string")) for i, e in enumerate(entries)]).alias("ref"),
        pick("_rule", list(enumerate(text))).alias("id"), pick("_rule", list(enumerate(null_part))).alias("null_part"), "n",
        pick("_rule", [(i, x.cast("long")) for i, x in enumerate(long)]).alias("n_long"))


def reference_rules(rules: Mapping[str, TableRules]) -> dict[str, TableRules]:
    """The part of ``rules`` on which :func:`orphan_keys` depends: the references, and the keys of the tables referred to."""
    known = {ref for r in rules.values() for ref in r.refers.values()}
    return {t: TableRules(r.keys if t in known else (), r.refers) for t, r in rules.items() if t in known or r.refers}


def orphan_keys(census: DataFrame) -> DataFrame:
    """(table_name, column_name, ref, id, n): values that the table they refer to lacks, and the rows that hold them.

    All references of all tables meet all keys of one column in one anti join on (table, id). Hand in a census whose lineage is cut:
    of a lazy one the optimizer moves the join below the union and scans the tables again for each. The sort of the join goes
    by id first: its bytes differ early, those of the few table names do not.
    """
    known = census.where("kind = 'key' and not contains(subject, ',')").select(F.col("table_name").alias("ref"), "id")
    return census.where("kind = 'ref' and not null_part").join(known, ["id", "ref"], "left_anti") \
        .select("table_name", F.col("subject").alias("column_name"), "ref", "id", "n")


def census_counts(census: DataFrame) -> DataFrame:
    """(table_name, kind, subject, n_rows, n_null, n_repeated, n_long) of what a census holds.

    ``n_null`` counts rows, ``n_repeated`` the values that occur more than once (for a key also those with a missing part).
    """
    repeated = (F.col("n") > 1) & ~F.col("null_part") | (F.col("kind") == "key") & F.col("null_part")
    return census.groupBy("table_name", "kind", "subject").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("null_part"), F.col("n")).otherwise(0)).alias("n_null"),
        F.count_if(repeated).alias("n_repeated"), F.sum("n_long").alias("n_long"))


def unsorted_neighbours(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows of a sorted frame that come before their predecessor: those inside a partition, and first rows of one.

    Checks an ordering without moving the rows: each partition compares neighbours where they lie, and only the first and
    last key of every partition meet. Empty exactly if the frame is in order. ``order``: columns in ascending order.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    rows = df.select(key.alias("key"), F.monotonically_increasing_id().alias("at")) \
        .withColumn("part", F.shiftright("at", 33))
    inside = Window.partitionBy("part").orderBy("at")
    wrong = rows.withColumn("before", F.lag("key").over(inside)).where("key < before").select("part", "key")
    ends = rows.groupBy("part").agg(F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    one = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per partition
    return wrong.unionByName(ends.withColumn("before", F.lag("last").over(one)).where("first < before")
                             .select("part", F.col("first").alias("key")))


def quality_null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: NULL count per column (``null_<col>``) plus ``n_rows``, in a single pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in cols])


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table, one small aggregate each, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def quality_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n): rows that break NOT NULL, for every column of ``cols`` (0 when it holds)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n"))
                                             for c in cols])).alias("x")).select("x.column_name", "x.n")


def quality_unique_value(df: DataFrame, col: str) -> DataFrame:
    """Values of a UNIQUE column that occur more than once: value, n (NULLs are never equal, as in SQL)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def quality_length(df: DataFrame, col: str, most: int) -> DataFrame:
    """Values longer than a VARCHAR(``most``) column takes: value, n."""
    return df.where(F.length(col) > most).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def rejected_rows(raw: DataFrame, required: Sequence[str]) -> DataFrame:
    """(reason, n): rows a cleaner rejects, by the first required column that is blank, and the rows it accepts."""
    reason = F.coalesce(*[F.when(F.trim(c).isNull() | (F.trim(c) == ""), F.lit(f"blank {c}")) for c in required],
                        F.lit("accepted"))
    return raw.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def second_values(raw: DataFrame, key: str, col: str) -> DataFrame:
    """Keys that come with more than one value of ``col``: key, kept (the smallest, which survives), n_values."""
    k, v = F.trim(key), F.trim(col)
    return raw.where((k != "") & (v != "")).groupBy(k.alias(key)).agg(
        F.min(v).alias("kept"), F.countDistinct(v).alias("n_values")).where(F.col("n_values") > 1)


def table_list(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """(table_name, present, row_count) of Parquet tables under ``folder``, by name; an absent one has no count."""
    parts = []
    for name in sorted(names):
        try:
            n = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").agg(F.count(F.lit(1)).alias("n"))
            parts.append(n.select(F.lit(name).alias("table_name"), F.lit(True).alias("present"),
                                  F.col("n").alias("row_count")))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(False).alias("present"),
                                               F.lit(None).cast("long").alias("row_count")))
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Frequency of each value including NULL; with ``top``, the report of the most frequent ones."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if top is not None:
        out = out.orderBy(F.col("n").desc(), F.col(col).asc_nulls_first()).limit(top)
    return out
