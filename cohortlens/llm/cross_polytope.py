"""Operator 7: approximate nearest neighbours by cross-polytope hashing.

Largest inner product becomes smallest angle: candidates are scaled by the largest norm and get one
more coordinate that fills them up to length 1, queries get a 0 there. A pseudo-rotation (three rounds
of random signs and a fast Hadamard transform) assigns a unit vector to its nearest signed axis. A
bucket of a table is the tuple of the axes that ``ROTATIONS`` pseudo-rotations give, so the number of
occupied buckets grows with the rows. How well a bucket suits a query is the sum of the query's
nearness to its axes. A query probes, in each table, the buckets that reach its limit, and all that
it finds there is ranked by the exact inner product of the original vectors.

The limit of a query is the sum that a share of the rows reaches: ``share`` x rows ** -0.4, so the
share of candidates that are ranked falls as the table grows. It is read off the buckets of
``SAMPLE`` rows of the index (those of least seeded hash; a bounded sample, and the only thing fitted
besides the largest norm). A query only goes to the buckets whose first axis is among its nearest
``VISITS`` x sqrt(that share) of all axes. Every row is indexed in every table.

The first axes of a table are dealt out in blocks, more of them the more rows there are; a block of many
candidates or many queries is split on both sides, so a hot bucket is no hot task. Every part sends
back a query's best only. Equal vectors are kept ``k + 1`` times at most, those of least id, which is all
that a result can show. A query that finds fewer than ``k`` is compared with every bucket of one table.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows without an id; only vectors of the same length are compared; of rows with one id the
least vector counts; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import written
from cohortlens.sources.tables import read_table

K = 20
TABLES = 4
ROTATIONS = 6          # axes that make a bucket
SHARE = 1.3            # share of the rows that a query ranks in a table: SHARE * rows ** -0.4
VISITS = 4.0           # share of first axes that a query goes to: VISITS * sqrt(share of the rows)
SAMPLE = 8192          # rows of the index that limits are read off
BLOCKS = 8             # blocks of first axes in a table, at least: each sends back k rows of a query
BLOCK_ROWS = 25_000    # candidates, and queries, that meet in one task
STEP = 1000            # vectors that are rotated at once
SEED = 20240501

FOUND = "query_id long, vec_id long, score double"
KEY = ["dim", "table", "block", "part", "side"]


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim): one usable vector per id."""
    ok = F.col("vec_id").isNotNull() & (F.size("v") > 0) \
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    return rows.where(F.coalesce(ok, F.lit(False))).groupBy("vec_id").agg(F.min("v").alias("v")) \
        .withColumn("dim", F.size("v"))


def _sylvester(n: int) -> np.ndarray:
    h = np.ones((1, 1))
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (a power of two long), scaled to keep lengths.

    The transform of length a * b is that of length b on each of a runs, then that of length a across the runs.
    """
    n = x.shape[1]
    a = 1 << ((n.bit_length() - 1) // 2)
    b = n // a
    y = x.reshape(-1, b) @ _sylvester(b).astype(x.dtype)
    y = np.ascontiguousarray(y.reshape(-1, a, b).swapaxes(1, 2)).reshape(-1, a) @ _sylvester(a).astype(x.dtype)
    return y.reshape(-1, b, a).swapaxes(1, 2).reshape(-1, n) / x.dtype.type(np.sqrt(n))


def axes(dim: int) -> int:
    """Number of signed axes of the space that vectors of length ``dim`` are rotated in."""
    return 2 << int(dim).bit_length()


def rotated(x: np.ndarray, rotation: int, seed: int = SEED) -> np.ndarray:
    """Nearness to each signed axis: the rotated coordinates, then their negatives."""
    n = axes(x.shape[1] - 1) // 2
    y = np.zeros((len(x), n), dtype=np.float32)
    y[:, :x.shape[1]] = x
    rng = np.random.default_rng([seed, rotation, n])
    for _ in range(3):
        y = hadamard(y * rng.choice(np.array([-1, 1], dtype=np.float32), n))
    return np.concatenate([y, -y], axis=1)


def near_axes(unit: np.ndarray, table: int) -> list[np.ndarray]:
    """Nearness of each row to the signed axes of each rotation of a table."""
    return [rotated(unit, table * ROTATIONS + r) for r in range(ROTATIONS)]


def _matrix(vectors: pd.Series, kind: str) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=kind) for v in vectors]).astype(float)


def _unit_queries(x: np.ndarray) -> np.ndarray:
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])


def indexed(rows: DataFrame, tables: int, largest: dict[int, float], kind: str) -> DataFrame:
    """``rows`` (vec_id, v, dim) with ``axes``: the bucket of each table, one table after the other."""
    def run(frames):
        for f in frames:
            for dim, own in f.groupby("dim"):
                for i in range(0, len(own), STEP):
                    part = own.iloc[i:i + STEP]
                    x = _matrix(part["v"], kind) / largest[dim]
                    unit = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])
                    bucket = np.stack([near.argmax(axis=1) for t in range(tables) for near in near_axes(unit, t)], axis=1)
                    yield part.assign(axes=list(bucket.astype(np.int32)))
    element = "float" if kind == "<f4" else "double"
    return rows.select("vec_id", "v", "dim").mapInPandas(run, f"vec_id long, v array<{element}>, dim int, axes array<int>")


def fitted_sample(index: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Buckets of the ``SAMPLE`` rows of least seeded hash of each vector length."""
    if not sizes:
        return {}
    # about four times as many rows as are wanted enter the sort
    limit = F.create_map(*(F.lit(x) for dim, n in sizes.items()
                           for x in (dim, min(2**63 - 1, int(2**64 * min(1.0, 4 * SAMPLE / n)) - 2**63))))
    place = F.xxhash64(F.lit(SEED), "vec_id")
    first = Window.partitionBy("dim").orderBy("_place", "vec_id")
    rows = index.select("dim", "vec_id", "axes", place.alias("_place")).where(F.col("_place") <= limit[F.col("dim")]) \
        .withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= SAMPLE).select("dim", "axes").toPandas()
    return {int(dim): np.stack(own["axes"].to_numpy()) for dim, own in rows.groupby("dim")}


def _sums(near: list[np.ndarray], who: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For each query of ``who`` (rows) and each bucket (columns) the sum of the nearness to the bucket's axes."""
    total = near[0][who][:, bucket[:, 0]]
    for r in range(1, len(near)):
        total += near[r][who][:, bucket[:, r]]
    return total


def ranked_share(rows: int, k: int, share: float) -> float:
    """Share of the rows of a table that a query ranks."""
    return min(1.0, max(4 * k / rows, share * rows ** -0.4))


def _asked(queries: DataFrame, tables: int, shares: dict[int, float], blocks: dict[int, int],
           sample: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Queries with their limit and the first axes they go to, a row for each table and block."""
    sent = queries.sparkSession.sparkContext.broadcast(sample)
    element = "float" if kind == "<f4" else "double"

    def run(frames):
        for f in frames:
            out = []
            for dim, own in f.groupby("dim"):
                n, f_rows = axes(dim), shares[dim]
                visits = min(n, max(1, int(np.ceil(VISITS * np.sqrt(f_rows) * n))))
                for i in range(0, len(own), STEP // 4):
                    part = own.iloc[i:i + STEP // 4]
                    unit, ids, vs = _unit_queries(_matrix(part["v"], kind)), part["vec_id"].to_numpy(), part["v"].to_numpy()
                    for t in range(tables):
                        near = near_axes(unit, t)
                        if f_rows >= 1:
                            least = np.full(len(part), -np.inf)
                        else:
                            seen = _sums(near, np.arange(len(part)), sample[dim][:, t * ROTATIONS:(t + 1) * ROTATIONS])
                            at = max(0, int(np.floor(seen.shape[1] * (1 - f_rows))) - 1)
                            least = np.partition(seen, at, axis=1)[:, at] - 1e-5
                        best = np.sort(np.argpartition(-near[0], visits - 1, axis=1)[:, :visits], axis=1)
                        for j, first in enumerate(best):
                            block = first * blocks[dim] // n
                            out += [(dim, t, int(b), ids[j], vs[j], float(least[j]), first[block == b].astype(np.int32))
                                    for b in np.unique(block)]
            yield pd.DataFrame(out, columns=["dim", "table", "block", "id", "v", "least", "first"])
    return queries.select("vec_id", "v", "dim").mapInPandas(
        run, f"dim int, table int, block int, id long, v array<{element}>, least double, first array<int>")


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> list[tuple[np.ndarray, ...]]:
    """The ``k`` best (query, candidate, score) of each query, ties to the smaller id."""
    q, c, s = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    keep = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q)))) < k
    return [(q[keep], c[keep], s[keep])]


def _meet(queries: DataFrame, candidates: DataFrame, k: int, kind: str) -> DataFrame:
    """Each query's best in each part of a block: rows (query_id, vec_id, score)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            q, c = _matrix(left["v"], kind), _matrix(right["v"], kind)
            qi, ci, least = left["id"].to_numpy(), right["id"].to_numpy(), left["least"].to_numpy()
            bucket = np.stack(right["bucket"].to_numpy())
            who = np.repeat(np.arange(len(left)), [len(b) for b in left["first"]])
            first = np.concatenate(left["first"].to_numpy())
            near = near_axes(_unit_queries(q), int(left["table"].iloc[0]))
            waiting = 0
            for b in np.unique(bucket[:, 0]):
                own, here = who[first == b], np.flatnonzero(bucket[:, 0] == b)
                step = max(1, 500_000 // len(here))
                for i in range(0, len(own), step):
                    some = own[i:i + step]
                    row, col = np.nonzero(_sums(near, some, bucket[here]) >= least[some][:, None])
                    row, col = some[row], here[col]
                    other = qi[row] != ci[col]
                    row, col = row[other], col[other]
                    for j in range(0, len(row), 100_000):
                        r, o = row[j:j + 100_000], col[j:j + 100_000]
                        found.append((qi[r], ci[o], (q[r] * c[o]).sum(axis=1)))
                    waiting += len(row)
                    if waiting > 2_000_000:
                        found, waiting = _best(found, k), 0
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], _best(found, k)[0], strict=True)))
    return queries.groupBy(*KEY).cogroup(candidates.groupBy(*KEY)).applyInPandas(run, FOUND)


def _search(queries: DataFrame, index: DataFrame, k: int, tables: int, shares: dict[int, float],
            sizes: dict[int, int], sample: dict[int, np.ndarray], kind: str, block_rows: int) -> DataFrame:
    spark = index.sparkSession
    blocks = {dim: min(axes(dim), max(BLOCKS, -(-n // block_rows))) for dim, n in sizes.items()}
    lengths = spark.createDataFrame([(dim, n, axes(dim)) for dim, n in blocks.items()],
                                    "dim int, blocks int, axes int")  # a row per vector length
    in_tables = F.explode(F.array(*(
        F.struct(F.lit(t).alias("table"), F.slice("axes", t * ROTATIONS + 1, ROTATIONS).alias("bucket"))
        for t in range(tables)))).alias("_t")
    candidates = index.select("dim", F.col("vec_id").alias("id"), "v", in_tables).select("dim", "id", "v", "_t.*") \
        .join(F.broadcast(lengths), "dim") \
        .withColumn("block", F.expr("cast(bucket[0] * blocks div axes as int)")).drop("blocks", "axes")
    asked = _asked(queries, tables, shares, blocks, sample, kind)
    # at most tables * axes rows per vector length: how often each side of a block is split
    count = F.count(F.lit(1))
    of_both = candidates.groupBy("dim", "table", "block").agg(count.alias("_c"), F.lit(0).cast("long").alias("_q")) \
        .unionByName(asked.groupBy("dim", "table", "block").agg(F.lit(0).cast("long").alias("_c"), count.alias("_q"))) \
        .groupBy("dim", "table", "block").agg(F.sum("_c").alias("_c"), F.sum("_q").alias("_q"))
    split = spark.createDataFrame(
        [(r["dim"], r["table"], r["block"], -(-r["_c"] // block_rows), -(-r["_q"] // max(block_rows, STEP)))
         for r in of_both.collect() if r["_c"] and r["_q"]],
        "dim int, table int, block int, parts int, sides int")
    deal = F.xxhash64(F.lit(SEED), "id")

    def dealt(rows: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        return rows.join(F.broadcast(split), ["dim", "table", "block"]) \
            .withColumn(own, F.pmod(deal, F.col(own_n)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).drop("parts", "sides")
    return _meet(dealt(asked, "side", "sides", "part", "parts"), dealt(candidates, "part", "parts", "side", "sides"),
                 k, kind)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query, k: int = K, tables: int = TABLES, share: float = SHARE,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``is_query`` holds."""
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = written(clean(vectors.select("vec_id", "embedding")), "polytope-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    largest = {r["dim"]: r["m"] for r in rows.groupBy("dim").agg(F.max(norm).alias("m")).collect()}
    same = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    index = written(indexed(kept, tables, largest, kind), "polytope-index")
    sizes = {r["dim"]: r["count"] for r in index.groupBy("dim").count().collect()}
    sample = fitted_sample(index, sizes)
    shares = {dim: ranked_share(n, k, share) for dim, n in sizes.items()}
    queries = rows.where(is_query)
    found = written(_top(_search(queries, index, k, tables, shares, sizes, sample, kind, block_rows), k), "polytope-found")
    there = index.groupBy("dim").count()
    got = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("got"))
    short = queries.join(there, "dim").join(got, F.col("vec_id") == F.col("query_id"), "left") \
        .where(F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.col("count") - 1)).select("vec_id", "v", "dim")
    short = written(short, "polytope-short")
    if not short.isEmpty():
        every = dict.fromkeys(sizes, 1.0)
        again = _top(_search(short, index, k, 1, every, sizes, sample, kind, block_rows), k)
        found = found.join(short, F.col("query_id") == short["vec_id"], "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """Contract query: 20 neighbours of every vector whose id is divisible by 20, among all vectors."""
    return nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), F.col("vec_id") % 20 == 0)
