"""Shared helpers of the training-data operators: word spans and 64-bit hashes over Arrow buffers.

Texts travel to Python as binary columns, so a batch is one byte buffer plus offsets; the helpers
work on whole batches with numpy and never build per-word Python objects.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources.tables import read_table

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run of anything but the six ASCII white-space characters
CHUNK_BYTES = 1_000_000      # texts are hashed in runs of documents of about this many bytes
SEGMENT_BYTES = 8_000_000    # a longer run, which is one long document, is hashed in segments of this many
TASKS = 100_000              # tasks that the groups of a step are dealt to at most; beyond, a task works through several

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POW: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, pruned to the named columns."""
    return read_table(spark, sf_dir, "documents", columns)


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string").cast("binary"), F.lit(b""))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the texts that one Arrow batch holds (only a transfer size; results do not depend on it)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: a lineage cut that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_count(docs: DataFrame, size: int) -> int:
    """Groups of about ``size`` bytes of text each: they grow in number with the input, not in size."""
    return 1 + int(docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) // size


def by_part(df: DataFrame, parts: int) -> DataFrame:
    """``df`` dealt by its column ``part`` to as many tasks as there are groups, ``TASKS`` at most."""
    return df.repartition(min(parts, TASKS), "part")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POW[kind]
    if len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 65_536), _BASE if kind == "up" else _INV, dtype=np.uint64)
        steps[0] = 1
        have = _POW[kind] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any byte span of ``buf``."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _powers("up", len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span; equal bytes give equal hashes wherever they stand."""
    raw = (prefix[ends] - prefix[starts]) * _powers("down", len(prefix))[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def arrow_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary Arrow array, without copying the texts."""
    arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, target: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents of about ``target`` bytes (one long document is a run of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word; words never cross documents."""
    n = len(buf)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, e
    word = ~_WS[buf]
    cut = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    before[cut] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    after[cut - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of some spans that are in order and do not overlap; a long buffer is hashed in segments."""
    if len(buf) <= SEGMENT_BYTES:
        return span_hash(prefix_hash(buf), starts, ends)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, a + SEGMENT_BYTES, "left")))
        out[i:j] = span_hash(prefix_hash(buf[a:int(ends[j - 1])]), starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def word_hashes(buf: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every word, with A-Z lower-cased if asked."""
    starts, ends, doc = word_spans(buf, offsets)
    return hash_spans(_LOWER[buf] if lower else buf, starts, ends), doc


def as_long(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed integer, which is what a Spark long holds."""
    return x.view(np.int64)
