"""Operator 1: packing by Karmarkar-Karp multiway differencing.

Each Spark task streams its documents: it encodes a text, cuts it into pieces and collects pieces
until a batch is full; a batch is then dealt into windows. The batch is the unit of differencing, so
memory is bounded by the batch and nothing is shuffled: a hot key cannot exist.

Differencing: every piece starts as a partial partition (one loaded window, the others empty). The
two partitions with the largest imbalance (fullest minus emptiest window) are merged, the fullest
windows of one on the emptiest of the other, until one partition is left. Its windows are nearly
equal. If the fullest exceeds the capacity, the number of windows rises by one and the batch is
dealt again.

Defined cases: a null or empty text is the end id alone; a text of any length is cut losslessly, and
a whole capacity of ids is a window of its own; repeated rows and null ids are packed like any other
row; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import tokens
from cohortlens.llm.common import documents, small_batches

CAPACITY = 2048     # ids per sequence
PIECE = 512         # longest piece of a document's last, partly filled stretch
BATCH = 131_072     # ids dealt at once

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, padded_to long")


def difference(sizes: list[int], k: int) -> tuple[list[int], list[list[int]]]:
    """Karmarkar-Karp: (load of each of ``k`` windows, piece numbers in each)."""
    heap = []
    for i, s in enumerate(sizes):
        load = np.zeros(k, dtype=np.int64)
        load[0] = s
        heap.append((-s, i, load, [[i]] + [[] for _ in range(k - 1)]))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        load = a + b[::-1]                       # loads are kept in falling order
        order = np.argsort(-load, kind="stable")
        load = load[order]
        both = [x + y for x, y in zip(in_a, reversed(in_b), strict=True)]
        heapq.heappush(heap, (-int(load[0] - load[-1]), turn, load, [both[j] for j in order]))
        turn += 1
    return heap[0][2].tolist(), heap[0][3]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; one more window whenever the fullest exceeds it."""
    if not sizes:
        return []
    k = -(-sum(sizes) // capacity)
    while True:
        loads, dealt = difference(sizes, k)
        if loads[0] <= capacity:
            return [w for w in dealt if w]
        k += 1


def padded(n: int, capacity: int) -> int:
    """Length of a sequence of ``n`` ids in store: a power of two stays as it is, others fill the capacity."""
    return n if n & (n - 1) == 0 else capacity


def cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole capacities, then near-equal pieces of the rest."""
    out = [(i, capacity) for i in range(0, n - n % capacity, capacity)]
    rest = n % capacity
    if rest:
        parts = -(-rest // piece)
        edges = [n - rest + rest * j // parts for j in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, piece: int = PIECE, batch: int = BATCH,
         vocabulary: str | None = None, end_id: int = tokens.END_ID) -> DataFrame:
    """Pack ``docs`` (doc_id, text): one row per piece with its ids and its place in a sequence.

    ``sequence_tokens`` is the number of ids in the sequence, ``padded_to`` the length it takes in store.
    """
    path = vocabulary or tokens.vocabulary_path()
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encoder = tokens.Encoder(path)
        number = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        held = 0

        def emit(groups: list[list[tuple]]) -> pd.DataFrame:
            nonlocal number
            rows = []
            for group in groups:
                total = sum(len(p[2]) for p in group)
                offset = 0
                for doc_id, start, ids, doc_tokens in group:
                    rows.append((doc_id, start, len(ids), ids.tobytes(), doc_tokens, number, offset, total,
                                 padded(total, capacity)))
                    offset += len(ids)
                number += 1
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id",
                                              "offset", "sequence_tokens", "padded_to"])
            return out.astype({"doc_id": "Int64"})

        for frame in frames:
            full = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(encoder.encode(text), np.uint32(end_id)).astype("<u4")
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for start, length in cut(len(ids), capacity, piece):
                    row = (doc_id, start, ids[start:start + length], len(ids))
                    if length == capacity:
                        full.append([row])
                    else:
                        waiting.append(row)
                        held += length
                if held >= batch:
                    full += [[waiting[i] for i in w] for w in windows([len(p[2]) for p in waiting], capacity)]
                    waiting, held = [], 0
                if len(full) >= 400:
                    yield emit(full)
                    full = []
            if full:
                yield emit(full)
        if waiting:
            yield emit([[waiting[i] for i in w] for w in windows([len(p[2]) for p in waiting], capacity)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInPandas(run, PIECES)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: every piece of every document, with a checksum in place of its ids."""
    return digest(pack(documents(spark, sf_dir, "doc_id", "text")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_tokens", "padded_to")
