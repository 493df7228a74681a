"""Operator 9: token ids in binary form, packed by best-fit decreasing.

Each Spark task streams its documents into bounded batches. A text longer than a sequence is split
without loss: whole sequences first, the rest is one piece. The pieces of a batch are placed in
falling order of length, each into the open sequence with the least room that still holds it; that
sequence is found in a segment tree over the room left, in steps of the logarithm of the capacity.

A row of the result is one sequence: a row of the packed id matrix (little-endian unsigned 32-bit,
padded to the capacity), the cumulative segment lengths (from 0 to the number of ids) and the
position of each id, which starts again from 0 at each segment (little-endian unsigned 16-bit).

Defined cases: a null or empty text is the end id alone; repeated rows and null ids are packed like
any other row (a null id stays null in ``doc_ids``); an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import tokens
from cohortlens.llm.common import documents, small_batches

CAPACITY = 2048    # ids per sequence
BATCH = 1_000_000  # ids placed at once
PAD_ID = 0

SEQUENCES = ("sequence_id long, n_tokens int, n_segments int, doc_ids array<long>, starts array<long>, "
             "cumulative_lengths array<int>, ids binary, positions binary")


class Room:
    """Open sequences by the room they have left; the segment tree counts them over ranges of room."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self._open[room].append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of the fullest open sequence that holds ``need``, or None."""
        node = need + self._leaves
        if not self._count[node]:
            while node > 1 and (node & 1 or not self._count[node + 1]):  # up to a right sibling with a sequence
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:                                   # down to its least room
                node = 2 * node if self._count[2 * node] else 2 * node + 1
        room = node - self._leaves
        self._change(room, -1)
        return room, self._open[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Piece numbers of each sequence."""
    room, sequences = Room(capacity), []
    for i in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        found = room.take(sizes[i])
        if found is None:
            left, at = capacity, len(sequences)
            sequences.append([])
        else:
            left, at = found
        sequences[at].append(i)
        if left > sizes[i]:
            room.add(left - sizes[i], at)
    return sequences


def to_sequences(docs: DataFrame, capacity: int = CAPACITY, batch: int = BATCH, vocabulary: str | None = None,
                 end_id: int = tokens.END_ID, pad_id: int = PAD_ID) -> DataFrame:
    """Packed sequences of ``docs`` (doc_id, text); ``capacity`` is at most 65,535 (16-bit positions)."""
    if not 0 < capacity < 1 << 16:
        raise ValueError("capacity must be between 1 and 65,535")
    path = vocabulary or tokens.vocabulary_path()
    small_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encoder = tokens.Encoder(path)
        number = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        held = 0

        def sequence(group: list[tuple]) -> tuple:
            nonlocal number
            ids = np.full(capacity, pad_id, dtype="<u4")
            at = np.zeros(capacity, dtype="<u2")
            edges = [0]
            for _, _, piece in group:
                a, b = edges[-1], edges[-1] + len(piece)
                ids[a:b] = piece
                at[a:b] = np.arange(len(piece))
                edges.append(b)
            number += 1
            return (number - 1, edges[-1], len(group), [g[0] for g in group], [g[1] for g in group], edges,
                    ids.tobytes(), at.tobytes())

        def emit(groups: list[list[tuple]]) -> Iterator[pd.DataFrame]:
            for i in range(0, len(groups), 500):
                yield pd.DataFrame([sequence(g) for g in groups[i:i + 500]],
                                   columns=["sequence_id", "n_tokens", "n_segments", "doc_ids", "starts",
                                            "cumulative_lengths", "ids", "positions"])

        for frame in frames:
            full = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(encoder.encode(text), np.uint32(end_id)).astype("<u4")
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for start in range(0, len(ids), capacity):
                    piece = (doc_id, start, ids[start:start + capacity])
                    if len(piece[2]) == capacity:
                        full.append([piece])
                    else:
                        waiting.append(piece)
                        held += len(piece[2])
                if held >= batch:
                    full += [[waiting[i] for i in s]
                             for s in best_fit_decreasing([len(p[2]) for p in waiting], capacity)]
                    waiting, held = [], 0
                if len(full) >= 500:
                    yield from emit(full)
                    full = []
            yield from emit(full)
        yield from emit([[waiting[i] for i in s] for s in best_fit_decreasing([len(p[2]) for p in waiting], capacity)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInPandas(run, SEQUENCES)


def write_sequences(sequences: DataFrame, path: str) -> None:
    """Write the packed matrix as Parquet: one row group row per sequence, readable with :func:`read_pieces`."""
    sequences.write.mode("errorifexists").parquet(path)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces in a written matrix: (doc_id, start, length, ids) with the ids cut out of their row."""
    edges = F.col("cumulative_lengths")
    return spark.read.parquet(path).select("sequence_id", "ids", "doc_ids", "starts", "cumulative_lengths",
                                           F.posexplode("doc_ids").alias("i", "doc_id")).select(
        "sequence_id", "doc_id", F.col("starts")[F.col("i")].alias("start"),
        (edges[F.col("i") + 1] - edges[F.col("i")]).alias("length"),
        F.substring("ids", edges[F.col("i")] * 4 + 1, (edges[F.col("i") + 1] - edges[F.col("i")]) * 4).alias("ids"))


def op9_token_output(spark, sf_dir: str) -> DataFrame:
    """Every packed sequence of the whole ``documents`` table."""
    return to_sequences(documents(spark, sf_dir, "doc_id", "text"))
