"""Operator 4: quality rules by an isolation forest on rule statistics.

Each text gives the counts of the usual quality rules and from them a row of ratios. The limits of
each rule are the outer ``TAIL`` quantiles of its ratio over the good labelled rows; a rule's statistic is by how
much a document exceeds them. A forest of random splits over these statistics, grown on a bounded
sample of labelled rows, measures how few splits set a row apart; the shorter its mean path, the more
anomalous the document. The threshold is calibrated on all labelled rows that pass the base rules: of
those that keep at least ``KEEP`` of the good ones, the one that best parts good from bad.

Sample: the ``SAMPLE`` labelled rows of least seeded hash (numbers only, under a megabyte) are fetched
to the driver; each tree draws ``ROWS`` of them. Counts, scores and the calibration cover all rows.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows are judged
alike; a document labelled more than once is good only if every row says so; null ids have no label;
without labelled rows of both kinds only the base rules decide; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import (arrow_buffer, chunks, documents, hash_spans, mix64, small_batches, text_bytes,
                                   word_spans, written)
from cohortlens.sources.tables import read_table

SAMPLE = 8192    # labelled rows the trees draw from
TREES = 200
ROWS = 256       # rows of a tree
TAIL = 0.001     # share of good labelled rows outside a rule's limit, on each side
KEEP = 0.995     # share of good labelled rows that the threshold must keep
BINS = 2000      # steps of the anomaly score in the calibration
SEED = 20240501

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "n_upper", "n_letters", "n_digits", "n_bangs", "n_bars", "n_stops", "n_repeats"]
RATIOS = ["log_words", "word_length", "symbols", "dup_lines", "repeat_words", "distinct", "upper", "digits", "bangs",
          "bars", "stops", "words_per_line", "repeats"]


def _table(characters: str) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(characters.encode())] = True
    return t


_SYMBOLS, _DIGITS, _BANGS, _BARS, _STOPS = map(_table, ("#*$%&|<>", "0123456789", "!", "|", "."))
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTERS = _UPPER | _table("abcdefghijklmnopqrstuvwxyz")
_LETTERS[128:] = True
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True


def counts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS and MORE of every document of a batch."""
    n, out = len(offsets) - 1, {}

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(mask))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, doc = word_spans(buf, offsets)
    words = out["n_words"] = np.bincount(doc, minlength=n)
    edge = np.zeros(len(buf) + 1, dtype=np.int64)
    edge[starts] += 1
    edge[ends] -= 1  # a word may begin where the last document's word ends: add, do not set
    inside = np.cumsum(edge[:-1]) > 0
    out["word_chars"] = total(inside & ~_CONTINUES[buf])
    for name, table in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_letters", _LETTERS), ("n_digits", _DIGITS),
                        ("n_bangs", _BANGS), ("n_bars", _BARS), ("n_stops", _STOPS)):
        out[name] = total(table[buf])

    # lines: between line feeds and document edges; only those with a word count
    feeds = np.flatnonzero(buf == 10)
    first = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    first = first[first < len(buf)]
    last = np.append(first[1:], len(buf))
    end = np.where(np.isin(last - 1, feeds) & (last > first), last - 1, last)
    line_of_word = np.searchsorted(first, starts, "right") - 1
    used = np.unique(line_of_word)
    line_doc = np.searchsorted(offsets, first[used], "right") - 1
    key = mix64(hash_spans(buf, first[used], end[used]) + line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    _, at = np.unique(key, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[at], minlength=n)

    word = hash_spans(buf, starts, ends)
    own = mix64(word + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at, = np.unique(own, return_index=True)
    out["n_distinct"] = np.bincount(doc[at], minlength=n)
    same = np.zeros(len(doc), dtype=bool)
    same[1:] = (own[1:] == own[:-1])
    out["n_repeats"] = np.bincount(doc[same], minlength=n)
    m = max(0, len(word) - 2)
    window = mix64(own[:m] + mix64(own[1:m + 1] + mix64(own[2:m + 2])))
    valid = np.flatnonzero(doc[:m] == doc[2:m + 2])
    _, which, times = np.unique(window[valid], return_inverse=True, return_counts=True)
    twice = valid[times[which] >= 2]
    edge = np.zeros(len(word) + 3, dtype=np.int64)
    edge[twice] += 1
    np.add.at(edge, twice + 3, -1)
    covered = np.cumsum(edge)[:len(word)] > 0
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    assert words.sum() == len(starts)
    return out


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of RATIOS."""
    words, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_letters"], 1)
    chars, lines = np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.stack([np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars,
                     c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_distinct"] / np.sqrt(words),
                     c["n_upper"] / letters, c["n_digits"] / chars, c["n_bangs"] / words, c["n_bars"] / words,
                     c["n_stops"] / words, np.log1p(c["n_words"] / lines), c["n_repeats"] / words], axis=1)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, ratios) of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                buf, offsets = arrow_buffer(batch.column(1))
                parts = [counts(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                         for i, j in chunks(offsets)]
                c = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c[k].astype(np.int64)) for k in COUNTS),
                     pa.array(list(ratios(c)), pa.list_(pa.float64()))], names=["doc_id", *COUNTS, "ratios"])
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", ratios array<double>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("b")).mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ---------------------------------------------------------------- forest

def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + 0.5772156649015329) - 2 * m / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation forest: ``score`` is 2 ** (- mean path / expected path), near 1 for rows set apart early."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.deepest = int(np.ceil(np.log2(max(2, self.size))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, split, left, right, path = [], [], [], [], []

        def node(own: np.ndarray, depth: int) -> int:
            i = len(feature)
            for column, value in ((feature, -1), (split, 0.0), (left, i), (right, i),
                                  (path, depth + float(_expected(len(own))))):
                column.append(value)
            low, high = own.min(axis=0), own.max(axis=0)
            vary = np.flatnonzero(high > low)
            if depth < self.deepest and len(own) > 1 and len(vary):
                f = int(rng.choice(vary))
                feature[i], split[i] = f, float(rng.uniform(low[f], high[f]))
                below = own[:, f] < split[i]
                left[i] = node(own[below], depth + 1) if below.any() else i
                right[i] = node(own[~below], depth + 1) if (~below).any() else i
            return i
        node(rows, 0)
        return (np.array(feature), np.array(split), np.array(left), np.array(right), np.array(path))

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, split, left, right, path in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.deepest):
                f = feature[at]
                below = rows[np.arange(len(rows)), np.maximum(f, 0)] < split[at]
                at = np.where(f < 0, at, np.where(below, left[at], right[at]))
            total += path[at]
        return np.exp2(-total / len(self.trees) / max(float(_expected(self.size)), 1e-9))


def limits(good: DataFrame, tail: float = TAIL) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of each ratio over all rows of ``good``; without rows nothing exceeds them."""
    row = good.agg(*(F.percentile_approx(F.col("ratios")[i], [tail, 1 - tail], 100_000).alias(name)
                     for i, name in enumerate(RATIOS))).first()
    low, high = zip(*((-np.inf, np.inf) if row[name] is None else row[name] for name in RATIOS), strict=True)
    return np.array(low, dtype=float), np.array(high, dtype=float)


def excess(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(0, rows - high) + np.maximum(0, low - rows)


def anomaly(stats: DataFrame, forest: Forest, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``stats`` with the column ``anomaly`` in place of ``ratios``."""
    sent = stats.sparkSession.sparkContext.broadcast((forest, low, high))
    rest = [c for c in stats.columns if c != "ratios"]
    schema = ", ".join(f"{c} {stats.schema[c].dataType.simpleString()}" for c in rest) + ", anomaly double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("ratios").to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            forest, low, high = sent.value
            score = forest.score(excess(x, low, high)) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(score, pa.float64())],
                                             names=[*rest, "anomaly"])
    return stats.select(*rest, "ratios").mapInArrow(run, schema)


def threshold(bins: pd.DataFrame, keep: float) -> float:
    """Least anomaly that is rejected: of the cuts that keep ``keep`` of the good rows, the best.

    The best cut has the largest share of bad rows rejected less share of good rows rejected; of equals, the one
    that rejects least. ``bins`` has (at, quality, count) with ``at`` in steps of 1 / BINS.
    """
    at, n = bins["at"].to_numpy(), bins["count"].to_numpy(float)
    good, bad = (np.bincount(np.clip(at, 0, BINS), weights=n * (bins["quality"].to_numpy() == q), minlength=BINS + 1)
                 for q in (1, 0))
    if not good.sum() or not bad.sum():
        return 2.0
    kept_good = np.append(0, np.cumsum(good)) / good.sum()  # at cut i, bins below i are kept
    kept_bad = np.append(0, np.cumsum(bad)) / bad.sum()
    gain = np.where(kept_good >= keep, kept_good - kept_bad, -1.0)
    return float(len(gain) - 1 - np.argmax(np.round(gain[::-1], 12))) / BINS


def quality_rules(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """(doc_id, COUNTS, base_failed, kept, anomaly, threshold) for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    stats = written(rule_statistics(docs), "quality-statistics")  # a row of numbers per document, read three times
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    labelled = written(stats.where(~base_failed()).join(known, "doc_id"), "quality-labelled")
    # of the least hashes, about four times as many as are wanted enter the sort: its tasks send rows in all, not each
    place = F.xxhash64(F.lit(SEED), "doc_id")
    share = min(1.0, 4 * SAMPLE / max(1, labelled.count()))
    few = labelled.where(place <= int(-2**63 + (2**64 - 1) * share)) if share < 1 else labelled
    sample = few.orderBy(place, "doc_id").limit(SAMPLE).select("ratios").toPandas()
    result = stats.withColumn("base_failed", base_failed())
    if len(sample) < 2:
        return result.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed")).alias("kept"),
                             F.lit(None).cast("double").alias("anomaly"), F.lit(2.0).alias("threshold"))
    low, high = limits(labelled.where("quality = 1"))
    forest = Forest(excess(np.stack(sample["ratios"].to_numpy()), low, high))
    bins = anomaly(labelled.select("quality", "ratios"), forest, low, high) \
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("at"), "quality").count().toPandas()
    cut = threshold(bins, keep)
    return anomaly(result.select("doc_id", *COUNTS, "base_failed", "ratios"), forest, low, high).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.floor(F.col("anomaly") * BINS) < cut * BINS))
        .alias("kept"), "anomaly", F.lit(cut).alias("threshold"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: rule statistics and verdict of every document."""
    return quality_rules(documents(spark, sf_dir, "doc_id", "text"),
                         read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
