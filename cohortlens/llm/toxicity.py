"""Operator 6: toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary labelled documents, spell words byte by byte; a gram is the byte
and up to ``ORDER - 1`` bytes before it in its word. Each class discounts its own counts of the whole
gram and gives the freed mass to shorter grams, whose Kneser-Ney continuation counts the classes
share, so that a rare expression leans on what both have seen. A word's evidence is the difference
of its two log-likelihoods. A document counts and speaks once for each of its words, however often it
repeats it. Its statistic is length-normalised: the mean evidence of the fiftieth of its distinct
words (three at least, if it has them) that speaks loudest for toxic. A logistic curve, fitted on
labelled documents that gave no counts, turns it into the score.

Counting covers every labelled training document, and what it shuffles grows with them; a map task
sums its own grams first. No gram is left out: a model of at most ``MODEL_GRAMS`` grams (16 bytes
each) is sent to the tasks; a larger one stays a table, whose probabilities are aggregates and joins
and which the distinct words are joined with. Labels are joined by broadcast only if a count finds
them below ``LABELS_SENT`` rows, else by a shuffle.

Folds are crc32(doc_id as text) mod 5: 0 is held out, 4 fits the curve, the others give counts.

Defined cases: a null text or one without words has statistic 0; a null id is not held out and has no
label; a document labelled more than once is toxic if any row says so; rows with a null label are
left out; without documents of both classes every statistic is 0; repeated rows are scored alike; an
empty table gives no rows; columns other than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortlens.llm.common import (_LOWER, arrow_buffer, as_long, chunks, documents, hash_spans, small_batches,
                                   text_bytes, word_spans, written)
from cohortlens.sources.tables import read_table

ORDER = 4                  # bytes of a gram, at most 7
DISCOUNT = 0.75
LOUDEST = 50               # the statistic is the mean over one in so many distinct words,
LEAST = 3                  # and over so many at least
MODEL_GRAMS = 1 << 20      # grams of a model that is sent out; a larger one is joined
LABELS_SENT = 2_000_000
FLUSH = 500_000            # distinct grams a map task holds before it sends them
BINS = 20                  # steps of the statistic per unit, when the curve is fitted
U8 = np.uint64


def fold(doc_id: str = "doc_id", folds: int = 5):
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds).cast("int")


# ---------------------------------------------------------------- grams

def word_grams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram, word number) of every byte of the words and of the space that ends them.

    A gram packs its bytes into an integer, the latest lowest; a word begins with a space, at which grams stop.
    """
    size = ends - starts + 2
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) - first[word]
    inside = (place > 0) & (place < size[word] - 1)
    letters = np.full(len(word), 32, dtype=U8)
    letters[inside] = buf[(starts[word] + place - 1)[inside]]
    gram = letters.copy()
    for k in range(1, ORDER):
        before = np.zeros_like(letters)
        before[k:] = letters[:-k]
        before[place < k] = 0
        gram |= before << U8(8 * k)
    spelled = place > 0
    return gram[spelled], word[spelled]


def _distinct_words(buf: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, spans of the distinct words, and (distinct word, document) once for each pair."""
    buf = _LOWER[buf]
    starts, ends, doc = word_spans(buf, offsets)
    if not len(starts):
        return buf, starts, ends, starts, doc
    _, at, which = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
    pairs = np.unique(doc * len(at) + which)  # in the order of documents
    return buf, starts[at], ends[at], pairs % len(at), pairs // len(at)


def _span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span, in any order."""
    order = np.argsort(starts)
    out = np.empty(len(starts), dtype=np.uint64)
    out[order] = hash_spans(buf, starts[order], ends[order])
    return out


def count_grams(labelled: DataFrame) -> DataFrame:
    """(gram, ordinary, toxic): counts over all rows of ``labelled`` (b: bytes, toxic: 0 or 1)."""
    def send(grams: list, counts: list) -> pa.RecordBatch:
        u, which = np.unique(np.concatenate(grams), return_inverse=True)
        c = np.concatenate(counts)
        total = [np.bincount(which, weights=c[:, k], minlength=len(u)).astype(np.int64) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(total[0]), pa.array(total[1])],
                                          names=["gram", "ordinary", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        with np.errstate(over="ignore"):
            for batch in batches:
                toxic = batch.column(1).to_numpy()
                data, offsets = arrow_buffer(batch.column(0))
                for i, j in chunks(offsets):
                    buf, s, e, which, doc = _distinct_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    if not len(s):
                        continue
                    y = toxic[i:j][doc]
                    per_word = np.stack([np.bincount(which[y == k], minlength=len(s)) for k in (0, 1)], axis=1)
                    gram, word = word_grams(buf, s, e)
                    u, at = np.unique(gram, return_inverse=True)
                    grams.append(u)
                    counts.append(np.stack([np.bincount(at, weights=per_word[word, k], minlength=len(u))
                                            for k in (0, 1)], axis=1))
                    held += len(u)
                    if held >= FLUSH:
                        yield send(grams, counts)
                        grams, counts, held = [], [], 0
            if held:
                yield send(grams, counts)
    return labelled.mapInArrow(run, "gram long, ordinary long, toxic long") \
        .groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


# ---------------------------------------------------------------- model

def _shorter(gram: np.ndarray, order: int) -> np.ndarray:
    """The gram without its first byte if it has ``order`` bytes; a shorter one begins a word and stays."""
    full = (gram >> U8(8 * (order - 1))) != 0
    return np.where(full, gram & U8((1 << (8 * (order - 1))) - 1), gram)


def shared_backoff(gram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability, from the continuation counts of both classes, of each gram without its first byte."""
    levels, now, weight = [], gram, count.astype(float)
    for order in range(ORDER, 1, -1):
        short = _shorter(now, order)
        u, which = np.unique(short, return_inverse=True)
        # a gram that lost its first byte counts once per longer gram; one that begins a word keeps its count
        weight = np.bincount(which, weights=np.where(short != now, 1.0, weight))
        levels.append((order - 1, u, weight))
        now = u
    known, p = None, None
    for order, u, weight in reversed(levels):
        _, h = np.unique(u >> U8(8), return_inverse=True)
        total, kinds = np.bincount(h, weights=weight)[h], np.bincount(h)[h]
        lower = np.full(len(u), 1 / 256) if known is None else p[np.searchsorted(known, _shorter(u, order))]
        p = np.maximum(weight - DISCOUNT, 0) / total + DISCOUNT * kinds / total * lower
        known = u
    return p[np.searchsorted(known, _shorter(gram, ORDER))]


class Model:
    """Evidence (difference of log-likelihoods) of seen grams, and of unseen grams by their history."""

    def __init__(self, gram: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray):
        order = np.argsort(gram)
        self.gram, counts = gram[order], (ordinary[order].astype(float), toxic[order].astype(float))
        self.empty = not (len(gram) and counts[0].any() and counts[1].any())
        if self.empty:
            return
        backoff = shared_backoff(self.gram, counts[0] + counts[1])
        self.history, h = np.unique(self.gram >> U8(8), return_inverse=True)
        logs, rests = [], []
        for c in counts:
            total, kinds = np.bincount(h, weights=c), np.bincount(h, weights=c > 0)
            rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            logs.append(np.log(np.maximum(c - DISCOUNT, 0) / np.maximum(total[h], 1) + rest[h] * backoff))
            rests.append(np.log(rest))
        self.seen = (logs[1] - logs[0]).astype(np.float32)
        self.unseen = (rests[1] - rests[0]).astype(np.float32)

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Evidence of each word."""
        gram, word = word_grams(buf, starts, ends)
        i = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        value = self.seen[i]
        miss = np.flatnonzero(self.gram[i] != gram)
        past = gram[miss] >> U8(8)
        j = np.minimum(np.searchsorted(self.history, past), len(self.history) - 1)
        value[miss] = np.where(self.history[j] == past, self.unseen[j], 0)
        return np.bincount(word, weights=value, minlength=len(starts))

    def statistics(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One statistic per document."""
        n = len(offsets) - 1
        if self.empty:
            return np.zeros(n)
        buf, s, e, which, doc = _distinct_words(data, offsets)
        if not len(s):
            return np.zeros(n)
        value = self.words(buf, s, e)[which]
        order = np.lexsort((-value, doc))
        count = np.bincount(doc, minlength=n)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        loud = np.maximum(1, np.minimum(count, np.maximum(LEAST, count // LOUDEST)))
        use = place < loud[doc]                       # doc is in order already
        return np.bincount(doc[use], weights=value[order][use], minlength=n) / loud


class GramTable:
    """The evidence of :class:`Model` as tables, for any number of grams: seen (gram, value), unseen (history, value)."""

    def __init__(self, grams: DataFrame):
        def shorter(gram: str, order: int) -> Column:
            low = F.col(gram).bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
            return F.when(F.shiftright(gram, 8 * (order - 1)) != 0, low).otherwise(F.col(gram))

        level, levels = grams.select("gram", (F.col("ordinary") + F.col("toxic")).cast("double").alias("weight")), []
        for order in range(ORDER, 1, -1):
            short = shorter("gram", order)
            level = level.select(short.alias("gram"), F.when(short != F.col("gram"), 1.0).otherwise(F.col("weight"))
                                 .alias("weight")).groupBy("gram").agg(F.sum("weight").alias("weight"))
            level = written(level, "toxic-level")
            levels.append((order - 1, level))
        known = None
        for order, level in reversed(levels):
            level = level.withColumn("h", F.shiftright("gram", 8))
            level = level.join(level.groupBy("h").agg(F.sum("weight").alias("total"), F.count("h").alias("kinds")), "h")
            if known is None:
                level = level.withColumn("lower", F.lit(1 / 256))
            else:
                level = level.withColumn("short", shorter("gram", order)).join(known, "short")
            p = F.greatest(F.col("weight") - DISCOUNT, F.lit(0.0)) / F.col("total") \
                + DISCOUNT * F.col("kinds") / F.col("total") * F.col("lower")
            known = level.select(F.col("gram").alias("short"), p.alias("lower"))

        history, classes = F.shiftright("gram", 8).alias("history"), ("ordinary", "toxic")
        rests = grams.groupBy(history).agg(*(x for c in classes for x in (
            F.sum(c).alias(f"{c}_total"), F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds"))))
        rests = written(rests.select("history", *(x for c in classes for x in (F.col(f"{c}_total"), F.when(
            F.col(f"{c}_total") > 0, DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_total")).otherwise(1.0)
            .alias(f"{c}_rest")))), "toxic-rests")
        self.unseen = rests.select("history", (F.log("toxic_rest") - F.log("ordinary_rest")).alias("value"))

        def log(c: str) -> Column:
            own = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"{c}_total"), F.lit(1))
            return F.log(own + F.col(f"{c}_rest") * F.col("lower"))

        seen = grams.withColumns({"history": F.shiftright("gram", 8), "short": shorter("gram", ORDER)}) \
            .join(rests, "history").join(known, "short")
        self.seen = written(seen.select("gram", (log("toxic") - log("ordinary")).alias("value")), "toxic-seen")

    def words(self, words: DataFrame) -> DataFrame:
        """(word, value): evidence of the words of ``words`` (word, gram, times)."""
        seen = self.seen.withColumnRenamed("value", "seen")
        unseen = self.unseen.withColumnRenamed("value", "unseen")
        found = words.join(seen, "gram", "left").withColumn("history", F.shiftright("gram", 8)) \
            .join(unseen, "history", "left")
        return found.groupBy("word").agg(F.sum(F.coalesce("seen", "unseen", F.lit(0.0)) * F.col("times")).alias("value"))

    def statistics(self, rows: DataFrame) -> DataFrame:
        """(row, statistic) as by :func:`statistics`. Equal texts, told by two 64-bit hashes, are scored once."""
        keyed = rows.select("row", F.xxhash64("b").alias("k"), F.xxhash64(F.lit(1), "b").alias("l"), "b")

        def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with np.errstate(over="ignore"):
                for batch in batches:
                    data, offsets = arrow_buffer(batch.column(0))
                    for i, j in chunks(offsets):
                        buf, s, e, _, _ = _distinct_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                        if not len(s):
                            continue
                        gram, word = word_grams(buf, s, e)
                        order = np.lexsort((gram, word))
                        gram, word = gram[order], word[order]
                        new = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (word[1:] != word[:-1])))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(as_long(_span_hashes(buf, s, e))[word[new]]), pa.array(as_long(gram[new])),
                             pa.array(np.diff(np.append(new, len(gram))))], names=["word", "gram", "times"])

        def spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with np.errstate(over="ignore"):
                for batch in batches:
                    k, m = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                    data, offsets = arrow_buffer(batch.column(2))
                    for i, j in chunks(offsets):
                        buf, s, e, which, doc = _distinct_words(data[offsets[i]:offsets[j]],
                                                                offsets[i:j + 1] - offsets[i])
                        if len(s):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(k[i:j][doc]), pa.array(m[i:j][doc]),
                                 pa.array(as_long(_span_hashes(buf, s, e))[which])], names=["k", "l", "word"])

        words = keyed.select("b").mapInArrow(spelled, "word long, gram long, times long") \
            .groupBy("word", "gram").agg(F.max("times").alias("times"))
        values = written(self.words(words), "toxic-words")
        pairs = keyed.select("k", "l", "b").mapInArrow(spoken, "k long, l long, word long").distinct()
        text = Window.partitionBy("k", "l")
        loud = F.greatest(F.lit(1), F.least("n", F.greatest(F.lit(LEAST), F.floor(F.col("n") / LOUDEST))))
        found = pairs.join(values, "word").select("k", "l", "value", F.count("word").over(text).alias("n"),
                                                  F.row_number().over(text.orderBy(F.desc("value"))).alias("place"))
        found = found.where(F.col("place") <= loud).groupBy("k", "l").agg(F.avg("value").alias("statistic"))
        return keyed.join(found, ["k", "l"], "left").select("row", F.coalesce("statistic", F.lit(0.0)).alias("statistic"))


def model_of(grams: DataFrame) -> Model | GramTable:
    """The model of all of ``grams`` (gram, ordinary, toxic); a count decides whether it is sent out."""
    grams = written(grams, "toxic-grams")
    size = grams.agg(F.count("gram").alias("n"), F.max("ordinary").alias("o"), F.max("toxic").alias("t")).first()
    if size["n"] > MODEL_GRAMS and size["o"] and size["t"]:
        return GramTable(grams)
    table = grams.limit(MODEL_GRAMS).toPandas()  # all of them, unless a class has none and nothing is learned
    return Model(table["gram"].to_numpy(np.int64).view(U8), table["ordinary"].to_numpy(), table["toxic"].to_numpy())


def statistics(rows: DataFrame, model: Model | GramTable) -> DataFrame:
    """(row, statistic) of every row of ``rows`` (row: struct of anything, b: bytes)."""
    if isinstance(model, GramTable):
        return model.statistics(rows)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([rows.schema["row"], StructField("statistic", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                data, offsets = arrow_buffer(batch.column(1))
                out = [np.zeros(0)] + [sent.value.statistics(data[offsets[i]:offsets[j]],
                                                             offsets[i:j + 1] - offsets[i])
                                       for i, j in chunks(offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out), pa.float64())],
                                                 names=["row", "statistic"])
    return rows.select("row", "b").mapInArrow(run, schema)


def fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through counts ``n`` at (x, y), by Newton steps."""
    if not len(x) or y.min() == y.max():
        return 1.0, -3.0
    w = np.zeros(2)
    a = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (n * (y - p)) - ridge * n.sum() * w * [1, 0]
        hess = (a * (n * p * (1 - p))[:, None]).T @ a + ridge * n.sum() * np.diag([1, 1e-6]) + 1e-9 * np.eye(2)
        w = w + np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1])


# ---------------------------------------------------------------- operator

def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that have a label, with ``toxic`` 0 or 1."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    if labels.count() <= LABELS_SENT:  # at most 32 MB; beyond that the planner shuffles both sides
        known = F.broadcast(known)
    return docs.join(known, "doc_id")


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model | GramTable, float, float]:
    """(model, slope, intercept) from documents (doc_id, b) and labels (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    own = with_labels(docs, labels.select("doc_id", "toxic"))
    model = model_of(count_grams(own.where(fold().isin(1, 2, 3)).select("b", "toxic")))
    at = F.round(F.col("statistic") * BINS)
    bins = statistics(own.where(fold() == 4).select(F.struct("toxic").alias("row"), "b"), model) \
        .groupBy(F.greatest(F.lit(-2000), F.least(F.lit(2000), at)).alias("at"), F.col("row.toxic").alias("toxic")) \
        .count().toPandas()
    slope, intercept = fit_curve(bins["at"].to_numpy(float) / BINS, bins["toxic"].to_numpy(float),
                                 bins["count"].to_numpy(float))
    return model, slope, intercept


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, statistic, score): the rows of ``docs`` (doc_id, text, ...) as structs, with their scores."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("b"))
    model, slope, intercept = train(rows, labels)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(slope) * F.col("statistic") + F.lit(intercept))))
    all_rows = docs.select(F.struct(*docs.columns).alias("row"), text_bytes().alias("b"))
    return statistics(all_rows, model).withColumn("score", score)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, statistic) for every row of ``docs`` (doc_id, text)."""
    scored = score_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return scored.select(F.col("row.doc_id").alias("doc_id"), "score", "statistic").select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "statistic")


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return score_rows(docs, labels).where("score < 0.5").select("row.*")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: the toxicity of every document."""
    return toxicity(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "labels",
                                                                           ["doc_id", "toxic"]))
