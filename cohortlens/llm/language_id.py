"""Operator 3: language identification by compression.

Each language gets a zstandard dictionary of raw training text. A text, in lower case, is compressed
with every dictionary, in pieces small enough that the dictionary matters, and the language whose dictionary
leaves the fewest bytes wins. The margin to the second is the confidence; a narrow one is a
rejection: the best language is still named, with ``rejected`` true.

The dictionaries are the only thing learned, from a bounded sample: of each language the ``SAMPLE``
training documents of least seeded hash give up to ``TAKE`` bytes each, in ``PIECES`` pieces from seeded places
spread over the whole text, so that what documents begin with is not all that is learned. They are fetched to the
driver (``SAMPLE * TAKE`` bytes, 128 KB, for a language) and sent to the tasks. Every text is
classified whole.

Folds are crc32(doc_id as text) mod 4: fold 2 is held out.

Defined cases: a text that is null or has no letter is ``und`` with score 0; ties go to the language
with more training documents, then by code point; documents with a null language or null text teach nothing; a null id is not
held out and teaches nothing; with no language learned every text is ``und``; an empty table gives no
rows; columns other than doc_id, text and (in training) lang are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, small_batches

SAMPLE = 128       # training documents of a language
TAKE = 1024        # bytes of each
PIECES = 4         # in so many pieces
PIECE = 2048       # bytes compressed at once
LEVEL = 9
MARGIN = 0.01      # saving over the second-best, as a share of the text, below which a result is rejected
UNKNOWN = "und"
SEED = 20240501


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread(b: Column, h: Column, take: int, pieces: int = PIECES) -> Column:
    """``take`` of the bytes ``b``: one piece from each of some equal parts, at a place in it that ``h`` decides."""
    n, width = F.length(b), take // pieces
    part = F.floor(n / pieces).cast("int")
    cuts = [F.substr(b, F.lit(j) * part + 1 + F.pmod(F.xxhash64(h, F.lit(j)), part - width + 1).cast("int"), F.lit(width))
            for j in range(pieces)]
    return F.when(n <= take, b).otherwise(F.concat(*cuts))


def learn(docs: DataFrame, sample: int = SAMPLE, take: int = TAKE, seed: int = SEED) -> dict[str, bytes]:
    """Dictionary text of each language, most frequent first, from training documents (doc_id, text, lang)."""
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                      & F.col("text").rlike(r"\p{L}"))
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    h = F.xxhash64(F.lit(seed), "doc_id")
    rows = rows.select("lang", spread(F.lower("text").cast("binary"), h, take).alias("b"), h.alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "b"))
    out: dict[str, list[bytes]] = {}
    for r in rows.withColumn("i", place).where(F.col("i") <= sample).orderBy("lang", "i").collect():
        out.setdefault(r["lang"], []).append(bytes(r["b"]))
    return {lang: b"\n".join(out[lang]) for lang in sorted(out, key=lambda x: (-known[x], x.encode()))}


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], piece: int = PIECE, level: int = LEVEL):
        import zstandard as z
        self.languages, self.piece, self._by = list(dictionaries), piece, []
        for text in dictionaries.values():
            d = z.ZstdCompressionDict(text, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self._by.append(z.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                             write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        """Compressed size in bytes per language."""
        pieces = [text[i:i + self.piece] for i in range(0, len(text), self.piece)]
        return [sum(len(c(p)) for p in pieces) for c in self._by]


def classify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) of every row of ``docs`` (doc_id, text).

    ``margin`` is the saving over the second-best language as a share of the text's bytes; the score rises
    with the bits saved, from an even chance to 1.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Classifier(sent.value)
        for f in frames:
            best, score, room = [], [], []
            for text, letters in zip(f["text"], f["letters"], strict=True):
                if not letters or not judge.languages:
                    best.append(UNKNOWN), score.append(0.0), room.append(0.0)
                    continue
                b = text.lower().encode()
                sizes = np.array(judge.sizes(b), dtype=float)
                i = int(np.argmin(sizes))
                second = np.partition(sizes, 1)[1] if len(sizes) > 1 else sizes[i] + len(b)
                best.append(judge.languages[i])
                score.append(float(1 / np.sum(np.exp2(np.clip(sizes[i] - sizes, -60, 0)))))
                room.append(float((second - sizes[i]) / len(b)))
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "lang_pred": best, "score": score,
                                "margin": room, "rejected": [x == UNKNOWN or r < margin
                                                             for x, r in zip(best, room, strict=True)]})
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")) \
        .mapInPandas(run, "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the training folds of ``docs`` (doc_id, text, lang) and classify every row."""
    found = classify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: the language of every document."""
    return identify(documents(spark, sf_dir, "doc_id", "text", "lang"))
