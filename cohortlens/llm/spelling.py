"""Operator 11: spelling variants by a variable-length gram index.

Words that differ by one inserted, deleted or replaced character are near; a word's form is its most
frequent near word, if that is at least twice as frequent, and following forms leads to its root.

* Dictionary. All grams of QMIN to QMAX characters of the distinct words are counted. A gram is extended by one more
  character only where it is frequent, and only to extensions that are not rare themselves; all shortest grams
  are kept. The dictionary's size is bounded by the thresholds, whatever the number of words.
* Decomposition. From each position of a word the longest gram of the dictionary is taken, unless one taken before
  covers it.
* Affected grams. For each place an edit can have, :func:`affected` counts the grams that it may change: those whose
  choice looked at the place, those between the first of them and the place, and those after it that a new,
  longer gram could cover. The largest such count is the word's bound.
* Lists. With a bound of b, one of any b + 1 grams of a word is left alone by the edit. A word enters the lists of its
  b + 1 rarest grams (all tied ones included). Left alone by an edit, a gram has the same text up to its end, or the
  same text from its start, in both words; so a gram's list is split by the text before it and again by the
  text after it, and by the word's length. Words that meet in such a list are verified.
* The rest. Where the bound leaves no gram, a pair is still found if it leaves one in the other word. Pairs of two
  such (short) words are found by the same lists over the shortest grams, of which an edit touches at most QMIN;
  words of at least QMIN + 3 characters always keep one.
* Lists beyond LIST words. Words of a list agree up to the gram's end or from its start, and the edit lies in the rest
  of the word. The rest is halved: one edit leaves one half alone, so the list is split by either half, and again
  while it is long. At the end its words differ in one place, where an alphabet of 90 letters sets the bound.
  Runs of letters of over LONG_WORD characters, which are no words of a language and may repeat one gram, all lie in
  the list of their length, and are halved from there.

Texts are read in Arrow batches and counted in pieces; a task holds one piece and a bounded table of counts. Everything
after that moves words, never documents. Roots are found by doubling: a chain of forms at least doubles its count with
each step, so log2(log2(largest count)) rounds reach every end.

Defined cases: a null or empty text has no words; a null doc_id counts as an empty string where letters are dropped;
rows alike in every column count each; ties between near words go to the smaller in code-point order; an empty table
gives no rows; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, text_bytes, written
from cohortlens.session import default_buckets

RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")  # letters a-z and U+00C0 to U+00FF, in UTF-8, after lower-casing
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_EDGE = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")  # an ASCII byte that is no letter: no run crosses it
PIECE_BYTES = 1_000_000   # a long text is counted in pieces of about so many bytes
HELD_WORDS = 200_000      # distinct words a task counts before it hands them on
DROP_EVERY = 97           # of a word's checksums, those that lose a letter
LEAST_LENGTH = 5          # characters of a word
LEAST_COUNT = 3           # occurrences of a word
LIFT = 2                  # a form is at least so many times as frequent
QMIN, QMAX = 2, 4         # characters of a gram
FREQUENT = 20_000         # a gram is extended if it stands in more than 1 in so many positions
RARE = 10                 # an extension is kept from a share of so many times less
LONG_WORD = 64            # longer words enter the list of their length instead of lists of grams
LIST = 200                # words of a list that are compared with each other


def lowered(text: bytes) -> bytes:
    return text.translate(_LOWER)


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut where no run of letters is cut."""
    at = 0
    while len(text) - at > size:
        edge = _EDGE.search(text, at + size)
        if edge is None:
            break
        yield text[at:edge.start()]
        at = edge.start()
    yield text[at:] if at else text


def dropped(run: bytes, h: int) -> bytes:
    """The run without the character that its checksum points at."""
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1:]).encode()


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}
    crc, seen = zlib.crc32, held.get

    def out() -> pa.RecordBatch:
        rows = [(w, n) for w, n in held.items()
                if len(w) >= LEAST_LENGTH and (w.isascii() or len(w.decode()) >= LEAST_LENGTH)]
        held.clear()
        return pa.record_batch([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
                               names=["word", "n"])
    for batch in batches:
        for doc_id, text in zip(batch.column("id"), batch.column("body"), strict=True):
            tag = crc(doc_id.as_py().encode() + b":")
            for piece in pieces(text.as_py()):
                for run, n in Counter(RUN.findall(lowered(piece))).items():
                    h = crc(run, tag)
                    word = run if h % DROP_EVERY else dropped(run, h)
                    held[word] = seen(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield out()
    yield out()


def count_words(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) that occur often enough."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text_bytes().alias("body"))
    return rows.mapInArrow(_count_batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= least).select(F.col("word").cast("string").alias("word"), "n")


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Gram -> count over the distinct words, pruned by frequency.

    The driver receives at most all shortest grams (pairs of 90 letters) and (QMAX - QMIN) * RARE * FREQUENT longer ones.
    """
    positions = words.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).collect()[0][0]
    frequent = max(20, positions // FREQUENT)
    rare = max(2, frequent // RARE)
    grams = F.flatten(F.array(*(_grams(q) for q in range(QMIN, QMAX + 1))))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").count() \
        .where((F.length("gram") == QMIN) | (F.col("count") >= rare))
    found = {r["gram"]: r["count"] for r in counts.collect()}
    return {g: n for g, n in found.items() if len(g) == QMIN or found[g[:-1]] > frequent}


def _grams(q: int) -> Column:
    last = F.length("word") - q + 1
    at = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda p: F.substr(F.col("word"), p, F.lit(q)))


def decompose(word: str, grams: dict[str, int], qmax: int = QMAX) -> list[tuple[int, int, int]]:
    """The grams of a word: start, end, and the last place the choice looked at. Covered ones are left out later."""
    out = []
    for p in range(len(word) - QMIN + 1):
        end = p + QMIN
        while end < len(word) and end - p < qmax and word[p:end + 1] in grams:
            end += 1
        out.append((p, end, min(end, p + qmax - 1)))
    return out


def uncovered(chosen: Sequence[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Those of the chosen grams (start, end) that none before covers."""
    out, reached = [], 0
    for p, end, _ in chosen:
        if end > reached:
            out.append((p, end))
            reached = end
    return out


def affected(length: int, chosen: Sequence[tuple[int, int, int]], kept: Sequence[tuple[int, int]], qmax: int = QMAX) -> int:
    """The most of ``kept`` that one edit may change, over all its places (``length``: an insertion at the end).

    An edit at i changes the choice only at starts up to i that looked as far as i. A gram that starts between the first
    of them and i may become covered; so may one after i that ends within ``qmax`` of it. All others stay, with the
    word before them or after them unchanged.
    """
    most = 0
    for i in range(length + 1):
        first = next((p for p, _, saw in chosen[max(0, i - qmax):i + 1] if saw >= i), i)
        most = max(most, sum(1 for p, end in kept if first <= p and (p <= i or end <= i + qmax)))
    return most


def lists_of(word: str, grams: dict[str, int]) -> Iterator[tuple[str, str]]:
    """(list, rest): the lists a word enters, and the part of the word in which the edit must lie."""
    if len(word) >= LONG_WORD:
        yield "l", word
    if len(word) > LONG_WORD:
        return
    chosen = decompose(word, grams)
    kept = uncovered(chosen)
    bound = affected(len(word), chosen, kept)
    yield from _entries("v", word, kept, bound, grams)
    if bound >= len(kept):
        shortest = decompose(word, grams, QMIN)
        every = uncovered(shortest)
        yield from _entries("s", word, every, affected(len(word), shortest, every, QMIN), grams)


def _entries(kind: str, word: str, kept: Sequence[tuple[int, int]], bound: int, grams: dict[str, int]):
    by_rarity = sorted((grams.get(word[p:end], 0), word[p:end], p, end) for p, end in kept)
    cut = by_rarity[min(bound, len(by_rarity) - 1)][:2]
    for n, gram, p, end in by_rarity:
        if (n, gram) <= cut:
            yield f"{kind}<{word[:end]}", word[end:]   # the edit lies after the gram
            yield f"{kind}>{word[p:]}", word[:p]       # or before it


def _entry_batches(grams) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = grams.value
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                rows = [(key, word, n, rest) for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist(),
                                                                strict=True) for key, rest in lists_of(word, known)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
                    pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["key", "word", "n", "rest"])
    return run


def lists(words: DataFrame) -> DataFrame:
    """The lists: key, shorter, word, n, rest. In a list the shorter words have a rest of ``shorter`` characters.

    A word stands in the list of its own rest's length, and as the longer word in the one below. Keys are hashes;
    lists that share one by chance only have more words to verify.
    """
    spark = words.sparkSession
    grams = spark.sparkContext.broadcast(gram_dictionary(words))
    entries = words.select("word", "n").repartition(default_buckets(spark), "word").mapInArrow(
        _entry_batches(grams), "key string, word string, n long, rest string")
    r = F.length("rest")
    return entries.withColumn("key", F.xxhash64("key")).withColumn("shorter", F.explode(F.when(r > 0, F.array(r, r - 1)).otherwise(F.array(r))))


def halved(entries: DataFrame) -> DataFrame:
    """The entries of lists, dealt again by either half of the rest.

    Two rests of r and r or r + 1 characters that are one edit apart agree in the first r // 2 characters or in the
    last r - r // 2; what is left is the new rest.
    """
    r, left = F.length("rest"), (F.col("shorter") / 2).cast("int")
    right = F.col("shorter") - left
    parts = F.array(
        F.struct(F.concat(F.lit("<"), F.substr("rest", F.lit(1), left)).alias("same"), right.alias("shorter"),
                 F.substr("rest", left + 1).alias("rest")),
        F.struct(F.concat(F.lit(">"), F.substr("rest", r - right + 1)).alias("same"), left.alias("shorter"),
                 F.substr("rest", F.lit(1), r - right).alias("rest")))
    dealt = entries.select("key", F.col("shorter").alias("_of"), "word", "n", F.explode(parts).alias("p"))
    return dealt.select(F.xxhash64("key", "_of", "p.same").alias("key"),
                        F.col("p.shorter").alias("shorter"), "word", "n", F.col("p.rest").alias("rest"))


def _meet(entries: DataFrame) -> DataFrame:
    """Verified pairs (a, b, n_a, n_b) of words that share a list and differ by one edit; b is no shorter than a."""
    a = entries.where(F.length("rest") == F.col("shorter")).select("key", "shorter", F.col("word").alias("a"),
                                                                   F.col("n").alias("n_a"))
    b = entries.select("key", "shorter", F.col("word").alias("b"), F.col("n").alias("n_b"),
                       (F.length("rest") > F.col("shorter")).alias("longer"))
    pairs = a.join(b, ["key", "shorter"]).where(F.col("longer") | (F.col("a") < F.col("b")))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "n_a", "n_b")


def near_pairs(words: DataFrame, longest_list: int = LIST) -> DataFrame:
    """Every pair of near words once: a, b, n_a, n_b. ``words`` (word, n) has each word once.

    Lists of more than ``longest_list`` words are halved until they are shorter, or their words differ in one
    place only. Runs jobs while it is called.
    """
    here, found = written(lists(words), "spelling-lists"), []
    while True:
        long = written(here.where("shorter > 1").groupBy("key", "shorter").count().where(F.col("count") > longest_list)
                       .select("key", "shorter"), "spelling-long")
        none = long.isEmpty()
        found.append(_meet(here if none else here.join(long, ["key", "shorter"], "left_anti")))
        if none:
            break
        here = written(halved(here.join(long, ["key", "shorter"], "left_semi")), "spelling-halves")
    return reduce(DataFrame.unionByName, found).dropDuplicates(["a", "b"])


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form); ``most``: the largest count of a word."""
    at = forms.select("word", F.col("form").alias("root"))
    for i in range(max(0, math.ceil(math.log2(math.log2(max(most, 2)) + 1)))):
        at = written(at, f"spelling-roots{i}")
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return at


def variants(words: DataFrame) -> DataFrame:
    """Per word of ``words`` (word, n): form, root, n_near and form_n."""
    pairs = near_pairs(words)
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    both = pairs.select(F.explode(ways).alias("x")).select("x.*")  # a union of the two would work out all pairs twice
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    strong = -F.col("best.minus") >= LIFT * F.col("n")
    rows = written(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    most = rows.agg(F.max("n")).collect()[0][0] or 0
    ends = roots(rows.where("form is not null"), most)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """Contract query: every word of ``documents`` with its form and root."""
    return variants(written(count_words(documents(spark, sf_dir, "doc_id", "text")), "spelling-words"))


def oracle() -> str:
    """DuckDB SQL for :func:`op11_spelling`: near words by words with one character blanked or left out."""
    from cohortlens.llm import duck
    lower = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, {lower} AS run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  GROUP BY doc_id, {lower}),
hashed AS (SELECT run, n, {duck.crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {DROP_EVERY} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.l = b.l AND a.r = b.r AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.l || c.r
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.l || c.r),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY word),
named AS (SELECT p.word, min(encode(p.other)) AS other FROM pairs p JOIN best b ON b.word = p.word AND p.other_n = b.top GROUP BY p.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= {LIFT} * w.n THEN decode(m.other) END AS form,
         CASE WHEN b.top >= {LIFT} * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word) LEFT JOIN named m USING (word)),
follow(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT f.word, x.form FROM follow f JOIN forms x ON x.word = f.root WHERE x.form IS NOT NULL)
SELECT f.word, f.form, e.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN follow e ON e.word = f.word JOIN forms x ON x.word = e.root AND x.form IS NULL"""
