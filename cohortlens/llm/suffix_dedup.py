"""Operator 10: remove repeated byte windows, found by a depth-limited radix sort of suffixes.

A suffix is ordered only through its first ``window`` bytes, by most-significant-digit passes: windows
equal so far are split by their next eight bytes, windows alone in their group leave, and the groups
left after the last pass are exactly the repeated windows. All but the first of a group are removed.

The first digit deals the windows out. It is the window's anchor: its ``gram`` bytes with the least
hash, which depends on the window's bytes alone, so equal windows have equal anchors at equal places.
Neighbouring windows share their anchor, so only about one position in 35 is shuffled, as one entry:
anchor, hash of the bytes its windows cover (the context), document, first window, number of windows.

1. Entries with equal anchor and context: all but the first are removed with all their windows.
2. If the remaining entries of an anchor have different contexts, their bytes are fetched and their
   windows go through the passes. Anchors of a single context are done.
3. The removed windows go to their documents, whose bytes are cut there.

Hot passages: a map task sends one entry per anchor and context whatever their number, removing the
others itself. An anchor with more than ``SPREAD`` contexts is dealt out by whole windows, after a
first round of passes in each task, so that it is no single group. Context hashes have 64 bits.
Documents without an id are told apart by 63 bits of a hash of their text.

Order of documents: smaller doc_id first, a null id last, then by a hash of the text. Rows equal in
both are one document given more than once: each gets the same result and none repeats another.
Defined cases: a null or empty text has no bytes (and is empty in the result of ``cut_repeats``); a text shorter than the window is kept whole; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from cohortlens.llm.common import (SEGMENT_BYTES, WORD, arrow_buffer, by_part, chunks, documents, group_count, prefix_hash,
                                   small_batches, span_hash, text_bytes, written)

WINDOW = 100        # bytes
GRAM = 32           # bytes of an anchor
GROUP_BYTES = 4_000_000  # bytes of text a group of entries or documents is counted for
FLUSH = 500_000     # entries a map task holds before it sends them
FLUSH_BYTES = 16_000_000
SPREAD = 20_000     # contexts of an anchor from which its windows are dealt out one by one
AT_ONCE = 1_000_000 # windows in one run of the passes

ENTRY = np.dtype([("g", "<u8"), ("c", "<u8"), ("d", "<i8"), ("t", "<i8"), ("p", "<i4"), ("l", "u1"), ("s", "u1")])
# g anchor, c context, d and t document (t: 63 bits of a hash, negative for a null id), p first window, l anchor's place after p, s further windows
BLOBS = "part int, kind int, entries binary, texts binary"
ENTRIES, CUTS, MIXED, HOT = 0, 1, 2, 3
LAST = (1 << 63) - 1


def _pack(e: np.ndarray) -> bytes:
    return b"".join(e[f].tobytes() for f in ENTRY.names)


def _unpack(blobs: list[bytes]) -> np.ndarray:
    out = np.empty(sum(len(b) for b in blobs) // ENTRY.itemsize, dtype=ENTRY)
    at = 0
    for b in blobs:
        n, x = len(b) // ENTRY.itemsize, 0
        for f in ENTRY.names:
            size = ENTRY[f].itemsize * n
            out[f][at:at + n] = np.frombuffer(b[x:x + size], dtype=ENTRY[f])
            x += size
        at += n
    return out


def _rows(part: np.ndarray, kind: int, e: np.ndarray, bodies: list[bytes] | None = None) -> Iterator[tuple]:
    """(part, kind, entries, texts) per part; ``bodies`` are the contexts of the entries."""
    order = np.argsort(part, kind="stable")
    part, e = part[order], e[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(part)), strict=True):
        if b > a:
            texts = b"".join(bodies[i] for i in order[a:b]) if bodies is not None else None
            yield int(part[a]), kind, _pack(e[a:b]), texts


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("entries", pa.binary()), ("texts", pa.binary())])

    def make() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema,
                                                                              strict=True)], schema=schema)
    for r in rows:
        held.append(r)
        size += len(r[2] or b"") + len(r[3] or b"")
        if size > 8_000_000:
            yield make()
            held, size = [], 0
    if held:
        yield make()


def _table(rows: Iterator[tuple]) -> pa.Table:
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("entries", pa.binary()), ("texts", pa.binary())])
    return pa.Table.from_batches(list(_batches(rows)), schema)


def _doc_part(e: np.ndarray, parts: int) -> np.ndarray:
    return document_part(e["d"], e["t"], parts)


def document_part(d: np.ndarray, t: np.ndarray, parts: int) -> np.ndarray:
    x = d.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + t.view(np.uint64)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(parts)).astype(np.int64)


# ---------------------------------------------------------------- entries

def anchors(buf: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Entries of a run of documents: (anchor hash, context hash, document, first window, place, further windows)."""
    n, width = len(buf), window - gram + 1
    if n < window:
        return tuple(np.zeros(0, np.uint64 if i < 2 else np.int64) for i in range(6))
    sums = prefix_hash(buf)
    at = np.arange(n - gram + 1)
    hashes = span_hash(sums, at, at + gram)
    key = ((hashes >> np.uint64(33)) << np.uint64(32)) | at.astype(np.uint64)  # ties: the first place
    blocks = -(-len(key) // width)
    tiled = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    tiled[:len(key)] = key
    tiled = tiled.reshape(blocks, width)
    up = np.minimum.accumulate(tiled, axis=1).ravel()
    down = np.minimum.accumulate(tiled[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - window + 1
    least = (np.minimum(down[:m], up[width - 1:width - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    start = np.flatnonzero(np.arange(m) + window <= ends[:m])  # windows inside one document
    if not len(start):
        return tuple(np.zeros(0, np.uint64 if i < 2 else np.int64) for i in range(6))
    anchor = least[start]
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    lo, hi = start[new], start[np.append(new[1:], len(start)) - 1]
    a = anchor[new]
    doc = np.searchsorted(offsets, lo, "right") - 1
    context = span_hash(sums, lo, hi + window) + (a - lo).astype(np.uint64)
    return hashes[a], context, doc, lo - offsets[doc], a - lo, hi - lo


def segments(buf: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, bytes before them) of a run of documents; one long document comes in overlapping segments.

    A window lies in exactly one segment, and its anchor depends on its own bytes alone. A run of windows that a
    segment's edge parts makes two entries, which are compared like any others.
    """
    if len(offsets) > 2 or len(buf) <= SEGMENT_BYTES:
        yield buf, offsets, 0
        return
    for a in range(0, len(buf), SEGMENT_BYTES):
        own = buf[a:a + SEGMENT_BYTES + window - 1]
        yield own, np.array([0, len(own)]), a


def _firsts(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first entry of each anchor and context, entries to remove); an entry given twice counts once."""
    e = e[np.lexsort((e["p"], e["t"], e["d"], e["c"], e["g"]))]
    same = np.zeros(len(e), dtype=bool)
    same[1:] = (e["g"][1:] == e["g"][:-1]) & (e["c"][1:] == e["c"][:-1])
    again = np.zeros(len(e), dtype=bool)
    again[1:] = same[1:] & (e["d"][1:] == e["d"][:-1]) & (e["t"][1:] == e["t"][:-1]) & (e["p"][1:] == e["p"][:-1])
    group = np.cumsum(~same) - 1
    first = e[~same]
    own = first[group] if len(e) else e
    is_first = (own["d"] == e["d"]) & (own["t"] == e["t"]) & (own["p"] == e["p"])
    return first, e[~is_first & ~again]


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    """(d, t, b, row): the place of a document in the order, its bytes and its other columns."""
    h = F.xxhash64("b")
    tag = F.shiftleft(h.bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(
        F.shiftrightunsigned(h, 31).bitwiseAND(F.lit(0xFFFFFFFF)))  # 63 bits, the lowest 31 first in the order
    row = F.struct(*carry) if carry else F.struct(F.lit(0).alias("none"))
    return docs.select(F.col("doc_id").cast("long").alias("i"), text_bytes().alias("b"), row.alias("row")).select(
        F.coalesce("i", F.lit(LAST)).alias("d"), F.when(F.col("i").isNull(), -1 - tag).otherwise(tag).alias("t"), "b",
        "row")


def _entries(keyed: DataFrame, window: int, gram: int, parts: int) -> DataFrame:
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        first, cut = _firsts(np.concatenate(held))
        yield from _batches(_rows((first["g"] % np.uint64(parts)).astype(np.int64), ENTRIES, first))
        yield from _batches(_rows(_doc_part(cut, parts), CUTS, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                d, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                buf, offsets = arrow_buffer(batch.column(2))
                for i, j in chunks(offsets):
                    for part, own, skip in segments(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], window):
                        g, c, doc, p, place, more = anchors(part, own, window, gram)
                        e = np.empty(len(g), dtype=ENTRY)
                        e["g"], e["c"], e["d"], e["t"] = g, c, d[i:j][doc], t[i:j][doc]
                        e["p"], e["l"], e["s"] = p + skip, place, more
                        held.append(e)
                        n += len(e)
                        if n >= FLUSH:
                            yield from flush(held)
                            held, n = [], 0
            if n:
                yield from flush(held)
    return keyed.select("d", "t", "b").mapInArrow(run, BLOBS)


def _settle(sent: DataFrame, parts: int, spread: int) -> DataFrame:
    """By anchor: entries to remove, and entries of anchors with several contexts, both by document."""
    def run(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        blobs = table["entries"].to_pylist()
        first, cut = _firsts(_unpack([b for b, k in zip(blobs, kinds, strict=True) if k == ENTRIES]))
        known = _unpack([b for b, k in zip(blobs, kinds, strict=True) if k == CUTS])
        cut = np.concatenate([cut, known])
        out = list(_rows(_doc_part(cut, parts), CUTS, cut))
        if len(first):
            starts = np.flatnonzero(np.append(True, first["g"][1:] != first["g"][:-1]))
            sizes = np.diff(np.append(starts, len(first)))
            sizes = np.repeat(sizes, sizes)
            for kind, pick in ((MIXED, (sizes > 1) & (sizes <= spread)), (HOT, sizes > spread)):
                out += _rows(_doc_part(first[pick], parts), kind, first[pick])
        return _table(iter(out))
    return by_part(sent, parts).groupBy("part").applyInArrow(run, BLOBS)


# ---------------------------------------------------------------- texts by document part

TEXTS = "part int, d binary, t binary, sizes binary, texts binary, rows binary"


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _texts(keyed: DataFrame, parts: int, carry: bool) -> DataFrame:
    """Texts in compressed bundles, one or more per task and document part, with their other columns if asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1)
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            d = np.concatenate([h[0] for h in held])
            t = np.concatenate([h[1] for h in held])
            buf = np.concatenate([h[2] for h in held])
            sizes = np.concatenate([h[3] for h in held])
            at = np.append(0, np.cumsum(sizes))
            part = document_part(d, t, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            carried = pa.Table.from_batches([h[4] for h in held]).combine_chunks() if carry else None
            rows = []
            for own in np.split(order, cuts):
                body = b"".join(buf[at[i]:at[i + 1]].tobytes() for i in own)
                rows.append((int(part[own[0]]), d[own].tobytes(), t[own].tobytes(), sizes[own].tobytes(),
                             squeeze.compress(body), _stream(carried.take(pa.array(own))) if carry else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))],
                names=["part", "d", "t", "sizes", "texts", "rows"])

        with np.errstate(over="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                buf, offsets = arrow_buffer(batch.column(2))
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), buf,
                             np.diff(offsets).astype(np.int64), batch.select(["row"])))
                size += len(buf)
                if size >= FLUSH_BYTES:
                    yield from flush()
                    held, size = [], 0
            if held:
                yield from flush()
    return keyed.mapInArrow(run, TEXTS)


def _documents_of(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    """(d, t, bytes) of every text of a part."""
    import zstandard
    plain = zstandard.ZstdDecompressor()
    for row in table.select(["d", "t", "sizes", "texts"]).to_pylist():
        body = plain.decompress(row["texts"])
        at = 0
        for d, t, n in zip(np.frombuffer(row["d"], "<i8").tolist(), np.frombuffer(row["t"], "<i8").tolist(),
                           np.frombuffer(row["sizes"], "<i8").tolist(), strict=True):
            yield d, t, body[at:at + n]
            at += n


def _by_document(table: pa.Table, kinds: tuple[int, ...]) -> dict[tuple[int, int], np.ndarray]:
    e = _unpack([b for b, k in zip(table["entries"].to_pylist(), table["kind"].to_pylist(), strict=True) if k in kinds])
    if not len(e):
        return {}
    e = e[np.lexsort((e["p"], e["t"], e["d"]))]
    new = np.flatnonzero(np.append(True, (e["d"][1:] != e["d"][:-1]) | (e["t"][1:] != e["t"][:-1])))
    return {(int(e["d"][a]), int(e["t"][a])): e[a:b] for a, b in zip(new, np.append(new[1:], len(e)), strict=True)}


# ---------------------------------------------------------------- the passes

def repeated(body: np.ndarray, group: np.ndarray, start: np.ndarray, rank: np.ndarray, window: int) -> np.ndarray:
    """Whether each window repeats an earlier one. ``start``: its place in ``body``; ``group``: its first digit;
    ``rank``: its place in the order of all windows (equal ranks are one window given twice)."""
    out = np.zeros(len(start), dtype=bool)
    live = np.arange(len(start))
    padded = np.append(body, np.zeros(8, np.uint8))
    for depth in range(-8, window, 8):
        if depth < 0:
            digit = np.zeros(len(live), np.uint64)
        else:
            width = min(8, window - depth)
            digit = np.zeros(len(live), np.uint64)
            for k in range(width):
                digit = (digit << np.uint64(8)) | padded[start[live] + depth + k].astype(np.uint64)
        order = np.lexsort((digit, group))
        g, x = group[order], digit[order]
        new = np.append(True, (g[1:] != g[:-1]) | (x[1:] != x[:-1]))
        number = np.cumsum(new) - 1
        alone = np.bincount(number)[number] < 2
        live, group = live[order[~alone]], number[~alone]
        if not len(live):
            return out
    order = np.lexsort((rank[live], group))
    live, group = live[order], group[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.repeat(rank[live[first]], np.diff(np.append(first, len(live))))
    out[live] = rank[live] > least
    return out


def _compare(e: np.ndarray, bodies: list[bytes], window: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Run the passes over the windows of some entries: (runs, entry number, offset, removed) per window."""
    order = np.lexsort((e["p"], e["t"], e["d"]))
    place = np.empty(len(e), dtype=np.int64)
    key = np.append(True, (e["d"][order][1:] != e["d"][order][:-1]) | (e["t"][order][1:] != e["t"][order][:-1])
                    | (e["p"][order][1:] != e["p"][order][:-1]))
    place[order] = np.cumsum(key)                           # an entry given twice has one place
    body = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.append(0, np.cumsum([len(b) for b in bodies]))[:-1]
    count = e["s"].astype(np.int64) + 1
    own = np.repeat(np.arange(len(e)), count)
    offset = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    _, anchor = np.unique(e["g"], return_inverse=True)
    digit = anchor[own] * 256 + (e["l"].astype(np.int64)[own] - offset)
    removed = repeated(body, digit, begin[own] + offset, place[own] * 256 + offset, window)
    return own, offset, removed


def _cut_entries(e: np.ndarray, own: np.ndarray, offset: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """Entries for the runs of removed windows."""
    own, offset = own[removed], offset[removed]
    if not len(own):
        return e[:0]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (offset[1:] != offset[:-1] + 1)))
    size = np.diff(np.append(new, len(own)))
    out = e[own[new]].copy()
    out["p"] = out["p"] + offset[new].astype(np.int32)
    out["s"] = size - 1
    return out


def _in_runs(e: np.ndarray, bodies: list[bytes], window: int) -> np.ndarray:
    """Removed windows of entries, in runs of whole anchors of a bounded number of windows."""
    order = np.argsort(e["g"], kind="stable")
    e, bodies = e[order], [bodies[i] for i in order]
    cuts, out, a, held = np.flatnonzero(np.append(e["g"][1:] != e["g"][:-1], True)) + 1, [e[:0]], 0, 0
    windows = np.append(0, np.cumsum(e["s"].astype(np.int64) + 1))
    for b in cuts.tolist():
        held = int(windows[b] - windows[a])
        if held >= AT_ONCE or b == len(e):
            out.append(_cut_entries(e[a:b], *_compare(e[a:b], bodies[a:b], window)))
            a = b
    return np.concatenate(out)


def _contexts(texts: DataFrame, found: DataFrame, window: int, parts: int) -> DataFrame:
    """By anchor: entries of anchors with several contexts, with their bytes."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            wanted = {k: _by_document(right, (k,)) for k in (MIXED, HOT)}
            out = []
            if not any(wanted.values()):
                return _table(iter(out))
            held: dict[int, tuple[list, list]] = {MIXED: ([], []), HOT: ([], [])}
            for d, t, body in _documents_of(left):
                for kind, by in wanted.items():
                    e = by.pop((d, t), None)  # a row given twice is read once
                    if e is not None:
                        held[kind][0].append(e)
                        held[kind][1].extend(body[p:p + s + window] for p, s in
                                             zip(e["p"].tolist(), e["s"].tolist(), strict=True))
            if held[MIXED][0]:
                e = np.concatenate(held[MIXED][0])
                out += _rows((e["g"] % np.uint64(parts)).astype(np.int64), ENTRIES, e, held[MIXED][1])
            if held[HOT][0]:
                e, bodies = np.concatenate(held[HOT][0]), held[HOT][1]
                own, offset, removed = _compare(e, bodies, window)
                cut = _cut_entries(e, own, offset, removed)
                out += _rows((cut["g"] % np.uint64(parts)).astype(np.int64), CUTS, cut)
                own, offset = own[~removed], offset[~removed]
                single = e[own].copy()
                single["p"] = single["p"] + offset.astype(np.int32)
                single["l"] = single["l"] - offset.astype(np.uint8)
                single["s"] = 0
                bodies = [bodies[i][j:j + window] for i, j in zip(own.tolist(), offset.tolist(), strict=True)]
                body = np.frombuffer(b"".join(bodies), np.uint8)
                sums = prefix_hash(body)
                at = np.arange(len(single)) * window
                single["g"] = span_hash(sums, at, at + window)
                out += _rows((single["g"] % np.uint64(parts)).astype(np.int64), ENTRIES, single, bodies)
            return _table(iter(out))
    return by_part(texts, parts).groupBy("part").cogroup(by_part(found, parts).groupBy("part")).applyInArrow(run, BLOBS)


def _passes(contexts: DataFrame, window: int, parts: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        out, entries, bodies = [], [], []
        with np.errstate(over="ignore"):
            for kind, blob, body in zip(*(table[c].to_pylist() for c in ("kind", "entries", "texts")), strict=True):
                e = _unpack([blob])
                if kind == CUTS:
                    out += _rows(_doc_part(e, parts), CUTS, e)
                    continue
                at = 0
                for s in e["s"].tolist():
                    bodies.append(body[at:at + s + window])
                    at += s + window
                entries.append(e)
            if entries:
                cut = _in_runs(np.concatenate(entries), bodies, window)
                out += _rows(_doc_part(cut, parts), CUTS, cut)
            return _table(iter(out))
    return by_part(contexts, parts).groupBy("part").applyInArrow(run, BLOBS)


# ---------------------------------------------------------------- operator

RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, "
          "spans array<struct<start: long, end: long>>, kept binary")


def _apply(texts: DataFrame, cuts: DataFrame, window: int, parts: int, form: str, row: StructField | None) -> DataFrame:
    forms = {"bytes": lambda b: b, "digest": lambda b: hashlib.sha256(b).hexdigest().encode(),
             "text": lambda b: b.decode("utf-8", "ignore").encode()}
    shape = forms[form]
    schema = StructType([*StructType.fromDDL(RESULT), *([row] if row else [])])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        by = _by_document(right, (CUTS,))
        rows: list[list] = [[] for _ in range(6)]
        for d, t, body in _documents_of(left):
            cut = by.get((d, t))
            spans, kept = [], body
            if cut is not None:
                edge = np.zeros(len(body) + 1, dtype=np.int64)
                np.add.at(edge, cut["p"], 1)
                np.add.at(edge, cut["p"].astype(np.int64) + cut["s"] + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                steps = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans = [{"start": a, "end": b} for a, b in steps.reshape(-1, 2).tolist()]
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
            for column, value in zip(rows, (None if t < 0 else d, len(body), len(body) - len(kept), len(spans),
                                            spans, shape(kept)), strict=True):
                column.append(value)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
        out = pa.table([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
                       names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
        if row is None:
            return out
        streams = [pa.ipc.open_stream(x).read_all() for x in left["rows"].to_pylist()]
        if streams:
            return out.append_column("row", pa.concat_tables(streams)["row"].combine_chunks())
        return out.append_column(to_arrow_schema(StructType([row])).field(0), pa.nulls(0, to_arrow_schema(
            StructType([row])).field(0).type))
    return by_part(texts, parts).groupBy("part").cogroup(by_part(cuts, parts).groupBy("part")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, spread: int = SPREAD,
                   form: str = "bytes", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): sizes, removed spans (byte offsets) and what is kept.

    ``form`` of ``kept``: "bytes"; "text", without the bytes of characters that were cut through; "digest", the
    SHA-256 of the bytes in hexadecimal, so that they need not leave the task. The columns named by ``carry``
    come along in the struct ``row``.
    """
    if not gram < window <= 200:
        raise ValueError("gram < window <= 200 is needed")
    spark = docs.sparkSession
    small_batches(spark)
    parts = group_count(docs, GROUP_BYTES)
    keyed = _keyed(docs, carry or [])
    found = written(_settle(_entries(keyed, window, gram, parts), parts, spread), "suffix-entries")
    mixed = _contexts(_texts(keyed, parts, False), found.where(F.col("kind").isin(MIXED, HOT)), window, parts)
    more = _passes(mixed, window, parts)
    cuts = found.where(F.col("kind") == CUTS).unionByName(more)
    return _apply(_texts(keyed, parts, bool(carry)), cuts, window, parts, form, keyed.schema["row"] if carry else None)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns and without repeated passages.

    ``n_chars``, if there is one, is set to the new length where something was removed. A document of which only
    white space is left after a removal is dropped.
    """
    rest = [c for c in docs.columns if c != "text"]
    found = remove_repeats(docs, form="text", carry=rest)
    changed = F.col("n_removed") > 0
    found = found.select("row", F.col("kept").cast("string").alias("text"), "n_removed", "n_bytes")
    found = found.where(~(changed & ~F.col("text").rlike(WORD)))
    new = {"text": F.col("text")}
    if "n_chars" in rest:
        new["n_chars"] = F.when(changed, F.length("text")).otherwise(F.col("row.n_chars")) \
            .cast(docs.schema["n_chars"].dataType)
    return found.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: what is removed of every document, with a digest of what is kept."""
    return remove_repeats(documents(spark, sf_dir, "doc_id", "text"), form="digest").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))
