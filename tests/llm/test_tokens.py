"""Operators 1 and 9: ids as the public tokenizer gives them, lossless cuts, full sequences."""

import zlib

import numpy as np
import pytest
from tests.llm.conftest import documents

from cohortlens.llm import packing, token_output, tokens


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def test_ids_are_those_of_the_tokenizer(spark, reference):
    encoder = tokens.Encoder(tokens.vocabulary_path())
    texts = [r["text"] for r in documents(spark, "/root/testdata/sf0.001").collect()]
    texts += ["", " ", "\n\n a  b\t c  d　e", "don't we'll I'M", "a" * 3000, "x1y2 3.14 -- ok?!", "日本語 é́"]
    end = "<|endoftext|>"
    texts += [end, end * 2, f"{end}a", f"a{end}", f"a {end} b", f"x\n\n{end}\n{end} y", "<|endoftext|", f"<{end}>",
              " " * 150_000 + end + " " * 150_000 + "z"]
    for t in texts:
        assert encoder.encode(t).tolist() + [tokens.END_ID] == reference(t)


def test_added_tokens_are_those_of_the_vocabulary():
    import json
    with open(tokens.vocabulary_path("byte_bpe_50k.json")) as f:
        added = json.load(f)["added_tokens"]
    assert {x["content"]: x["id"] for x in added} == tokens.ADDED
    assert not any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized"))


@pytest.mark.parametrize("text", [" " * 1_000_000, "ab" + " " * 1_200_000 + "cd " + "\n" * 120_000 + "é",
                                  "x" + "\u3000" * 400_000 + "\x85" * 700_000, ("a" + " \x1c" * 60_000) * 2])
def test_ids_of_very_long_white_space(reference, text):
    encoder = tokens.Encoder(tokens.vocabulary_path())
    assert encoder.encode(text).tolist() + [tokens.END_ID] == reference(text)


def test_differencing_is_near_equal_and_complete():
    sizes = np.random.default_rng(1).integers(1, 512, 300).tolist()
    loads, dealt = packing.difference(sizes, 40)
    assert sorted(i for w in dealt for i in w) == list(range(300))
    assert loads == [sum(sizes[i] for i in w) for w in dealt]
    assert max(loads) - min(loads) < 40


def test_window_count_rises_when_capacity_is_exceeded():
    dealt = packing.windows([60, 60, 60], 100)  # two windows would hold the sum but not the pieces
    assert len(dealt) == 3
    assert packing.windows([], 100) == []


def _check_pieces(rows, docs, reference, capacity):
    want = sorted(((i is None, i or 0), tuple(reference(t))) for i, t in docs)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        at = 0
        for r in s:
            assert r.offset == at
            at += r.length
        assert 0 < at <= capacity
    assert sum(r.length for r in rows) == sum(len(w[1]) for w in want)
    return want, seqs


def test_pack_loses_nothing(spark, edge_docs, reference):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    rows = packing.pack(edge_docs).collect()
    want, _ = _check_pieces(rows, docs, reference, 2048)
    one = [r for r in rows if r.doc_id == 9]  # a long document: its pieces in order are its ids
    ids = b"".join(r.ids for r in sorted(one, key=lambda r: r.start))
    assert np.frombuffer(ids, "<u4").tolist() == list(dict((w[0][1], w[1]) for w in want)[9])
    assert [r.start for r in sorted(one, key=lambda r: r.start)] == list(np.cumsum([0] + [
        r.length for r in sorted(one, key=lambda r: r.start)])[:-1])
    assert sum(r.doc_id is None for r in rows) >= 2


def test_pack_digest_and_fill(spark):
    sf = "/root/testdata/sf0.01"
    rows = packing.op1_packing(spark, sf).collect()
    sequences = {r.sequence_id: r for r in rows}
    assert sum(r.length for r in rows) / sum(r.padded_to for r in sequences.values()) > 0.97
    pieces = packing.pack(documents(spark, sf)).limit(50).collect()
    by = {(r.doc_id, r.start): r for r in rows}
    for p in pieces:
        assert by[(p.doc_id, p.start)].ids_crc32 == zlib.crc32(p.ids) and by[(p.doc_id, p.start)].length == p.length


def test_empty_table(spark, no_docs):
    assert packing.pack(no_docs).count() == 0 and token_output.to_sequences(no_docs).count() == 0


def test_best_fit_takes_the_fullest_sequence_that_fits():
    assert token_output.best_fit_decreasing([5, 4, 3, 2, 1], 8) == [[0, 2], [1, 3, 4]]
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 64, 500).tolist()
    dealt, room = [], []
    for i in sorted(range(500), key=lambda j: -sizes[j]):  # plain search
        fits = [r for r in room if r >= sizes[i]]
        room.remove(min(fits)) if fits else None
        room.append((min(fits) if fits else 64) - sizes[i])
    got = token_output.best_fit_decreasing(sizes, 64)
    assert sorted(64 - sum(sizes[i] for i in s) for s in got) == sorted(room)
    assert sorted(i for s in got for i in s) == list(range(500)) and dealt == []


def test_matrix_round_trip(spark, edge_docs, reference, tmp_path):
    sequences = token_output.to_sequences(edge_docs)
    token_output.write_sequences(sequences, str(tmp_path / "m"))
    pieces = token_output.read_pieces(spark, str(tmp_path / "m")).collect()
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
        assert len(p.ids) == 4 * p.length
    for i, text in docs:
        if [d for d, _ in docs].count(i) == 1:
            ids = b"".join(p.ids for p in sorted(by[i], key=lambda p: p.start))
            assert np.frombuffer(ids, "<u4").tolist() == reference(text)
    total = sum(len(reference(t)) for _, t in docs)
    assert sum(p.length for p in pieces) == total
    for r in sequences.collect():
        at = np.frombuffer(r.positions, "<u2")
        edges = r.cumulative_lengths
        assert edges[0] == 0 and edges[-1] == r.n_tokens and len(edges) == r.n_segments + 1
        for a, b in zip(edges, edges[1:], strict=False):
            assert at[a:b].tolist() == list(range(b - a))
        assert len(r.ids) == 4 * 2048 and not any(r.ids[4 * r.n_tokens:])


def test_query_covers_every_document(spark):
    rows = token_output.op9_token_output(spark, "/root/testdata/sf0.001").collect()
    assert {d for r in rows for d in r.doc_ids} == set(range(200))
    assert sum(r.n_tokens for r in rows) / (2048 * len(rows)) > 0.95
