"""A text longer than a segment gives what it gives in one piece."""

import numpy as np

from cohortlens.llm import common as C
from cohortlens.llm import suffix_dedup as S


def test_spans_hash_alike_in_segments(monkeypatch):
    rng = np.random.default_rng(1)
    buf = rng.choice(np.frombuffer(b"abcdeAB \n", np.uint8), 50_000)
    offsets = np.array([0, len(buf)])
    whole = C.word_hashes(buf, offsets, True)
    monkeypatch.setattr(C, "SEGMENT_BYTES", 700)
    parts = C.word_hashes(buf, offsets, True)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    one_word = np.full(5_000, 97, np.uint8)
    assert len(C.word_hashes(one_word, np.array([0, 5_000]), False)[0]) == 1


def test_every_window_lies_in_one_segment(monkeypatch):
    rng = np.random.default_rng(2)
    buf = rng.choice(np.frombuffer(b"abc ", np.uint8), 20_000)
    offsets = np.array([0, len(buf)])
    monkeypatch.setattr(S, "SEGMENT_BYTES", 1_500)

    def windows(parts):
        out = {}
        with np.errstate(over="ignore"):
            for part, own, skip in parts:
                g, _, _, p, place, more = S.anchors(part, own, 100, 32)
                for gram, start, at, n in zip(g, p + skip, place, more, strict=True):
                    for k in range(n + 1):
                        assert start + k not in out
                        out[int(start) + k] = (int(gram), int(start + at))
        return out
    whole, split = windows([(buf, offsets, 0)]), windows(S.segments(buf, offsets, 100))
    assert whole == split and len(whole) == 20_000 - 99
