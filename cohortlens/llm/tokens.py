"""Token ids of whole texts: byte-level BPE over a public vocabulary file.

The ids are those of ``byte_bpe_50k.json`` under the ``tokenizers`` library (tests compare them). The
same vocabulary is read here in its rank form, because that encoder needs a quarter of the CPU time.
Its pattern runs out of stack on white-space runs of about a million characters, so runs of ``LONG_RUN``
or more are cut out by hand, as the pattern would. The vocabulary's added token is found in the text first, as that
library does, and has its own id; what stands between is encoded piece by piece.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 1  # written after every document
ADDED = {"<|endoftext|>": 50256}  # fixed value: the added token of the vocabulary
LONG_RUN = 100_000  # white-space characters
_SPACES = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")  # \s of the pattern
_ADDED = re.compile("(" + "|".join(map(re.escape, ADDED)) + ")")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class Encoder:
    """``encode(text)`` gives the ids as a numpy array of unsigned 32-bit integers; nothing is put around it."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        ids: list[int] = []
        for piece in _ADDED.split(text or ""):
            ids += [ADDED[piece]] if piece in ADDED else self._plain(piece)
        return np.array(ids, dtype="<u4")

    def _plain(self, text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return self._enc.encode_ordinary(text)
        ids, at = [], 0
        for run in _SPACES.finditer(text):
            if len(run[0]) >= LONG_RUN:
                end = run.end() - (run.end() < len(text))  # the last space goes with what follows
                ids += self._enc.encode_ordinary(text[at:run.start()])
                ids += self._enc._encode_single_piece(text[run.start():end])
                at = end
        return ids + self._enc.encode_ordinary(text[at:])
