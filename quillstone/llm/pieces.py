"""A public merge-type piece vocabulary, and batch look-ups in it."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import sentencepiece

#: White space as a SentencePiece vocabulary writes it.
SPACE = "▁"
DEFAULT_MODEL = "piece_bpe_32k.model"


def model_bytes(path: str | None = None) -> bytes:
    """The vocabulary file, read on the driver. It has a fixed size and so can be broadcast."""
    with open(path or public_tokenizers.path(DEFAULT_MODEL), "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces, scores and ids of a merge-type SentencePiece model."""

    def __init__(self, proto: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(sp.get_piece_size())
        self.size = len(ids)
        self.byte_ids = [-1] * 256
        self.ids: dict[str, int] = {}
        self.scores = np.full(self.size, -np.inf)
        for i in ids:
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[piece] = i
                self.scores[i] = sp.get_score(i)
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.ids))
        # No piece has white space after another character, so texts can be cut before each run of white space.
        self.splits_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.splits_at_space else r"(?s).+").findall


@functools.lru_cache(maxsize=2)
def vocabulary(proto: bytes) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(proto)


def code_points(words: list[str], width: int) -> np.ndarray:
    """len(words) x width code points; words are width long or shorter, 0 fills up."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


_BASE, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
#: Spreads the hashes of short strings over all leading bits.
_MIX = np.uint64(0xD6E8FEB86659FD93)


class SubstringIndex:
    """Finds which substrings of many words are pieces, by polynomial hashes modulo 2**64."""

    def __init__(self, pieces: dict[str, int]):
        by_hash = {}
        for piece, i in pieces.items():
            h = 0
            for c in piece:
                h = (h * int(_BASE) + ord(c) + 1) % 2**64
            by_hash[h * int(_MIX) % 2**64] = i
        if len(by_hash) < len(pieces):
            raise ValueError("two pieces share a hash; choose another base")
        self.hashes = np.array(sorted(by_hash), np.uint64)
        self.found = np.array([by_hash[int(h)] for h in self.hashes], np.int64)
        self.longest = max(map(len, pieces))
        # first: where hashes with the same leading bits begin, -1 if there are none; runs: their number at most.
        slots = (self.hashes >> _SHIFT).astype(np.int64)
        self.first = np.full(2 ** (64 - int(_SHIFT)), -1, np.int32)
        self.first[slots[::-1]] = np.arange(len(slots) - 1, -1, -1)
        self.runs = int(np.bincount(np.unique(slots, return_inverse=True)[1]).max())

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat places in h that hold a piece's hash, and the pieces."""
        at = self.first[h.ravel() >> _SHIFT]
        places = np.flatnonzero(at >= 0)
        at, want = at[places], h.ravel()[places]
        hit = np.full(len(places), -1, np.int64)
        for k in range(self.runs):
            i = np.minimum(at + k, len(self.hashes) - 1)
            hit = np.where(self.hashes[i] == want, self.found[i], hit)
        return places[hit >= 0], hit[hit >= 0]

    def by_length(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """Per length from 1: piece ids (or -1) of the substrings starting at each column."""
        h = np.zeros(codes.shape, np.uint64)
        wide = codes.astype(np.uint64) + np.uint64(1)
        for n in range(1, min(self.longest, codes.shape[1]) + 1):
            h = h[:, : codes.shape[1] - n + 1] * _BASE + wide[:, n - 1 :]
            ids = np.full(h.shape, -1, np.int64)
            places, found = self.look_up(h * _MIX)
            ids.ravel()[places] = found
            yield ids
