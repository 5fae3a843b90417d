"""Byte-level BPE ids by the tokenizers library, chunk by chunk, with a memory of frequent chunks."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import public_tokenizers

#: Chunks up to this length are remembered by a worker, up to so many bytes; longer ones seldom come back.
KEPT_LENGTH, KEPT_BYTES = 64, 256 << 20
#: What a remembered chunk takes besides its characters.
ENTRY_BYTES = 190
DEFAULT_MODEL = "byte_bpe_50k.json"
#: A byte-level vocabulary splits before every run of white space and between a letter and a point or comma, so a text can be cut there.
#: Python's pattern takes four control characters for white space that the library doesn't.
_CHUNKS = re.compile(r"[^\S\x1c-\x1f]*[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?])|[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+").findall
#: White space that chunks often begin with. Such a chunk can follow any that doesn't end with white space.
_LEADS = " \n\t"


def model_json(path: str | None = None) -> str:
    """The vocabulary file, read on the driver. It has a fixed size and so can be broadcast."""
    with open(path or public_tokenizers.path(DEFAULT_MODEL), encoding="utf-8") as f:
        return f.read()


class ByteBpe:
    """Encodes texts as bytes of little-endian ids of the width that the vocabulary needs."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        size = self.library.get_vocab_size()
        self.width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # A byte-level piece has one character a byte; an added token stands for itself.
        added = self.library.get_added_tokens_decoder()
        self.bytes = np.array([len(added[i].content.encode()) if i in added else len(self.library.id_to_token(i) or "") for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _one_by_one(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _together(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that begin with white space and end without: their concatenation is encoded, and cut by the bytes that ids stand for."""
        ids = np.array(self.library.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, self.width)
        ends = np.cumsum([len(c.encode()) for c in chunks])
        stops = np.searchsorted(np.cumsum(self.bytes[ids]), ends) + 1
        flat, width = ids.tobytes(), self.width.itemsize
        return [flat[a * width : b * width] for a, b in pairwise([0, *stops.tolist()])]

    def _learn(self, new: list[str]) -> list[str]:
        """Remember new chunks; returns the long ones, to be forgotten after use."""
        spaced = [c for c in new if c[0] in _LEADS and not c.isspace()]
        rest = [c for c in new if c[0] not in _LEADS or c.isspace()]
        for some, encode in ((spaced, self._together), (rest, self._one_by_one)):
            for start in range(0, len(some), 4096):
                part = some[start : start + 4096]
                self.known.update(zip(part, encode(part), strict=True))
        long = [c for c in new if len(c) > KEPT_LENGTH]
        self.held += sum(map(len, new)) - sum(map(len, long)) + ENTRY_BYTES * (len(new) - len(long))
        return long

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if self.held > KEPT_BYTES:
            self.known, self.held = {}, 0
        chunked = [_CHUNKS(t) for t in texts]
        long = self._learn(list(set(chain.from_iterable(chunked)).difference(self.known)))
        get = self.known.__getitem__
        for cs in chunked:
            yield b"".join(map(get, cs))
        for c in long:
            del self.known[c]


@functools.lru_cache(maxsize=1)
def byte_bpe(model: str) -> ByteBpe:
    """One per worker process."""
    return ByteBpe(model)
