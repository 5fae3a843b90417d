"""SentencePiece encoding and decoding for merge-type vocabularies.

Every distinct white-space chunk of an Arrow batch is encoded by a score-ordered agenda of adjacent
symbol pairs: the pair whose merged piece scores best is merged first, the leftmost of equals, until
no pair makes a piece. No piece of such a vocabulary holds white space after another character, so
the chunks of a text are independent. The new chunks of each Arrow batch are checked against the
sentencepiece library, which also decodes.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillstone.llm.common import ship, text_or_empty
from quillstone.llm.pieces import SPACE, Vocabulary, model_bytes, vocabulary

#: Chunks longer than this get a heap; a task keeps two generations of so many encoded chunks, of about 150 bytes each;
#: the newer stays in the worker for later tasks, beside what other stages need.
LIST_WIDTH, KEPT_CHUNKS = 48, 600_000
_NEVER = float("inf")


class Agenda:
    """Encodes chunks: of all adjacent pairs the one whose merged piece has the best score goes first."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.cost = {piece: -float(vocab.scores[i]) for piece, i in vocab.ids.items()}

    def encode(self, chunk: str) -> list[int]:
        symbols = self._merge_list(chunk) if len(chunk) <= LIST_WIDTH else self._merge_heap(chunk)
        ids = self.vocab.ids
        try:
            return [ids[s] for s in symbols]
        except KeyError:
            return list(chain.from_iterable([ids[s]] if s in ids else self._bytes(s) for s in symbols))

    def _bytes(self, c: str) -> list[int]:
        """Byte pieces of a character that is no piece; the unknown id where the vocabulary has none."""
        fallback = [self.vocab.byte_ids[b] for b in c.encode()]
        return [self.vocab.unknown] if min(fallback) < 0 else fallback

    def _merge_list(self, chunk: str) -> list[str]:
        """The agenda of a short chunk is the list of its pairs' costs; the leftmost of equals is merged first."""
        cost, symbols = self.cost.get, list(chunk)
        agenda = [cost(a + b, _NEVER) for a, b in pairwise(symbols)]
        while agenda:
            best = min(agenda)
            if best == _NEVER:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], _NEVER)
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], _NEVER)
        return symbols

    def _merge_heap(self, chunk: str) -> list[str]:
        """The agenda of a long chunk is a heap by cost and place, from which outdated pairs are skipped."""
        cost, text = self.cost, list(chunk)
        before, after = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (merged := text[left] + text[right]) in cost:
                heapq.heappush(agenda, (cost[merged], left, right, merged))

        for k in range(len(text) - 1):
            propose(k, k + 1)
        while agenda:
            _, left, right, merged = heapq.heappop(agenda)
            if not text[left] or not text[right] or len(text[left]) + len(text[right]) != len(merged):
                continue
            text[left], text[right] = merged, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [s for s in text if s]


class Codec:
    """Encodes and decodes batches of texts; remembers the chunks of earlier ones."""

    def __init__(self, proto: bytes):
        self.vocab = vocabulary(proto)
        self.agenda = Agenda(self.vocab)
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers of the machine
        self.older: dict[str, bytes] = {}
        self.disputed: set[str] = set()

    def _library(self, chunks: list[str]) -> list[list[int]]:
        # The library puts one white space before a text and gives no ids for an empty one.
        ids = self.vocab.library.encode([c[1:].replace(SPACE, " ") for c in chunks], num_threads=1)
        return [i if c != SPACE else [self.vocab.ids[SPACE]] for c, i in zip(chunks, ids, strict=True)]

    def _learn(self, chunked: list[list[str]]) -> None:
        if len(self.known) > KEPT_CHUNKS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set(chain.from_iterable(chunked)).difference(known)
        again = missing.intersection(older) if older else ()
        known.update((c, older[c]) for c in again)
        new = list(missing.difference(again))
        for c, checked in zip(new, self._library(new), strict=True):
            own = self.agenda.encode(c)
            if own != checked:
                self.disputed.add(c)
                own = checked
            known[c] = array("i", own).tobytes()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], bool]]:
        """Per text: ids, and whether the library agrees on every chunk."""
        chunked = [self.vocab.chunks(n) for n in self.vocab.library.normalize(texts)]
        self._learn(chunked)
        get = self.known.__getitem__
        for cs in chunked:
            yield np.frombuffer(b"".join(map(get, cs)), np.int32).tolist(), not self.disputed or self.disputed.isdisjoint(cs)

    def rest(self) -> None:
        """Give up the older generation, between tasks."""
        self.older = {}

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.vocab.library.decode(ids) if ids else []


@functools.lru_cache(maxsize=1)
def codec_of(proto: bytes) -> Codec:
    """One per worker process, so that later tasks know the chunks of earlier ones."""
    return Codec(proto)


def _rounds(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """texts in runs of about most characters, so that one Arrow batch of long texts stays small in memory."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def piece_codec(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, ids, decoded, library_agrees.

    ids are those of the library's encode without begin and end ids; decoded is its decode of them. A
    null text counts as empty and gives no ids. library_agrees is false if the library's ids of a
    chunk differed from the agenda's; then the library's stand. Repeated rows give repeated rows,
    ids may be null, other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    proto = spark.sparkContext.broadcast(model_bytes(model_path))
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(proto.value)
        for batch in batches:
            start = 0
            for texts in _rounds(batch.column(1).to_pylist()):
                coded = list(codec.encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array([c[0] for c in coded], pa.list_(pa.int32())), pa.array(codec.decode([c[0] for c in coded]), pa.string()), pa.array([c[1] for c in coded])],
                    names=["doc_id", "ids", "decoded", "library_agrees"],
                )
                start += len(texts)
        codec.rest()

    return docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col)).mapInArrow(run, f"doc_id {id_type.simpleString()}, ids array<int>, decoded string, library_agrees boolean")


def piece_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, library_agrees of the same encoding and decoding, digested in place.

    A null text counts as empty, repeated rows give repeated rows, ids may be null, no other columns are read.
    """
    spark = docs.sparkSession
    ship(spark)
    proto = spark.sparkContext.broadcast(model_bytes(model_path))
    id_type = docs.schema[id_col].dataType
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(proto.value)
        for batch in batches:
            n, ids, decoded, agrees = [], [], [], []
            for texts in _rounds(batch.column(1).to_pylist()):
                coded = list(codec.encode(texts))
                n += [len(c[0]) for c in coded]
                ids += [sha(",".join(map(str, c[0]))) for c in coded]
                agrees += [c[1] for c in coded]
                decoded += [sha(t) for t in codec.decode([c[0] for c in coded])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "library_agrees"])
        codec.rest()

    return docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col)).mapInArrow(run, f"doc_id {id_type.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, library_agrees boolean")
