"""Removal of repeated 100-byte strings, by a multi-document Burrows-Wheeler construction.

Every string of ``length`` bytes belongs to the leftmost smallest hash among the grams inside it; equal
strings so have equal grams, at one place in them. A run of strings that one gram owns is a context: a
short byte string, all of whose strings of that length are judged together. In one pass over the places
sorted by gram and digest, contexts of grams that occur once are dropped, equal contexts are judged by
their first occurrence, and what is left of a gram with several contexts goes to the sort.

In a task, the suffixes of a collection of contexts are sorted column by column: each round inserts one
more symbol of every context, from its end to its start, into the collection's Burrows-Wheeler transform
and updates the common prefixes of neighbours. Both are in sequential files, which a round reads twice,
in blocks. Neighbours with a common prefix of a whole string are equal strings; all but the first go.

Grams that a sample of the documents shows to be very frequent, and grams with very many contexts, are cut into their strings, which are dealt out by their own hashes.
"""

from __future__ import annotations

import secrets
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import broadcast_if_small, checkpointed, ship, text_or_empty

LENGTH, GRAM = 100, 48
#: Contexts sorted together; a gram with over CROWDED is cut into strings.
COLLECTION, CROWDED = 8192, 1024
#: A gram with over HOT_PLACES places, by the documents that one hash in SAMPLE picks, is cut before the shuffle; at most HOT_GRAMS are.
HOT_PLACES, SAMPLE, HOT_GRAMS = 200_000, 32, 65_536
#: Symbols of the transform held at once; bytes of text hashed at once; places combined before the shuffle.
BLOCK, _SEGMENT, _COMBINED = 1 << 18, 1 << 19, 400_000
_PLACE = np.uint64((1 << 20) - 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: A span is a context's first string, the number of its strings less one, and where its gram begins; NO_GRAM if it was cut from one.
_START, _MORE, NO_GRAM = 1 << 16, 1 << 8, 255


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64."""

    def __init__(self, base: int, n: int):
        one = np.ones(1, np.uint64)
        self.up, self.down = (np.cumprod(np.concatenate([one, np.full(n, x, np.uint64)])) for x in (base, pow(base, -1, 2**64)))


def hash_keys() -> tuple[int, int]:
    """Bases of the two hashes of a run, drawn anew, so that nobody can make texts that agree in them; of the largest order modulo 2**64."""
    return tuple(secrets.randbits(61) << 3 | 5 for _ in range(2))


_POWERS: dict[tuple[int, int], _Powers] = {}


class SubstringHashes:
    """64-bit hashes of any substrings of a piece of text, from one running sum of its symbols times powers."""

    def __init__(self, data: np.ndarray, base: int):
        key = (base, max(_SEGMENT + 256, len(data)))
        if key not in _POWERS:
            if len(_POWERS) > 4:  # of earlier runs
                _POWERS.clear()
            _POWERS[key] = _Powers(*key)
        self.powers = _POWERS[key]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers.up[: len(data)])])

    def all(self, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[size:] - self.sums[:-size]) * self.powers.down[: len(self.sums) - size])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[stop] - self.sums[start]) * self.powers.down[start])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while n * 2 <= width:
        x, n = np.minimum(x[:-n], x[n:]), n * 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def _contexts(data: np.ndarray, edges: np.ndarray, hot: np.ndarray, length: int, gram: int, keys: tuple[int, int]) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, gram, digest, span) of the contexts of texts that lie end to end, cut at edges, a piece at a time."""
    for at in range(int(edges[0]), max(int(edges[-1]) - length + 1, int(edges[0])), _SEGMENT):
        piece = data[at : min(at + _SEGMENT + length - 1, int(edges[-1]))]
        hashes = SubstringHashes(piece, keys[0])
        h = hashes.all(gram)
        # The place breaks ties to the left. It fits, as a piece is shorter than the low bits' range.
        owner = _sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        crossing = np.zeros(len(owner) + 1, np.int32)
        inner = edges[(edges > at) & (edges < at + len(piece))] - at
        np.add.at(crossing, np.clip(inner - length + 1, 0, len(owner)), 1)
        np.add.at(crossing, np.clip(inner, 0, len(owner)), -1)
        inside = np.cumsum(crossing[:-1]) == 0
        turns = np.concatenate([[True], (owner[1:] != owner[:-1]) | ~inside[:-1]]), np.concatenate([(owner[1:] != owner[:-1]) | ~inside[1:], [True]])
        first, last = np.flatnonzero(inside & turns[0]), np.flatnonzero(inside & turns[1])
        if not len(first):
            continue
        place = (owner[first] & _PLACE).astype(np.int64)
        grams = h[place]
        digests = SubstringHashes(piece, keys[1])
        cut = np.isin(grams, hot) if len(hot) else np.zeros(len(grams), bool)
        begin, names, marks = first[~cut], grams[~cut], digests.of(first[~cut], last[~cut] + length)
        shape = (last - first)[~cut] * _MORE + (place - first)[~cut]
        if cut.any():
            counts = (last - first)[cut] + 1
            each = np.repeat(first[cut], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            begin, names = np.concatenate([begin, each]), np.concatenate([names, hashes.of(each, each + length)])
            marks, shape = np.concatenate([marks, digests.of(each, each + length)]), np.concatenate([shape, np.full(len(each), NO_GRAM)])
        doc = np.searchsorted(edges, begin + at, "right") - 1
        yield doc, names, marks, (begin + at - edges[doc]) * _START + shape


def places_of(batch: pa.RecordBatch, hot: np.ndarray, keys: tuple[int, int], length: int = LENGTH, gram: int = GRAM) -> Iterator[pa.RecordBatch]:
    """gram, digest, id, tie, span of the contexts in a batch of (id, tie, text).

    Of equal contexts of about _COMBINED, all but the first are known to be copies: their span is complemented
    and their gram replaced by a hash of their place, so that a frequent context is met once by each task.
    """
    text = batch.column(2)
    edges = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) or pa.types.is_binary(text.type) else np.int64)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    if not len(text) or edges[0] == edges[-1]:
        return
    data = np.frombuffer(text.buffers()[2], np.uint8)
    ids, ties = batch.column(0).to_pylist(), batch.column(1).to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, ties[i]))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum([k > 0 and (ids[i], ties[i]) != (ids[order[k - 1]], ties[order[k - 1]]) for k, i in enumerate(order)])

    def combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, grams, digests, spans = (np.concatenate(x) for x in zip(*parts, strict=True))
        with np.errstate(over="ignore"):
            code = grams * _MIX + digests
        order = np.lexsort((spans, rank[doc], code))
        order = order[np.concatenate([[True], (np.diff(rank[doc[order]]) != 0) | (np.diff(spans[order]) != 0)])]  # not the places of repeated rows
        doc, grams, digests, spans = (x[order] for x in (doc, grams, digests, spans))
        copy = np.concatenate([[False], (grams[1:] == grams[:-1]) & (digests[1:] == digests[:-1])])
        spread = _mixed(spans.view(np.uint64) * _MIX ^ doc.view(np.uint64))
        columns = [np.where(copy, spread, grams).view(np.int64), digests.view(np.int64), None, ties[doc], np.where(copy, ~spans, spans)]
        arrays = [batch.column(0).take(pa.array(doc)) if c is None else pa.array(c) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["gram", "digest", "id", "tie", "span"])

    held, n = [], 0
    for part in _contexts(data, edges, hot, length, gram, keys):
        held.append(part)
        n += len(part[0])
        if n > _COMBINED:
            yield combined(held)
            held, n = [], 0
    if held:
        yield combined(held)


def _without_twins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows without those of the same gram and place as the row before: repeated rows of one document."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if last is None else pa.concat_batches([last, batch])
        last = batch.slice(len(batch) - 1, 1)
        tie, span, gram = (rows.column(c).to_numpy() for c in ("tie", "span", "gram"))
        same = (tie[1:] == tie[:-1]) & (tie[1:] != 0) & (span[1:] == span[:-1]) & (gram[1:] == gram[:-1])  # the tie is 0 if no other row has the id
        if same.any():
            a, b = rows.column("id").slice(1), rows.column("id").slice(0, len(rows) - 1)
            equal = pc.if_else(pc.is_null(a), pc.is_null(b), pc.fill_null(pc.equal(a, b), False))
            keep = np.concatenate([[True], ~(same & equal.to_numpy(zero_copy_only=False))])[len(rows) - len(batch) :]
            batch = batch.filter(pa.array(keep))
        yield batch


def mark_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From places sorted by gram, digest and place: copies (first is false), and first contexts of grams with several.

    Holds the last gram and digest, and the only context of a gram until another one comes.
    """
    gram = digest = pending = None
    for batch in _without_twins(batches):
        g, d, spans = (batch.column(k).to_numpy() for k in (0, 1, 4))
        known = spans < 0
        parts = [_marked(batch.filter(pa.array(known)), False, complement=True)] if known.any() else []
        if known.any():
            batch = batch.filter(pa.array(~known))
            g, d = g[~known], d[~known]
        if len(g):
            opens = np.concatenate([[gram is None or g[0] != gram], g[1:] != g[:-1]])
            new = opens | np.concatenate([[digest is None or d[0] != digest], d[1:] != d[:-1]])
            firsts = np.flatnonzero(new)
            opening = opens[firsts]
            several = ~opening | np.concatenate([~opening[1:], [False]])[: len(firsts)]
            parts.append(_marked(batch.filter(pa.array(~new)), False))
            parts.append(_marked(batch.take(pa.array(firsts[several])), True))
            if len(firsts):
                if pending is not None and not opening[0]:
                    parts.append(_marked(pending, True))
                pending = batch.slice(int(firsts[-1]), 1) if opening[-1] else None
            gram, digest = g[-1], d[-1]
        for part in parts:
            if len(part):
                yield part


def _marked(rows: pa.RecordBatch, first: bool, complement: bool = False) -> pa.RecordBatch:
    spans = rows.column(4).to_numpy()
    return pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), rows.column(3), pa.array(~spans if complement else spans), pa.array(np.full(len(rows), first))], names=["gram", "id", "tie", "span", "first"])


class Transform:
    """The Burrows-Wheeler transform of a growing collection of suffixes, with the common prefix of each suffix and the
    one before it and a label, in sequential files that are read and written in blocks."""

    KINDS = (np.uint16, np.uint8, np.uint32)  # symbol, common prefix, label

    def __init__(self, folder: str, block: int):
        self.block, self.now, self.count = block, 0, 0
        self.files = [[Path(folder, f"{k}-{which}").open("w+b", buffering=0) for k in range(len(self.KINDS))] for which in (0, 1)]

    def __enter__(self) -> Transform:
        return self

    def __exit__(self, *_: object) -> None:
        for f in self.files[0] + self.files[1]:
            f.close()

    def blocks(self) -> Iterator[list[np.ndarray]]:
        """The columns of every block in order."""
        for f in self.files[self.now]:
            f.seek(0)
        for at in range(0, self.count, self.block):
            columns = [np.empty(min(self.block, self.count - at), kind) for kind in self.KINDS]
            for f, x in zip(self.files[self.now], columns, strict=True):
                left = memoryview(x).cast("B")
                while len(left):
                    left = left[f.readinto(left) :]
            yield columns

    def insert(self, places: np.ndarray, columns: list[np.ndarray], changed: np.ndarray, common: np.ndarray) -> None:
        """Insert rows at places (ascending, in the new order), and set the common prefixes at changed (new places)."""
        before = places - np.arange(len(places))  # old rows
        files = self.files[1 - self.now]
        for f in files:
            f.seek(0)
        end = a = 0
        for block in self.blocks() if self.count else [[np.empty(0, kind) for kind in self.KINDS]]:
            begin, end = end + a, end + len(block[0])
            b = int(np.searchsorted(before, end)) if end < self.count else len(before)
            at = places[a:b] - begin
            old = np.ones(len(block[0]) + b - a, bool)
            old[at] = False
            x, y = np.searchsorted(changed, (begin, begin + len(old)))
            for k, (kind, f) in enumerate(zip(self.KINDS, files, strict=True)):
                out = np.empty(len(old), kind)
                out[old] = block[k]
                out[at] = columns[k][a:b]
                if k == 1:
                    out[changed[x:y] - begin] = common[x:y]
                left = memoryview(out).cast("B")
                while len(left):
                    left = left[f.write(left) :]
            a = b
        self.now, self.count = 1 - self.now, self.count + len(places)


class _RangeMinima:
    """Minima of any runs of a block of common prefixes, from those of all runs of 1, 2, 4, ... of them."""

    def __init__(self, x: np.ndarray):
        levels, n = [x], 1
        while n * 2 <= len(x):
            levels.append(np.minimum(levels[-1][:-n], levels[-1][n:]))
            n *= 2
        self.least = levels[-1].min()
        self.flat = np.concatenate(levels)
        self.begin = np.concatenate([[0], np.cumsum([len(v) for v in levels])])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minima of x[start:stop], which isn't empty."""
        level = np.frexp((stop - start).astype(np.float32))[1] - 1
        begin = self.begin[level]
        return np.minimum(self.flat[begin + start], self.flat[begin + stop - (1 << level)])


def _label(text: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return (text.astype(np.uint32) << np.uint32(8)) | np.asarray(size, np.uint32)


def labels(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, size) of suffixes."""
    return (label >> np.uint32(8)).astype(np.int64), (label & np.uint32(255)).astype(np.int64)


def sort_suffixes(transform: Transform, texts: np.ndarray, lengths: np.ndarray) -> None:
    """Fill an empty transform: one text a row, its symbols at the left and over 0; equal suffixes come by row."""
    n, alphabet = len(texts), int(texts.max(initial=0)) + 1
    # Round 0: the empty suffixes in row order, each preceded by its text's last symbol.
    inserted = texts[np.arange(n), np.maximum(lengths - 1, 0)]
    transform.insert(np.arange(n), [inserted, np.zeros(n, np.uint8), _label(np.arange(n), 0)], np.empty(0, np.int64), np.empty(0, np.uint8))
    total = np.bincount(inserted, minlength=alphabet)
    total[0] = 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        smaller = n + np.cumsum(total) - total
        seen = np.zeros(alphabet, np.int64)
        since = np.full(alphabet, 255, np.uint8)  # of a symbol: the least common prefix after its last place
        was_new = np.zeros(alphabet, bool)
        found: list[tuple[np.ndarray, ...]] = []
        for symbol, common, label in transform.blocks():
            order = np.argsort(symbol, kind="stable")
            ordered = symbol[order]
            starts = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            at = np.flatnonzero(starts)
            ends = np.append(at[1:], len(order)) - 1
            present = ordered[at]
            new = ((label & np.uint32(255)) == size - 1)[order]
            # The rows inserted last, and those that follow them among the rows of their symbol, but for whole texts.
            wanted = new.copy()
            wanted[1:] |= new[:-1] & ~starts[1:]
            wanted[at] |= was_new[present]
            if present[0] == 0:
                wanted[: ends[0] + 1] = False
            k = np.flatnonzero(wanted)
            c, place, opens = ordered[k], order[k], starts[k]
            minima = _RangeMinima(common)
            least = minima.of(np.where(opens, 0, order[k - 1] + 1), place + 1)
            least = np.where(opens, np.minimum(least, since[c]), least)
            first_ever = opens & (seen[c] == 0)
            rank = k - at[np.searchsorted(at, k, "right") - 1]
            found.append((smaller[c] + seen[c] + rank, np.where(first_ever, 0, least + 1).astype(np.uint8), new[k], label[place] >> np.uint32(8)))
            since = np.minimum(since, minima.least)
            lasts = order[ends] + 1
            since[present] = 255
            inner = lasts < len(common)
            since[present[inner]] = minima.of(lasts[inner], np.full(inner.sum(), len(common)))
            seen[present] += ends - at + 1
            was_new[present] = new[ends]
        places, least, new, rows = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(places)
        places, least, new, rows = (x[order] for x in (places, least, new, rows))
        rows = rows[new].astype(np.int64)
        left = lengths[rows] - size
        inserted = np.where(left > 0, texts[rows, np.maximum(left - 1, 0)], 0).astype(np.uint16)
        transform.insert(places[new], [inserted, least[new], _label(rows, size)], places[~new], least[~new])
        total += np.bincount(inserted, minlength=alphabet)
        total[0] = 0


def repeated_spans(contexts: list[bytes], more: np.ndarray, gram_at: np.ndarray, length: int, gram: int, folder: str, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, from, to) of the bytes in a string that an earlier context of this collection has too.

    Equal strings have equal grams at one place, so a gram is one symbol here: a number for its bytes.
    """
    raw = np.zeros((len(contexts), 2 * length - gram), np.uint8)
    sizes = more + length
    raw[np.arange(raw.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(contexts), np.uint8)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, gram, axis=1)[np.arange(len(raw)), gram_at])
    number = np.unique(grams.view(f"V{gram}").ravel(), return_inverse=True)[1].ravel()
    string, lengths = length - gram + 1, sizes - gram + 1
    column = np.arange(int(lengths.max()))
    source = np.minimum(column + np.where(column > gram_at[:, None], gram - 1, 0), raw.shape[1] - 1)
    texts = np.take_along_axis(raw, source, axis=1).astype(np.uint16) + 1
    texts[np.arange(len(raw)), gram_at] = 257 + number
    texts[column >= lengths[:, None]] = 0
    edge = np.zeros((len(contexts), raw.shape[1] + 1), np.int32)
    row, at = np.empty((2, 0), np.int64)

    def judge(row: np.ndarray, at: np.ndarray, group: np.ndarray) -> None:
        order = np.lexsort((row, group))
        later = np.concatenate([[False], group[order][1:] == group[order][:-1]])
        np.add.at(edge, (row[order][later], at[order][later]), 1)
        np.add.at(edge, (row[order][later], at[order][later] + length), -1)

    with Transform(folder, block) as transform:
        sort_suffixes(transform, texts, lengths)
        for _, common, label in transform.blocks():
            text, size = labels(label)
            long = size >= string  # what follows a suffix with as many symbols in common is as long
            new = np.concatenate([np.zeros(len(row), bool), (common < string)[long]])
            row, at = np.concatenate([row, text[long]]), np.concatenate([at, (lengths[text] - size)[long]])
            if len(row):
                group = np.cumsum(new)
                whole = group < group[-1]  # the last group can go on in the next block
                judge(row[whole], at[whole], group[whole])
                row, at = row[~whole], at[~whole]
    judge(row, at, np.zeros(len(row), np.int64))
    covered = np.zeros((len(contexts), raw.shape[1] + 2), np.int8)
    covered[:, 1:] = np.cumsum(edge, axis=1) > 0
    step = np.diff(covered, axis=1)
    where, begin = np.nonzero(step == 1)
    return where, begin, np.nonzero(step == -1)[1]


def _collections(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows sorted by gram, in tables of over ``most`` rows that end where a gram does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) > most:
            rows = pa.Table.from_batches(held)
            grams = rows["gram"].to_numpy()
            ends = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            if len(ends):
                yield rows.slice(0, int(ends[-1]))
                rows = rows.slice(int(ends[-1])).combine_chunks()
            held = rows.to_batches()
    if held and sum(len(b) for b in held):
        yield pa.Table.from_batches(held)


def _sort_contexts(length: int, gram: int, collection: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            for rows in _collections(_without_twins(batches), collection):
                spans = rows["span"].to_numpy()
                row, begin, end = repeated_spans(rows["bytes"].to_pylist(), spans // _MORE % _MORE, spans % _MORE, length, gram, folder)
                start = spans[row] // _START
                taken = rows.select(["id", "tie"]).take(pa.array(row)).combine_chunks()
                for part in pa.table([*taken.columns, pa.array(start + begin), pa.array(start + end)], names=["id", "tie", "start", "stop"]).to_batches():
                    yield part

    return run


def _bytes_of(length: int):
    """gram, id, tie, span, bytes of contexts, from (id, tie, text, at: gram and span of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text = batch.column(2)[i].as_py().encode()
                at = batch.column(3).slice(i, 1).flatten()
                spans = at.field(1).to_numpy()
                begin = spans // _START
                parts = [text[a:b] for a, b in zip(begin.tolist(), (begin + spans // _MORE % _MORE + length).tolist(), strict=True)]
                own = pa.array(np.full(len(parts), i))
                yield pa.RecordBatch.from_arrays([at.field(0), batch.column(0).take(own), batch.column(1).take(own), at.field(1), pa.array(parts, pa.binary())], names=["gram", "id", "tie", "span", "bytes"])

    return run


def repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
    collection: int = COLLECTION, crowded: int = CROWDED, hot_places: int = HOT_PLACES, sample: int = SAMPLE,
) -> DataFrame:
    """(id, tie, text, spans): per row of docs its text and the runs of bytes, as (start, stop), that repeats cover."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    if not 0 < gram < length or 2 * length - gram >= NO_GRAM:
        raise ValueError(f"gram must be shorter than length, and contexts shorter than {NO_GRAM} bytes")
    keys = hash_keys()
    named = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = named.schema["id"].dataType.simpleString()
    # Rows that share an id are told apart by their text; the tie is 0 for all others.
    shared = checkpointed(named.groupBy("id").count().filter("count > 1").select(F.col("id").alias("shared_id"), F.lit(True).alias("shared")))
    tie = F.when(F.col("shared"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    keyed = named.join(broadcast_if_small(shared), F.col("id").eqNullSafe(F.col("shared_id")), "left").select("id", tie.alias("tie"), "text")

    def find(hot):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from places_of(batch, hot.value, keys, length, gram)

        return run

    places_schema = f"gram long, digest long, id {id_type}, tie long, span long"
    picked = keyed.filter(F.pmod(F.xxhash64("id", "tie"), F.lit(sample)) == 0)
    none = spark.sparkContext.broadcast(np.empty(0, np.uint64))
    # Copies that a task combines have no gram any more, so a gram is counted once a task and digest, as it is shuffled.
    counted = picked.mapInArrow(find(none), places_schema).filter("span >= 0").groupBy("gram").count()
    frequent = counted.filter(F.col("count") * sample > hot_places).orderBy(F.desc("count"), "gram").limit(HOT_GRAMS).collect()
    hot = spark.sparkContext.broadcast(np.array(sorted(r["gram"] for r in frequent), np.int64).view(np.uint64))

    def marked(places: DataFrame) -> DataFrame:
        dealt = places.repartition("gram").sortWithinPartitions("gram", "digest", "id", "tie", "span")
        return dealt.mapInArrow(mark_copies, f"gram long, id {id_type}, tie long, span long, first boolean")

    marks = checkpointed(marked(keyed.mapInArrow(find(hot), places_schema)))
    start, more = F.expr(f"span DIV {_START}"), F.expr(f"span DIV {_MORE} % {_MORE}")
    covered = lambda rows: rows.filter("NOT first").select("id", "tie", start.alias("start"), (start + more + length).alias("stop"))
    spans = covered(marks)

    # Strings cut from a gram are equal only if their digests are; the others' contexts are compared.
    firsts = marks.filter(F.col("first") & (F.col("span") % _MORE != NO_GRAM)).select("gram", "id", "tie", "span")
    many = checkpointed(firsts.groupBy("gram").count().filter(F.col("count") > crowded).select("gram"))

    def with_bytes(wanted: DataFrame) -> DataFrame:
        listed = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("gram", "span")).alias("at"))  # no more than the document has
        own = [F.col(f"t.{c}") for c in ("id", "tie", "text")]
        met = keyed.alias("t").join(listed.alias("l"), F.col("t.id").eqNullSafe(F.col("l.id")) & (F.col("t.tie") == F.col("l.tie"))).select(*own, "at")
        return met.mapInArrow(_bytes_of(length), f"gram long, id {id_type}, tie long, span long, bytes binary")

    some = not many.isEmpty()
    few = firsts.join(broadcast_if_small(many), "gram", "left_anti") if some else firsts
    dealt = with_bytes(few).repartition("gram").sortWithinPartitions("gram", "id", "tie", "span")
    spans = spans.unionByName(dealt.mapInArrow(_sort_contexts(length, gram, collection), f"id {id_type}, tie long, start long, stop long"))
    if some:
        cut = with_bytes(firsts.join(broadcast_if_small(many), "gram", "left_semi")).select("id", "tie", start.alias("start"), "bytes", F.explode(F.sequence(F.lit(0).cast("long"), more)).alias("k"))
        string = F.expr(f"substring(bytes, CAST(k AS INT) + 1, {length})")
        strings = cut.select(F.xxhash64(string).alias("gram"), F.xxhash64(F.lit(1), string).alias("digest"), "id", "tie", ((F.col("start") + F.col("k")) * _START + NO_GRAM).alias("span"))
        spans = spans.unionByName(covered(marked(strings)))
    by_doc = spans.groupBy("id", "tie").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    same = F.col("t.id").eqNullSafe(F.col("s.id")) & (F.col("t.tie") == F.col("s.tie"))
    return keyed.alias("t").join(by_doc.alias("s"), same, "left").select("t.id", "t.tie", "t.text", "s.spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans, kept.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller
    id, or earlier in its own. spans are the maximal runs that go, kept is what stays (bytes, as a run can
    end inside a character). Ids are of any type with an order. Null texts count as empty, texts shorter than
    ``length`` stay whole. Null ids sort first; rows that share an id are ordered by a hash of their text, and
    repeated rows (same id, same text) are one document and get one result. Other columns are not read.
    """
    found = repeated_bytes(docs, id_col, text_col, **options)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data, merged = text.as_py().encode(), []
                if spans.is_valid:
                    begin, end = (spans.values.field(k).to_numpy() for k in (0, 1))
                    reach = np.maximum.accumulate(end)
                    new = np.concatenate([[True], begin[1:] > reach[:-1]])
                    merged = list(zip(begin[new].tolist(), reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])].tolist(), strict=True))
                sizes.append(len(data))
                runs.append([{"start": a, "stop": b} for a, b in merged])
                edges = [0, *(x for ab in merged for x in ab), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    id_type = found.schema["id"].dataType.simpleString()
    return found.select(F.col("id").alias("doc_id"), "text", "spans").mapInArrow(cut, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def repeats_digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of remove_repeats; a row without spans removes nothing."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
