"""SimHash near-dedup by anchor-point covering.

Two fingerprints at distance 4 or less differ in at most 2 bits of one of their 32-bit halves. In each
half, the anchors are the words of a covering code: the Hamming code of length 31 (covering radius 1)
with a free bit, 2**27 anchors. Two halves at distance 2 have a point between them at distance 1 from
both, and the anchor that covers it is within radius + 1 of both: so each fingerprint is replicated to
every anchor within the covering radius plus the threshold's share of its side, and pairs meet at an
anchor. Fingerprints are compared there by all 64 bits, and linked ones are joined to components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import broadcast_if_small, checkpointed, join_counted, ship, text_or_empty
from quillstone.llm.components import connected_components

BITS, HALF, THRESHOLD = 64, 32, 4
#: Fingerprints compared with each other in one piece; an anchor with more is dealt out in cells of two such pieces.
CELL = 4096
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles_of(text: str, size: int) -> list[bytes]:
    """Word shingles, repeats included; the whole sequence if there are fewer words, nothing if there are none."""
    words = _WORDS.findall(text.encode().translate(_LOWER))
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]])
    return [joined[a:b] for a, b in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """doc_id, fp (long) of every row; null and blank texts have fingerprint zero."""
    ship(docs.sparkSession)
    digest = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(np.fromiter((digest(s, 42) for s in shingles_of(t.as_py(), shingle_words)), np.uint64)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col)).mapInArrow(run, f"doc_id {id_type}, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Syndrome of the low 31 bits under the Hamming code: the exclusive or of the positions (from 1) of set bits."""
    out = np.zeros(len(words), np.int64)
    for k in range(31):
        out ^= np.where((words >> np.uint64(k)) & np.uint64(1), k + 1, 0)
    return out


def _nearest(words: np.ndarray) -> np.ndarray:
    """The anchor that covers each 32-bit word: its code word, at distance 1 or 0, and the free bit."""
    s = _syndromes(words)
    return np.where(s > 0, words ^ (np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64)), words)


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into fps, anchor) of every replica. An anchor is the half (bit 32) and its code word."""
    index, keys = [], []
    own = np.arange(len(fps))
    for half in (0, 1):
        words = (fps >> np.uint64(HALF * half)) & np.uint64(0xFFFFFFFF)
        # Anchors that cover a word at distance 0 or 1; several such words can share one.
        near = np.stack([_nearest(words), *(_nearest(words ^ np.uint64(1 << k)) for k in range(HALF))])
        near.sort(axis=0)
        first = np.vstack([np.ones((1, len(fps)), bool), near[1:] != near[:-1]])
        index.append(np.broadcast_to(own, near.shape)[first])
        keys.append(near[first] | np.uint64(half << HALF))
    return np.concatenate(index), np.concatenate(keys)


def _bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _stars(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what distance connects in one piece: of each component, its spanning links."""
    left, out = fps, []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            p, front = front[0], front[1:]
            hit = _bit_count(left ^ p) <= THRESHOLD
            if hit.any():
                out += [(int(p), int(q)) for q in left[hit]]
                front, left = np.concatenate([front, left[hit]]), left[~hit]
    return out


def compare_per_anchor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) between fingerprints of one key; rows come sorted by (key, fp), a key may span batches."""
    held_key, held_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, sizes = np.concatenate([[0], edges]), np.diff(np.concatenate([[0], edges, [len(keys)]]))
        found: list[np.ndarray] = []
        small = np.repeat(sizes, sizes) <= 16
        k, f = keys[small], fps[small]
        for step in range(1, 16):
            near = np.flatnonzero((k[step:] == k[:-step]) & (_bit_count(f[step:] ^ f[:-step]) <= THRESHOLD)) if len(k) > step else np.empty(0, int)
            found.append(np.stack([f[near], f[near + step]]))
        for i in np.flatnonzero(sizes > 16):
            own = _stars(np.unique(fps[starts[i] : starts[i] + sizes[i]]))
            if own:
                found.append(np.array(own, np.uint64).T)
        both = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.uint64)
        both = np.unique(both, axis=1) if both.size else both
        return pd.DataFrame({"a": both[0].view(np.int64) if both.size else both[0].astype(np.int64), "b": both[1].view(np.int64) if both.size else both[1].astype(np.int64)})

    for batch in batches:
        keys = np.concatenate([held_key, batch["key"].to_numpy(np.int64)])
        fps = np.concatenate([held_fp, batch["fp"].to_numpy(np.int64).view(np.uint64)])
        if not len(keys):
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield links(keys[:cut], fps[:cut])
        held_key, held_fp = keys[cut:], fps[cut:]
    if len(held_key):
        yield links(held_key, held_fp)


def fingerprint_links(distinct: DataFrame, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all of distinct(fp) that chains of distances of 4 or less connect."""

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = b["fp"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(fps), 20_000):
                some = fps[at : at + 20_000]
                index, keys = anchors_of(some)
                yield pd.DataFrame({"anchor": keys.view(np.int64), "fp": some[index].view(np.int64)})

    replicas = distinct.mapInPandas(replicate, "anchor long, fp long")
    # An anchor with over cell fingerprints is a triangle of cells: each row goes to the cells of its piece with every piece.
    crowded = replicas.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell).select("anchor", F.ceil(F.col("n") / cell * 2).cast("int").alias("pieces"))
    dealt = replicas.join(broadcast_if_small(checkpointed(crowded)), "anchor", "left")
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    cells = F.when(F.col("pieces").isNull(), F.array(F.col("anchor"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: F.xxhash64("anchor", F.least(j, piece), F.greatest(j, piece)))
    )
    keyed = dealt.select(F.explode(cells).alias("key"), "fp")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(compare_per_anchor, "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """One row per input row: doc_id, fp, fingerprint (hex), component_id.

    component_id is the smallest id that links reach, itself included; links join fingerprints of 4
    or fewer differing bits. Blank and null texts have fingerprint zero and link like any other. Null
    ids are never the smallest unless a component has no other. Repeated rows give repeated rows.
    """
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle_words))
    # Equal fingerprints are one node from here on, so a hot text costs no more than a rare one.
    nodes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")))
    roots = checkpointed(connected_components(fingerprint_links(nodes.select("fp"))))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "root", "least_id")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = rooted.join(least, "root").select("fp", "component_id")
    by_fp = checkpointed(nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("component_id", "least_id").alias("component_id")))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    return join_counted(rows, by_fp, "fp", total).select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
