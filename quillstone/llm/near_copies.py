"""SimHash near-dedup up to a given similarity of word shingles: the form for pipelines.

Two texts are linked if the Jaccard similarity of their sets of word shingles reaches a threshold; every link
is verified on the whole sets. Pairs to compare come from the anchors of the SimHash fingerprints and, as
texts at 0.8 differ in 10 of 64 bits where anchors reach 4, from bands of minimal hashes too. A band's bucket
is first compared with the member that meets most others; after that only members that the links so far leave in different
components are compared, inside tasks that hand out links alone, so a large group of near copies makes no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import broadcast_if_small, checkpointed, join_counted, ship, text_or_empty
from quillstone.llm.components import connected_components
from quillstone.llm.simhash import fingerprint, fingerprint_links, shingles_of

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity s shares no band with a chance of (1 - s ** BAND_ROWS) ** BANDS: 1 in 20,000 at 0.8.
BANDS, BAND_ROWS = 25, 5
#: Members of a bucket, and hashes in their sets, that one task compares; a larger set is a piece of its own.
CELL, CELL_HASHES = 4096, 1 << 20
_FACTORS = np.random.default_rng(5).integers(0, 2**31, BANDS * BAND_ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = np.random.default_rng(6).integers(0, 2**32, BANDS * BAND_ROWS, np.uint32)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """64-bit hashes of the word shingles, repeats included."""
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles_of(text, size)), np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit key a band; none of an empty set."""
    if not len(hashes):
        return []
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTORS), 2**32 - 1, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, (short[None, at : at + 1024] * _FACTORS[:, None] + _ADDENDS[:, None]).min(axis=1), out=least)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _node(hashes: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes())], np.uint64).view(np.int64)[0])


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, th, fp, node (hash of the shingle set), n (its size), bands of every row of texts(doc_id, th, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [shingle_hashes(t.as_py(), size) for t in batch.column(2)]
            sets = [np.unique(h) for h in hashes]
            found = [pa.array([fingerprint(h) for h in hashes], pa.int64()), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=["doc_id", "th", "fp", "node", "n", "bands"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {id_type}, th long, fp long, node long, n int, bands array<long>")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """node, shingles (array of longs) of every row of texts(text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), size)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs(a, b) whose sets are similar."""
    one, other = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s_{c}")) for c in "ab")
    both = pairs.join(other, "b").join(one, "a")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(common / (F.size("s_a") + F.size("s_b") - common) >= similarity).select("a", "b")


def _links_within(root: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between the components (root) of one bucket that similar sets connect; shingles holds the sets end to end."""
    if (root == root[0]).all():
        return []
    number, given, root, out = np.unique(shingles, return_inverse=True)[1].ravel(), root, root.copy(), []
    begin = np.cumsum(sizes) - sizes
    mine = np.zeros(int(number.max()) + 1, np.int32)
    for i in range(len(root) - 1):
        own = number[begin[i] : begin[i] + sizes[i]]
        mine[own] = 1
        common = np.add.reduceat(mine[number[begin[i + 1] :]], begin[i + 1 :] - begin[i + 1])
        mine[own] = 0
        near = i + 1 + np.flatnonzero(common >= similarity * (sizes[i] + sizes[i + 1 :] - common) - 1e-9)
        for j in near[root[near] != root[i]]:
            if root[j] != root[i]:
                out.append((int(given[i]), int(given[j])))
                root[root == root[j]] = root[i]
        if (root == root[0]).all():
            break
    return out


def _compared(members: DataFrame, similarity: float, cell: int) -> DataFrame:
    """Links (a, b) between roots within the buckets of members(key, node, root, shingles); a bucket of over cell members, or CELL_HASHES hashes, is a
    triangle of cells: each member goes to the cells of its piece with every piece."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = rows["cell"].to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if last:
                yield links(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None and len(held):
            yield links(held)

    def links(rows: pa.Table) -> pa.RecordBatch:
        key, root = (rows[c].to_numpy() for c in ("cell", "root"))
        sets = rows["shingles"].combine_chunks()
        sets = sets if isinstance(sets, pa.ListArray) else pa.concat_arrays(sets.chunks)
        shingles, sizes = sets.flatten().to_numpy(), np.diff(sets.offsets.to_numpy())
        ends, starts, out = np.cumsum(sizes), np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]), []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            out += _links_within(root[a:b], sizes[a:b], shingles[ends[a] - sizes[a] : ends[b - 1]], similarity)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    load = F.greatest(F.count(F.lit(1)) / cell, F.sum(F.size("shingles")) / CELL_HASHES)
    crowded = members.groupBy("key").agg(load.alias("load")).filter("load > 1").select("key", F.ceil(F.col("load") * 2).cast("int").alias("pieces"))
    dealt = members.join(broadcast_if_small(checkpointed(crowded)), "key", "left")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    cells = F.when(F.col("pieces").isNull(), F.array(F.col("key"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: F.xxhash64("key", F.least(j, piece), F.greatest(j, piece)))
    )
    keyed = dealt.select(F.explode(cells).alias("cell"), "node", "root", "shingles")
    return keyed.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(compare, "a long, b long")


def _components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, cell: int = CELL) -> DataFrame:
    """One row per input row: doc_id, th (hash of the text), first (doc_id and th of the component's first row)."""
    ship(docs.sparkSession)
    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = checkpointed(_sketched(texts, shingle))
    # Equal sets are one node from here on, so a hot text costs no more than a rare one.
    nodes = checkpointed(rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("least_id"), F.min("th").alias("th"), F.min("fp").alias("fp"), F.count(F.lit(1)).alias("copies")))
    keyed = rows.select("node", "n", F.explode("bands").alias("key")).distinct()
    crowd = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    crowded = checkpointed(keyed.join(crowd, "key"))
    # A bucket is compared with the member that meets most texts in all its buckets: of edited copies, the original.
    weights = crowded.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = checkpointed(crowded.join(weights, "node"))
    shared = weighed.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("first"))
    met = checkpointed(weighed.select("key", "node", "n").join(shared, "key"))

    # Fingerprints within reach of an anchor: their first nodes are compared, and the nodes of one fingerprint with its first.
    by_fp = checkpointed(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")))
    ends = [by_fp.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab"]
    linked_fps = fingerprint_links(by_fp.select("fp")).join(ends[0], "a").join(ends[1], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    one_fp = join_counted(nodes.select("fp", "node"), by_fp, "fp", nodes.count()).filter(F.col("first") != F.col("node")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    anchored = checkpointed(linked_fps.unionByName(one_fp))

    wanted = met.select("node").unionByName(anchored.select(F.explode(F.array("a", "b")).alias("node"))).distinct().join(nodes, "node").select("th")
    # One row of each text is read: that of its smallest id, so copies of a text aren't brought together.
    first = wanted.join(rows.groupBy("th").agg(F.min("doc_id").alias("__id")), "th").withColumnRenamed("th", "__th")
    sets = checkpointed(_sets(texts.join(first, (F.col("th") == F.col("__th")) & texts["doc_id"].eqNullSafe(F.col("__id")), "left_semi").dropDuplicates(["th"]).select("text"), shingle))

    def alike(n: str, m: str):
        return F.least(n, m) >= similarity * F.greatest(n, m) - 1e-9  # else the sizes alone rule it out

    stars = met.filter((F.col("node") != F.col("first.node")) & alike("n", "first.n")).select(F.col("first.node").alias("a"), F.col("node").alias("b")).unionByName(anchored).distinct()
    links = checkpointed(_verified(stars, sets, similarity))
    roots = connected_components(links).select("node", "root")

    # Pairs of different components are all that is left; tasks compare them bucket by bucket.
    placed = checkpointed(met.select("key", "node", "n").join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root")))
    split = checkpointed(placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high"))
    mixed = placed.join(split.select("key"), "key").select("key", "node", "root")
    more = checkpointed(_compared(mixed.join(sets, "node"), similarity, cell).distinct())

    # Components are joined by their roots, of which there are fewer than nodes; a large component's root is a frequent key.
    tops = connected_components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    rooted = checkpointed(nodes.join(roots, "node", "left").select("node", "least_id", "copies", F.coalesce("root", "node").alias("root")))
    by_root = checkpointed(rooted.groupBy("root").agg(F.min("least_id").alias("least_id"), F.count(F.lit(1)).alias("n")).join(tops, "root", "left").withColumn("top", F.coalesce("top", "root")))
    least = by_root.groupBy("top").agg(F.min("least_id").alias("component_id"))
    found = checkpointed(by_root.join(least, "top").select("root", "n", "component_id"))
    by_node = checkpointed(join_counted(rooted, found, "root", rooted.count()).select("node", F.col("copies").alias("n"), "component_id"))
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    return join_counted(rows.select("doc_id", "th", "node"), by_node, "node", total).select("doc_id", "th", F.col("component_id").alias("first"))


def near_copy_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, cell: int = CELL) -> DataFrame:
    """One row per input row: doc_id, component_id.

    component_id is the smallest id that links reach, itself included; links join texts whose sets of
    ``shingle``-word shingles have a Jaccard similarity of ``similarity`` or more. A text of fewer words
    is one shingle; texts without words are copies of each other. Null ids are never the smallest
    unless a component has no other. Repeated rows give repeated rows.
    """
    return _components(docs, id_col, text_col, shingle, similarity, cell).select("doc_id", F.col("first.doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """docs with one row of each component: that of the smallest id, then of the smallest text hash.

    A row without an id stays only if its component has no other; of repeated rows (same id, same text) one stays, whichever. An id
    that several unlike texts share is judged text by text.
    """
    found = checkpointed(_components(docs, id_col, text_col, **options))
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    stays = checkpointed(first.groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(F.count(F.lit(1)).alias("__rows")))
    hashed = docs.withColumn("__hash", F.xxhash64(text_or_empty(text_col)))
    here = docs[id_col].eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th"))
    once = hashed.join(stays.filter("__rows = 1"), here, "left_semi")
    # Only texts of repeated rows are shuffled to be told apart.
    again = hashed.join(broadcast_if_small(stays.filter("__rows > 1")), here, "left_semi").dropDuplicates([id_col, "__hash"])
    return once.unionByName(again).select(*docs.columns)
