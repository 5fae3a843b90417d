"""Benchmark decontamination with DataFrame functions only.

Item-sized windows of documents get SimHash fingerprints, which are cut into blocks; the blocks of the
items of that size are looked up with all values near them, so a window meets every item within ``radius``
bits in some block. What meets is verified by the exact similarity of the shingle multisets.

Only windows that could match some item are fingerprinted. A window that is similar enough to an item
holds a known number of its shingles, so the others can't match. This says where to look; which item a
window matches is found by the blocks alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import broadcast_if_small, checkpointed, text_or_empty

SHINGLE, SIMILARITY = 5, 0.8
#: At a similarity of 0.8, 64 fingerprint bits differ in 10 on average, with a deviation of 3.
RADIUS, BLOCK_BITS = 23, 8


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_strings(words: Column, size: Column) -> Column:
    n = F.size(words) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(words, i + 1, size), " "))).otherwise(F.array().cast("array<string>"))


def shingle_hashes(words: Column, size: int) -> Column:
    """64-bit hashes of the same shingles, in order, from those of their words."""
    own = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size(words) - size
    of = lambda w: F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    # The word hashes are the one element of an outer array, so that they are computed once.
    return F.when(n >= 0, F.flatten(F.transform(F.array(own), of))).otherwise(F.array().cast("array<bigint>"))


def sized_hashes(words: Column, k: Column, sizes: list[int]) -> Column:
    """shingle_hashes of a size that is one of few."""
    out = F.array().cast("array<bigint>")
    for size in sizes:
        out = F.when(k == size, shingle_hashes(words, size)).otherwise(out)
    return out


def simhash(hashes: Column) -> Column:
    """Bits set in over half of the hashes; a repeated shingle weighs as often as it occurs."""
    n = F.size(hashes)
    bit = lambda b: F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.shiftright(h, b).bitwiseAND(F.lit(1)).cast("int"))
    bits = [F.when(bit(b) * 2 > n, F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(64)]
    out = bits[0]
    for x in bits[1:]:
        out = out.bitwiseOR(x)
    return out


def _blocks(fp: Column) -> Column:
    """(block number, its bits) of a fingerprint."""
    n = 64 // BLOCK_BITS
    return F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1).cast("long")).cast("int").alias("bits")) for b in range(n)])


def _masks(radius: int) -> list[int]:
    """Differences that one of the blocks must show if fingerprints differ in radius bits at most."""
    most = radius // (64 // BLOCK_BITS)
    return [m for m in range(2**BLOCK_BITS) if m.bit_count() <= most]


def _common(a: Column, b: Column) -> Column:
    """Size of the intersection of two multisets of strings."""
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, s: acc + F.least(F.size(F.filter(a, lambda x: x == s)), F.size(F.filter(b, lambda x: x == s))))


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """As benchmark_matches, with th, the hash of the document's text."""
    every = (
        benchmark.select(F.col(item_col).alias("item_id"), words_of(text_or_empty(item_text_col)).alias("words")).filter(F.size("words") > 0)
        .dropDuplicates(["item_id", "words"])
        .withColumns({"length": F.size("words"), "k": F.least(F.lit(shingle), F.size("words"))})
    )
    sizes = sorted(r["k"] for r in every.select("k").distinct().collect())  # at most `shingle` values
    hashed_items = every.withColumns({"item_shingles": shingle_strings(F.col("words"), F.col("k")), "item_hashes": sized_hashes(F.col("words"), F.col("k"), sizes)})
    items = checkpointed(hashed_items.select(
        F.xxhash64(F.col("item_id"), F.lit(1), "words").alias("item"), "item_id", "length", "k", "item_shingles", "item_hashes", simhash(F.col("item_hashes")).alias("item_fp"), F.size("item_shingles").alias("n_item")
    ))
    postings = items.select("item", "length", "k", "n_item", F.explode(F.array_distinct("item_hashes")).alias("h"))

    raw = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("th"), text_or_empty(text_col).alias("text"))
    words = words_of(F.col("text"))
    of_size = lambda k: F.transform(shingle_hashes(F.col("words"), k), lambda h, pos: F.struct(F.lit(k).alias("k"), pos.alias("pos"), h.alias("h")))
    none = F.array().cast("array<struct<k:int,pos:int,h:bigint>>")
    hashed = raw.select("doc_id", "th", words.alias("words")).select("doc_id", "th", F.size("words").alias("n_words"), F.explode(F.concat(none, *[of_size(k) for k in sizes])).alias("s")).select("doc_id", "th", "n_words", "s.*")

    places = (
        hashed.join(broadcast_if_small(postings), ["k", "h"])
        .groupBy("doc_id", "th", "item", "length", "k", "n_item", "n_words").agg(F.array_sort(F.collect_set("pos")).alias("at"))
        .withColumn("n_window", F.least("n_item", F.col("n_words") - F.col("k") + 1))
        # A similarity s needs s / (1 + s) of both sizes in common, and so that many places in the window.
        .withColumn("need", F.greatest(F.lit(1), F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n_item") + F.col("n_window")) - F.lit(1e-9)).cast("int")))
        .filter(F.size("at") >= F.col("need"))
    )
    # From each place, the windows that begin at or before it and reach the place that is need - 1 later.
    far = lambda i: F.get("at", i + F.col("need") - 1)
    spans = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("at") - F.col("need")), lambda i: far(i) - F.get("at", i) < F.col("n_window")),
        lambda i: F.sequence(F.greatest(F.lit(0), far(i) - F.col("n_window") + 1), F.least(F.get("at", i), F.col("n_words") - F.col("k") + 1 - F.col("n_window"))),
    )
    starts = places.select("doc_id", "th", "length", F.explode(F.array_distinct(F.flatten(spans))).alias("start"))
    by_doc = checkpointed(starts.groupBy("doc_id", "th").agg(F.collect_set(F.struct("length", "start")).alias("starts")))  # of one document
    hit = by_doc.select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), "starts")
    found = raw.join(broadcast_if_small(hit), raw["doc_id"].eqNullSafe(F.col("hit_id")) & (raw["th"] == F.col("hit_th"))).select("doc_id", "th", "starts", words_of(F.col("text")).alias("words"))
    cut = F.transform("starts", lambda s: F.struct(s["length"].alias("length"), s["start"].alias("start"), F.slice("words", s["start"] + 1, s["length"]).alias("window")))
    windows = checkpointed(found.select("doc_id", "th", F.inline(cut)))
    # Equal windows are judged once, however many documents hold them.
    k = F.least(F.lit(shingle), F.col("length"))
    hashed_windows = windows.select("length", "window").distinct().withColumn("hashes", sized_hashes(F.col("window"), k, sizes))
    prints = checkpointed(hashed_windows.select("length", "window", simhash(F.col("hashes")).alias("fp")))

    near = items.select("item", "length", "item_fp", F.explode(_blocks(F.col("item_fp"))).alias("b")).select(
        "item", "length", "item_fp", F.col("b.block").alias("block"), F.explode(F.transform(F.array(*[F.lit(m) for m in _masks(radius)]), lambda m: F.col("b.bits").bitwiseXOR(m))).alias("bits")
    )
    met = (
        prints.select("length", "window", "fp", F.explode(_blocks(F.col("fp"))).alias("b")).select("length", "window", "fp", F.col("b.block").alias("block"), F.col("b.bits").alias("bits"))
        .join(broadcast_if_small(near), ["length", "block", "bits"])
        .withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).filter(F.col("hamming") <= radius)
        .select("item", "window", "hamming").distinct()  # a window can meet an item in several blocks
    )
    similar = (
        met.join(broadcast_if_small(items.select("item", "item_id", "k", "item_shingles", "n_item", "length")), "item").withColumn("shingles", shingle_strings(F.col("window"), F.col("k")))
        .withColumn("common", _common(F.col("item_shingles"), F.col("shingles")))
        .select("length", "item_id", "window", "hamming", F.size("window").alias("n_words"), (F.col("common") / (F.col("n_item") + F.size("shingles") - F.col("common"))).alias("similarity"))
    )
    verified = windows.join(checkpointed(similar.filter(F.col("similarity") >= similarity)), ["length", "window"])
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words", "hamming"))
    return verified.groupBy("doc_id", "th", "item_id").agg(best.alias("best")).select(
        "doc_id", "th", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).cast("long").alias("start_word"), F.col("best.n_words").cast("long").alias("n_words"), F.col("best.hamming").cast("long").alias("hamming"),
    )


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per document and item that match: doc_id, item_id, similarity, start_word, n_words, hamming.

    A document matches an item if some window of as many words as the item (the whole document, if that is
    shorter) has a weighted Jaccard similarity of its shingle multiset of ``similarity`` or more, and a
    fingerprint within ``radius`` bits. The most similar window is returned, the first of equals. Items
    with fewer words than ``shingle`` use shingles of all their words; items without words match nothing;
    nor do documents that have fewer words than an item's shingles. Null texts count as empty. Rows of
    one id and equal text are one document; repeated items are one item. Ids may be null.
    """
    return _matches(docs, benchmark, id_col, text_col, item_col, item_text_col, shingle, similarity, radius).drop("th")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """docs without the rows whose document matches an item; rows that share an id, or have none, are judged by their own texts."""
    dirty = checkpointed(_matches(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct())
    here = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__th"))
    return docs.join(broadcast_if_small(dirty), here, "left_anti")
