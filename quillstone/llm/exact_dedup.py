"""Exact dedup by a heavy-hitter split.

A Misra-Gries summary of every partition nominates frequent digests. At most ``counters + 1``
digests can pass the floor, so their exactly counted winners are broadcast and resolve their copies
without a shuffle. All other digests are too rare to skew and go through one ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import checkpointed, ship, text_or_empty


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int, kind: pa.DataType = pa.binary()) -> Iterator[pa.RecordBatch]:  # noqa: B008
    """Lower bounds of the counts of frequent digests (the first column) of one partition.

    A bound is too low by n / (counters + 1) at most, and so a digest without one is not more
    frequent than that. At most ``counters`` entries are held between batches.
    """
    held: dict[bytes, int] = {}
    for batch in batches:
        for x in pc.value_counts(batch.column(0)).to_pylist():
            held[x["values"]] = held.get(x["values"], 0) + x["counts"]
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: v - cut for k, v in held.items() if v > cut}
    yield pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], names=["digest", "low"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 4096) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical; null counts as empty. The largest id of a group stays.
    Repeated rows (same id, same text) are one document: they carry one verdict and all count in
    group_size. A null id stays only in a group that has no other id. Other columns are not read, so
    their names can't clash. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    digests = checkpointed(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest")))
    n = digests.count()
    floor = n / (counters + 1)
    nominated = (
        digests.select("digest").mapInArrow(partial(misra_gries, counters=counters), "digest binary, low long")
        .groupBy("digest").agg(F.sum("low").alias("low"))
        .filter((F.col("low") >= floor) & (F.col("low") > 1)).select("digest")
    )  # at most counters + 1 rows, as the bounds add up to n at most; what has 2 n / (counters + 1) copies is among them
    winners = checkpointed(
        digests.join(F.broadcast(nominated), "digest")
        .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    split = digests.join(F.broadcast(winners), "digest", "left")
    frequent = split.filter(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    rest = (
        split.filter(F.col("group_size").isNull()).select("doc_id", "digest")
        .withColumns({"keep_id": F.max("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)})
    )
    return frequent.unionByName(rest).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
