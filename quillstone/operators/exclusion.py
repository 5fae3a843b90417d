"""Spans chosen by priority so that they don't overlap, and the reasons of those that aren't."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators.pieces import Islands, fold_pieces


class TakenSpans:
    """Taken spans by start. Those of a lane without clusters are disjoint; clusters may share up to ``most`` of the shorter."""

    def __init__(self, cluster: bool, most: float):
        self.cluster, self.most = cluster, most
        self.spans: list[tuple[int, int, int]] = []  # start, end, place in the order of taking
        self.longest = 0

    def clash(self, start: int, end: int) -> int | None:
        """The place of the first taken span that rules this one out."""
        first = None
        # Only spans that begin before this one's end, and no longer before its start than the longest lasts, can meet it.
        i = bisect_left(self.spans, (end,)) - 1
        while i >= 0 and self.spans[i][0] > start - self.longest - 1:
            s, e, place = self.spans[i]
            if start < e and end > s and (not self.cluster or (min(end, e) - max(start, s)) > self.most * min(end - start, e - s)):
                first = place if first is None else min(first, place)
            i -= 1
        return first

    def take(self, start: int, end: int) -> None:
        insort(self.spans, (start, end, len(self.spans)))
        self.longest = max(self.longest, end - start)


def exclusive_spans(rows: DataFrame, by: str, key: str, priority: str, start: str, end: str, cluster: Column, checks: list[tuple[str, Column]], most: float = 0.5, parts: int | None = None) -> DataFrame:
    """rows with ``reason`` (null: taken) and ``against`` (the ``key`` of the taken row that rules it out).

    Rows are judged in order of falling priority (missing ones last, ties by ``key``). The first of ``checks`` that is true is the reason; then comes ``overlap`` with a row of the same
    ``by`` that was taken before: of clusters with clusters, if they share more than ``most`` of the shorter, of others with others, if they share anything. A row without start or end overlaps nothing.

    Rows that can't overlap are apart before anything is judged: islands are split where a running maximum of ends is reached. An island is streamed in order of
    priority and only what is taken is held, in an ordered set.
    """
    names = rows.columns
    judged = rows.withColumn("__lane", F.coalesce(cluster, F.lit(False))).withColumn("reason", F.coalesce(*[F.when(c, name) for name, c in checks], F.lit(None).cast("string")))
    key_type = rows.schema[key].dataType.simpleString()
    open_ = F.col("reason").isNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
    apart = fold_pieces(judged.filter(open_).drop("reason"), [by, "__lane"], start, [key], Islands(), value=end, parts=parts).drop("taken")
    first = -F.coalesce(F.col(priority).cast("double"), F.lit(float("-inf")))
    streamed = apart.repartition(by, "__lane", "last").sortWithinPartitions(F.col(by), F.col("__lane"), F.col("last"), first, F.col(key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, taken, keys = None, TakenSpans(False, most), []
        for batch in batches:
            reasons, against = [], []
            for *island, s, e, k in zip(*[batch.column(c).to_pylist() for c in (by, "__lane", "last", start, end, key)], strict=True):
                if island != at:
                    at, taken, keys = island, TakenSpans(island[1], most), []
                clash = taken.clash(s, e)
                if clash is None:
                    taken.take(s, e)
                    keys.append(k)
                reasons.append(None if clash is None else "overlap")
                against.append(None if clash is None else keys[clash])
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(reasons, pa.string()), pa.array(against, batch.schema.field(key).type)], names=[*names, "reason", "against"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", reason string, against {key_type}"
    return streamed.mapInArrow(run, schema).unionByName(judged.filter(~open_).drop("__lane").withColumn("against", F.lit(None).cast(key_type)))
