"""Connections that open and close, and reviews that end: streams with state and timers, written once however often a batch is repeated."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_CHANGES = "video_id STRING, connection_id STRING, delta INT, at TIMESTAMP"


def connection_changes(events: DataFrame, idle: str = "30 seconds", late: str = "10 seconds") -> DataFrame:
    """video_id, connection_id, delta (1: opened, -1: closed), at; of a stream of (video_id, connection_id, kind, ts).

    A connection opens with its first event that isn't a ``disconnect``, and closes with a disconnect or, without one, ``idle`` after its last event: a timer on event time ends it.
    A disconnect of what isn't open says nothing. State is one time stamp a connection that is open.
    """
    wait = pd.Timedelta(idle)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, pd.Timestamp]] = []
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        if state.hasTimedOut:
            out.append((-1, last + wait))
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
            for kind, ts in zip(rows["kind"], rows["ts"], strict=True):
                if last is not None and ts - last > wait:
                    out.append((-1, last + wait))
                    last = None
                if kind == "disconnect":
                    if last is not None:
                        out.append((-1, ts))
                    last = None
                else:
                    if last is None:
                        out.append((1, ts))
                    last = ts
            if last is None:
                if state.exists:
                    state.remove()
            else:
                state.update((int(last.value // 1000),))
                # A timer can't lie before the watermark; the row that comes too late to wait is ended by the next batch.
                state.setTimeoutTimestamp(max(int((last + wait).value // 1_000_000) + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame({"video_id": key[0], "connection_id": key[1], "delta": [d for d, _ in out], "at": [t for _, t in out]})

    keyed = events.withWatermark("ts", late).groupBy("video_id", "connection_id")
    return keyed.applyInPandasWithState(step, _CHANGES, "last LONG", "append", GroupStateTimeout.EventTimeTimeout)


def connection_counts(events: DataFrame, now: F.Column, idle: F.Column, order: list[str]) -> DataFrame:
    """video_id, opened, closed, open of a table of (video_id, connection_id, kind, order): the same rules, as of ``now``.

    ``order`` begins with the time, in the unit of ``now`` and ``idle``.
    """
    own = Window.partitionBy("video_id", "connection_id").orderBy(*order)
    at = order[0]
    e = events.withColumns({"__before": F.lag("kind").over(own), "__since": F.col(at) - F.lag(at).over(own), "__until": F.lead(at).over(own) - F.col(at), "__last": F.lead(at).over(own).isNull()})
    ends, says = F.col("kind") == "disconnect", F.col("kind") != "disconnect"
    shut = F.col("__before").isNull() | (F.col("__before") == "disconnect") | (F.col("__since") > idle)
    timed_out = says & ((F.col("__until") > idle) | (F.col("__last") & (now - F.col(at) > idle)))
    return e.groupBy("video_id").agg(F.count_if(says & shut).alias("opened"), F.count_if((ends & ~shut) | timed_out).alias("closed")).withColumn("open", F.col("opened") - F.col("closed"))


def sessions(events: DataFrame, idle: F.Column, order: list[str]) -> DataFrame:
    """video_id, connection_id, opened_at, closed_at of every connection that was open: from its first event to its disconnect, or ``idle`` behind its last event."""
    own = Window.partitionBy("video_id", "connection_id").orderBy(*order)
    at = order[0]
    shut = F.lag("kind").over(own).isNull() | (F.lag("kind").over(own) == "disconnect") | (F.col(at) - F.lag(at).over(own) > idle)
    live = events.withColumn("__shut", shut).filter(~((F.col("kind") == "disconnect") & F.col("__shut")))
    numbered = live.withColumn("__n", F.sum(F.col("__shut").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ended = F.max(F.when(F.col("kind") == "disconnect", F.col(at)))
    return numbered.groupBy("video_id", "connection_id", "__n").agg(F.min(at).alias("opened_at"), F.coalesce(ended, F.max(at) + idle).alias("closed_at")).drop("__n")


def write_once(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that gives each batch a folder of its own; a batch that is repeated replaces it."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def open_connections(spark: SparkSession, path: str) -> DataFrame:
    """video_id, open of what ``write_once`` has written: videos with an open connection."""
    changes = spark.read.schema(f"{_CHANGES}, batch INT").parquet(path)
    return changes.groupBy("video_id").agg(F.sum("delta").alias("open")).filter("open > 0")


def advance_completed(path: str, to: str = "question_generation") -> Callable[[DataFrame, int], None]:
    """A handler of review progress (video_id, total, decided, pending): writes each video that has nothing pending, once, with the stage it goes on to.

    What earlier batches have advanced is left alone; a batch that is repeated finds the same videos and replaces its own folder, so a restart changes nothing.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = batch.filter("pending = 0 AND total > 0").select("video_id", "total").dropDuplicates(["video_id"])
        if number:
            seen = spark.read.schema("video_id STRING, stage STRING, batch INT").parquet(path).filter(F.col("batch") < number)
            done = done.join(seen, "video_id", "left_anti")
        done.select("video_id", F.lit(to).alias("stage"), "total").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return handle
