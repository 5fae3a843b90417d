"""Joins and tables that hold where one key has a large share of all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a key that one task should take; a key with less than a SHARE-th of all rows is left whole, so fewer than SHARE keys are split.
CELL, SHARE = 20_000, 10_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it, and set as the checkpoint folder.

    A folder of our own is set only where the session names none and all tasks run in this process, as in tests.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quillstone-checkpoint-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """df, written to the cluster's checkpoint folder and read from there, so that lost executors don't cost what lies before."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt_join(few: DataFrame, many: DataFrame, by: list[str], deal: list[str], cell: int = CELL, *, work: int | None = None) -> DataFrame:
    """Inner join on ``by``; rows of ``many`` whose key has over ``cell`` of them are dealt out by a hash of ``deal``, and rows of ``few`` go to every part.

    The table of split keys has fewer than SHARE rows, and so is broadcast. Null keys meet nothing. Where each pair costs much, ``work`` is how many a task should
    take: keys with more are dealt out, and the number of tasks follows from that of pairs, not from bytes. There are fewer split keys than tasks.
    """
    counts = many.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    if work is None:
        total, tasks = many.count(), None
        split = counts.filter((F.col("__n") > cell) & (F.col("__n") * SHARE > total)).withColumn("__parts", F.ceil(F.col("__n") / cell))
    else:
        counts = kept(counts.join(few.groupBy(*by).agg(F.count(F.lit(1)).alias("__m")), by).withColumn("__pairs", F.col("__n") * F.col("__m")))
        tasks = max(1, -(-int(counts.agg(F.sum("__pairs")).first()[0] or 0) // work))
        parts = F.greatest(F.when(F.col("__pairs") > work, F.least("__n", F.ceil(F.col("__pairs") / work))).otherwise(1), F.ceil(F.col("__n") / cell))
        split = counts.withColumn("__parts", parts).filter("__parts > 1")
    hot = F.broadcast(split.select(*by, F.col("__parts").cast("int").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1))
    left = few.join(hot, by, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    right = many.join(hot, by, "left").withColumn("__part", F.pmod(F.xxhash64(*deal), parts).cast("int")).drop("__parts")
    if tasks is not None:
        left, right = left.repartition(tasks, *by, "__part"), right.repartition(tasks, *by, "__part")
    return left.join(right, [*by, "__part"]).drop("__part")
