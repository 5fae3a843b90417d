"""What the training-data operators share: checkpoints, bounded broadcasts, shipping code to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

#: A table is broadcast up to so many rows and, if some of its columns have no fixed width, so many bytes of JSON.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16 << 20
#: Rows of a batch that goes to a Python worker, where the session has the default of 10,000.
BATCH_ROWS = 1_000
#: Bound of the keys that are broadcast as frequent ones.
HOT_KEYS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of df in the cluster's shared folder (``spark.checkpoint.dir``).

    A folder of our own is set only where the session names none and all tasks run in this process, as in tests.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quillstone-checkpoint-"))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if a count shows it has few rows and bytes; else as it is, for a shuffled join."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType))]
    size = F.sum(F.length(F.to_json(F.struct(*wide)))) if wide else F.lit(0)
    found = df.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and (found["bytes"] or 0) <= most_bytes else df


def join_counted(rows: DataFrame, found: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """rows joined with found on a key that is unique in found, which counts in n how many of the total rows have it.

    Keys of more than a HOT_KEYS-th of the rows are broadcast, so their rows stay where they are; fewer than HOT_KEYS
    keys can be that frequent. The rest is shuffled.
    """
    often = F.col(n) * HOT_KEYS > total
    hot = F.broadcast(found.filter(often).drop(n))
    rest = rows.join(hot.select(key), key, "left_anti").join(found.filter(~often).drop(n), key)
    return rows.join(hot, key).unionByName(rest)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the Python workers of every executor, once per context, and keep their batches small."""
    # Texts can be long, and tasks hold a batch on both sides; a session's own setting stands.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_quillstone_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    fd, path = tempfile.mkstemp(prefix="quillstone-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted((root / "quillstone").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(path)
    sc._quillstone_shipped = True


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))
