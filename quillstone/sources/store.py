"""Results kept by key and content: what was computed for a content is not computed again.

A store is a folder of versions. A version is written whole by one job and counts once its success marker stands, so a job that was lost halfway
leaves nothing that readers see. Of several rows of a key, the one of the newest version holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.skew import kept

#: Versions of a store that may stand before they are written as one.
MOST_VERSIONS = 50


def _versions(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """Numbers of the versions that are complete, and the highest of any; by Spark's own file system, as only that may reach the store."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(at):
        return [], 0
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("v=")]
    whole = [int(p.getName()[2:]) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(whole), max((int(p.getName()[2:]) for p in found), default=0)


def read_store(spark: SparkSession, path: str, schema: str, key: list[str]) -> DataFrame:
    """The newest row of each key: schema's columns, content_hash and version."""
    whole, _ = _versions(spark, path)
    full = f"{schema}, content_hash STRING"
    rows = spark.createDataFrame([], f"{full}, version INT")
    for v in whole:
        rows = rows.unionByName(spark.read.schema(full).parquet(f"{path}/v={v}").withColumn("version", F.lit(v)))
    names = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*names), "version").alias("__row")).select(*key, *[F.col(f"__row.{c}").alias(c) for c in names])


def append_store(rows: DataFrame, path: str) -> int:
    """Write rows as the next version; its number."""
    version = _versions(rows.sparkSession, path)[1] + 1
    rows.write.mode("error").parquet(f"{path}/v={version}")
    return version


def content_hash(columns: list[str]) -> F.Column:
    """A digest of the columns that tells null from empty."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def cached(inputs: DataFrame, path: str, schema: str, key: list[str], content: list[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results (schema's columns, version) of all inputs; ``compute`` sees only rows whose key or content the store lacks.

    Keys are unique and not null; compute returns schema's columns. What is missing is found by an anti-join of digests, so texts that are known are
    read but neither shuffled nor computed.
    """
    spark = inputs.sparkSession
    hashed = inputs.withColumn("content_hash", content_hash(content))
    known = read_store(spark, path, schema, key).select(*key, "content_hash")
    lacking = kept(hashed.select(*key, "content_hash").join(known, [*key, "content_hash"], "left_anti"))
    if lacking.limit(1).count():
        todo = hashed.join(lacking, [*key, "content_hash"], "left_semi")
        append_store(compute(todo.drop("content_hash")).join(lacking, key).select(*[f.name for f in spark.createDataFrame([], schema).schema], "content_hash"), path)
    if len(_versions(spark, path)[0]) > MOST_VERSIONS:
        append_store(kept(read_store(spark, path, schema, key).drop("version")), path)
    return read_store(spark, path, schema, key).join(hashed.select(*key, "content_hash"), [*key, "content_hash"]).drop("content_hash")
