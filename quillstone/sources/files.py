"""Readers and writers: checkpoints, lists, logs, reports. Schemas are stated, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Public schemas of the persistent tables that operators read.
SCHEMAS: dict[str, str] = {
    "videos": "video_id STRING, status STRING, pipeline_stage STRING, batch_id STRING, duration DOUBLE, created_at TIMESTAMP_NTZ",
    "questions": "video_id STRING, question_id STRING, question_type STRING, text STRING, start DOUBLE, end DOUBLE, audio_cues ARRAY<STRING>, visual_cues ARRAY<STRING>, status STRING",
    "evidence_items": "id BIGINT, video_id STRING, evidence_type STRING, timestamp_start DOUBLE, timestamp_end DOUBLE, gpt4_prediction STRING, confidence_score DOUBLE, needs_human_review BOOLEAN, priority_level STRING, human_review_status STRING",
    "cost_log": "timestamp TIMESTAMP_NTZ, video_id STRING, category STRING, amount DOUBLE, description STRING",
}
PREDICTION = "answer STRING, confidence DOUBLE"


def read_checkpoints(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file; file name and unreadable content in _file and _corrupt."""
    return spark.read.schema(f"{schema}, _corrupt STRING").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True).withColumn("_file", F.col("_metadata.file_name"))


def has_fields(document: Column, required: list[str]) -> Column:
    """Whether a JSON text parses to an object with all required keys."""
    keys = F.json_object_keys(document)
    return F.coalesce(F.forall(F.array(*[F.lit(r) for r in required]), lambda r: F.array_contains(keys, r)), F.lit(False))


def resume_phase(checkpoints: DataFrame, by: str = "video_id", last: int = 9) -> DataFrame:
    """Per key the first phase that is missing or invalid, from (key, phase, valid); ``last`` + 1 if none."""
    valid = checkpoints.filter("valid").groupBy(by).agg(F.collect_set("phase").alias("done"))
    rest = lambda done: F.coalesce(F.array_min(F.array_except(F.sequence(F.lit(1), F.lit(last)), done)), F.lit(last + 1))
    return checkpoints.select(by).distinct().join(valid, by, "left").select(by, rest(F.coalesce("done", F.array().cast("array<int>"))).alias("phase"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of text files that aren't blank or comments: file, line."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("line")).filter("line <> '' AND NOT startswith(line, '#')")


def slice_lines(lines: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows offset + 1 to offset + limit in an explicit order."""
    return lines.orderBy(*order).offset(offset).limit(limit)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_report(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header and a fixed column list."""
    rows.select(*columns).write.mode("overwrite").csv(path, header=True)


def latest(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last change of each key, from an append-only table of changes."""
    names = [c for c in changes.columns if c not in key]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("__row")).select(*key, *[F.col(f"__row.{c}").alias(c) for c in names])


def add_missing(rows: DataFrame, table: str) -> DataFrame:
    """rows with the columns of a known table that it lacks, as nulls."""
    empty = rows.sparkSession.createDataFrame([], SCHEMAS[table])
    return rows.unionByName(empty, allowMissingColumns=True)


def numbered(rows: DataFrame, by: str, order: list[str], prefix: str) -> DataFrame:
    """A title per row of each key, numbered from 1 in order."""
    return rows.withColumn("title", F.concat(F.lit(prefix), F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("string")))
