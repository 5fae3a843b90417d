"""Evidence views over the test tables.

Media time is whole milliseconds (bigint), so that equality and band joins are exact. One hour of wall
clock in ``events`` is one second of media. ``VIEWS_SQL`` states every view in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked events: video_id, seq, ms, event_type, score, marker."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("seq"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', cast(ts AS timestamp_ntz)) DIV 3600000").alias("ms"),
        "event_type", F.col("value").alias("score"), F.get_json_object("props", "$.k").cast("int").alias("marker"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript segments: video_id, seq, start_ms, end_ms, speaker, text."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("seq"), (F.col("turn") * 90000).alias("start_ms"),
        (F.col("turn") * 90000 + 40000).alias("end_ms"), F.col("role").alias("speaker"), "text",
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with review state: question_id, video_id, question_type, text, n_chars, status, hallucinated."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("question_id"), F.col("source").alias("video_id"), F.col("lang").alias("question_type"), "text", "n_chars",
        F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").otherwise("pending").alias("status"),
        F.col("toxic").alias("hallucinated"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedded frames: video_id, frame_id, ms, embedding, scene_type."""
    return table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id DIV 50").alias("video_id"), F.col("vec_id").alias("frame_id"), (F.col("vec_id") * 500).alias("ms"), "embedding", F.col("label").alias("scene_type")
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected objects with boxes: video_id, ms, part, supp, line, class, x, y, w, h, confidence."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("video_id"), (F.col("l_linenumber").cast("long") * 1000).alias("ms"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("class"),
        (F.col("l_partkey") % 100).cast("double").alias("x"), (F.col("l_suppkey") % 100).cast("double").alias("y"),
        F.col("l_quantity").alias("w"), (F.col("l_linenumber") * 10).cast("double").alias("h"), (1 - F.col("l_discount")).alias("confidence"),
    )


def cost_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs in whole hundredths of a currency unit: video_id, part, supp, line, category, amount."""
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("video_id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_linenumber").alias("line"),
        F.col("p_brand").alias("category"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos: video_id, owner, status, priority, value, created."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("video_id"), F.col("o_custkey").alias("owner"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("created"),
    )


VIEWS_SQL = {
    "timeline": "SELECT user_id AS video_id, event_id AS seq, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 3600000 AS ms, event_type, value AS score, CAST(json_extract_string(props, '$.k') AS INTEGER) AS marker FROM events",
    "segments": "SELECT conv_id AS video_id, turn AS seq, turn * 90000 AS start_ms, turn * 90000 + 40000 AS end_ms, role AS speaker, text FROM conversations",
    "questions": "SELECT d.doc_id AS question_id, d.source AS video_id, d.lang AS question_type, d.text, d.n_chars, CASE quality WHEN 1 THEN 'approved' WHEN 0 THEN 'rejected' ELSE 'pending' END AS status, toxic AS hallucinated FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "frames": "SELECT vec_id // 50 AS video_id, vec_id AS frame_id, vec_id * 500 AS ms, embedding, label AS scene_type FROM embeddings",
    "detections": "SELECT l_orderkey AS video_id, CAST(l_linenumber AS BIGINT) * 1000 AS ms, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line, l_returnflag AS class, CAST(l_partkey % 100 AS DOUBLE) AS x, CAST(l_suppkey % 100 AS DOUBLE) AS y, l_quantity AS w, CAST(l_linenumber * 10 AS DOUBLE) AS h, 1 - l_discount AS confidence FROM lineitem",
    "cost_log": "SELECT l_orderkey AS video_id, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line, p_brand AS category, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey",
    "videos": "SELECT o_orderkey AS video_id, o_custkey AS owner, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS value, o_orderdate AS created FROM orders",
}


def with_views(names: str, body: str, *, more: str = "") -> str:
    """DuckDB SQL: the named views, further CTEs, and a query over them."""
    parts = [f"{n} AS ({VIEWS_SQL[n]})" for n in names.split()]
    return "WITH " + ", ".join(parts + ([more] if more else [])) + " " + body


def as_double(sql: str, *columns: str) -> str:
    """The SQL with columns cast to double, where DuckDB would compute in decimals."""
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in columns)}) FROM ({sql})"
