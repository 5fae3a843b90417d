"""Queries of scans, updates and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.plans.base import query
from quillstone.sources.adapters import cost_log, questions, segments, table, timeline, videos, with_views
from quillstone.sources.files import has_fields, latest, numbered, resume_phase


@query("s02_point_lookup_decode", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id = 77")
def s02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter("event_id = 77").select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query("s03_natural_key", "SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000007' LIMIT 1")
def s03(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").filter("c_name = 'Customer#000000007'").limit(1).select("c_custkey")


@query("s04_foreign_key_scan", with_views("questions", "SELECT question_id FROM questions WHERE video_id = 'src5'"))
def s04(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).filter("video_id = 'src5'").select("question_id")


@query("s06_checkpoint_validity", "SELECT event_id, contains(props, '\"k\"') AS valid, false AS complete FROM events")
def s06(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", has_fields(F.col("props"), ["k"]).alias("valid"), has_fields(F.col("props"), ["k", "stage"]).alias("complete"))


@query("s07_resume_point", with_views("timeline", "SELECT video_id, coalesce(min(p) FILTER (NOT EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = v.video_id AND t.marker = p AND t.score > 2)), 10) AS phase FROM (SELECT DISTINCT video_id FROM timeline) v, range(1, 10) r(p) GROUP BY 1"))
def s07(spark: SparkSession, d: str) -> DataFrame:
    done = timeline(spark, d).select("video_id", F.col("marker").alias("phase"), (F.col("score") > 2).alias("valid"))
    return resume_phase(done).withColumn("phase", F.col("phase").cast("long"))


@query("s10_list_source", "SELECT p_type, p_partkey, 'Video ' || row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS title FROM part")
def s10(spark: SparkSession, d: str) -> DataFrame:
    return numbered(table(spark, d, "part").select("p_type", "p_partkey"), "p_type", ["p_partkey"], "Video ")


@query("s11_offset_limit", "SELECT p_partkey FROM part ORDER BY p_name, p_partkey LIMIT 25 OFFSET 10")
def s11(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").orderBy("p_name", "p_partkey").offset(10).limit(25).select("p_partkey")


@query("s20_insert_defaults", with_views("videos", "SELECT video_id, coalesce(status, 'pending') AS status, 0 AS attempts FROM videos UNION ALL SELECT -1, 'pending', 0"))
def s20(spark: SparkSession, d: str) -> DataFrame:
    new = spark.sql("SELECT -1L AS video_id, CAST(NULL AS STRING) AS status")
    return videos(spark, d).select("video_id", "status").unionByName(new).select("video_id", F.coalesce("status", F.lit("pending")).alias("status"), F.lit(0).alias("attempts"))


@query("s21_latest_decision", with_views("timeline", "SELECT video_id, arg_max(event_type, struct_pack(m := ms, s := seq)) AS event_type, arg_max(marker, struct_pack(m := ms, s := seq)) AS marker FROM timeline GROUP BY 1"))
def s21(spark: SparkSession, d: str) -> DataFrame:
    return latest(timeline(spark, d), ["video_id"], ["ms", "seq"]).select("video_id", "event_type", "marker")


@query("s22_bulk_update", with_views("questions", "SELECT question_id, CASE WHEN question_id % 10 = 3 THEN 'approved' ELSE status END AS status FROM questions"))
def s22(spark: SparkSession, d: str) -> DataFrame:
    chosen = table(spark, d, "documents").filter("doc_id % 10 = 3").select(F.col("doc_id").alias("question_id"), F.lit("approved").alias("decided"))
    return questions(spark, d).join(chosen, "question_id", "left").select("question_id", F.coalesce("decided", "status").alias("status"))


@query("s23_delete_cascade", with_views("cost_log videos", "SELECT video_id, count(*) AS n FROM cost_log WHERE video_id NOT IN (SELECT video_id FROM videos WHERE status = 'P') GROUP BY 1"))
def s23(spark: SparkSession, d: str) -> DataFrame:
    gone = videos(spark, d).filter("status = 'P'").select("video_id")
    return cost_log(spark, d).join(gone, "video_id", "left_anti").groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))


@query("s26_read_defaults", with_views("segments", "SELECT video_id, seq, coalesce(nullif(speaker, 'system'), 'unknown') AS speaker FROM segments"))
def s26(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("video_id", "seq", F.coalesce(F.nullif("speaker", F.lit("system")), F.lit("unknown")).alias("speaker"))
