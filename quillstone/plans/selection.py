"""Queries of the folds that need string similarity or marginal scores, and of streaming views in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.similarity import dedupe_replacing, pick_diverse, similar_pairs
from quillstone.plans.base import query
from quillstone.plans.validation import cued
from quillstone.sources.adapters import timeline, videos, with_views
from quillstone.streaming.events import budget_state, latest_state, review_progress


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """Questions of twenty videos each, as one cluster."""
    return cued(spark, d).select(F.expr("video_id DIV 20").alias("cluster"), "id", "question", F.length("answer").alias("score"))


@query("j21_similar_text_pairs")
def j21(spark: SparkSession, d: str) -> DataFrame:
    return similar_pairs(_asked(spark, d), "cluster", "id", "question", 0.7)


_DIVERSE = """g AS (SELECT video_id, 0 AS place, NULL::BIGINT AS seq, []::BIGINT[] AS seqs, []::VARCHAR[] AS kinds FROM (SELECT DISTINCT video_id FROM timeline) UNION ALL
  SELECT video_id, place + 1, s, list_append(seqs, s), list_append(kinds, k) FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY points DESC, s) AS best FROM (
    SELECT *, 0.5::DOUBLE * difficulty + 0.3::DOUBLE * (CASE WHEN n = 0 THEN 2 ELSE 0 END - (3 * n + CASE WHEN n >= 2 THEN 10 ELSE 0 END))::DOUBLE + 0.2::DOUBLE * failure AS points FROM (
      SELECT g.video_id, g.place, g.seqs, g.kinds, t.seq AS s, t.event_type AS k, t.marker / 10 AS difficulty, t.score AS failure, len(list_filter(g.kinds, lambda x: x = t.event_type)) AS n
      FROM g JOIN timeline t ON t.video_id = g.video_id WHERE g.place < 4 AND NOT list_contains(g.seqs, t.seq)))) WHERE best = 1)"""


@query("t04_diverse_top_k", with_views("timeline", "SELECT video_id, seq, place FROM g WHERE place > 0", more=_DIVERSE).replace("WITH ", "WITH RECURSIVE ", 1))
def t04(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).select("video_id", "seq", "event_type", (F.col("marker") / 10).alias("difficulty"), F.col("score").alias("failure"))
    return pick_diverse(t, "video_id", "seq", "event_type", "difficulty", "failure")


@query("t20_text_dedup_replacing")
def t20(spark: SparkSession, d: str) -> DataFrame:
    return dedupe_replacing(_asked(spark, d), "cluster", "id", "question", "score", 0.7)


@query("x03_review_progress", with_views("videos", "SELECT CAST(owner AS VARCHAR) AS video_id, count(*) AS total, count(*) FILTER (status = 'F') AS decided, count(*) FILTER (status <> 'F') AS pending FROM videos GROUP BY 1"))
def x03(spark: SparkSession, d: str) -> DataFrame:
    v = videos(spark, d).select(F.col("owner").cast("string").alias("video_id"), F.when(F.col("status") == "F", "approved").otherwise("pending").alias("status"))
    return review_progress(v)


@query("x05_latest_state", with_views("timeline", "SELECT video_id, arg_max(marker, ms * 1000000 + seq) AS progress, max(ms * 1000000 + seq) AS ts FROM timeline GROUP BY 1"))
def x05(spark: SparkSession, d: str) -> DataFrame:
    return latest_state(timeline(spark, d).select("video_id", F.col("marker").alias("progress"), (F.col("ms") * 1000000 + F.col("seq")).alias("ts")))


@query("x06_budget_alarm", with_views("timeline", "SELECT video_id, CAST(sum(marker) AS BIGINT) AS spent, CASE WHEN sum(marker) > 3500 THEN 'exceeded' WHEN sum(marker) > 3150 THEN 'warning' ELSE 'ok' END AS state FROM timeline GROUP BY 1"))
def x06(spark: SparkSession, d: str) -> DataFrame:
    return budget_state(timeline(spark, d).select("video_id", F.col("marker").alias("amount")), 3500)
