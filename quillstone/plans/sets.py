"""Set-operation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.plans.base import query
from quillstone.sources.adapters import detections, segments, table, timeline, videos, with_views


@query("u01_union_distinct", with_views("timeline", "SELECT video_id, seq FROM timeline WHERE marker > 90 UNION SELECT video_id, seq FROM timeline WHERE event_type = 'purchase' UNION SELECT video_id, seq FROM timeline WHERE ms % 10000 < 500"))
def u01(spark: SparkSession, d: str) -> DataFrame:
    # The three tiers read one table, so their union is one scan with a disjunction.
    return timeline(spark, d).filter("marker > 90 OR event_type = 'purchase' OR ms % 10000 < 500").select("video_id", "seq").distinct()


@query("u02_union_all_ordinal", with_views("timeline segments", "SELECT 0 AS source, video_id, seq FROM timeline UNION ALL SELECT 1, video_id, seq FROM segments"))
def u02(spark: SparkSession, d: str) -> DataFrame:
    a = timeline(spark, d).select(F.lit(0).alias("source"), "video_id", "seq")
    return a.unionByName(segments(spark, d).select(F.lit(1).alias("source"), "video_id", "seq"))


def merged_timeline(spark: SparkSession, d: str) -> DataFrame:
    """Events, first speaker turns and speaker changes as one stream: video_id, ms, src, seq, kind, text."""
    events = timeline(spark, d).select("video_id", "ms", F.lit(0).alias("src"), "seq", F.col("event_type").alias("kind"))
    s = segments(spark, d)
    turns = s.select("video_id", F.col("start_ms").alias("ms"), F.lit(1).alias("src"), "seq", F.lit("segment").alias("kind"), F.col("speaker").alias("text"))
    changes = s.withColumn("p", F.lag("speaker").over(Window.partitionBy("video_id").orderBy("seq"))).filter("p <> speaker").select("video_id", F.col("start_ms").alias("ms"), F.lit(2).alias("src"), "seq", F.lit("change").alias("kind"))
    return events.unionByName(turns, allowMissingColumns=True).unionByName(changes, allowMissingColumns=True)


@query("u03_event_timeline", with_views("timeline segments", "SELECT video_id, ms, 0 AS src, seq, event_type AS kind, CAST(NULL AS VARCHAR) AS text FROM timeline UNION ALL SELECT video_id, start_ms, 1, seq, 'segment', speaker FROM segments UNION ALL SELECT video_id, start_ms, 2, seq, 'change', NULL FROM (SELECT *, lag(speaker) OVER (PARTITION BY video_id ORDER BY seq) AS p FROM segments) WHERE p <> speaker"))
def u03(spark: SparkSession, d: str) -> DataFrame:
    return merged_timeline(spark, d).orderBy("video_id", "ms", "src", "seq")


@query("u04_name_membership", with_views("segments", "SELECT video_id, seq, len(list_filter(['the', 'der', 'les'], lambda n: contains(lower(text), n))) > 0 AS named FROM segments"))
def u04(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("the", "der", "les")])
    return segments(spark, d).select("video_id", "seq", F.exists(names, lambda n: F.contains(F.lower("text"), n)).alias("named"))


@query("u05_difference", with_views("timeline", "SELECT v.video_id, string_agg(e, ',' ORDER BY e) AS unused FROM (SELECT DISTINCT video_id FROM timeline) v, (VALUES ('refund'), ('view'), ('share')) x(e) WHERE NOT EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = v.video_id AND t.event_type = e) GROUP BY 1"))
def u05(spark: SparkSession, d: str) -> DataFrame:
    every = F.array(*[F.lit(x) for x in ("refund", "view", "share")])
    return timeline(spark, d).groupBy("video_id").agg(F.array_join(F.array_sort(F.array_except(every, F.collect_set("event_type"))), ",").alias("unused"))


@query("u06_token_jaccard", "SELECT a.p_partkey AS a, b.p_partkey AS b, round(len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) / len(list_distinct(list_concat(string_split(a.p_name, ' '), string_split(b.p_name, ' ')))), 6) AS jaccard FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def u06(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_partkey").alias("b"), F.col("w").alias("v"))
    return p.join(nxt, "p_partkey").select(F.col("p_partkey").alias("a"), "b", F.round(F.size(F.array_intersect("w", "v")) / F.size(F.array_union("w", "v")), 6).alias("jaccard"))


@query("u07_added_missing", "SELECT a.p_partkey AS a, len(list_filter(list_distinct(string_split(b.p_name, ' ')), lambda x: NOT list_contains(string_split(a.p_name, ' '), x))) AS added, len(list_filter(list_distinct(string_split(a.p_name, ' ')), lambda x: NOT list_contains(string_split(b.p_name, ' '), x))) AS missing FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def u07(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("w").alias("v"))
    return p.join(nxt, "p_partkey").select(F.col("p_partkey").alias("a"), F.size(F.array_except("v", "w")).cast("long").alias("added"), F.size(F.array_except("w", "v")).cast("long").alias("missing"))


@query("u08_ordered_dedupe", "SELECT p_name, min(p_partkey) AS first_key FROM part GROUP BY 1")
def u08(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("first_key"))


@query("u09_consensus_split", with_views("detections", "SELECT line, count(*) FILTER (class = 'A') AS agreed, count(*) FILTER (class <> 'A') AS disagreed, count(*) AS merged FROM detections GROUP BY 1"))
def u09(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).groupBy("line").agg(F.count_if(F.col("class") == "A").alias("agreed"), F.count_if(F.col("class") != "A").alias("disagreed"), F.count(F.lit(1)).alias("merged"))


@query("u10_explode_kinds", with_views("detections", "SELECT kind, count(*) AS n FROM (SELECT unnest(['person', 'object', 'scene']) AS kind, class FROM detections) WHERE kind <> 'person' OR class = 'A' GROUP BY 1"))
def u10(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.when(F.col("class") == "A", F.array(*[F.lit(x) for x in ("person", "object", "scene")])).otherwise(F.array(F.lit("object"), F.lit("scene")))
    return detections(spark, d).select(F.explode_outer(kinds).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("u11_single_or_cluster", with_views("detections", "SELECT video_id, CASE WHEN count(*) >= 5 THEN 'cluster' ELSE 'single' END AS kind, min(ms) AS start_ms, max(ms) AS end_ms FROM detections GROUP BY 1"))
def u11(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).groupBy("video_id").agg(F.when(F.count(F.lit(1)) >= 5, "cluster").otherwise("single").alias("kind"), F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"))


@query("u12_vocabulary", "SELECT DISTINCT w FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part UNION ALL SELECT lower(p_type) FROM part UNION ALL SELECT lower(c_mktsegment) FROM customer UNION ALL SELECT 'music')")
def u12(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    words = p.select(F.explode(F.split(F.lower("p_name"), " ")).alias("w")).union(p.select(F.lower("p_type"))).union(table(spark, d, "customer").select(F.lower("c_mktsegment"))).union(spark.sql("SELECT 'music'"))
    return words.distinct()


@query("u13_name_candidates", with_views("segments", "SELECT DISTINCT unnest(regexp_extract_all(text, '(^|[ \\n])([A-Z][a-z]{3,})', 2)) AS name FROM segments"))
def u13(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r"(^|[ \n])([A-Z][a-z]{3,})"), 2)).alias("name")).distinct()


@query("u14_simple_timeline", with_views("timeline segments", "SELECT video_id, ms, event_type AS type FROM timeline UNION ALL SELECT video_id, start_ms, 'speech' FROM segments"))
def u14(spark: SparkSession, d: str) -> DataFrame:
    a = timeline(spark, d).select("video_id", "ms", F.col("event_type").alias("type"))
    return a.unionByName(segments(spark, d).select("video_id", F.col("start_ms").alias("ms"), F.lit("speech").alias("type"))).orderBy("video_id", "ms")


@query("u15_class_split", with_views("detections", "SELECT video_id, count(*) FILTER (class = 'A') AS people, count(*) FILTER (class <> 'A') AS objects FROM detections GROUP BY 1"))
def u15(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).groupBy("video_id").agg(F.count_if(F.col("class") == "A").alias("people"), F.count_if(F.col("class") != "A").alias("objects"))


@query("u_videos_without_cost", "SELECT o_orderkey AS video_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def without_cost(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).select("video_id").subtract(detections(spark, d).select("video_id"))
