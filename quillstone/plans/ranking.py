"""Sort, limit, top-k and greedy selection queries. Limits here are the feature: reports and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.exclusion import exclusive_spans
from quillstone.plans.base import query
from quillstone.sources.adapters import cost_log, detections, questions, segments, table, timeline, videos, with_views

_CASE = "CASE priority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END"


def review_queue(v: DataFrame, limit: int, offset: int) -> DataFrame:
    """Pending videos by priority (unknown priorities first), then value, then id."""
    return v.filter("status = 'P'").withColumn("p", F.expr(_CASE)).orderBy(F.col("p").asc_nulls_first(), "value", "video_id").offset(offset).limit(limit)


@query("t01_review_queue", with_views("videos", f"SELECT video_id, priority, value FROM videos WHERE status = 'P' ORDER BY {_CASE} NULLS FIRST, value, video_id LIMIT 50 OFFSET 20"))
def t01(spark: SparkSession, d: str) -> DataFrame:
    return review_queue(videos(spark, d), 50, 20).select("video_id", "priority", "value")


@query("t02_pagination", with_views("videos", "SELECT video_id, (SELECT count(*) FROM videos WHERE status = 'O') > 40 AS has_more FROM videos WHERE status = 'O' ORDER BY video_id LIMIT 20 OFFSET 20"))
def t02(spark: SparkSession, d: str) -> DataFrame:
    v = videos(spark, d).filter("status = 'O'").select("video_id")
    page = v.orderBy("video_id").offset(20).limit(21)  # one more than the page tells whether another follows
    n = F.row_number().over(Window.orderBy("video_id"))
    return page.withColumns({"n": n, "k": F.count(F.lit(1)).over(Window.partitionBy())}).filter("n <= 20").select("video_id", (F.col("k") > 20).alias("has_more"))


# What a frame must show for a type of question, and the protected radius of each mode, in seconds.
FRAME_NEEDS = {
    "Needle": ("has_text", "No visible text for Needle question"),
    "Referential Grounding": ("has_text", "No visible text for Referential Grounding question"),
    "Counting": ("objects >= 2", "Need 2+ objects for Counting question"),
    "Object Interaction Reasoning": ("has_person", "No person detected for Object Interaction question"),
    "Context": ("coalesce(scene, 'unknown') NOT IN ('unknown', '')", "No clear scene for Context question"),
    "Subscene": ("coalesce(scene, 'unknown') NOT IN ('unknown', '')", "No clear scene for Subscene question"),
    "Temporal Understanding": ("objects > 0 OR coalesce(scene, '') <> ''", "No visible content for Temporal Understanding question"),
    "Sequential": ("objects > 0 OR coalesce(scene, '') <> ''", "No visible content for Sequential question"),
    "Inference": ("objects > 0", "No visible action/object for Inference question"),
    "General Holistic Reasoning": ("coalesce(scene, 'unknown') NOT IN ('unknown', '')", "No clear scene for General Holistic Reasoning question"),
    "Comparative": ("objects >= 2", "Need 2+ objects/elements for Comparative question"),
    "Audio-Visual Stitching": ("objects > 0 OR coalesce(scene, '') <> ''", "No visible content for Audio-Visual Stitching question"),
    "Tackling Spurious Correlations": ("objects > 0 OR coalesce(scene, '') <> ''", "No visible content for Spurious Correlation question"),
}
MODE_RADII = {"precise": 5.0, "micro_temporal": 3.0, "inference_window": 2.0, "cluster": 0.0}
#: Moments proposed on the timeline: an event each, whose type, mode, window and frame follow from its row.
_MOMENT = {
    "kind": "CASE seq % 13 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(FRAME_NEEDS)) + " END",
    "mode": "CASE WHEN seq % 4 = 0 THEN 'cluster' WHEN seq % 4 = 1 THEN 'precise' WHEN seq % 4 = 2 THEN 'inference_window' ELSE 'micro_temporal' END",
    "radius": "CAST(CASE WHEN seq % 9 = 0 THEN 9 WHEN seq % 4 = 1 THEN 5 WHEN seq % 4 = 2 THEN 2 ELSE 3 END AS DOUBLE)",
    "start_ms": "CASE WHEN seq % 31 <> 0 THEN ms END",
    "end_ms": "ms + CASE WHEN seq % 4 = 0 THEN 20000 ELSE 8000 END",
    "objects": "marker % 5", "has_text": "marker % 3 <> 0", "has_person": "marker % 2 = 0", "scene": "CASE WHEN marker % 7 = 0 THEN 'unknown' WHEN marker % 11 = 0 THEN NULL ELSE event_type END",
}
_CONTENT = "CASE kind " + " ".join(f"WHEN '{k}' THEN CASE WHEN NOT ({need}) THEN 'Frame content: {text}' END" for k, (need, text) in FRAME_NEEDS.items()) + " END"
_EXPECTED = "CASE mode " + " ".join(f"WHEN '{m}' THEN {r}" for m, r in MODE_RADII.items()) + " ELSE 5.0 END"
_RADIUS = f"mode <> 'cluster' AND abs(radius - {_EXPECTED}) > 1.0"
_EXCLUSIVE = f"""m AS (SELECT video_id, seq, score, {', '.join(f'{sql} AS {c}' for c, sql in _MOMENT.items())} FROM timeline),
j AS (SELECT *, coalesce({_CONTENT}, CASE WHEN {_RADIUS} THEN 'Protected radius' END) AS early, row_number() OVER (PARTITION BY video_id ORDER BY score DESC NULLS LAST, seq) AS n FROM m),
g AS (SELECT video_id, 0::BIGINT AS n, NULL::BIGINT AS seq, NULL::VARCHAR AS reason, NULL::BIGINT AS against, []::STRUCT(s BIGINT, e BIGINT, c BOOLEAN, k BIGINT)[] AS taken FROM (SELECT DISTINCT video_id FROM j) UNION ALL
  SELECT video_id, n, seq, coalesce(early, CASE WHEN clash IS NOT NULL THEN 'overlap' END), clash, CASE WHEN early IS NULL AND clash IS NULL AND start_ms IS NOT NULL THEN list_append(taken, {{'s': start_ms, 'e': end_ms, 'c': mode = 'cluster', 'k': seq}}) ELSE taken END FROM (
    SELECT j.*, g.taken, CASE WHEN early IS NULL THEN list_filter(g.taken, lambda t: t.c = (j.mode = 'cluster') AND j.start_ms < t.e AND j.end_ms > t.s AND (NOT t.c OR least(j.end_ms, t.e) - greatest(j.start_ms, t.s) > 0.5 * least(j.end_ms - j.start_ms, t.e - t.s)))[1].k END AS clash
    FROM g JOIN j ON j.video_id = g.video_id AND j.n = g.n + 1))"""


@query("t03_priority_no_overlap", with_views("timeline", "SELECT video_id, seq, reason IS NULL AS taken, reason, against FROM g WHERE n > 0", more=_EXCLUSIVE).replace("WITH ", "WITH RECURSIVE ", 1))
def t03(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    moments = t.select("video_id", "seq", "score", *[F.expr(sql).alias(c) for c, sql in _MOMENT.items()])
    first = moments.withColumns({"content": F.expr(_CONTENT), "off": F.expr(_RADIUS)})
    judged = exclusive_spans(first, "video_id", "seq", "score", "start_ms", "end_ms", F.col("mode") == "cluster", [("content", F.col("content").isNotNull()), ("Protected radius", F.col("off"))])
    return judged.select("video_id", "seq", F.col("reason").isNull().alias("taken"), F.when(F.col("reason") == "content", F.col("content")).otherwise(F.col("reason")).alias("reason"), "against")


@query("t05_round_robin_caps", with_views("timeline", "SELECT video_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n, event_type) AS place FROM (SELECT *, row_number() OVER (PARTITION BY video_id, event_type ORDER BY score DESC, seq) AS n FROM timeline) WHERE n <= 3) WHERE place <= 10"))
def t05(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("video_id", "event_type").orderBy(F.desc("score"), "seq"))
    place = F.row_number().over(Window.partitionBy("video_id").orderBy("n", "event_type"))
    return timeline(spark, d).withColumn("n", n).filter("n <= 3").withColumn("place", place).filter("place <= 10").select("video_id", "seq")


def _top(rows: DataFrame, by: str, k: int, *order) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("place") <= k).drop("place")


@query("t06_composite_top", with_views("timeline", "SELECT video_id, bin, score FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, bin) AS n FROM (SELECT video_id, ms // 30000 AS bin, max(marker) * count(DISTINCT event_type) AS score FROM timeline GROUP BY ALL)) WHERE n <= 5"))
def t06(spark: SparkSession, d: str) -> DataFrame:
    bins = timeline(spark, d).groupBy("video_id", F.expr("ms DIV 30000").alias("bin")).agg((F.max("marker") * F.size(F.collect_set("event_type"))).cast("long").alias("score"))
    return _top(bins, "video_id", 5, F.desc("score"), "bin")


@query("t07_max_over_map", "SELECT vec_id, round(CAST(list_max(embedding[1:8]) AS DOUBLE), 6) AS score FROM embeddings ORDER BY list_max(embedding[1:8]) DESC, vec_id LIMIT 100")
def t07(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.map_from_arrays(F.sequence(F.lit(1), F.lit(8)), F.slice("embedding", 1, 8)).alias("m"))
    return e.withColumn("s", F.coalesce(F.array_max(F.map_values("m")), F.lit(0.0))).orderBy(F.desc("s"), "vec_id").limit(100).select("vec_id", F.round("s", 6).alias("score"))


@query("t08_multi_key_rank", with_views("detections", "SELECT video_id, part, supp, line FROM detections ORDER BY confidence DESC, w DESC, h DESC, video_id, part, supp, line LIMIT 200"))
def t08(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).orderBy(F.desc("confidence"), F.desc("w"), F.desc("h"), "video_id", "part", "supp", "line").limit(200).select("video_id", "part", "supp", "line")


@query("t09_ids_reassigned", with_views("questions", "SELECT video_id, question_id, video_id || '_' || lpad(CAST(n AS VARCHAR), 3, '0') AS new_id FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n_chars DESC, question_id) AS n FROM questions) WHERE n <= 10"))
def t09(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("n_chars"), "question_id"))
    return questions(spark, d).withColumn("n", n).filter("n <= 10").select("video_id", "question_id", F.concat("video_id", F.lit("_"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("new_id"))


@query("t10_premium_sort", with_views("timeline", "SELECT seq FROM timeline ORDER BY event_type = 'purchase' DESC, marker DESC, ms, seq LIMIT 100"))
def t10(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).orderBy(F.desc(F.col("event_type") == "purchase"), F.desc("marker"), "ms", "seq").limit(100).select("seq")


@query("t11_difficulty_rank", with_views("questions", "SELECT question_id, rank() OVER (PARTITION BY video_id ORDER BY n_chars DESC) AS place FROM questions"))
def t11(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).select("question_id", F.rank().over(Window.partitionBy("video_id").orderBy(F.desc("n_chars"))).cast("long").alias("place"))


@query("t12_best_worst", with_views("timeline", "SELECT video_id, 'best' AS side, event_type FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY r DESC, event_type) AS n FROM x) WHERE n <= 3 UNION ALL SELECT video_id, 'worst', event_type FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY r, event_type) AS n FROM x) WHERE n <= 3", more="x AS (SELECT video_id, event_type, round(avg(marker), 6) AS r FROM timeline GROUP BY ALL)"))
def t12(spark: SparkSession, d: str) -> DataFrame:
    x = timeline(spark, d).groupBy("video_id", "event_type").agg(F.round(F.avg("marker"), 6).alias("r"))
    by = Window.partitionBy("video_id")
    both = x.withColumns({"hi": F.row_number().over(by.orderBy(F.desc("r"), "event_type")), "lo": F.row_number().over(by.orderBy("r", "event_type"))})
    sides = F.array_compact(F.array(F.when(F.col("hi") <= 3, "best"), F.when(F.col("lo") <= 3, "worst")))
    return both.select("video_id", F.explode(sides).alias("side"), "event_type")


@query("t13_top_counter", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def t13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_name").limit(10)


@query("t14_pairwise_losers", with_views("detections", "SELECT video_id, part, supp, line FROM detections a WHERE EXISTS (SELECT 1 FROM detections b WHERE b.video_id = a.video_id AND b.class = a.class AND b.ms = a.ms AND (b.confidence > a.confidence OR b.confidence = a.confidence AND (b.part < a.part OR b.part = a.part AND b.supp < a.supp)))"))
def t14(spark: SparkSession, d: str) -> DataFrame:
    # The winner of a group is its first row by this order; all others lose to it, so no pairs are needed.
    w = Window.partitionBy("video_id", "class", "ms").orderBy(F.desc("confidence"), "part", "supp")
    return detections(spark, d).withColumn("n", F.row_number().over(w)).filter("n > 1").select("video_id", "part", "supp", "line")


@query("t15_exactly_three_types", with_views("timeline", "SELECT video_id, string_agg(event_type, ',' ORDER BY n) AS types FROM (SELECT video_id, event_type, row_number() OVER (PARTITION BY video_id ORDER BY f) AS n FROM (SELECT video_id, event_type, min(ms * 1000000000 + seq) AS f FROM timeline GROUP BY ALL)) WHERE n <= 3 GROUP BY 1"))
def t15(spark: SparkSession, d: str) -> DataFrame:
    seen = timeline(spark, d).groupBy("video_id", "event_type").agg(F.min(F.struct("ms", "seq")).alias("at"))
    order = F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"])
    return seen.groupBy("video_id").agg(F.array_join(F.slice(F.array_distinct(order), 1, 3), ",").alias("types"))


@query("t16_frame_budget", with_views("timeline", "SELECT video_id, CAST(greatest(47, least(150, greatest(10 * (max(ms) // 60000), 2 * count(*) FILTER (marker > 90), 43 + max(ms) // 30000))) AS BIGINT) AS frames FROM timeline GROUP BY 1"))
def t16(spark: SparkSession, d: str) -> DataFrame:
    g = timeline(spark, d).groupBy("video_id").agg(F.max("ms").alias("m"), F.count_if(F.col("marker") > 90).alias("h"))
    want = F.greatest(F.expr("10 * (m DIV 60000)"), F.col("h") * 2, F.expr("43 + m DIV 30000"))
    return g.select("video_id", F.greatest(F.expr("47L"), F.least(F.expr("150L"), want)).alias("frames"))


@query("t18_first_applicable", with_views("segments", "SELECT video_id, min(seq) AS seq FROM segments WHERE speaker = 'assistant' AND length(text) > 200 GROUP BY 1"))
def t18(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter((F.col("speaker") == "assistant") & (F.length("text") > 200)).groupBy("video_id").agg(F.min("seq").alias("seq"))


@query("t19_stop_at_budget", with_views("cost_log", "SELECT video_id, part, supp, line FROM (SELECT *, sum(amount) OVER (PARTITION BY video_id ORDER BY part, supp, line, amount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent FROM cost_log) WHERE coalesce(spent, 0) < 10000000"))
def t19(spark: SparkSession, d: str) -> DataFrame:
    before = F.sum("amount").over(Window.partitionBy("video_id").orderBy("part", "supp", "line", "amount").rowsBetween(Window.unboundedPreceding, -1))
    return cost_log(spark, d).withColumn("spent", before).filter("coalesce(spent, 0) < 10000000").select("video_id", "part", "supp", "line")
