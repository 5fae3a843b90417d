"""Queries that match texts, words and cues, and further templates and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.joins import band_join, nearest, nearest_within, range_join
from quillstone.plans.base import query
from quillstone.plans.scalars import over_sentences, sentences
from quillstone.plans.templates import first
from quillstone.sources.adapters import as_double, detections, segments, table, timeline, with_views


@query("j23_overlap_pairs", with_views("segments", "SELECT a.video_id, a.seq AS a, b.seq AS b FROM segments a JOIN segments b ON a.video_id = b.video_id AND a.seq < b.seq AND a.start_ms < b.end_ms + 60000 AND b.start_ms < a.end_ms + 60000"))
def j23(spark: SparkSession, d: str) -> DataFrame:
    width = 60000
    s = segments(spark, d).select("video_id", "seq", "start_ms", (F.col("end_ms") + width).alias("stop"))
    touched = F.explode(F.sequence(F.floor(F.col("start_ms") / width).cast("long"), F.floor(F.col("stop") / width).cast("long"))).alias("k")
    a = s.select("video_id", F.col("seq").alias("a"), F.col("start_ms").alias("a0"), F.col("stop").alias("a1"), touched)
    b = s.select("video_id", F.col("seq").alias("b"), F.col("start_ms").alias("b0"), F.col("stop").alias("b1"), touched)
    return a.join(b, ["video_id", "k"]).filter("a < b AND a0 < b1 AND b0 < a1").select("video_id", "a", "b").distinct()


@query("j28_cue_grounding", with_views("segments", "SELECT c.video_id, c.word, EXISTS (SELECT 1 FROM segments s WHERE s.video_id = c.video_id AND s.speaker = 'assistant' AND list_contains(string_split(lower(s.text), ' '), c.word)) AS grounded FROM (SELECT DISTINCT video_id, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS word FROM segments WHERE speaker = 'user') c"))
def j28(spark: SparkSession, d: str) -> DataFrame:
    words = segments(spark, d).select("video_id", "speaker", F.explode(F.array_remove(F.split(F.lower("text"), " "), "")).alias("word"))
    said = words.filter("speaker = 'assistant'").select("video_id", "word").distinct().withColumn("grounded", F.lit(True))
    return words.filter("speaker = 'user'").select("video_id", "word").distinct().join(said, ["video_id", "word"], "left").select("video_id", "word", F.coalesce("grounded", F.lit(False)).alias("grounded"))


@query("f15_matching_blocks")
def f15(spark: SparkSession, d: str) -> DataFrame:
    from quillstone.operators.similarity import ratio

    ratios = F.pandas_udf(lambda a, b: a.combine(b, ratio).astype("float64"), "double")
    return table(spark, d, "part").select("p_partkey", F.round(ratios("p_name", "p_type"), 6).alias("likeness"))


@query("f18_box_overlap", with_views("detections", "SELECT video_id, part, supp, line, round(greatest(0, least(x + w, 60) - greatest(x, 20)) * greatest(0, least(y + h, 60) - greatest(y, 20)) / (w * h + 1600 - greatest(0, least(x + w, 60) - greatest(x, 20)) * greatest(0, least(y + h, 60) - greatest(y, 20))), 6) AS iou FROM detections"))
def f18(spark: SparkSession, d: str) -> DataFrame:
    from quillstone.operators.joins import iou

    boxes = detections(spark, d).withColumns({"bx": F.lit(20.0), "by": F.lit(20.0), "bw": F.lit(40.0), "bh": F.lit(40.0)})
    return boxes.select("video_id", "part", "supp", "line", F.round(iou("", "b"), 6).alias("iou"))


@query("f20_horizontal_position", with_views("detections", "SELECT video_id, part, supp, line, CASE WHEN w IS NULL OR w <= 0 THEN 'center' WHEN (x + w / 2) / 150 < 1 / 3 THEN 'left' WHEN (x + w / 2) / 150 < 2 / 3 THEN 'center' ELSE 'right' END AS position FROM detections"))
def f20(spark: SparkSession, d: str) -> DataFrame:
    c = (F.col("x") + F.col("w") / 2) / 150
    return detections(spark, d).select("video_id", "part", "supp", "line", F.when(F.col("w").isNull() | (F.col("w") <= 0), "center").when(c < 1 / 3, "left").when(c < 2 / 3, "center").otherwise("right").alias("position"))


@query("f31_rule_complexity", as_double(over_sentences(r"SELECT id, greatest(0, least(3, len(regexp_extract_all(regexp_replace(lower(question), '([^\p{L}\p{N}_])', '\1\1', 'g'), '(^|[^\p{L}\p{N}_])(before|after|while)($|[^\p{L}\p{N}_])'))) + least(2, len(regexp_extract_all(question, ','))) * 0.5 + least(2, length(question) // 40) - CASE WHEN length(question) < 20 THEN 1 ELSE 0 END) AS complexity FROM q"), "complexity"))
def f31(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question")
    n = lambda p: F.regexp_count(F.lower(q), F.lit(p))
    score = F.least(F.lit(3), n(r"\b(before|after|while)\b")) + F.least(F.lit(2), n(",")) * 0.5 + F.least(F.lit(2), F.floor(F.length(q) / 40)) - F.when(F.length(q) < 20, 1).otherwise(0)
    return sentences(spark, d).select("id", F.greatest(F.lit(0.0), score.cast("double")).alias("complexity"))


@query("f39_test_outcome", with_views("timeline", "SELECT seq, CASE WHEN event_type = 'error' THEN 'hallucination' WHEN marker > 70 THEN 'pass' WHEN marker < 30 THEN 'fail' ELSE 'unclear' END AS outcome FROM timeline"))
def f39(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).select("seq", F.when(F.col("event_type") == "error", "hallucination").when(F.col("marker") > 70, "pass").when(F.col("marker") < 30, "fail").otherwise("unclear").alias("outcome"))


@query("f44_capitalised_names", over_sentences("SELECT id, list_filter(string_split(answer, ' ')[2:], lambda x: regexp_matches(x, '^[A-Z][a-z]+')) AS names FROM q"))
def f44(spark: SparkSession, d: str) -> DataFrame:
    words = F.split("answer", " ")
    return sentences(spark, d).select("id", F.filter(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w: w.rlike("^[A-Z][a-z]+")).alias("names"))


@query("f51_ordered_replacements", over_sentences("SELECT id, replace(replace(answer, 'the', 'THE'), 'THE player', 'someone') AS text FROM q"))
def f51(spark: SparkSession, d: str) -> DataFrame:
    steps = F.array(F.struct(F.lit("the").alias("a"), F.lit("THE").alias("b")), F.struct(F.lit("THE player").alias("a"), F.lit("someone").alias("b")))
    return sentences(spark, d).select("id", F.aggregate(steps, F.col("answer"), lambda t, s: F.replace(t, s["a"], s["b"])).alias("text"))


@query("v20_multiplied_confidence", as_double(with_views("detections", "SELECT video_id, part, supp, line, round(CASE WHEN w < 5 THEN 0.7 ELSE 1 END * CASE WHEN h > 60 THEN 0.5 ELSE 1 END * CASE WHEN confidence < 0.95 THEN 0.8 ELSE 1 END, 6) AS confidence FROM detections"), "confidence"))
def v20(spark: SparkSession, d: str) -> DataFrame:
    c = F.when(F.col("w") < 5, 0.7).otherwise(1.0) * F.when(F.col("h") > 60, 0.5).otherwise(1.0) * F.when(F.col("confidence") < 0.95, 0.8).otherwise(1.0)
    return detections(spark, d).select("video_id", "part", "supp", "line", F.round(c, 6).alias("confidence"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms", "text")


@query("q06_context", with_views("timeline segments", "SELECT video_id, min(seq) AS turn FROM (SELECT s.video_id, s.seq FROM segments s JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 15000 GROUP BY ALL HAVING count(DISTINCT t.event_type) >= 2 AND count(*) FILTER (t.event_type = 'view') > 0) GROUP BY 1"))
def q06(spark: SparkSession, d: str) -> DataFrame:
    near = band_join(_turns(spark, d).drop("text"), timeline(spark, d).select("video_id", "ms", "event_type"), "video_id", "start_ms", "ms", 15000)
    fits = near.groupBy("video_id", "turn").agg(F.size(F.collect_set("event_type")).alias("k"), F.bool_or(F.col("event_type") == "view").alias("v")).filter("k >= 2 AND v")
    return fits.groupBy("video_id").agg(F.min("turn").alias("turn"))


@query("q13_spurious", with_views("timeline segments", "SELECT s.video_id, min(s.seq) AS turn FROM segments s WHERE regexp_matches(lower(s.text), '(it|he|der)') AND EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 2000) GROUP BY 1"))
def q13(spark: SparkSession, d: str) -> DataFrame:
    vague = _turns(spark, d).filter(F.lower("text").rlike("(it|he|der)")).drop("text")
    return band_join(vague, timeline(spark, d).select("video_id", "ms"), "video_id", "start_ms", "ms", 2000).groupBy("video_id").agg(F.min("turn").alias("turn"))


@query("q17_subscene_needle", with_views("timeline segments", "SELECT video_id, arg_min(seq, struct_pack(m := ms, s := seq)) AS seq FROM (SELECT a.video_id, a.seq, a.ms FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.seq <> b.seq AND abs(a.ms - b.ms) < 5000 WHERE a.marker >= 80 AND EXISTS (SELECT 1 FROM segments s WHERE s.video_id = a.video_id AND abs(s.start_ms - a.ms) <= 10000) GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1"))
def q17(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    marked = nearest_within(t.filter("marker >= 80").select("video_id", "seq", "ms"), _turns(spark, d), "video_id", ["seq"], "ms", "start_ms", ["turn"], 10000, ["turn"]).filter("near_turn IS NOT NULL")
    near = band_join(marked, t.select("video_id", F.col("seq").alias("other"), F.col("ms").alias("other_ms")), "video_id", "ms", "other_ms", 5000, strict=True)
    return first(near.filter("seq <> other").groupBy("video_id", "seq", "ms").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2"), "seq")


@query("q18_holistic_inference", with_views("timeline segments", "SELECT t.video_id, count(*) AS inside FROM timeline t JOIN segments s ON s.video_id = t.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms GROUP BY 1 HAVING count(*) >= 2"))
def q18(spark: SparkSession, d: str) -> DataFrame:
    inside = range_join(timeline(spark, d).select("video_id", "ms"), _turns(spark, d).drop("text"), "video_id", "ms", "start_ms", "end_ms")
    return inside.groupBy("video_id").agg(F.count(F.lit(1)).alias("inside")).filter("inside >= 2")


@query("q19_emotion_context", with_views("timeline segments", "SELECT s.video_id, s.seq, count(t.seq) + 1 AS elements FROM segments s LEFT JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 5000 WHERE contains(lower(s.text), 'th') GROUP BY s.video_id, s.seq"))
def q19(spark: SparkSession, d: str) -> DataFrame:
    told = _turns(spark, d).filter(F.contains(F.lower("text"), F.lit("th"))).drop("text")
    near = band_join(told, timeline(spark, d).select("video_id", "ms"), "video_id", "start_ms", "ms", 5000).groupBy("video_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    return told.join(near, ["video_id", "turn"], "left").select("video_id", F.col("turn").alias("seq"), (F.coalesce("n", F.lit(0)) + 1).alias("elements"))


@query("q20_transformation", with_views("timeline", "SELECT video_id, event_type, arg_min(marker, ms * 1000000 + seq) AS before, arg_max(marker, ms * 1000000 + seq) AS after FROM timeline GROUP BY ALL HAVING count(*) >= 3 AND arg_min(marker, ms * 1000000 + seq) < arg_max(marker, ms * 1000000 + seq)"))
def q20(spark: SparkSession, d: str) -> DataFrame:
    at = F.struct("ms", "seq")
    g = timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min_by("marker", at).alias("before"), F.max_by("marker", at).alias("after"))
    return g.filter("n >= 3 AND before < after").drop("n")


@query("q22_action_cues", with_views("timeline segments", "SELECT t.video_id, t.seq, (SELECT arg_min(s.seq, abs(s.start_ms - t.ms) * 1000 + s.seq) FROM segments s WHERE s.video_id = t.video_id) AS turn FROM timeline t WHERE t.event_type = 'click'"))
def q22(spark: SparkSession, d: str) -> DataFrame:
    clicks = timeline(spark, d).filter("event_type = 'click'").select("video_id", "seq", "ms")
    return nearest(clicks, _turns(spark, d), "video_id", ["seq"], "ms", "start_ms", "turn", ["turn"]).select("video_id", "seq", F.col("near_turn").alias("turn"))


@query("q24_first_three", with_views("timeline", "SELECT video_id, string_agg(event_type, ' > ' ORDER BY ms, seq) AS events FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms, seq) AS n FROM timeline) WHERE n <= 3 GROUP BY 1"))
def q24(spark: SparkSession, d: str) -> DataFrame:
    ordered = F.slice(F.array_sort(F.collect_list(F.struct("ms", "seq", "event_type"))), 1, 3)
    return timeline(spark, d).groupBy("video_id").agg(F.array_join(F.transform(ordered, lambda x: x["event_type"]), " > ").alias("events"))
