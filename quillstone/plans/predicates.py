"""Filter and projection queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.joins import range_join
from quillstone.plans.base import query
from quillstone.sources.adapters import detections, frames, questions, segments, table, timeline, videos, with_views


def in_intro_or_outro(at: Column, duration: Column, rule: str = "B") -> Column:
    """Whether a time (ms) is in the intro or the outro. A: fixed 10 and 30 s; B: a tenth, 15 s at most; C: 5 and 10 s."""
    if rule == "A":
        return (at < 10_000) | (at > duration - 30_000)
    if rule == "B":
        edge = F.least(duration * 0.1, F.lit(15_000))
        return (at < edge) | (at > duration - edge)
    if rule == "C":
        return (at < 5_000) | (at > duration - 10_000)
    raise ValueError(f"no rule {rule}")


@query("p01_equality_filter", with_views("videos", "SELECT video_id FROM videos WHERE status = 'P'"))
def p01(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).filter("status = 'P'").select("video_id")


@query("p02_conjunctive_order", with_views("questions", "SELECT question_id FROM questions WHERE video_id = 'src3' AND status = 'pending'"))
def p02(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).filter("video_id = 'src3' AND status = 'pending'").orderBy("question_id").select("question_id")


def optional(rows: DataFrame, **equal: object) -> DataFrame:
    """rows filtered by the arguments that are set."""
    for name, value in equal.items():
        if value:
            rows = rows.filter(F.col(name) == value)
    return rows


@query("p03_optional_predicate", with_views("videos", "SELECT video_id FROM videos WHERE priority = '1-URGENT' AND CAST(created AS DATE) >= DATE '1997-01-01'"))
def p03(spark: SparkSession, d: str) -> DataFrame:
    return optional(videos(spark, d), priority="1-URGENT", status=None).filter("created >= TIMESTAMP_NTZ'1997-01-01 00:00:00'").select("video_id")


@query("p04_public_record", with_views("videos", "SELECT video_id, status, strftime(created, '%Y-%m-%dT%H:%M:%S') AS created_at FROM videos"))
def p04(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).select("video_id", "status", F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))


@query("p05_two_thresholds", with_views("timeline", "SELECT seq FROM timeline WHERE score >= 3.0 AND marker >= 40"))
def p05(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("score >= 3.0 AND marker >= 40").select("seq")


@query("p06_adaptive_threshold", with_views("timeline", "SELECT seq FROM timeline WHERE marker / 100 >= CASE WHEN event_type = 'error' THEN 0.75 * 0.87 ELSE 0.75 END"))
def p06(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter(F.col("marker") / 100 >= F.when(F.col("event_type") == "error", 0.75 * 0.87).otherwise(0.75)).select("seq")


@query("p07_confidence_length", with_views("segments", "SELECT video_id, seq FROM segments WHERE length(text) >= 200 AND speaker <> 'system'"))
def p07(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter((F.length("text") >= 200) & (F.col("speaker") != "system")).select("video_id", "seq")


@query("p08_nested_search", with_views("segments", "SELECT video_id, seq, count(*) AS n FROM (SELECT video_id, seq, unnest(string_split(text, chr(10))) AS line FROM segments) WHERE contains(lower(line), 'the') GROUP BY ALL"))
def p08(spark: SparkSession, d: str) -> DataFrame:
    lines = segments(spark, d).select("video_id", "seq", F.explode(F.split("text", "\n")).alias("line"))
    return lines.filter(F.contains(F.lower("line"), F.lit("the"))).groupBy("video_id", "seq").agg(F.count(F.lit(1)).alias("n"))


@query("p09_min_score_head", with_views("timeline", "SELECT seq FROM timeline WHERE score >= 0.4 ORDER BY score DESC, seq LIMIT 50"))
def p09(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("score >= 0.4").orderBy(F.desc("score"), "seq").limit(50).select("seq")


@query("p10_any_frame_rule", with_views("timeline segments", "SELECT s.video_id, s.seq FROM segments s WHERE NOT EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = s.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms) OR EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = s.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms AND t.event_type = 'purchase')"))
def p10(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms")
    rule = range_join(timeline(spark, d).select("video_id", "ms", "event_type"), s, "video_id", "ms", "start_ms", "end_ms").groupBy("video_id", "turn").agg(F.bool_or(F.col("event_type") == "purchase").alias("ok"))
    return s.join(rule, ["video_id", "turn"], "left").filter("coalesce(ok, true)").select("video_id", F.col("turn").alias("seq"))


@query("p11_intro_rule_a", with_views("timeline", "SELECT seq FROM timeline WHERE ms < 10000 OR ms > 720000 - 30000"))
def p11(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter(in_intro_or_outro(F.col("ms"), F.lit(720_000), "A")).select("seq")


@query("p12_intro_rule_b", with_views("timeline", "SELECT seq FROM timeline WHERE ms < 15000 OR ms > 720000 - 15000"))
def p12(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter(in_intro_or_outro(F.col("ms"), F.lit(720_000), "B")).select("seq")


@query("p13_intro_rule_c", with_views("segments", "SELECT video_id, seq FROM segments WHERE start_ms < 5000 OR end_ms > 720000 - 10000"))
def p13(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter((F.col("start_ms") < 5_000) | (F.col("end_ms") > 720_000 - 10_000)).select("video_id", "seq")


@query("p14_intro_rule_d", with_views("timeline", "SELECT seq FROM (SELECT *, marker % 3 * 1000 AS intro_end FROM timeline) WHERE nullif(intro_end, 0) IS NOT NULL AND ms < intro_end * 20"))
def p14(spark: SparkSession, d: str) -> DataFrame:
    intro = F.nullif(F.col("marker") % 3 * 1000, F.lit(0))  # 0 means unset
    return timeline(spark, d).filter(F.coalesce(F.col("ms") < intro * 20, F.lit(False))).select("seq")


@query("p15_state_guard", with_views("questions", "SELECT question_id, CASE WHEN status <> 'rejected' THEN 'not rejected' WHEN question_id % 4 >= 3 THEN 'too many attempts' ELSE 'ok' END AS reason FROM questions"))
def p15(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).select("question_id", F.when(F.col("status") != "rejected", "not rejected").when(F.col("question_id") % 4 >= 3, "too many attempts").otherwise("ok").alias("reason"))


@query("p16_stage_gate", with_views("videos", "SELECT video_id FROM videos WHERE status IN ('P', 'O')"))
def p16(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).filter(F.col("status").isin("P", "O")).select("video_id")


@query("p17_class_category", with_views("detections", "SELECT video_id, part, supp, line, CASE class WHEN 'A' THEN 'person' WHEN 'N' THEN 'vehicle' ELSE 'other' END AS category FROM detections"))
def p17(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).select("video_id", "part", "supp", "line", F.when(F.col("class") == "A", "person").when(F.col("class") == "N", "vehicle").otherwise("other").alias("category"))


@query("p18_any_content_reject", "SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: regexp_matches(x, 'red|ring'))[1] AS first_hit FROM part WHERE regexp_matches(p_name, 'red|ring')")
def p18(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    return words.filter(F.exists("w", lambda x: x.rlike("red|ring"))).select("p_partkey", F.get(F.filter("w", lambda x: x.rlike("red|ring")), F.lit(0)).alias("first_hit"))


@query("p19_type_assignment", with_views("timeline", "SELECT seq FROM timeline WHERE list_contains(['view', 'click'], event_type) AND marker >= CASE event_type WHEN 'view' THEN 20 ELSE 50 END"))
def p19(spark: SparkSession, d: str) -> DataFrame:
    least = F.create_map(F.lit("view"), F.lit(20), F.lit("click"), F.lit(50))
    return timeline(spark, d).filter(F.col("event_type").isin("view", "click") & (F.col("marker") >= least[F.col("event_type")])).select("seq")


@query("p20_ui_filters", with_views("questions", "SELECT question_id FROM questions WHERE status = 'approved' AND question_type = 'en' AND contains(lower(text), 'the')"))
def p20(spark: SparkSession, d: str) -> DataFrame:
    return optional(questions(spark, d), status="approved", question_type="en").filter(F.contains(F.lower("text"), F.lit("the"))).select("question_id")


@query("p21_required_evidence", with_views("timeline", "SELECT video_id FROM timeline GROUP BY 1 HAVING count(*) FILTER (event_type = 'purchase') >= 10 AND count(*) FILTER (marker > 95) >= 2"))
def p21(spark: SparkSession, d: str) -> DataFrame:
    g = timeline(spark, d).groupBy("video_id").agg(F.count_if(F.col("event_type") == "purchase").alias("p"), F.count_if(F.col("marker") > 95).alias("m"))
    return g.filter("p >= 10 AND m >= 2").select("video_id")


@query("p22_window_predicates", with_views("segments", "SELECT video_id, seq, end_ms - start_ms >= CASE speaker WHEN 'user' THEN 30000 WHEN 'assistant' THEN 45000 ELSE 10000 END AS long_enough FROM segments"))
def p22(spark: SparkSession, d: str) -> DataFrame:
    least = F.coalesce(F.create_map(F.lit("user"), F.lit(30000), F.lit("assistant"), F.lit(45000))[F.col("speaker")], F.lit(10000))
    return segments(spark, d).select("video_id", "seq", (F.col("end_ms") - F.col("start_ms") >= least).alias("long_enough"))


@query("p23_dual_layout", with_views("frames", "SELECT frame_id, coalesce(CASE WHEN frame_id % 2 = 0 THEN scene_type END, CAST(trunc(embedding[1] * 100) AS INTEGER)) AS value FROM frames"))
def p23(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).select("frame_id", F.coalesce(F.when(F.col("frame_id") % 2 == 0, F.col("scene_type")), (F.try_element_at("embedding", F.lit(1)) * 100).cast("int")).alias("value"))
