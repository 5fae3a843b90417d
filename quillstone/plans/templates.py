"""Question templates: for every video the first evidence that a template can ask about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.pieces import greedy_min_gap
from quillstone.operators.joins import band_join, nearest_within, range_join
from quillstone.plans.base import query
from quillstone.sources.adapters import segments, timeline, with_views

_O = "PARTITION BY video_id ORDER BY ms, seq"
_FIRST = "arg_min({0}, struct_pack(m := ms, s := seq))"


def first(rows: DataFrame, *columns: str) -> DataFrame:
    """The earliest row of each video."""
    return rows.groupBy("video_id").agg(F.min_by(F.struct(*columns), F.struct("ms", "seq")).alias("r")).select("video_id", *[F.col(f"r.{c}").alias(c) for c in columns])


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms", "speaker")


def _in_order():
    return Window.partitionBy("video_id").orderBy("ms", "seq")


@query("q01_counting", with_views("timeline", "SELECT video_id, event_type, count(*) AS n FROM timeline WHERE event_type = 'purchase' AND ms BETWEEN 15000 AND 705000 GROUP BY ALL HAVING count(*) >= 3"))
def q01(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("event_type = 'purchase' AND ms BETWEEN 15000 AND 705000").groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")


@query("q02_temporal", with_views("timeline", f"SELECT video_id, {_FIRST.format('seq')} AS seq, {_FIRST.format('nxt')} AS nxt FROM (SELECT *, lead(seq) OVER ({_O}) AS nxt, lead(ms) OVER ({_O}) AS nms FROM timeline) WHERE nms - ms >= 5000 AND ms >= 15000 AND nms <= 705000 GROUP BY 1"))
def q02(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumns({"nxt": F.lead("seq").over(_in_order()), "nms": F.lead("ms").over(_in_order())})
    return first(t.filter("nms - ms >= 5000 AND ms >= 15000 AND nms <= 705000"), "seq", "nxt")


_CHAIN = """r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms, seq) AS n FROM timeline),
g AS (SELECT video_id, n, event_type, ms AS last_ms, true AS take FROM r WHERE n = 1 UNION ALL
  SELECT r.video_id, r.n, r.event_type, CASE WHEN r.ms - g.last_ms >= 5000 THEN r.ms ELSE g.last_ms END, r.ms - g.last_ms >= 5000 FROM g JOIN r ON r.video_id = g.video_id AND r.n = g.n + 1),
p AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n) AS place FROM g WHERE take)"""


@query("q03_sequential", with_views("timeline", "SELECT video_id, string_agg(event_type, ' > ' ORDER BY place) AS sequence FROM p WHERE place <= 3 GROUP BY 1 HAVING count(*) = 3", more=_CHAIN).replace("WITH ", "WITH RECURSIVE ", 1))
def q03(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).select("video_id", "ms", "seq", "event_type")
    three = greedy_min_gap(rows, ["video_id"], "ms", ["seq"], 5000, 3)
    in_turn = F.array_sort(F.collect_list(F.struct("ms", "seq", "event_type"))).alias("p")  # three at most
    return three.groupBy("video_id").agg(in_turn).filter(F.size("p") == 3).select("video_id", F.array_join(F.col("p.event_type"), " > ").alias("sequence"))


@query("q04_needle", with_views("timeline segments", f"SELECT video_id, {_FIRST.format('seq')} AS seq FROM timeline t WHERE marker >= 90 AND EXISTS (SELECT 1 FROM segments s WHERE s.video_id = t.video_id AND abs(s.start_ms - t.ms) <= 3000) GROUP BY 1"))
def q04(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).filter("marker >= 90").select("video_id", "seq", "ms")
    heard = nearest_within(t, _turns(spark, d), "video_id", ["seq"], "ms", "start_ms", ["turn"], 3000, ["turn"])
    return first(heard.filter("near_turn IS NOT NULL"), "seq")


@query("q05_referential", with_views("timeline segments", "SELECT video_id, min(seq) AS turn FROM (SELECT s.video_id, s.seq FROM segments s JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 10000 GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1"))
def q05(spark: SparkSession, d: str) -> DataFrame:
    near = band_join(_turns(spark, d), timeline(spark, d).select("video_id", "ms"), "video_id", "start_ms", "ms", 10000).groupBy("video_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    return near.filter("n >= 2").groupBy("video_id").agg(F.min("turn").alias("turn"))


@query("q07_comparative", with_views("timeline segments", "SELECT p.video_id, min(s.seq) AS turn FROM (SELECT video_id, min(ms) AS lo, max(ms) AS hi FROM timeline WHERE event_type = 'signup' GROUP BY 1 HAVING max(ms) - min(ms) >= 10000) p JOIN segments s ON s.video_id = p.video_id AND s.start_ms > lo AND s.start_ms < hi GROUP BY 1"))
def q07(spark: SparkSession, d: str) -> DataFrame:
    states = timeline(spark, d).filter("event_type = 'signup'").groupBy("video_id").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi")).filter("hi - lo >= 10000")
    return _turns(spark, d).join(states, "video_id").filter("start_ms > lo AND start_ms < hi").groupBy("video_id").agg(F.min("turn").alias("turn"))


@query("q08_inference", with_views("timeline", f"SELECT video_id, {_FIRST.format('seq')} AS seq FROM (SELECT *, lead(ms) OVER ({_O}) AS nms FROM timeline) WHERE nms - ms <= 10000 GROUP BY 1"))
def q08(spark: SparkSession, d: str) -> DataFrame:
    return first(timeline(spark, d).withColumn("nms", F.lead("ms").over(_in_order())).filter("nms - ms <= 10000"), "seq")


@query("q09_object_interaction", with_views("timeline", "SELECT t.video_id, count(*) AS actions FROM timeline t JOIN (SELECT video_id, min(ms) AS lo, max(ms) AS hi FROM timeline WHERE event_type = 'view' GROUP BY 1) p ON p.video_id = t.video_id AND t.ms > lo AND t.ms < hi AND t.event_type = 'click' GROUP BY 1"))
def q09(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    span = t.filter("event_type = 'view'").groupBy("video_id").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"))
    return t.filter("event_type = 'click'").join(span, "video_id").filter("ms > lo AND ms < hi").groupBy("video_id").agg(F.count(F.lit(1)).alias("actions"))


@query("q10_subscene", with_views("timeline", "SELECT video_id, arg_min(seq, struct_pack(m := ms, s := seq)) AS seq FROM (SELECT a.video_id, a.seq, a.ms FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.seq <> b.seq AND abs(a.ms - b.ms) < 5000 WHERE a.marker >= 90 GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1"))
def q10(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    near = band_join(t.filter("marker >= 90").select("video_id", "seq", "ms"), t.select("video_id", F.col("seq").alias("other"), F.col("ms").alias("other_ms")), "video_id", "ms", "other_ms", 5000, strict=True)
    return first(near.filter("seq <> other").groupBy("video_id", "seq", "ms").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2"), "seq")


@query("q11_holistic", with_views("timeline segments", "SELECT video_id, (SELECT count(*) FROM segments s WHERE s.video_id = g.video_id) AS turns FROM (SELECT video_id FROM timeline GROUP BY 1 HAVING count(*) >= 5 AND (max(ms) - min(ms)) / (count(*) - 1) < 12000) g WHERE (SELECT count(*) FROM segments s WHERE s.video_id = g.video_id) >= 2"))
def q11(spark: SparkSession, d: str) -> DataFrame:
    busy = timeline(spark, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), (F.max("ms") - F.min("ms")).alias("span")).filter("n >= 5 AND span < 12000 * (n - 1)")
    turns = _turns(spark, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("turns")).filter("turns >= 2")
    return busy.join(turns, "video_id").select("video_id", "turns")


@query("q12_av_stitching", with_views("timeline segments", "SELECT s.video_id, min(s.seq) AS turn FROM segments s JOIN timeline t ON t.video_id = s.video_id AND t.event_type = 'error' AND t.ms BETWEEN s.start_ms AND s.end_ms GROUP BY 1"))
def q12(spark: SparkSession, d: str) -> DataFrame:
    cuts = timeline(spark, d).filter("event_type = 'error'").select("video_id", "ms")
    return range_join(cuts, _turns(spark, d), "video_id", "ms", "start_ms", "end_ms").groupBy("video_id").agg(F.min("turn").alias("turn"))


@query("q16_causal", with_views("timeline", f"SELECT video_id, {_FIRST.format('seq')} AS seq, {_FIRST.format('event_type')} AS event_type FROM (SELECT *, lead(ms) OVER ({_O}) AS nms FROM timeline) WHERE nms - ms BETWEEN 1000 AND 10000 GROUP BY 1"))
def q16(spark: SparkSession, d: str) -> DataFrame:
    return first(timeline(spark, d).withColumn("nms", F.lead("ms").over(_in_order())).filter("nms - ms BETWEEN 1000 AND 10000"), "seq", "event_type")


@query("q14_temporal_counting", with_views("timeline", f"SELECT video_id, {_FIRST.format('seq')} AS seq FROM (SELECT *, lead(ms) OVER ({_O}) AS nms, count(*) FILTER (event_type = 'view') OVER ({_O} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM timeline) WHERE nms - ms >= 5000 AND later >= 3 GROUP BY 1"))
def q14(spark: SparkSession, d: str) -> DataFrame:
    later = F.count(F.when(F.col("event_type") == "view", 1)).over(_in_order().rowsBetween(1, Window.unboundedFollowing))
    return first(timeline(spark, d).withColumns({"nms": F.lead("ms").over(_in_order()), "later": later}).filter("nms - ms >= 5000 AND later >= 3"), "seq")


@query("q15_needle_after_events", with_views("timeline", f"SELECT video_id, {_FIRST.format('seq')} AS seq FROM (SELECT *, row_number() OVER ({_O}) AS n FROM timeline) WHERE marker >= 90 AND n > 2 GROUP BY 1"))
def q15(spark: SparkSession, d: str) -> DataFrame:
    return first(timeline(spark, d).withColumn("n", F.row_number().over(_in_order())).filter("marker >= 90 AND n > 2"), "seq")
