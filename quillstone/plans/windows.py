"""Window and order-based queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.pieces import dedupe_keep_better, greedy_min_gap, scene_cuts
from quillstone.operators.joins import dot
from quillstone.plans.base import query
from quillstone.sources.adapters import frames, segments, timeline, with_views


def by_video():
    return Window.partitionBy("video_id")


def in_order():
    return by_video().orderBy("ms", "seq")


_O = "PARTITION BY video_id ORDER BY ms, seq"


@query("w01_change_detection", with_views("segments", "SELECT video_id, seq, start_ms FROM (SELECT *, lag(coalesce(speaker, 'UNKNOWN')) OVER (PARTITION BY video_id ORDER BY seq) AS p FROM segments) WHERE p IS NOT NULL AND p <> coalesce(speaker, 'UNKNOWN')"))
def w01(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("s", F.coalesce("speaker", F.lit("UNKNOWN")))
    return s.withColumn("p", F.lag("s").over(by_video().orderBy("seq"))).filter("p IS NOT NULL AND p <> s").select("video_id", "seq", "start_ms")


@query("w02_gap_detection", with_views("timeline", f"SELECT video_id, seq, nxt - ms AS gap FROM (SELECT *, lead(ms) OVER ({_O}) AS nxt FROM timeline) WHERE nxt - ms > 30000"))
def w02(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).withColumn("gap", F.lead("ms").over(in_order()) - F.col("ms")).filter("gap > 30000").select("video_id", "seq", "gap")


@query("w03_neighbour_anomaly", with_views("frames", "SELECT a.frame_id, round(avg(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 6) AS likeness FROM frames a JOIN frames b ON a.video_id = b.video_id AND abs(a.frame_id - b.frame_id) BETWEEN 1 AND 5 GROUP BY 1 HAVING avg(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) < 0"))
def w03(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    near = F.collect_list(F.struct("frame_id", "embedding")).over(by_video().orderBy("frame_id").rowsBetween(-5, 5))
    scores = F.transform(F.filter("near", lambda n: n["frame_id"] != F.col("frame_id")), lambda n: dot(F.col("embedding"), n["embedding"]))
    mean = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / F.size("scores")
    return f.withColumn("near", near).withColumn("scores", scores).filter(F.size("scores") > 0).withColumn("mean", mean).filter("mean < 0").select("frame_id", F.round("mean", 6).alias("likeness"))


@query("w04_trailing_spike", with_views("timeline", f"SELECT video_id, seq FROM (SELECT *, avg(marker) OVER ({_O} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m, row_number() OVER ({_O}) AS n FROM timeline) WHERE n > 10 AND marker > 1.8 * m"))
def w04(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumns({"m": F.avg("marker").over(in_order().rowsBetween(-9, 0)), "n": F.row_number().over(in_order())})
    return t.filter((F.col("n") > 10) & (F.col("marker") > F.col("m") * F.lit(1.8))).select("video_id", "seq")


@query("w05_global_zscore", with_views("timeline", "SELECT video_id, seq, round(least((marker - m) / s / 3, 1), 6) AS confidence FROM timeline JOIN (SELECT video_id, avg(marker) AS m, stddev_pop(marker) AS s FROM timeline GROUP BY 1) USING (video_id) WHERE marker > m + 1.5 * s"))
def w05(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    stats = t.groupBy("video_id").agg(F.avg("marker").alias("m"), F.stddev_pop("marker").alias("s"))
    return t.join(stats, "video_id").filter("marker > m + 1.5 * s").select("video_id", "seq", F.round(F.least((F.col("marker") - F.col("m")) / F.col("s") / 3, F.lit(1.0)), 6).alias("confidence"))


@query("w06_percentile_threshold", with_views("timeline", "SELECT video_id, seq, round(marker / mx, 6) AS confidence FROM timeline JOIN (SELECT video_id, quantile_cont(marker, 0.8) AS p, max(marker) AS mx FROM timeline GROUP BY 1) USING (video_id) WHERE marker > p"))
def w06(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    stats = t.groupBy("video_id").agg(F.percentile("marker", 0.8).alias("p"), F.max("marker").alias("mx"))
    return t.join(stats, "video_id").filter("marker > p").select("video_id", "seq", F.round(F.col("marker") / F.col("mx"), 6).alias("confidence"))


@query("w07_calibrated_threshold", with_views("timeline", f"SELECT video_id, round(greatest(20, least(60, quantile_cont(diff, 0.85))), 6) AS threshold FROM (SELECT video_id, abs(marker - lag(marker) OVER ({_O})) AS diff FROM timeline) WHERE diff IS NOT NULL GROUP BY 1"))
def w07(spark: SparkSession, d: str) -> DataFrame:
    diffs = timeline(spark, d).withColumn("diff", F.abs(F.col("marker") - F.lag("marker").over(in_order()))).filter("diff IS NOT NULL")
    return diffs.groupBy("video_id").agg(F.round(F.greatest(F.lit(20.0), F.least(F.lit(60.0), F.percentile("diff", 0.85))), 6).alias("threshold"))


_SESSIONS = f"SELECT *, sum(CASE WHEN gap IS NULL OR gap > 10000 THEN 1 ELSE 0 END) OVER ({_O}) AS session FROM (SELECT *, ms - lag(ms) OVER ({_O}) AS gap FROM timeline)"


@query("w09_capped_clusters", with_views("timeline", f"SELECT video_id, CAST(session AS BIGINT) AS session, (n - 1) // 4 AS part, count(*) AS size, min(ms) AS start_ms, max(ms) AS end_ms FROM (SELECT *, row_number() OVER (PARTITION BY video_id, session ORDER BY ms, seq) AS n FROM ({_SESSIONS})) GROUP BY ALL HAVING count(*) >= 2"))
def w09(spark: SparkSession, d: str) -> DataFrame:
    gap = F.col("ms") - F.lag("ms").over(in_order())
    s = timeline(spark, d).withColumn("gap", gap).withColumn("session", F.sum(F.when(F.col("gap").isNull() | (F.col("gap") > 10000), 1).otherwise(0)).over(in_order()))
    n = F.row_number().over(Window.partitionBy("video_id", "session").orderBy("ms", "seq"))
    return s.withColumn("n", n).groupBy("video_id", "session", F.expr("(n - 1) DIV 4").alias("part")).agg(F.count(F.lit(1)).alias("size"), F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms")).filter("size >= 2")


@query("w10_islands", with_views("timeline", f"SELECT video_id, min(ms) AS start_ms, max(ms) AS end_ms, max(ms) - min(ms) > 20000 AS long FROM (SELECT *, sum(CASE WHEN low IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER ({_O}) AS island FROM (SELECT *, lag(low) OVER ({_O}) AS p FROM (SELECT *, marker < 40 AS low FROM timeline))) WHERE low GROUP BY video_id, island HAVING max(ms) - min(ms) > 3000"))
def w10(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("low", F.col("marker") < 40).withColumn("p", F.lag("low").over(in_order()))
    runs = t.withColumn("island", F.sum(F.when(F.col("low").eqNullSafe(F.col("p")), 0).otherwise(1)).over(in_order())).filter("low")
    return runs.groupBy("video_id", "island").agg(F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms")).filter("end_ms - start_ms > 3000").select("video_id", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms") > 20000).alias("long"))


@query("w11_state_change", with_views("timeline", f"SELECT video_id, seq, CASE WHEN p IS NULL THEN 'start' ELSE 'change' END AS kind FROM (SELECT *, lag(event_type) OVER ({_O}) AS p FROM timeline) WHERE p IS DISTINCT FROM event_type"))
def w11(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("p", F.lag("event_type").over(in_order())).filter(~F.col("p").eqNullSafe(F.col("event_type")))
    return t.select("video_id", "seq", F.when(F.col("p").isNull(), "start").otherwise("change").alias("kind"))


@query("w12_first_appearance", with_views("timeline", "SELECT event_type, marker, arg_min(seq, struct_pack(m := ms, s := seq)) AS first_seq FROM timeline GROUP BY ALL"))
def w12(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).groupBy("event_type", "marker").agg(F.min_by("seq", F.struct("ms", "seq")).alias("first_seq"))


@query("w13_first_last_state", with_views("timeline", "SELECT video_id, event_type, arg_min(marker, struct_pack(m := ms, s := seq)) AS first_marker, arg_max(marker, struct_pack(m := ms, s := seq)) AS last_marker FROM timeline GROUP BY ALL HAVING count(*) >= 2 AND max(ms) - min(ms) >= 10000 AND arg_min(marker, struct_pack(m := ms, s := seq)) <> arg_max(marker, struct_pack(m := ms, s := seq))"))
def w13(spark: SparkSession, d: str) -> DataFrame:
    at = F.struct("ms", "seq")
    g = timeline(spark, d).groupBy("video_id", "event_type").agg(F.min_by("marker", at).alias("first_marker"), F.max_by("marker", at).alias("last_marker"), F.count(F.lit(1)).alias("n"), (F.max("ms") - F.min("ms")).alias("span"))
    return g.filter("n >= 2 AND span >= 10000 AND first_marker <> last_marker").select("video_id", "event_type", "first_marker", "last_marker")


@query("w14_adjacent_pair", with_views("timeline", f"SELECT video_id, arg_min(seq, struct_pack(m := ms, s := seq)) AS seq, arg_min(nxt, struct_pack(m := ms, s := seq)) AS nxt FROM (SELECT *, lead(seq) OVER ({_O}) AS nxt, lead(ms) OVER ({_O}) AS nms FROM timeline) WHERE nms - ms BETWEEN 1000 AND 10000 AND ms >= 15000 AND nms <= 705000 GROUP BY 1"))
def w14(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumns({"nxt": F.lead("seq").over(in_order()), "nms": F.lead("ms").over(in_order())}).filter("nms - ms BETWEEN 1000 AND 10000 AND ms >= 15000 AND nms <= 705000")
    at = F.struct("ms", "seq")
    return t.groupBy("video_id").agg(F.min_by("seq", at).alias("seq"), F.min_by("nxt", at).alias("nxt"))


_GREEDY = "r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms, seq) AS n FROM timeline), g AS (SELECT video_id, n, seq, ms, ms AS last_ms, 1 AS taken, true AS take FROM r WHERE n = 1 UNION ALL SELECT r.video_id, r.n, r.seq, r.ms, CASE WHEN r.ms - g.last_ms >= 5000 AND g.taken < 3 THEN r.ms ELSE g.last_ms END, CASE WHEN r.ms - g.last_ms >= 5000 AND g.taken < 3 THEN g.taken + 1 ELSE g.taken END, r.ms - g.last_ms >= 5000 AND g.taken < 3 FROM g JOIN r ON r.video_id = g.video_id AND r.n = g.n + 1)"


@query("w15_greedy_min_gap", with_views("timeline", "SELECT video_id, seq FROM g WHERE take", more=_GREEDY).replace("WITH ", "WITH RECURSIVE ", 1))
def w15(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).select("video_id", "ms", "seq")
    return greedy_min_gap(rows, ["video_id"], "ms", ["seq"], 5000, 3).select("video_id", "seq")


_DEDUP = """r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms, seq) AS n FROM timeline),
g AS (SELECT video_id, n, ms AS last_ms, seq AS kept, score FROM r WHERE n = 1 UNION ALL
  SELECT r.video_id, r.n, CASE WHEN r.ms - g.last_ms >= 5000 THEN r.ms ELSE g.last_ms END, CASE WHEN r.ms - g.last_ms >= 5000 OR r.score > g.score THEN r.seq ELSE g.kept END, CASE WHEN r.ms - g.last_ms >= 5000 OR r.score > g.score THEN r.score ELSE g.score END
  FROM g JOIN r ON r.video_id = g.video_id AND r.n = g.n + 1)"""


@query("w16_greedy_dedup", with_views("timeline", "SELECT video_id, arg_max(kept, n) AS seq FROM g GROUP BY video_id, last_ms", more=_DEDUP).replace("WITH ", "WITH RECURSIVE ", 1))
def w16(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).select("video_id", "ms", "seq", "score")
    return dedupe_keep_better(rows, ["video_id"], "ms", ["seq"], "score", 5000).select("video_id", "seq")


_SCENES = """r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms, seq) AS n FROM timeline),
g AS (SELECT video_id, n, ms, ms AS last_ms, [marker::DOUBLE] AS past, false AS cut FROM r WHERE n = 1 UNION ALL
  SELECT *, coalesce(list_sum(past) / len(past) > 60 AND ms - last_ms >= 20000, false) FROM (
    SELECT r.video_id, r.n, r.ms, CASE WHEN g.cut THEN g.ms ELSE g.last_ms END AS last_ms, list_append(CASE WHEN g.cut THEN [] ELSE g.past[-4:] END, r.marker::DOUBLE) AS past
    FROM g JOIN r ON r.video_id = g.video_id AND r.n = g.n + 1))"""


@query("w08_scene_cuts", with_views("timeline", "SELECT video_id, ms AS cut_ms FROM g WHERE cut", more=_SCENES).replace("WITH ", "WITH RECURSIVE ", 1))
def w08(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).select("video_id", "ms", "seq", "marker")
    return scene_cuts(rows, ["video_id"], "ms", ["seq"], "marker", 60.0, 20000).select("video_id", F.col("ms").alias("cut_ms"))


@query("w17_block_trend", with_views("timeline", "SELECT video_id, CASE WHEN avg(marker) FILTER (n <= 10) - avg(marker) FILTER (n > 10) > 5 THEN 'up' WHEN avg(marker) FILTER (n <= 10) - avg(marker) FILTER (n > 10) < -5 THEN 'down' ELSE 'stable' END AS trend FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ms DESC, seq DESC) AS n FROM timeline) WHERE n <= 20 GROUP BY 1 HAVING count(*) = 20"))
def w17(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("n", F.row_number().over(by_video().orderBy(F.desc("ms"), F.desc("seq")))).filter("n <= 20")
    change = F.avg(F.when(F.col("n") <= 10, F.col("marker"))) - F.avg(F.when(F.col("n") > 10, F.col("marker")))
    g = t.groupBy("video_id").agg(change.alias("c"), F.count(F.lit(1)).alias("k")).filter("k = 20")
    return g.select("video_id", F.when(F.col("c") > 5, "up").when(F.col("c") < -5, "down").otherwise("stable").alias("trend"))


@query("w18_largest_change", with_views("timeline", f"SELECT video_id, round(max(abs(marker - p) / (p + 1e-10)), 4) AS change FROM (SELECT *, lag(marker) OVER ({_O}) AS p FROM timeline) WHERE p > 0 GROUP BY 1"))
def w18(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("p", F.lag("marker").over(in_order())).filter("p > 0")
    return t.groupBy("video_id").agg(F.round(F.max(F.abs(F.col("marker") - F.col("p")) / (F.col("p") + F.lit(1e-10))), 4).alias("change"))


@query("w19_hash_difference", with_views("timeline", f"SELECT video_id, max(diff) AS most, round(avg(diff), 6) AS mean, avg(diff) < 3 AS static FROM (SELECT video_id, CAST(bit_count(xor(marker, lag(marker) OVER ({_O}))) AS INTEGER) AS diff FROM timeline) WHERE diff IS NOT NULL GROUP BY 1"))
def w19(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("diff", F.bit_count(F.col("marker").bitwiseXOR(F.lag("marker").over(in_order())))).filter("diff IS NOT NULL")
    return t.groupBy("video_id").agg(F.max("diff").alias("most"), F.round(F.avg("diff"), 6).alias("mean"), (F.avg("diff") < 3).alias("static"))


@query("w20_sliding_count", with_views("timeline", f"SELECT video_id, w * 5 AS first_row, count(*) AS n, CAST(sum(marker) AS BIGINT) AS total FROM (SELECT video_id, marker, unnest(list_filter([k // 5, k // 5 - 1], lambda x: x >= 0)) AS w FROM (SELECT *, row_number() OVER ({_O}) - 1 AS k FROM timeline)) GROUP BY ALL"))
def w20(spark: SparkSession, d: str) -> DataFrame:
    # A row is in the windows that start at its multiple of five and at the one before.
    t = timeline(spark, d).withColumn("k", F.row_number().over(in_order()) - 1).withColumn("h", F.expr("k DIV 5"))
    w = t.select("video_id", "marker", F.explode(F.filter(F.array("h", F.col("h") - 1), lambda x: x >= 0)).alias("w"))
    return w.groupBy("video_id", (F.col("w") * 5).alias("first_row")).agg(F.count(F.lit(1)).alias("n"), F.sum("marker").alias("total"))


@query("w21_tumbling_change", with_views("timeline", "SELECT video_id, w, round(m, 4) AS tempo, abs(m - p) > 20 AS changed FROM (SELECT *, lag(m) OVER (PARTITION BY video_id ORDER BY w) AS p FROM (SELECT video_id, ms // 5000 AS w, avg(marker) AS m FROM timeline GROUP BY ALL))"))
def w21(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).groupBy("video_id", F.expr("ms DIV 5000").alias("w")).agg(F.avg("marker").alias("m"))
    return t.withColumn("p", F.lag("m").over(by_video().orderBy("w"))).select("video_id", "w", F.round("m", 4).alias("tempo"), (F.abs(F.col("m") - F.col("p")) > 20).alias("changed"))


@query("w22_mean_gap", with_views("timeline", "SELECT video_id, round((max(ms) - min(ms)) / (count(*) - 1), 4) AS gap, (max(ms) - min(ms)) / (count(*) - 1) < 3000 AS rapid FROM timeline GROUP BY 1 HAVING count(*) >= 5"))
def w22(spark: SparkSession, d: str) -> DataFrame:
    gap = (F.max("ms") - F.min("ms")) / F.nullif(F.count(F.lit(1)) - 1, F.lit(0))
    return timeline(spark, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.round(gap, 4).alias("gap"), (gap < 3000).alias("rapid")).filter("n >= 5").drop("n")


@query("w23_ordinal_rank", with_views("timeline", "SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, seq) AS place FROM timeline"))
def w23(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).select("video_id", "seq", F.row_number().over(by_video().orderBy(F.desc("score"), "seq")).cast("long").alias("place"))


@query("w24_fixed_batches", with_views("timeline", f"SELECT video_id, (n - 1) // 20 AS batch, count(*) AS size, min(seq) AS first_seq FROM (SELECT *, row_number() OVER ({_O}) AS n FROM timeline) GROUP BY ALL"))
def w24(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("n", F.row_number().over(in_order()))
    return t.groupBy("video_id", F.expr("(n - 1) DIV 20").alias("batch")).agg(F.count(F.lit(1)).alias("size"), F.min("seq").alias("first_seq"))


@query("w25_utterances", with_views("timeline", f"SELECT video_id, min(ms) AS start_ms, max(ms) AS end_ms, string_agg(event_type, ' ' ORDER BY ms, seq) AS text FROM (SELECT *, sum(CASE WHEN ended THEN 1 ELSE 0 END) OVER ({_O}) AS u FROM (SELECT *, coalesce(lag(event_type = 'purchase') OVER ({_O}) OR ms - lag(ms) OVER ({_O}) > 10000, false) AS ended FROM timeline)) GROUP BY video_id, u"))
def w25(spark: SparkSession, d: str) -> DataFrame:
    ended = F.coalesce(F.lag(F.col("event_type") == "purchase").over(in_order()) | (F.col("ms") - F.lag("ms").over(in_order()) > 10000), F.lit(False))
    t = timeline(spark, d).withColumn("ended", ended).withColumn("u", F.sum(F.when(F.col("ended"), 1).otherwise(0)).over(in_order()))
    words = F.array_sort(F.collect_list(F.struct("ms", "seq", "event_type")))
    return t.groupBy("video_id", "u").agg(F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"), F.array_join(F.transform(words, lambda w: w["event_type"]), " ").alias("text")).drop("u")
