"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.plans.base import query
from quillstone.sources.adapters import as_double, cost_log, detections, frames, questions, segments, table, timeline, videos, with_views


def _when(condition: str) -> Column:
    return F.sum(F.expr(f"CASE WHEN {condition} THEN 1 END"))


def ratio(a: Column | str, b: Column | str, digits: int | None = None, empty: float | None = 0.0) -> Column:
    """a / b, rounded; ``empty`` where b is 0."""
    out = F.try_divide(a, b)
    out = out if digits is None else F.round(out, digits)
    return out if empty is None else F.coalesce(out, F.lit(empty))


@query("a01_review_progress", with_views("questions", "SELECT video_id, count(*) AS total, CAST(sum(CASE WHEN status = 'approved' THEN 1 END) AS BIGINT) AS approved, CAST(sum(CASE WHEN status = 'rejected' THEN 1 END) AS BIGINT) AS rejected, CAST(sum(CASE WHEN status = 'pending' THEN 1 END) AS BIGINT) AS pending, CAST(sum(CASE WHEN hallucinated = 1 THEN 1 END) AS BIGINT) AS hallucinated FROM questions GROUP BY 1"))
def a01(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).groupBy("video_id").agg(
        F.count(F.lit(1)).alias("total"), _when("status = 'approved'").alias("approved"), _when("status = 'rejected'").alias("rejected"),
        _when("status = 'pending'").alias("pending"), _when("hallucinated = 1").alias("hallucinated"),
    )


@query("a02_reviewer_stats", with_views("videos", "SELECT owner, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished FROM videos WHERE CAST(created AS DATE) >= DATE '1995-01-01' GROUP BY 1"))
def a02(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).filter("to_date(created) >= DATE'1995-01-01'").groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"), F.count_if(F.col("status") == "F").alias("finished"))


@query("a03_reviewer_rates", with_views("questions", "SELECT video_id, round(coalesce(count(*) FILTER (status = 'approved') / nullif(count(*) FILTER (status <> 'pending'), 0), 0) * 100, 1) AS rate FROM questions GROUP BY 1"))
def a03(spark: SparkSession, d: str) -> DataFrame:
    decided, approved = F.count_if(F.col("status") != "pending"), F.count_if(F.col("status") == "approved")
    return questions(spark, d).groupBy("video_id").agg(F.round(ratio(approved, decided) * 100, 1).alias("rate"))


@query("a04_progress_percent", with_views("questions", "SELECT video_id, round((count(*) - count(*) FILTER (status = 'pending')) / count(*) * 100, 1) AS reviewed, round(count(*) FILTER (status = 'approved') / count(*) * 100, 1) AS approved FROM questions GROUP BY 1"))
def a04(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return questions(spark, d).groupBy("video_id").agg(F.round(ratio(n - F.count_if(F.col("status") == "pending"), n) * 100, 1).alias("reviewed"), F.round(ratio(F.count_if(F.col("status") == "approved"), n) * 100, 1).alias("approved"))


@query("a05_evidence_stats_v1", with_views("detections", "SELECT video_id, count(*) FILTER (class <> 'N') AS approved, round(avg(confidence), 6) AS accuracy FROM detections GROUP BY 1"))
def a05(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).groupBy("video_id").agg(F.count_if(F.col("class") != "N").alias("approved"), F.round(F.avg("confidence"), 6).alias("accuracy"))


@query("a06_evidence_stats_v2", with_views("detections", "SELECT video_id, count(*) FILTER (class = 'A') AS approved, round(count(*) FILTER (class = 'A') / nullif(count(*) FILTER (class IN ('A', 'R')), 0), 3) AS accuracy FROM detections GROUP BY 1"))
def a06(spark: SparkSession, d: str) -> DataFrame:
    a = F.count_if(F.col("class") == "A")
    return detections(spark, d).groupBy("video_id").agg(a.alias("approved"), ratio(a, F.count_if(F.col("class").isin("A", "R")), 3, None).alias("accuracy"))


@query("a07_stage_progress", with_views("questions", "SELECT video_id, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'pending') = 0 AS complete FROM questions GROUP BY 1"))
def a07(spark: SparkSession, d: str) -> DataFrame:
    n, a, r = F.count(F.lit(1)), F.count_if(F.col("status") == "approved"), F.count_if(F.col("status") == "rejected")
    return questions(spark, d).groupBy("video_id").agg(a.alias("approved"), r.alias("rejected"), (n - a - r).alias("pending"), ((n - a - r == 0) & (n > 0)).alias("complete"))


@query("a08_derived_counters", with_views("questions", "SELECT video_id, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status IN ('approved', 'rejected')) AS progress FROM questions GROUP BY 1"))
def a08(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).groupBy("video_id").agg(F.count_if(F.col("status") == "approved").alias("approved"), F.count_if(F.col("status").isin("approved", "rejected")).alias("progress"))


@query("a09_queue_summary", with_views("videos", "SELECT priority, least(count(*), 1000) AS n FROM videos WHERE status = 'P' GROUP BY 1"))
def a09(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).filter("status = 'P'").groupBy("priority").agg(F.least(F.count(F.lit(1)), F.expr("1000L")).alias("n"))


@query("a10_global_analytics", with_views("cost_log", "SELECT count(DISTINCT video_id) AS videos, round(CAST(sum(amount) AS DOUBLE) / count(DISTINCT video_id), 2) AS mean_cost, round(count(*) FILTER (amount > 3000000) / count(*) * 100, 1) AS costly FROM cost_log"))
def a10(spark: SparkSession, d: str) -> DataFrame:
    per_video = cost_log(spark, d).groupBy("video_id").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount") > 3000000).alias("c"))
    return per_video.agg(F.count(F.lit(1)).alias("videos"), F.round(ratio(F.sum("amount").cast("double"), F.count(F.lit(1))), 2).alias("mean_cost"), F.round(ratio(F.sum("c"), F.sum("n")) * 100, 1).alias("costly"))


@query("a11_fixed_histogram", with_views("questions", "SELECT CASE WHEN n_chars < 500 THEN '<500' WHEN n_chars < 2000 THEN '<2000' WHEN n_chars < 5000 THEN '<5000' ELSE 'more' END AS bucket, count(*) AS n FROM questions GROUP BY 1"))
def a11(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("n_chars")
    return questions(spark, d).groupBy(F.when(c < 500, "<500").when(c < 2000, "<2000").when(c < 5000, "<5000").otherwise("more").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


_CATEGORIES = "VALUES ('view', 'passive'), ('click', 'active'), ('purchase', 'active'), ('error', 'fault'), ('refund', 'fault') AS c(event_type, category)"


@query("a12_type_rollup", with_views("timeline", "SELECT category, CAST(sum(n) AS BIGINT) AS n FROM (SELECT c.category, count(t.seq) AS n FROM (VALUES ('view', 'passive'), ('click', 'active'), ('purchase', 'active'), ('error', 'fault'), ('refund', 'fault')) c(event_type, category) LEFT JOIN timeline t USING (event_type) GROUP BY ALL) GROUP BY 1"))
def a12(spark: SparkSession, d: str) -> DataFrame:
    counts = timeline(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return spark.sql(f"SELECT * FROM {_CATEGORIES}").join(counts, "event_type", "left").groupBy("category").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@query("a13_redundancy", with_views("timeline", "SELECT video_id, CAST(sum(n - 1) AS BIGINT) AS redundancy FROM (SELECT video_id, event_type, count(*) AS n FROM timeline GROUP BY ALL) GROUP BY 1"))
def a13(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("video_id").agg(F.sum(F.col("n") - 1).alias("redundancy"))


@query("a14_balance", with_views("timeline", "SELECT video_id, round(1 / (1 + stddev_pop(n) / avg(n)), 6) AS balance FROM (SELECT video_id, event_type, count(*) AS n FROM timeline GROUP BY ALL) GROUP BY 1"))
def a14(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("video_id").agg(F.round(1 / (1 + F.stddev_pop("n") / F.avg("n")), 6).alias("balance"))


@query("a15_diversity_score", with_views("timeline", "SELECT video_id, round(greatest(0, least(1, 0.4 * count(*) / 5 + 0.3 / (1 + stddev_pop(n) / avg(n)) - least(0.001 * sum(n - 1), 0.3) + 0.06 * count(*))), 6) AS score FROM (SELECT video_id, event_type, count(*) AS n FROM timeline GROUP BY ALL) GROUP BY 1"))
def a15(spark: SparkSession, d: str) -> DataFrame:
    per_type = timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.count(F.lit(1))
    raw = kinds / 5 * 0.4 + 0.3 / (1 + F.stddev_pop("n") / F.avg("n")) - F.least(F.sum(F.col("n") - 1) * 0.001, F.lit(0.3)) + kinds * 0.06
    return per_type.groupBy("video_id").agg(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 6).alias("score"))


@query("a16_feedback_rollup", with_views("questions", "SELECT count(*) AS total, count(*) FILTER (status = 'approved') AS passed, count(*) FILTER (status = 'rejected') AS failed, round(count(*) FILTER (status = 'approved') / nullif(count(*) FILTER (status <> 'pending'), 0), 6) AS pass_rate, round(count(*) FILTER (hallucinated = 1) / nullif(count(hallucinated), 0), 6) AS hallucination_rate FROM questions"))
def a16(spark: SparkSession, d: str) -> DataFrame:
    ok, bad = F.count_if(F.col("status") == "approved"), F.count_if(F.col("status") == "rejected")
    return questions(spark, d).agg(F.count(F.lit(1)).alias("total"), ok.alias("passed"), bad.alias("failed"), ratio(ok, ok + bad, 6).alias("pass_rate"), ratio(F.count_if(F.col("hallucinated") == 1), F.count("hallucinated"), 6).alias("hallucination_rate"))


@query("a17_failures_by_layer", "SELECT layer, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS layer FROM part) GROUP BY 1")
def a17(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("layer")).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


_BY_TYPE = "SELECT question_type, count(*) AS total, count(*) FILTER (status = 'approved') / count(*) AS pass_rate, coalesce(count(*) FILTER (status = 'rejected') / nullif(count(*) FILTER (status <> 'pending'), 0), 0) AS fail_rate, count(*) FILTER (hallucinated = 1) / count(*) AS hallucination_rate FROM questions GROUP BY 1"


def performance_by_type(q: DataFrame) -> DataFrame:
    n, ok, bad = F.count(F.lit(1)), F.count_if(F.col("status") == "approved"), F.count_if(F.col("status") == "rejected")
    return q.groupBy("question_type").agg(n.alias("total"), ratio(ok, n).alias("pass_rate"), ratio(bad, ok + bad).alias("fail_rate"), ratio(F.count_if(F.col("hallucinated") == 1), n).alias("hallucination_rate"))


@query("a18_performance_by_type", with_views("questions", f"SELECT question_type, total, round(pass_rate, 6) AS pass_rate, round(fail_rate, 6) AS fail_rate, round(hallucination_rate, 6) AS hallucination_rate FROM ({_BY_TYPE})"))
def a18(spark: SparkSession, d: str) -> DataFrame:
    return performance_by_type(questions(spark, d)).select("question_type", "total", *[F.round(c, 6).alias(c) for c in ("pass_rate", "fail_rate", "hallucination_rate")])


@query("a19_type_scores", with_views("questions", f"SELECT question_type, round(0.4 * pass_rate + 0.4 * fail_rate - 0.2 * hallucination_rate, 6) AS score, rank() OVER (ORDER BY round(0.4 * pass_rate + 0.4 * fail_rate - 0.2 * hallucination_rate, 6) DESC, question_type) AS place FROM ({_BY_TYPE})"))
def a19(spark: SparkSession, d: str) -> DataFrame:
    score = F.round(F.col("pass_rate") * 0.4 + F.col("fail_rate") * 0.4 - F.col("hallucination_rate") * 0.2, 6)
    scored = performance_by_type(questions(spark, d)).select("question_type", score.alias("score"))  # one row per type
    return scored.withColumn("place", F.rank().over(Window.orderBy(F.desc("score"), "question_type")).cast("long"))


@query("a20_weighted_patterns", with_views("timeline", "SELECT event_type, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CAST(trunc(n * rate) AS BIGINT)) AS BIGINT) AS hits, round(least(1, count(*) / 9), 6) AS confidence FROM (SELECT video_id, event_type, count(*) AS n, count(*) FILTER (marker > 50) / count(*) AS rate FROM timeline GROUP BY ALL) GROUP BY 1 HAVING sum(n) >= 3"))
def a20(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"), ratio(F.count_if(F.col("marker") > 50), F.count(F.lit(1))).alias("rate"))
    return rows.groupBy("event_type").agg(F.sum("n").alias("total"), F.sum((F.col("n") * F.col("rate")).cast("long")).alias("hits"), F.round(F.least(F.lit(1.0), F.count(F.lit(1)) / 9), 6).alias("confidence")).filter("total >= 3")


@query("a21_weighted_mean", with_views("timeline", "SELECT event_type, round(sum(n * rate) / sum(n), 6) AS success FROM (SELECT video_id, event_type, count(*) AS n, avg(score) AS rate FROM timeline GROUP BY ALL) GROUP BY 1"))
def a21(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("rate"))
    return rows.groupBy("event_type").agg(F.round(F.sum(F.col("n") * F.col("rate")) / F.sum("n"), 6).alias("success"))


@query("a22_bucketed_mode", with_views("timeline", "SELECT video_id, arg_min(bucket, -n * 10 + bucket) AS mode_bucket FROM (SELECT video_id, CASE WHEN marker < 30 THEN 0 WHEN marker < 60 THEN 1 WHEN marker < 80 THEN 2 WHEN marker < 99 THEN 3 END AS bucket, count(*) AS n FROM timeline GROUP BY ALL) WHERE bucket IS NOT NULL GROUP BY 1"))
def a22(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("marker")
    b = F.when(m < 30, 0).when(m < 60, 1).when(m < 80, 2).when(m < 99, 3)
    counts = timeline(spark, d).groupBy("video_id", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).filter("bucket IS NOT NULL")
    return counts.groupBy("video_id").agg(F.min_by("bucket", F.struct(-F.col("n"), "bucket")).alias("mode_bucket"))


@query("a23_quartiles", with_views("timeline", "SELECT video_id, CASE WHEN count(*) >= 3 THEN round(quantile_cont(score, 0.25), 6) END AS low, CASE WHEN count(*) >= 3 THEN round(quantile_cont(score, 0.75), 6) END AS high, round(median(score), 6) AS middle, round(stddev_pop(score), 6) AS spread FROM timeline GROUP BY 1"))
def a23(spark: SparkSession, d: str) -> DataFrame:
    enough = F.count(F.lit(1)) >= 3
    q = lambda p: F.when(enough, F.round(F.percentile("score", p), 6))
    return timeline(spark, d).groupBy("video_id").agg(q(0.25).alias("low"), q(0.75).alias("high"), F.round(F.median("score"), 6).alias("middle"), F.round(F.stddev_pop("score"), 6).alias("spread"))


@query("a24_evidence_shape", with_views("timeline", "SELECT video_id, round(count(*) FILTER (a > 0 AND b > 0) / count(*), 6) AS both, round(avg(a), 6) AS mean_a, round(avg(b), 6) AS mean_b FROM (SELECT video_id, ms // 60000 AS w, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b FROM timeline GROUP BY ALL) GROUP BY 1 HAVING count(*) >= 3"))
def a24(spark: SparkSession, d: str) -> DataFrame:
    w = timeline(spark, d).groupBy("video_id", F.expr("ms DIV 60000").alias("w")).agg(F.count_if(F.col("event_type") == "view").alias("a"), F.count_if(F.col("event_type") == "click").alias("b"))
    return w.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.round(ratio(F.count_if((F.col("a") > 0) & (F.col("b") > 0)), F.count(F.lit(1))), 6).alias("both"), F.round(F.avg("a"), 6).alias("mean_a"), F.round(F.avg("b"), 6).alias("mean_b")).filter("n >= 3").drop("n")


@query("a25_model_accuracy", "SELECT model, count(*) AS n, count(*) FILTER (ok) AS correct FROM (SELECT 'tax' AS model, l_tax > 0.04 AS ok FROM lineitem UNION ALL SELECT 'discount', l_discount > 0.05 FROM lineitem UNION ALL SELECT 'quantity', l_quantity > 25 FROM lineitem) GROUP BY 1")
def a25(spark: SparkSession, d: str) -> DataFrame:
    wide = table(spark, d, "lineitem").select((F.col("l_tax") > 0.04).alias("tax"), (F.col("l_discount") > 0.05).alias("discount"), (F.col("l_quantity") > 25).alias("quantity"))
    counted = wide.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in wide.columns])  # one pass, then one row per model
    return counted.unpivot("n", ["tax", "discount", "quantity"], "model", "correct").select("model", "n", "correct")


@query("a26_error_patterns", with_views("detections", "SELECT class, line, count(*) AS n, round(count(*) / (SELECT count(*) FROM detections), 6) AS share FROM detections GROUP BY ALL HAVING count(*) >= 10"))
def a26(spark: SparkSession, d: str) -> DataFrame:
    groups = detections(spark, d).groupBy("class", "line").agg(F.count(F.lit(1)).alias("n"))  # few rows
    return groups.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6)).filter("n >= 10")


@query("a27_threshold_advice", as_double(with_views("detections", "SELECT class, CASE WHEN e > 0.3 THEN 0.70 WHEN e > 0.15 THEN 0.80 ELSE 0.85 END AS threshold FROM (SELECT class, count(*) FILTER (confidence < 0.93) / count(*) AS e FROM detections GROUP BY 1)"), "threshold"))
def a27(spark: SparkSession, d: str) -> DataFrame:
    e = ratio(F.count_if(F.col("confidence") < 0.93), F.count(F.lit(1)))
    return detections(spark, d).groupBy("class").agg(e.alias("e")).select("class", F.when(F.col("e") > 0.3, 0.70).when(F.col("e") > 0.15, 0.80).otherwise(0.85).alias("threshold"))


@query("a28_recent_performance", with_views("videos", "SELECT owner, count(*) AS n, round(count(*) FILTER (status = 'F') / count(*), 6) AS rate FROM videos WHERE created >= (SELECT max(created) FROM videos) - INTERVAL 365 DAY GROUP BY 1"))
def a28(spark: SparkSession, d: str) -> DataFrame:
    v = videos(spark, d)
    newest = v.agg(F.max("created").alias("newest"))  # one row
    return v.join(F.broadcast(newest), F.col("created") >= F.col("newest") - F.expr("INTERVAL 365 DAYS")).groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.round(ratio(F.count_if(F.col("status") == "F"), F.count(F.lit(1))), 6).alias("rate"))


@query("a29_benchmark_metrics", with_views("timeline", "SELECT event_type, count(*) AS n, count(*) FILTER (marker >= 50) AS passed, round(count(*) FILTER (marker >= 50) / count(*), 6) AS success, round(avg(score), 6) AS mean_cost, round(avg(score) FILTER (marker < 10), 6) AS mean_low FROM timeline GROUP BY 1"))
def a29(spark: SparkSession, d: str) -> DataFrame:
    n, ok = F.count(F.lit(1)), F.count_if(F.col("marker") >= 50)
    return timeline(spark, d).groupBy("event_type").agg(n.alias("n"), ok.alias("passed"), F.round(ratio(ok, n), 6).alias("success"), F.round(F.avg("score"), 6).alias("mean_cost"), F.round(F.avg(F.when(F.col("marker") < 10, F.col("score"))), 6).alias("mean_low"))


@query("a30_pattern_modes", with_views("timeline", "SELECT video_id, arg_min(event_type, struct_pack(n := -n, t := event_type)) AS commonest FROM (SELECT video_id, event_type, count(*) AS n FROM timeline WHERE marker < 50 GROUP BY ALL) GROUP BY 1"))
def a30(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("marker < 50").groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("video_id").agg(F.min_by("event_type", F.struct(-F.col("n"), "event_type")).alias("commonest"))


@query("a31_grade", with_views("timeline", "SELECT video_id, CASE WHEN r >= 0.6 THEN 'A' WHEN r >= 0.5 THEN 'B' WHEN r >= 0.4 THEN 'C' ELSE 'D' END AS grade FROM (SELECT video_id, count(*) FILTER (marker >= 50) / count(*) AS r FROM timeline GROUP BY 1)"))
def a31(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("r")
    return timeline(spark, d).groupBy("video_id").agg(ratio(F.count_if(F.col("marker") >= 50), F.count(F.lit(1))).alias("r")).select("video_id", F.when(r >= 0.6, "A").when(r >= 0.5, "B").when(r >= 0.4, "C").otherwise("D").alias("grade"))


@query("a32_batch_economics", with_views("cost_log", "SELECT count(*) AS videos, CAST(sum(c) AS BIGINT) AS cost, CAST(count(*) * 800 AS BIGINT) AS revenue, CAST(sum(c) // count(*) AS BIGINT) AS mean_cost FROM (SELECT video_id, sum(amount) AS c FROM cost_log GROUP BY 1)"))
def a32(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return cost_log(spark, d).groupBy("video_id").agg(F.sum("amount").alias("c")).agg(n.alias("videos"), F.sum("c").alias("cost"), (n * 800).alias("revenue"), F.expr("sum(c) DIV count(1)").alias("mean_cost"))


@query("a33_budget_state", with_views("cost_log", "SELECT video_id, category, CAST(sum(amount) AS BIGINT) AS spent, CASE WHEN sum(amount) > 8000000 THEN 'exceeded' WHEN sum(amount) > 7200000 THEN 'warning' ELSE 'ok' END AS state FROM cost_log GROUP BY ALL"))
def a33(spark: SparkSession, d: str) -> DataFrame:
    return cost_log(spark, d).groupBy("video_id", "category").agg(F.sum("amount").alias("spent")).withColumn("state", F.when(F.col("spent") > 8000000, "exceeded").when(F.col("spent") > 7200000, "warning").otherwise("ok"))


@query("a34_budget_remainder", with_views("cost_log", "SELECT video_id, CAST(greatest(0, 30000000 - sum(amount)) AS BIGINT) AS remaining, CASE WHEN greatest(0, 30000000 - sum(amount)) >= 15000000 THEN 'full' WHEN greatest(0, 30000000 - sum(amount)) >= 8000000 THEN 'selective' ELSE 'minimal' END AS strategy FROM cost_log GROUP BY 1"))
def a34(spark: SparkSession, d: str) -> DataFrame:
    left = cost_log(spark, d).groupBy("video_id").agg(F.greatest(F.lit(0), 30000000 - F.sum("amount")).alias("remaining"))
    return left.withColumn("strategy", F.when(F.col("remaining") >= 15000000, "full").when(F.col("remaining") >= 8000000, "selective").otherwise("minimal"))


@query("a35_category_totals", with_views("cost_log", "SELECT category, CAST(sum(amount) AS BIGINT) AS total FROM cost_log GROUP BY 1"))
def a35(spark: SparkSession, d: str) -> DataFrame:
    return cost_log(spark, d).groupBy("category").agg(F.sum("amount").alias("total"))


@query("a36_token_costs", "SELECT lang AS model, CAST(sum(n_chars // 4) AS BIGINT) AS tokens, round(sum(n_chars // 4) * CASE lang WHEN 'en' THEN 0.003 WHEN 'fr' THEN 0.015 ELSE 0.01 END / 1000, 6) AS cost FROM documents GROUP BY 1")
def a36(spark: SparkSession, d: str) -> DataFrame:
    rates = spark.sql("SELECT * FROM VALUES ('en', 0.003D), ('fr', 0.015D) AS r(model, rate)")
    used = table(spark, d, "documents").groupBy(F.col("lang").alias("model")).agg(F.sum(F.expr("n_chars DIV 4")).alias("tokens"))
    return used.join(F.broadcast(rates), "model", "left").select("model", "tokens", F.round(F.col("tokens") * F.coalesce("rate", F.lit(0.01)) / 1000, 6).alias("cost"))


@query("a37_monitoring", with_views("timeline", "SELECT round(count(*) FILTER (event_type = 'purchase') / count(*), 6) AS approval, round(avg(nullif(marker, 0)), 6) AS mean_marker FROM timeline"))
def a37(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).agg(F.round(ratio(F.count_if(F.col("event_type") == "purchase"), F.count(F.lit(1))), 6).alias("approval"), F.round(F.avg(F.nullif("marker", F.lit(0))), 6).alias("mean_marker"))


@query("a38_rejection_by_template", "SELECT regexp_extract(p_brand || ':' || p_type, ':([^:]*)$', 1) AS template, count(*) FILTER (p_size > 25) AS rejected, round(count(*) FILTER (p_size > 25) / count(*), 6) AS rate FROM part GROUP BY 1")
def a38(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("template", F.regexp_extract(F.concat_ws(":", "p_brand", "p_type"), ":([^:]*)$", 1))
    return p.groupBy("template").agg(F.count_if(F.col("p_size") > 25).alias("rejected"), F.round(ratio(F.count_if(F.col("p_size") > 25), F.count(F.lit(1))), 6).alias("rate"))


@query("a39_first_failing_layer", with_views("questions", "SELECT CASE WHEN n_chars < 100 THEN 'length' WHEN status = 'rejected' THEN 'review' WHEN hallucinated = 1 THEN 'content' ELSE 'none' END AS layer, count(*) AS n FROM questions GROUP BY 1"))
def a39(spark: SparkSession, d: str) -> DataFrame:
    layer = F.when(F.col("n_chars") < 100, "length").when(F.col("status") == "rejected", "review").when(F.col("hallucinated") == 1, "content").otherwise("none")
    return questions(spark, d).groupBy(layer.alias("layer")).agg(F.count(F.lit(1)).alias("n"))


@query("a40_violations", with_views("questions", "SELECT rule, status, count(*) AS n FROM (SELECT status, unnest(list_filter([CASE WHEN n_chars < 100 THEN 'short' END, CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN contains(text, '?') THEN 'mark' END], lambda x: x IS NOT NULL)) AS rule FROM questions) GROUP BY ALL"))
def a40(spark: SparkSession, d: str) -> DataFrame:
    rules = F.array_compact(F.array(F.when(F.col("n_chars") < 100, "short"), F.when(F.col("n_chars") > 5000, "long"), F.when(F.contains("text", F.lit("?")), "mark")))
    return questions(spark, d).select("status", F.explode(rules).alias("rule")).groupBy("rule", "status").agg(F.count(F.lit(1)).alias("n"))


_BINS = "SELECT video_id, ms // 1000 AS bin, max(CASE WHEN event_type = 'view' THEN marker / 100 END) AS a, max(CASE WHEN event_type = 'click' THEN marker / 100 END) AS v, max(CASE WHEN event_type = 'purchase' THEN marker / 100 END) AS s, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS signals, arg_max(ms, struct_pack(m := ms, s := seq)) AS at FROM timeline GROUP BY ALL"


def binned(t: DataFrame) -> DataFrame:
    """One row per video and second: the strongest signal of each kind, the kinds, and the last time."""
    best = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("marker") / 100))
    return t.groupBy("video_id", F.expr("ms DIV 1000").alias("bin")).agg(
        best("view").alias("a"), best("click").alias("v"), best("purchase").alias("s"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("signals"), F.max_by("ms", F.struct("ms", "seq")).alias("at"),
    )


@query("a41_one_second_bins", with_views("timeline", _BINS))
def a41(spark: SparkSession, d: str) -> DataFrame:
    return binned(timeline(spark, d))


@query("a42_weighted_fusion", with_views("timeline", f"SELECT video_id, bin, round(0.25 * coalesce(a, 0) + 0.25 * coalesce(v, 0) + 0.35 * coalesce(s, 0), 6) AS fused FROM ({_BINS}) WHERE coalesce(a, 0) + coalesce(v, 0) + coalesce(s, 0) > 0"))
def a42(spark: SparkSession, d: str) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    fused = zero("a") * 0.25 + zero("v") * 0.25 + zero("s") * 0.35
    return binned(timeline(spark, d)).filter(zero("a") + zero("v") + zero("s") > 0).select("video_id", "bin", F.round(fused, 6).alias("fused"))


@query("a43_signal_counts", with_views("timeline", "SELECT event_type, count(*) AS n FROM timeline GROUP BY 1"))
def a43(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a44_coverage_minimums", with_views("timeline", "SELECT m.event_type, m.least, count(t.seq) AS n FROM (VALUES ('view', 100), ('refund', 5), ('error', 1000000)) m(event_type, least) LEFT JOIN timeline t USING (event_type) GROUP BY ALL HAVING count(t.seq) < m.least"))
def a44(spark: SparkSession, d: str) -> DataFrame:
    least = spark.sql("SELECT * FROM VALUES ('view', 100), ('refund', 5), ('error', 1000000) AS m(event_type, least)")
    counts = timeline(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return least.join(counts, "event_type", "left").select("event_type", "least", F.coalesce("n", F.lit(0)).alias("n")).filter("n < least")


@query("a45_missing_types", with_views("timeline", "SELECT v.video_id, e.event_type FROM (SELECT DISTINCT video_id FROM timeline) v, (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('error'), ('refund')) e(event_type) WHERE NOT EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = v.video_id AND t.event_type = e.event_type)"))
def a45(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.array(*[F.lit(x) for x in ("view", "click", "purchase", "signup", "error", "refund")])
    return timeline(spark, d).groupBy("video_id").agg(F.collect_set("event_type").alias("has")).select("video_id", F.explode(F.array_except(wanted, "has")).alias("event_type"))


@query("a46_distinct_words", with_views("segments", "SELECT video_id, count(DISTINCT w) AS words FROM (SELECT video_id, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS w FROM segments) GROUP BY 1"))
def a46(spark: SparkSession, d: str) -> DataFrame:
    words = segments(spark, d).select("video_id", F.explode(F.array_remove(F.split(F.lower("text"), " "), "")).alias("w"))
    return words.groupBy("video_id").agg(F.count_distinct("w").alias("words"))


@query("a47_averages", with_views("frames", "SELECT scene_type, count(*) AS n, round(avg(embedding[1]), 6) AS quality FROM frames GROUP BY 1"))
def a47(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).groupBy("scene_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.get("embedding", F.lit(0))), 6).alias("quality"))


@query("a48_modality_diversity", with_views("segments", "SELECT video_id, count(DISTINCT CASE WHEN contains(lower(text), 'the') THEN 'a' WHEN contains(lower(text), 'der') THEN 'b' ELSE 'c' END) >= 2 AS diverse FROM segments GROUP BY 1"))
def a48(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.contains(F.lower("text"), F.lit("the")), "a").when(F.contains(F.lower("text"), F.lit("der")), "b").otherwise("c")
    return segments(spark, d).groupBy("video_id").agg((F.size(F.collect_set(kind)) >= 2).alias("diverse"))


@query("a49_adaptive_threshold", with_views("timeline", "SELECT video_id, CASE WHEN avg(coalesce(marker, 50)) > 55 THEN 28 WHEN avg(coalesce(marker, 50)) > 48 THEN 22 ELSE 15 END AS threshold FROM timeline GROUP BY 1"))
def a49(spark: SparkSession, d: str) -> DataFrame:
    m = F.avg(F.coalesce("marker", F.lit(50)))
    return timeline(spark, d).groupBy("video_id").agg(F.when(m > 55, 28).when(m > 48, 22).otherwise(15).alias("threshold"))


@query("a50_mode_first_tie", with_views("timeline", "SELECT video_id, arg_min(event_type, struct_pack(n := -n, s := first_seq)) AS dominant FROM (SELECT video_id, event_type, count(*) AS n, min(seq) AS first_seq FROM timeline GROUP BY ALL) GROUP BY 1"))
def a50(spark: SparkSession, d: str) -> DataFrame:
    counts = timeline(spark, d).groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))
    return counts.groupBy("video_id").agg(F.min_by("event_type", F.struct(-F.col("n"), "first_seq")).alias("dominant"))


@query("a51_level_histogram", with_views("timeline", "SELECT l.level, count(t.seq) AS n FROM (VALUES ('easy'), ('medium'), ('hard'), ('expert')) l(level) LEFT JOIN (SELECT seq, CASE WHEN marker >= 100 THEN 'expert' WHEN marker >= 60 THEN 'hard' WHEN marker >= 30 THEN 'medium' ELSE 'easy' END AS level FROM timeline) t USING (level) GROUP BY 1"))
def a51(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("marker")
    counts = timeline(spark, d).groupBy(F.when(m >= 100, "expert").when(m >= 60, "hard").when(m >= 30, "medium").otherwise("easy").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return spark.sql("SELECT * FROM VALUES ('easy'), ('medium'), ('hard'), ('expert') AS l(level)").join(counts, "level", "left").select("level", F.coalesce("n", F.lit(0)).alias("n"))


@query("a52_full_transcript", with_views("segments", "SELECT video_id, md5(string_agg(text, ' ' ORDER BY seq)) AS digest, count(*) AS n FROM segments GROUP BY 1"))
def a52(spark: SparkSession, d: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return segments(spark, d).groupBy("video_id").agg(F.md5(F.array_join(F.transform(ordered, lambda s: s["text"]), " ")).alias("digest"), F.count(F.lit(1)).alias("n"))


@query("a53_cue_span", with_views("timeline", "SELECT video_id, min(ms) AS start_ms, max(ms) + CASE WHEN arg_max(event_type, struct_pack(m := ms, s := seq)) IN ('view', 'click') THEN 1000 ELSE 0 END AS end_ms FROM timeline GROUP BY 1"))
def a53(spark: SparkSession, d: str) -> DataFrame:
    last = F.max_by("event_type", F.struct("ms", "seq"))
    return timeline(spark, d).groupBy("video_id").agg(F.min("ms").alias("start_ms"), (F.max("ms") + F.when(last.isin("view", "click"), 1000).otherwise(0)).alias("end_ms"))


@query("a54_selection_metrics", with_views("timeline", "SELECT video_id, round(avg(score), 6) AS mean, min(score) AS low, max(score) AS high, count(DISTINCT event_type) AS types FROM timeline WHERE marker >= 80 GROUP BY 1"))
def a54(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("marker >= 80").groupBy("video_id").agg(F.round(F.avg("score"), 6).alias("mean"), F.min("score").alias("low"), F.max("score").alias("high"), F.size(F.collect_set("event_type")).cast("long").alias("types"))


@query("a55_adversarial_share", with_views("questions", "SELECT question_type, count(*) FILTER (status = 'rejected' OR hallucinated = 1) AS adversarial, round(avg(CASE WHEN status = 'approved' THEN 1.0 ELSE 0.0 END), 6) AS success FROM questions GROUP BY 1"))
def a55(spark: SparkSession, d: str) -> DataFrame:
    hard = (F.col("status") == "rejected") | (F.coalesce("hallucinated", F.lit(0)) == 1)
    return questions(spark, d).groupBy("question_type").agg(F.count_if(hard).alias("adversarial"), F.round(F.avg(F.when(F.col("status") == "approved", 1.0).otherwise(0.0)), 6).alias("success"))


@query("a56_bottom_region", with_views("detections", "SELECT video_id, round(count(*) FILTER (y + h / 2 > 80) / count(*), 6) AS share, count(*) FILTER (y + h / 2 > 80) / count(*) < 0.3 AS passes FROM detections GROUP BY 1"))
def a56(spark: SparkSession, d: str) -> DataFrame:
    share = ratio(F.count_if(F.col("y") + F.col("h") / 2 > 80), F.count(F.lit(1)))
    return detections(spark, d).groupBy("video_id").agg(F.round(share, 6).alias("share"), (share < 0.3).alias("passes"))


@query("a57_optimal_span", with_views("timeline", "SELECT video_id, round_even((min(ms) - 100) / 1000, 1) AS start_s, round_even((max(ms) + 500) / 1000, 1) AS end_s FROM timeline GROUP BY 1"))
def a57(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).groupBy("video_id").agg(F.bround((F.min("ms") - 100) / 1000, 1).alias("start_s"), F.bround((F.max("ms") + 500) / 1000, 1).alias("end_s"))
