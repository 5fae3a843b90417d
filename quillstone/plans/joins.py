"""Join queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.joins import band_join, dot, iou, nearest, nearest_within, range_join
from quillstone.operators.skew import kept
from quillstone.plans.base import query
from quillstone.sources.adapters import cost_log, detections, frames, questions, segments, table, timeline, videos, with_views


@query("j01_failures_of_video", with_views("questions", "SELECT q.video_id, q.question_id, l.quality, q.n_chars AS failure_score, coalesce(nullif(l.toxic, 0), q.n_chars) AS combined_score FROM questions q JOIN labels l ON q.question_id = l.doc_id WHERE l.quality = 0"))
def j01(spark: SparkSession, d: str) -> DataFrame:
    failed = table(spark, d, "labels").filter("quality = 0").select(F.col("doc_id").alias("question_id"), "quality", "toxic")
    return questions(spark, d).join(failed, "question_id").select("video_id", "question_id", "quality", F.col("n_chars").alias("failure_score"), F.coalesce(F.nullif("toxic", F.lit(0)).cast("long"), "n_chars").alias("combined_score"))


@query("j02_two_left_joins", "SELECT d.doc_id AS question_id, l.quality, b.item_id FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON d.doc_id = b.item_id")
def j02(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    items = table(spark, d, "benchmark").select(F.col("item_id"), F.col("item_id").alias("doc_id"))
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").join(items, "doc_id", "left").select(F.col("doc_id").alias("question_id"), "quality", "item_id")


@query("j03_left_join_defaults", "SELECT d.doc_id AS question_id, CASE WHEN l.doc_id IS NULL THEN 'skipped' WHEN quality = 1 THEN 'passed' ELSE 'failed' END AS test_status, coalesce(toxic = 1, false) AS hallucinated, CASE WHEN coalesce(toxic, 0) = 1 THEN 'high' ELSE 'none' END AS severity FROM documents d LEFT JOIN labels l USING (doc_id)")
def j03(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").withColumn("known", F.lit(True))
    return table(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("question_id"),
        F.when(F.col("known").isNull(), "skipped").when(F.col("quality") == 1, "passed").otherwise("failed").alias("test_status"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("hallucinated"),
        F.when(F.coalesce("toxic", F.lit(0)) == 1, "high").otherwise("none").alias("severity"),
    )


@query("j04_type_map_default", "SELECT c.c_custkey, coalesce(n.n_name, 'unknown') AS type_name FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 10) n ON c.c_nationkey = n.n_nationkey")
def j04(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "nation").filter("n_nationkey < 10").select("n_nationkey", "n_name")
    return table(spark, d, "customer").join(names, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("type_name"))


@query("j05_interval_join_dissimilar", with_views("frames", "SELECT f.frame_id, g.frame_id AS text_id, round(1 - list_dot_product(CAST(f.embedding AS DOUBLE[]), CAST(g.embedding AS DOUBLE[])), 6) AS mismatch FROM frames f JOIN frames g ON f.video_id = g.video_id AND f.ms BETWEEN g.ms AND g.ms + 3000 WHERE list_dot_product(CAST(f.embedding AS DOUBLE[]), CAST(g.embedding AS DOUBLE[])) < 0.0"))
def j05(spark: SparkSession, d: str) -> DataFrame:
    images = frames(spark, d).select("video_id", "frame_id", "ms", "embedding")
    texts = frames(spark, d).select("video_id", F.col("frame_id").alias("text_id"), F.col("ms").alias("start_ms"), (F.col("ms") + 3000).alias("end_ms"), F.col("embedding").alias("text_embedding"))
    similarity = dot(F.col("embedding"), F.col("text_embedding"))
    return range_join(images, texts, "video_id", "ms", "start_ms", "end_ms").withColumn("s", similarity).filter("s < 0.0").select("frame_id", "text_id", F.round(1 - F.col("s"), 6).alias("mismatch"))


@query(
    "j06_interval_then_nearest",
    with_views(
        "timeline segments",
        "SELECT t.video_id, t.seq, coalesce((SELECT min_by(s.speaker, s.seq) FROM segments s WHERE s.video_id = t.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms), (SELECT arg_min(s.speaker, abs(s.start_ms - t.ms) * 1000 + s.seq) FROM segments s WHERE s.video_id = t.video_id), 'SPEAKER_00') AS speaker FROM timeline t",
    ),
)
def j06(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).select("video_id", "seq", "ms")
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms", "speaker")
    inside = range_join(t, s, "video_id", "ms", "start_ms", "end_ms").groupBy("video_id", "seq").agg(F.min_by("speaker", "turn").alias("inside"))
    near = nearest(t, s, "video_id", ["seq"], "ms", "start_ms", "turn", ["speaker"])
    return near.join(inside, ["video_id", "seq"], "left").select("video_id", "seq", F.coalesce("inside", "near_speaker", F.lit("SPEAKER_00")).alias("speaker"))


_NEAR = "SELECT t.video_id, t.seq, (SELECT arg_min(s.seq, abs(s.start_ms - t.ms) * 1000 + s.seq) FROM segments s WHERE s.video_id = t.video_id{0}) AS near_turn FROM timeline t"


@query("j07_nearest_within", with_views("timeline segments", _NEAR.format(" AND abs(s.start_ms - t.ms) <= 3000")))
def j07(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms")
    return nearest_within(timeline(spark, d).select("video_id", "seq", "ms"), s, "video_id", ["seq"], "ms", "start_ms", ["turn"], 3000, ["turn"]).select("video_id", "seq", "near_turn")


@query("j08_nearest_unbounded", with_views("timeline segments", _NEAR.format("")))
def j08(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms")
    return nearest(timeline(spark, d).select("video_id", "seq", "ms"), s, "video_id", ["seq"], "ms", "start_ms", "turn", ["turn"]).select("video_id", "seq", "near_turn")


@query(
    "j09_nearest_of_kinds",
    with_views(
        "timeline segments",
        "SELECT s.video_id, s.seq, (SELECT arg_min(t.event_type, (abs(t.ms - s.start_ms) * 10 + CASE t.event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END) * 1000000000 + t.seq) FROM timeline t WHERE t.video_id = s.video_id AND t.event_type IN ('view', 'click', 'error') AND abs(t.ms - s.start_ms) <= 2000) AS near_event_type FROM segments s",
    ),
)
def j09(spark: SparkSession, d: str) -> DataFrame:
    kinds = timeline(spark, d).filter(F.col("event_type").isin("view", "click", "error")).select("video_id", "ms", F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2).alias("kind"), F.col("seq").alias("event"), "event_type")
    return nearest_within(segments(spark, d).select("video_id", "seq", "start_ms"), kinds, "video_id", ["seq"], "start_ms", "ms", ["kind", "event"], 2000, ["event_type"]).select("video_id", "seq", "near_event_type")


@query("j10_nearest_frame_2s", with_views("timeline segments", "SELECT s.video_id, s.seq, (SELECT arg_min(t.seq, abs(t.ms - s.start_ms) * 1000000000 + t.seq) FROM timeline t WHERE t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 2000) AS near_event FROM segments s"))
def j10(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).select("video_id", "ms", F.col("seq").alias("event"))
    return nearest_within(segments(spark, d).select("video_id", "seq", "start_ms"), t, "video_id", ["seq"], "start_ms", "ms", ["event"], 2000, ["event"]).select("video_id", "seq", "near_event")


@query(
    "j11_midpoint_band_collect",
    with_views("timeline segments", "SELECT s.video_id, s.seq, coalesce(string_agg(t.event_type, '; ' ORDER BY t.ms, t.seq), 'none') AS cue FROM segments s LEFT JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - (s.start_ms + s.end_ms) // 2) <= 30000 GROUP BY s.video_id, s.seq"),
)
def j11(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", "seq", F.expr("(start_ms + end_ms) DIV 2").alias("middle"))
    t = timeline(spark, d).select("video_id", "ms", F.col("seq").alias("event"), "event_type")
    heard = band_join(s, t, "video_id", "middle", "ms", 30000).groupBy("video_id", "seq").agg(F.array_sort(F.collect_list(F.struct("ms", "event", "event_type"))).alias("e"))
    return s.join(heard, ["video_id", "seq"], "left").select("video_id", "seq", F.coalesce(F.array_join(F.transform("e", lambda x: x["event_type"]), "; "), F.lit("none")).alias("cue"))


@query("j12_band_to_edges", with_views("timeline segments", "SELECT DISTINCT t.video_id, t.seq FROM timeline t JOIN segments s ON s.video_id = t.video_id AND (abs(t.ms - s.start_ms) < 2000 OR abs(t.ms - s.end_ms) < 2000)"))
def j12(spark: SparkSession, d: str) -> DataFrame:
    edges = segments(spark, d).select("video_id", F.explode(F.array("start_ms", "end_ms")).alias("edge"))
    return band_join(timeline(spark, d).select("video_id", "seq", "ms"), edges, "video_id", "ms", "edge", 2000, strict=True).select("video_id", "seq").distinct()


@query(
    "j13_nearest_to_changes",
    with_views(
        "timeline segments",
        "SELECT c.video_id, c.seq, (SELECT arg_min(t.seq, abs(t.ms - c.start_ms) * 1000000000 + t.seq) FROM timeline t WHERE t.video_id = c.video_id) AS near_event FROM c",
        more="c AS (SELECT * FROM (SELECT *, lag(speaker) OVER (PARTITION BY video_id ORDER BY seq) AS before FROM segments) WHERE before IS NOT NULL AND before <> speaker)",
    ),
)
def j13(spark: SparkSession, d: str) -> DataFrame:
    changes = segments(spark, d).withColumn("before", F.lag("speaker").over(Window.partitionBy("video_id").orderBy("seq"))).filter("before IS NOT NULL AND before <> speaker").select("video_id", "seq", "start_ms")
    t = timeline(spark, d).select("video_id", "ms", F.col("seq").alias("event"))
    return nearest(changes, t, "video_id", ["seq"], "start_ms", "ms", "event", ["event"]).select("video_id", "seq", "near_event")


@query(
    "j14_nearest_to_grid",
    with_views(
        "timeline",
        "SELECT DISTINCT g.video_id, (SELECT arg_min(t.seq, abs(t.ms - g.at) * 1000000000 + t.seq) FROM timeline t WHERE t.video_id = g.video_id) AS near_event FROM (SELECT video_id, unnest(range(0, 720000, 10000)) AS at FROM (SELECT DISTINCT video_id FROM timeline)) g",
    ),
)
def j14(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).select("video_id", "ms", F.col("seq").alias("event"))
    grid = t.select("video_id").distinct().select("video_id", F.explode(F.sequence(F.expr("0L"), F.expr("719999L"), F.expr("10000L"))).alias("at"))
    return nearest(grid, t, "video_id", ["at"], "at", "ms", "event", ["event"]).select("video_id", "near_event").distinct()


_PAIRED = "p AS (SELECT a.video_id, a.ms, a.part, a.supp, b.part AS pose_part, b.supp AS pose_supp, {iou} AS iou FROM detections a JOIN detections b ON a.video_id = b.video_id AND a.ms = b.ms WHERE a.class = 'A' AND b.class = 'N')"
_IOU = "greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / (a.w * a.h + b.w * b.h - greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)))"


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    one = detections(spark, d)
    people = one.filter("class = 'A'").select("video_id", "ms", "part", "supp", *[F.col(c).alias(f"a_{c}") for c in "xywh"])
    poses = one.filter("class = 'N'").select("video_id", "ms", F.col("part").alias("pose_part"), F.col("supp").alias("pose_supp"), *[F.col(c).alias(f"b_{c}") for c in "xywh"])
    return people.join(poses, ["video_id", "ms"]).withColumn("iou", iou("a_", "b_"))


@query("j15_best_overlap", with_views("detections", "SELECT video_id, ms, part, supp, arg_min(pose_part, struct_pack(a := -round(iou, 9), b := pose_part, c := pose_supp)) AS pose_part, round(max(iou), 6) AS iou FROM p WHERE iou > 0.1 GROUP BY ALL", more=_PAIRED.format(iou=_IOU)))
def j15(spark: SparkSession, d: str) -> DataFrame:
    best = F.min_by("pose_part", F.struct(-F.round("iou", 9), "pose_part", "pose_supp"))
    return _overlaps(spark, d).filter("iou > 0.1").groupBy("video_id", "ms", "part", "supp").agg(best.alias("pose_part"), F.round(F.max("iou"), 6).alias("iou"))


@query("j16_first_overlap", with_views("detections", "SELECT video_id, ms, part, supp, min(pose_part) AS pose_part FROM p WHERE iou > 0.2 GROUP BY ALL", more=_PAIRED.format(iou=_IOU)))
def j16(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).filter("iou > 0.2").groupBy("video_id", "ms", "part", "supp").agg(F.min("pose_part").alias("pose_part"))


@query("j17_semi_join", "SELECT o_orderkey AS video_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09)")
def j17(spark: SparkSession, d: str) -> DataFrame:
    odd = detections(spark, d).filter("confidence < 0.91").select("video_id")
    return videos(spark, d).join(odd, "video_id", "left_semi").select("video_id")


@query("j18_missing_references", "SELECT o_orderkey AS video_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j18(spark: SparkSession, d: str) -> DataFrame:
    return videos(spark, d).join(detections(spark, d).select("video_id"), "video_id", "left_anti").select("video_id")


@query(
    "j19_fill_coverage",
    with_views(
        "timeline",
        "SELECT video_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY video_id, ms * 10 // 720000 ORDER BY score DESC, seq) AS n FROM timeline t WHERE event_type <> 'purchase' AND NOT EXISTS (SELECT 1 FROM timeline p WHERE p.video_id = t.video_id AND p.ms = t.ms AND p.event_type = 'purchase')) WHERE n <= 2",
    ),
)
def j19(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    taken = t.filter("event_type = 'purchase'").select("video_id", "ms")
    rest = t.filter("event_type <> 'purchase'").join(taken, ["video_id", "ms"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("video_id", F.expr("ms * 10 DIV 720000")).orderBy(F.desc("score"), "seq"))
    return rest.withColumn("n", rank).filter("n <= 2").select("video_id", "seq")


@query("j20_equal_segments", with_views("timeline", "SELECT video_id, ms * 8 // 720000 AS segment, count(*) AS n FROM timeline WHERE ms < 720000 GROUP BY ALL"))
def j20(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).filter("ms < 720000").groupBy("video_id", F.expr("ms * 8 DIV 720000").alias("segment")).agg(F.count(F.lit(1)).alias("n"))


#: j22 over all vectors: signs of 64 numbers, similar if 1 - hamming / 64 > 0.85. Of five bands, one differs in at most a bit.
_J22_RADIUS, _J22_BANDS = 9, [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Signatures of a cell, pairs of signatures that a task compares, and how many of them a pair of cells costs besides.
_J22_CELL, _J22_WORK, _J22_EACH = 2048, 100_000_000, 20_000
_J22_WORD = "CAST(list_sum(list_transform(range(0, 32), lambda i: CASE WHEN embedding[i + {}] > 0 THEN CAST(1 AS BIGINT) << i ELSE 0 END)) AS BIGINT)"


_J22_SQL = f"WITH h AS (SELECT vec_id, {_J22_WORD.format(1)} AS lo, {_J22_WORD.format(33)} AS hi FROM embeddings)"
_J22_ALIKE = "1 - (bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi))) / 64 > 0.85"


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    bits = F.expr(" | ".join(f"shiftleft(if(get(embedding, {i}) > 0, 1L, 0L), {i})" for i in range(64)))
    return table(spark, d, "embeddings").select("vec_id", bits.alias("bits"))


def _met(own: DataFrame) -> DataFrame:
    """Pairs x < y of distinct signatures (bits) that are similar, once for each band by which they meet.

    Signatures of one value of a band are a cell, or several if they are many; cells of values that differ in at most a bit are compared as a whole. Rows are cells, not
    pairs, and of cells there are as many as values (36,864 at most) until values have over _J22_CELL signatures. The number of tasks follows from that of pairs.
    """

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The similar signatures x < y of each pair of cells."""
        made = lambda found: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["x", "y"])
        for batch in batches:
            xs, ys = [(batch.column(c).values.to_numpy(), batch.column(c).offsets.to_numpy()) for c in ("xs", "ys")]
            found, n = [], 0
            for i, same in enumerate(batch.column("same").to_pylist()):
                x, y = [values[at[i] : at[i + 1]] for values, at in (xs, ys)]
                hit = np.bitwise_count(x.view(np.uint64)[:, None] ^ y.view(np.uint64)) <= _J22_RADIUS
                j, k = np.nonzero(np.logical_and(hit, x[:, None] < y) if same else hit)
                if len(j):
                    found.append((np.minimum(x[j], y[k]), np.maximum(x[j], y[k])))
                    n += len(j)
                if n > 100_000:
                    yield made(found)
                    found, n = [], 0
            if found:
                yield made(found)

    part = lambda at, n: F.shiftrightunsigned("bits", at).bitwiseAND(F.lit((1 << n) - 1))
    own = kept(own)
    each = own.select("bits", F.inline(F.array(*[F.struct(F.lit(k).alias("band"), part(at, n).alias("v")) for k, (at, n) in enumerate(_J22_BANDS)])))
    # A row for each value of a band, however many signatures there are.
    values = kept(each.groupBy("band", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / _J22_CELL)))
    # A value has 13 others beside it, each of which it meets once; products are no more than half the sum of squares.
    cost = values.agg(F.sum(7 * (F.col("n") * F.col("n") + _J22_EACH * F.col("parts") * F.col("parts")))).first()[0] or 0
    tasks = max(1, -(-int(cost) // _J22_WORK))
    dealt = each.join(F.broadcast(values), ["band", "v"]).withColumn("part", F.pmod(F.xxhash64("bits"), "parts"))
    cells = kept(dealt.groupBy("band", "v", "part").agg(F.collect_list("bits").alias("cell")))
    widths = F.element_at(F.array(*[F.lit(n) for _, n in _J22_BANDS]), F.col("band") + 1)
    beside = F.concat(F.array("w"), F.transform(F.sequence(F.lit(0), widths - 1), lambda j: F.col("w").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j))))
    one = cells.select("band", "v", "part", F.col("cell").alias("xs"))
    other = cells.select("band", F.col("v").alias("w"), F.col("part").alias("q"), F.col("cell").alias("ys")).withColumn("v", F.explode(F.filter(beside, lambda v: v <= F.col("w"))))
    both = one.join(other, ["band", "v"]).filter("v < w OR part <= q").withColumn("same", F.expr("v = w AND part = q"))
    return both.repartition(tasks, "band", "v", "w", "part", "q").select("xs", "ys", "same").mapInArrow(close, "x long, y long")


def _similar_signatures(own: DataFrame) -> DataFrame:
    """Pairs x < y of distinct signatures (bits) that are similar."""
    return _met(own).distinct()


@query("j22_bit_similarity", f"{_J22_SQL}, c AS (SELECT lo, hi, min(vec_id) AS rep FROM h GROUP BY ALL) SELECT a.rep AS a, b.rep AS b FROM c a JOIN c b ON a.rep < b.rep WHERE {_J22_ALIKE} UNION ALL SELECT rep, vec_id FROM h JOIN c ON h.lo = c.lo AND h.hi = c.hi WHERE vec_id <> rep")
def j22(spark: SparkSession, d: str) -> DataFrame:
    """Similar pairs of class representatives (the smallest id of a signature), and each representative with its members."""
    h = _signatures(spark, d)
    classes = h.groupBy("bits").agg(F.min("vec_id").alias("rep"))
    met = _similar_signatures(classes.select("bits"))
    one, other = classes.select(F.col("bits").alias("x"), F.col("rep").alias("p")), classes.select(F.col("bits").alias("y"), F.col("rep").alias("q"))
    apart = met.join(one, "x").join(other, "y").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    return apart.unionByName(h.join(classes, "bits").filter("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b")))


@query("j22_bit_similarity_all", f"{_J22_SQL} SELECT a.vec_id AS a, b.vec_id AS b FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE {_J22_ALIKE}")
def j22_all(spark: SparkSession, d: str) -> DataFrame:
    h = _signatures(spark, d)
    # Equal signatures are one in the search; their vectors are paired at the end.
    met = _similar_signatures(h.select("bits").distinct())
    left, right = h.select(F.col("vec_id").alias("p"), F.col("bits").alias("x")), h.select(F.col("vec_id").alias("q"), F.col("bits").alias("y"))
    apart = met.join(left, "x").join(right, "y").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    return apart.unionByName(left.join(right, F.col("x") == F.col("y")).filter("p < q").select(F.col("p").alias("a"), F.col("q").alias("b")))


@query("j26_covered_by_segment", with_views("timeline segments", "SELECT t.video_id, count(*) AS uncovered FROM timeline t WHERE NOT EXISTS (SELECT 1 FROM segments s WHERE s.video_id = t.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms) GROUP BY 1"))
def j26(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).select("video_id", "seq", "ms")
    s = segments(spark, d).select("video_id", "start_ms", "end_ms")
    return t.join(range_join(t, s, "video_id", "ms", "start_ms", "end_ms").select("video_id", "seq"), ["video_id", "seq"], "left_anti").groupBy("video_id").agg(F.count(F.lit(1)).alias("uncovered"))


@query("j27_reference_exists", with_views("timeline segments", "SELECT s.video_id, s.seq FROM segments s WHERE NOT EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = s.video_id AND abs(t.ms - s.start_ms) < 1000)"))
def j27(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", "seq", "start_ms")
    t = timeline(spark, d).select("video_id", "ms")
    return s.join(band_join(s, t, "video_id", "start_ms", "ms", 1000, strict=True).select("video_id", "seq"), ["video_id", "seq"], "left_anti").select("video_id", "seq")


@query("j29_coherent_ranges", with_views("timeline segments", "SELECT s.video_id, s.seq, count(DISTINCT t.event_type) AS kinds, count(DISTINCT t.event_type) = 1 AS coherent FROM segments s JOIN timeline t ON t.video_id = s.video_id AND t.ms BETWEEN s.start_ms AND s.end_ms GROUP BY ALL"))
def j29(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms")
    kinds = F.size(F.collect_set("event_type"))  # as many as there are event types
    joined = range_join(timeline(spark, d).select("video_id", "ms", "event_type"), s, "video_id", "ms", "start_ms", "end_ms").groupBy("video_id", F.col("turn").alias("seq")).agg(kinds.cast("long").alias("kinds"))
    return joined.withColumn("coherent", F.col("kinds") == 1)


@query("j30_count_after", with_views("timeline segments", "SELECT s.video_id, s.seq, t.event_type, count(*) AS n FROM segments s JOIN timeline t ON t.video_id = s.video_id AND t.ms > s.start_ms GROUP BY ALL HAVING count(*) >= 3"))
def j30(spark: SparkSession, d: str) -> DataFrame:
    # Running counts from the end, read at each cue: no pairs are made.
    t = timeline(spark, d).select("video_id", "ms", "event_type")
    cues = segments(spark, d).select("video_id", F.col("start_ms").alias("ms"), "seq")
    kinds = t.select("video_id", "event_type").distinct()
    marks = cues.join(kinds, "video_id")
    both = t.withColumns({"seq": F.lit(None).cast("long"), "one": F.lit(1)}).unionByName(marks.withColumn("one", F.lit(0)))
    later = Window.partitionBy("video_id", "event_type").orderBy(F.desc("ms")).rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn("n", F.sum("one").over(later)).filter("seq IS NOT NULL AND n >= 3").select("video_id", "seq", "event_type", F.col("n").cast("long").alias("n"))


@query("j31_band_having", with_views("timeline segments", "SELECT s.video_id, s.seq, count(*) AS n FROM segments s JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - s.start_ms) <= 10000 GROUP BY ALL HAVING count(*) >= 2"))
def j31(spark: SparkSession, d: str) -> DataFrame:
    s, t = segments(spark, d).select("video_id", "seq", "start_ms"), timeline(spark, d).select("video_id", "ms")
    return band_join(s, t, "video_id", "start_ms", "ms", 10000).groupBy("video_id", "seq").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("j32_band_self_join", with_views("timeline", "SELECT a.video_id, a.seq, count(*) AS n FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.seq <> b.seq AND abs(a.ms - b.ms) < 5000 WHERE a.marker >= 90 GROUP BY ALL HAVING count(*) >= 2"))
def j32(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    marked, others = t.filter("marker >= 90").select("video_id", "seq", "ms"), t.select("video_id", F.col("seq").alias("other"), F.col("ms").alias("other_ms"))
    return band_join(marked, others, "video_id", "ms", "other_ms", 5000, strict=True).filter("seq <> other").groupBy("video_id", "seq").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("j33_equi_and_band_first", with_views("timeline", "SELECT a.seq, min(b.seq) AS first_other FROM timeline a JOIN timeline b ON a.video_id = b.video_id AND a.event_type = b.event_type AND abs(a.ms - b.ms) <= 1000 AND a.seq <> b.seq GROUP BY 1"))
def j33(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d).withColumn("k", F.struct("video_id", "event_type"))
    return band_join(t.select("k", "seq", "ms"), t.select("k", F.col("seq").alias("other"), F.col("ms").alias("other_ms")), "k", "ms", "other_ms", 1000).filter("seq <> other").groupBy("seq").agg(F.min("other").alias("first_other"))


@query("j34_between_states", with_views("timeline", "SELECT t.video_id, count(*) AS between FROM timeline t JOIN (SELECT video_id, min(ms) AS lo, max(ms) AS hi FROM timeline WHERE event_type = 'purchase' GROUP BY 1) p ON p.video_id = t.video_id AND t.ms > lo AND t.ms < hi GROUP BY 1"))
def j34(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    states = t.filter("event_type = 'purchase'").groupBy("video_id").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"))
    return t.join(states, "video_id").filter("ms > lo AND ms < hi").groupBy("video_id").agg(F.count(F.lit(1)).alias("between"))


@query("j35_points_in_interval", with_views("timeline segments", "SELECT s.video_id, s.seq, count(t.seq) AS n FROM segments s LEFT JOIN timeline t ON t.video_id = s.video_id AND t.ms BETWEEN s.start_ms AND coalesce(s.end_ms, s.start_ms + 5000) GROUP BY ALL"))
def j35(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", F.coalesce("end_ms", F.col("start_ms") + 5000).alias("end_ms"))
    n = range_join(timeline(spark, d).select("video_id", "ms"), s, "video_id", "ms", "start_ms", "end_ms").groupBy("video_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    return s.join(n, ["video_id", "turn"], "left").select("video_id", F.col("turn").alias("seq"), F.coalesce("n", F.lit(0)).alias("n"))


@query("j36_key_translation", "SELECT c.c_name, o.o_orderkey AS video_id FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE c.c_name < 'Customer#000000100'")
def j36(spark: SparkSession, d: str) -> DataFrame:
    owners = table(spark, d, "customer").filter("c_name < 'Customer#000000100'").select("c_name", F.col("c_custkey").alias("owner"))
    return videos(spark, d).join(owners, "owner").select("c_name", "video_id")


@query("j37_alias_lookup", "SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END AS official FROM documents")
def j37(spark: SparkSession, d: str) -> DataFrame:
    aliases = spark.sql("SELECT * FROM VALUES ('en', 'English'), ('fr', 'French') AS a(lang, name)")
    return table(spark, d, "documents").select("doc_id", "lang").join(F.broadcast(aliases), "lang", "left").select("doc_id", F.coalesce("name", "lang").alias("official"))


@query("j39_array_zip", "SELECT vec_id, i - 1 AS position, embedding[i] AS value, coalesce(CAST(embedding[i + 62] AS VARCHAR), 'missing-' || (i - 1)) IS NOT NULL AS padded FROM (SELECT vec_id, embedding, unnest(range(1, 5)) AS i FROM embeddings)")
def j39(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", "embedding", F.posexplode(F.slice("embedding", 1, 4)).alias("position", "value"))
    other = F.coalesce(F.try_element_at("embedding", F.col("position") + 63).cast("string"), F.concat(F.lit("missing-"), "position"))
    return rows.select("vec_id", F.col("position").cast("long").alias("position"), "value", other.isNotNull().alias("padded"))


@query("j41_overlap_hull", with_views("segments timeline", "SELECT t.video_id, t.seq, coalesce(min(s.start_ms), t.ms) AS lo, coalesce(max(s.end_ms), t.ms + 60000) AS hi FROM timeline t LEFT JOIN segments s ON s.video_id = t.video_id AND s.start_ms <= t.ms + 60000 AND s.end_ms >= t.ms GROUP BY t.video_id, t.seq, t.ms"))
def j41(spark: SparkSession, d: str) -> DataFrame:
    # Spans overlap if they meet in a bucket: both sides list the buckets that they touch.
    width = 60000
    touched = lambda a, b: F.explode(F.sequence(F.floor(a / width).cast("long"), F.floor(b / width).cast("long")))
    t = timeline(spark, d).select("video_id", "seq", "ms")
    wanted = t.withColumn("bucket", touched(F.col("ms"), F.col("ms") + 60000))
    s = segments(spark, d).select("video_id", "start_ms", "end_ms").withColumn("bucket", touched(F.col("start_ms"), F.col("end_ms")))
    hull = wanted.join(s, ["video_id", "bucket"]).filter("start_ms <= ms + 60000 AND end_ms >= ms").groupBy("video_id", "seq").agg(F.min("start_ms").alias("lo"), F.max("end_ms").alias("hi"))
    return t.join(hull, ["video_id", "seq"], "left").select("video_id", "seq", F.coalesce("lo", "ms").alias("lo"), F.coalesce("hi", F.col("ms") + 60000).alias("hi"))


@query("j_cost_by_owner", with_views("cost_log videos", "SELECT owner, CAST(sum(amount) AS BIGINT) AS spent FROM cost_log JOIN videos USING (video_id) GROUP BY 1"))
def cost_by_owner(spark: SparkSession, d: str) -> DataFrame:
    per_video = cost_log(spark, d).groupBy("video_id").agg(F.sum("amount").alias("amount"))
    return per_video.join(videos(spark, d).select("video_id", "owner"), "video_id").groupBy("owner").agg(F.sum("amount").alias("spent"))
