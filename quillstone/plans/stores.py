"""Queries of files, logs and stores: tables written to the shared folder in the form of the source or sink, and read back; and of connections and reviews."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.joins import range_join
from quillstone.operators.skew import kept, shared_folder
from quillstone.plans.base import query
from quillstone.sources import files, store
from quillstone.sources.adapters import cost_log, detections, table, timeline, videos, with_views
from quillstone.streaming.connections import connection_counts, sessions


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid4().hex}"


#: Documents, each a file of its own, that one task writes.
DOCUMENTS = 2_000


def _written_checkpoints(spark: SparkSession, d: str) -> str:
    """One JSON document a video, in a file of its own; every eleventh video's is cut short. A folder holds the videos whose ids share their first three digits.

    Documents are small and files cost much, so the number of tasks follows from that of documents, not from bytes; a folder is written by one task, and is moved as a whole when it is done.
    """
    path = _place(spark)
    by_video = kept(timeline(spark, d).groupBy("video_id").agg(F.max("ms").alias("ms"), F.count(F.lit(1)).alias("n_events")))
    text = F.to_json(F.struct("video_id", F.lit(3).alias("phase"), "n_events", F.struct("ms").alias("state")))
    folder = F.substring(F.col("video_id").cast("string"), 1, 3).alias("folder")
    whole = by_video.select(F.when(F.col("video_id") % 11 == 0, F.substring(text, F.lit(1), F.length(text) - 4)).otherwise(text).alias("value"), folder)
    tasks = max(1, -(-by_video.count() // DOCUMENTS))
    whole.repartition(tasks, "folder").write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
    return path


_DOCS = "SELECT video_id, max(ms) AS ms, count(*) AS n_events FROM timeline GROUP BY 1"


@query("s05_checkpoint_scan", with_views("timeline", f"SELECT CASE WHEN video_id % 11 <> 0 THEN video_id END AS video_id, CASE WHEN video_id % 11 <> 0 THEN n_events END AS n_events, CASE WHEN video_id % 11 <> 0 THEN ms END AS ms, video_id % 11 = 0 AS broken FROM ({_DOCS})"))
def s05(spark: SparkSession, d: str) -> DataFrame:
    found = files.read_checkpoints(spark, _written_checkpoints(spark, d), "video_id LONG, phase INT, n_events LONG, state STRUCT<ms: LONG>")
    broken = F.col("_corrupt").isNotNull()
    hide = lambda c: F.when(~broken, F.col(c))
    return found.select(hide("video_id").alias("video_id"), hide("n_events").alias("n_events"), hide("state.ms").alias("ms"), broken.alias("broken"))


@query("s08_result_glob", with_views("timeline", f"SELECT video_id, n_events FROM ({_DOCS}) WHERE video_id % 11 <> 0 AND (video_id::VARCHAR LIKE '1%' OR video_id::VARCHAR LIKE '2%')"))
def s08(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the videos in the folders that begin with 1 or 2, as the pattern says."""
    found = files.read_checkpoints(spark, f"{_written_checkpoints(spark, d)}/folder=[12]*", "video_id LONG, n_events LONG")
    return found.filter("_corrupt IS NULL").select("video_id", "n_events")


_VIDEO = "video_id LONG, owner LONG, status STRING, priority STRING, value DOUBLE"


@query("s09_csv_source", with_views("videos", "SELECT status, priority, count(*) AS n, count(DISTINCT owner) AS owners, round(sum(value), 2) AS value FROM videos GROUP BY ALL"))
def s09(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark)
    videos(spark, d).select("video_id", "owner", "status", "priority", "value").write.csv(path, header=True)
    read = files.read_csv(spark, path, _VIDEO)
    return read.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("owner").alias("owners"), F.round(F.sum("value"), 2).alias("value"))


@query("s14_json_sink", with_views("timeline", "SELECT video_id, count(*) AS n, max(score) AS best, count(*) FILTER (marker IS NULL) AS unmarked FROM timeline GROUP BY 1"))
def s14(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark)
    files.append_json(timeline(spark, d).select("video_id", F.struct("seq", "score", "marker").alias("result")), path)
    read = spark.read.schema("video_id LONG, result STRUCT<seq: LONG, score: DOUBLE, marker: INT>").json(path)
    return read.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.max("result.score").alias("best"), F.count_if(F.col("result.marker").isNull()).alias("unmarked"))


@query("s15_csv_sink", with_views("videos", "SELECT video_id, status, priority FROM videos"))
def s15(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark)
    files.write_report(videos(spark, d), path, ["video_id", "status", "priority"])
    return files.read_csv(spark, path, "video_id LONG, status STRING, priority STRING")


@query("s17_cost_log", with_views("cost_log", "SELECT category, 2 * count(*) AS n, 2 * CAST(sum(amount) AS BIGINT) AS amount FROM cost_log GROUP BY 1"))
def s17(spark: SparkSession, d: str) -> DataFrame:
    """A log to which the same costs are appended twice; appending never reads what is there."""
    path = _place(spark)
    for _ in range(2):
        files.append_json(cost_log(spark, d).select("video_id", "category", "amount"), path)
    read = spark.read.schema("video_id LONG, category STRING, amount LONG").json(path)
    return read.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("s18_updated_log", with_views("timeline", "SELECT video_id, event_type, max(seq) AS seq, arg_max(score, seq) AS score FROM timeline GROUP BY ALL"))
def s18(spark: SparkSession, d: str) -> DataFrame:
    """A log whose entries are replaced: changes are appended, and the newest of each key is the entry."""
    path = _place(spark)
    files.append_json(timeline(spark, d).select("video_id", "event_type", "seq", "score"), path)
    read = spark.read.schema("video_id LONG, event_type STRING, seq LONG, score DOUBLE").json(path)
    return files.latest(read, ["video_id", "event_type"], ["seq"]).select("video_id", "event_type", "seq", "score")


@query("s24_migration", with_views("videos", "SELECT video_id::VARCHAR AS video_id, status, NULL::VARCHAR AS pipeline_stage, NULL::VARCHAR AS batch_id, NULL::DOUBLE AS duration FROM videos"))
def s24(spark: SparkSession, d: str) -> DataFrame:
    """An old table that lacks columns of the present schema gets them as nulls."""
    path = _place(spark)
    videos(spark, d).select(F.col("video_id").cast("string").alias("video_id"), "status").write.parquet(path)
    return files.add_missing(spark.read.parquet(path), "videos").select("video_id", "status", "pipeline_stage", "batch_id", "duration")


@query("s19_result_cache", "SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> ''))::INT AS n_words, CASE WHEN source = 'src0' OR (lang = 'de' AND upper(coalesce(text, '')) IS DISTINCT FROM text) THEN 2 ELSE 1 END AS version FROM documents")
def s19(spark: SparkSession, d: str) -> DataFrame:
    """Word counts from a store that was filled before one source came and before the German texts were changed: only those are counted now."""
    path, schema = _place(spark), "doc_id LONG, n_words INT"
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    count = lambda rows: rows.select("doc_id", F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")).alias("n_words"))
    before = docs.filter("NOT source <=> 'src0'").withColumn("text", F.when(F.col("lang") == "de", F.upper(F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    store.cached(before.select("doc_id", "text"), path, schema, ["doc_id"], ["text"], count)
    return store.cached(docs.select("doc_id", "text"), path, schema, ["doc_id"], ["text"], count).select("doc_id", "n_words", "version")


_LINKS = """c AS (SELECT video_id, marker % 4 AS connection_id, CASE WHEN event_type = 'error' THEN 'disconnect' ELSE 'message' END AS kind, ms, seq FROM timeline),
w AS (SELECT *, lag(kind) OVER o AS before, ms - lag(ms) OVER o AS since, lead(ms) OVER o - ms AS until, lead(ms) OVER o IS NULL AS final, (SELECT max(ms) FROM timeline) AS now FROM c WINDOW o AS (PARTITION BY video_id, connection_id ORDER BY ms, seq)),
s AS (SELECT *, before IS NULL OR before = 'disconnect' OR since > 30000 AS shut FROM w)"""


def _connected(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "disconnect").otherwise("message")
    return timeline(spark, d).select("video_id", (F.col("marker") % 4).alias("connection_id"), kind.alias("kind"), "ms", "seq")


_SESSIONS = f"{_LINKS}, n AS (SELECT *, sum(shut::INT) OVER (PARTITION BY video_id, connection_id ORDER BY ms, seq) AS n FROM s WHERE NOT (kind = 'disconnect' AND shut)), spans AS (SELECT video_id, connection_id, min(ms) AS opened_at, coalesce(max(ms) FILTER (kind = 'disconnect'), max(ms) + 30000) AS closed_at FROM n GROUP BY video_id, connection_id, n)"


@query("x01_deliveries", with_views("timeline", "SELECT t.video_id, t.event_type, count(*) AS sent FROM timeline t JOIN spans p ON p.video_id = t.video_id AND t.ms >= p.opened_at AND t.ms < p.closed_at GROUP BY ALL", more=_SESSIONS))
def x01(spark: SparkSession, d: str) -> DataFrame:
    """How often events of each type are sent: once to every connection of their video that is open."""
    spans = sessions(_connected(spark, d), F.lit(30000), ["ms", "seq"])
    sent = range_join(timeline(spark, d).select("video_id", "event_type", F.col("ms").alias("at")), spans, "video_id", "at", "opened_at", "closed_at", end_inclusive=False)
    return sent.groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("sent"))


@query("x02_connection_counts", with_views("timeline", "SELECT video_id, opened, closed, opened - closed AS open FROM (SELECT video_id, count(*) FILTER (kind = 'message' AND shut) AS opened, count(*) FILTER ((kind = 'disconnect' AND NOT shut) OR (kind = 'message' AND (until > 30000 OR (final AND now - ms > 30000)))) AS closed FROM s GROUP BY 1)", more=_LINKS))
def x02(spark: SparkSession, d: str) -> DataFrame:
    now = timeline(spark, d).agg(F.max("ms").alias("now"))  # one row
    return connection_counts(_connected(spark, d).join(F.broadcast(now)), F.col("now"), F.lit(30000), ["ms", "seq"])


@query("x04_advanced_videos", with_views("detections", "SELECT video_id, count(*) AS total FROM detections GROUP BY 1 HAVING count(*) FILTER (class NOT IN ('R', 'A')) = 0"))
def x04(spark: SparkSession, d: str) -> DataFrame:
    """Videos whose reviews are all decided; the stream writes each once (``advance_completed``)."""
    return detections(spark, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("class").isin("R", "A")).alias("pending")).filter("pending = 0").select("video_id", "total")
