"""The gate that moments pass before questions are made of them: every failing rule of each, and what the rest covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.fuzzy import fuzzy_quotes, quotes_in
from quillstone.operators.joins import range_join

#: Rules in the order in which their errors are listed.
RULES = ("frame_existence", "transcript_match", "timestamp_alignment", "intro_outro", "dual_cue")


def _by_id(moments: DataFrame, found: DataFrame) -> DataFrame:
    return moments.join(found, "id", "left")


def judged_moments(moments: DataFrame, frames: DataFrame, durations: DataFrame, transcript: DataFrame | None = None, *, match_quotes: bool = False, align: bool = False, intro_ms: int = 10_000, outro_ms: int = 30_000) -> DataFrame:
    """moments with ``errors``: an array of (rule, error), empty for what passes.

    moments: id, video_id, frame_ids, timestamps (ms), visual_cues, audio_cues (arrays; null counts as empty), correspondence. frames: video_id, frame_id. durations:
    video_id, duration_ms; a video without one has no outro. transcript (video_id, seq, start_ms, end_ms, text) serves the two optional rules: some quote of the audio cues is said, all
    timestamps lie in segments. Ids are unique. Each rule that needs evidence is one equi join on exploded references, put together again by id.
    """
    m = moments.withColumns({c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("visual_cues", "audio_cues")}).withColumns({c: F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in ("frame_ids", "timestamps")})
    refs = m.select("id", "video_id", F.posexplode("frame_ids").alias("place", "frame_id"))
    known = frames.select("video_id", "frame_id").distinct().withColumn("known", F.lit(True))
    absent = refs.join(known, ["video_id", "frame_id"], "left").filter("known IS NULL").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "frame_id"))).alias("absent"))
    m = _by_id(m, absent).join(durations.select("video_id", "duration_ms"), "video_id", "left")
    error: dict[str, F.Column] = {
        "frame_existence": F.when(F.size("frame_ids") == 0, "No frame IDs specified").when(F.col("absent").isNotNull(), F.concat(F.lit("Missing frames: "), F.array_join(F.transform("absent.frame_id", lambda x: x.cast("string")), ", "))),
        "dual_cue": F.when(F.size("visual_cues") == 0, "No visual cues specified").when(F.size("audio_cues") == 0, "No audio cues specified").when(F.coalesce("correspondence", F.lit("")) == "", "No correspondence explanation provided"),
    }
    late = F.coalesce(F.col("duration_ms") - outro_ms, F.lit(2**62))
    # The first timestamp that fails says where.
    off = F.get(F.filter(F.transform("timestamps", lambda t: F.when(t < intro_ms, "Timestamp in intro region").when(t > late, "Timestamp in outro region")), lambda e: e.isNotNull()), 0)
    error["intro_outro"] = off
    if match_quotes:
        quotes = m.select("id", "video_id", F.explode(F.flatten(F.transform("audio_cues", quotes_in))).alias("quote"))
        said = fuzzy_quotes(quotes, transcript.select("video_id", "seq", "text"), "video_id", "quote", "text", ["seq"])
        m = _by_id(m, said.select("id").distinct().withColumn("said", F.lit(True)))
        error["transcript_match"] = F.when(F.size("audio_cues") == 0, "No audio cues specified").when(F.col("said").isNull(), "Audio cues not found in transcript")
    if align:
        points = m.filter("size(audio_cues) > 0").select("id", "video_id", F.posexplode("timestamps").alias("place", "at"))
        inside = range_join(points, transcript.select("video_id", "start_ms", "end_ms"), "video_id", "at", "start_ms", "end_ms").select("id", "place").distinct().withColumn("inside", F.lit(True))
        outside = points.join(inside, ["id", "place"], "left").filter("inside IS NULL").groupBy("id").agg(F.min_by("at", "place").alias("outside"))
        m = _by_id(m, outside)
        error["timestamp_alignment"] = F.when(F.col("outside").isNotNull(), F.concat(F.lit("No audio segment found for timestamp "), F.col("outside").cast("string")))
    listed = F.array(*[F.when(error[r].isNotNull(), F.struct(F.lit(r).alias("rule"), error[r].alias("error"))) for r in RULES if r in error])
    return m.select(*moments.columns, F.array_compact(listed).alias("errors"))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") == 0).drop("errors")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") > 0)


def summary(judged: DataFrame) -> DataFrame:
    """video_id, total, validated, rejected and, by rule, how many moments failed it."""
    fails = lambda r: F.count_if(F.exists("errors", lambda e: e["rule"] == r)).alias(f"{r}_failed")
    return judged.groupBy("video_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("validated"), F.count_if(F.size("errors") > 0).alias("rejected"), *[fails(r) for r in RULES])


def coverage(judged: DataFrame, needed: dict[str, int], aliases: dict[str, str]) -> DataFrame:
    """video_id, type, n, need, met for every needed type: how many accepted moments have it as first or further type."""
    official = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    types = accepted(judged).select("video_id", F.explode(F.concat(F.array("primary"), F.coalesce("secondary", F.array().cast("array<string>")))).alias("raw"))
    counts = types.select("video_id", F.coalesce(official[F.col("raw")], F.col("raw")).alias("type")).groupBy("video_id", "type").agg(F.count(F.lit(1)).alias("n"))
    every = judged.select("video_id").distinct().select("video_id", F.explode(F.create_map(*[F.lit(x) for pair in needed.items() for x in pair])).alias("type", "need"))
    return every.join(counts, ["video_id", "type"], "left").select("video_id", "type", F.coalesce("n", F.lit(0)).alias("n"), "need", (F.coalesce("n", F.lit(0)) >= F.col("need")).alias("met"))
