"""Queries of the moment gate, of hallucination checks and of templates that need an editing step or a vague reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import moments as M
from quillstone.functions import wording as W
from quillstone.operators.joins import band_join, range_join
from quillstone.plans.base import query
from quillstone.plans.validation import CUED_SQL, cued
from quillstone.sources.adapters import frames, segments, timeline, with_views

# How many moments of each type a video needs, and the names of types.
MIN_COVERAGE = {
    "Temporal Understanding": 3, "Sequential": 2, "Subscene": 2, "General Holistic Reasoning": 1, "Inference": 3, "Context": 2, "Needle": 3, "Referential Grounding": 3, "Counting": 2, "Comparative": 2,
    "Object Interaction Reasoning": 2, "Audio-Visual Stitching": 1, "Tackling Spurious Correlations": 1,
}
#: Official name of each type, its short name and that in lower case.
TYPE_NAMES = [
    ("Temporal Understanding", "Temporal", "temporal"), ("Sequential", "Sequential", "sequential"), ("Subscene", "Subscene", "subscene"), ("General Holistic Reasoning", "Holistic", "holistic"),
    ("Inference", "Inference", "inference"), ("Context", "Context", "context"), ("Needle", "Needle", "needle"), ("Referential Grounding", "Referential", "referential"), ("Counting", "Counting", "counting"),
    ("Comparative", "Comparative", "comparative"), ("Object Interaction Reasoning", "ObjectInteraction", "object_interaction"), ("Audio-Visual Stitching", "AVStitching", "av_stitching"), ("Tackling Spurious Correlations", "Spurious", "spurious"),
]
TYPE_ALIASES = {name: official for official, *names in TYPE_NAMES for name in (official, *names)}
SHORT_NAMES = {name: names[1] for names in TYPE_NAMES for name in names}
_NAMED = [short for _, short, _ in TYPE_NAMES]
_TYPE = lambda n: f"CASE {n} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_NAMED)) + " END"
#: Moments on the timeline: an event each. ``array(...)`` and ``[...]`` are the dialects' words for a list.
_FRAME_IDS = "CASE WHEN seq % 29 = 0 THEN {0}{1} ELSE {0}video_id * 50 + seq % 53, video_id * 50 + (seq * 7) % 50{1} END"
_STAMPS = "{0}ms, ms + 2000{1}"
_VISUAL = "CASE WHEN seq % 23 = 0 THEN {0}{1} ELSE {0}'a ' || event_type || ' on the screen'{1} END"
_AUDIO = "CASE WHEN seq % 19 = 0 THEN {0}{1} ELSE {0}'the voice at ' || CAST(marker AS VARCHAR(9)){1} END"
_WHY = "CASE WHEN seq % 17 = 0 THEN '' WHEN seq % 31 = 0 THEN NULL ELSE 'both at once' END"
_SECOND = "CASE WHEN seq % 3 = 0 THEN {0}" + _TYPE("(seq * 5) % 13") + "{1} ELSE {0}{1} END"
_PARTS = {"frame_ids": _FRAME_IDS, "timestamps": _STAMPS, "visual_cues": _VISUAL, "audio_cues": _AUDIO, "correspondence": _WHY, "primary": _TYPE("seq % 13"), "secondary": _SECOND}
_MOMENTS_SQL = "m AS (SELECT seq AS id, video_id, " + ", ".join(f'{sql.format("[", "]")} AS "{c}"' for c, sql in _PARTS.items()) + """ FROM timeline),
dur AS (SELECT video_id, max(ms) + 20000 AS duration_ms FROM timeline GROUP BY 1),
absent AS (SELECT id, string_agg(frame_id, ', ' ORDER BY place) AS ids FROM (SELECT id, video_id, unnest(frame_ids) AS frame_id, generate_subscripts(frame_ids, 1) AS place FROM m) r WHERE NOT EXISTS (SELECT 1 FROM frames f WHERE f.video_id = r.video_id AND f.frame_id = r.frame_id) GROUP BY 1),
j AS (SELECT m.*, CASE WHEN len(frame_ids) = 0 THEN 'No frame IDs specified' WHEN ids IS NOT NULL THEN 'Missing frames: ' || ids END AS e1,
  CASE WHEN ts1 < 10000 THEN 'Timestamp in intro region' WHEN ts1 > duration_ms - 30000 THEN 'Timestamp in outro region' WHEN ts2 < 10000 THEN 'Timestamp in intro region' WHEN ts2 > duration_ms - 30000 THEN 'Timestamp in outro region' END AS e2,
  CASE WHEN len(visual_cues) = 0 THEN 'No visual cues specified' WHEN len(audio_cues) = 0 THEN 'No audio cues specified' WHEN coalesce(correspondence, '') = '' THEN 'No correspondence explanation provided' END AS e3
  FROM (SELECT *, timestamps[1] AS ts1, timestamps[2] AS ts2 FROM m) m LEFT JOIN absent USING (id) LEFT JOIN dur USING (video_id))"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    t = timeline(spark, d)
    typed = {"frame_ids": "array<bigint>", "timestamps": "array<bigint>", "visual_cues": "array<string>", "audio_cues": "array<string>", "secondary": "array<string>"}
    moments = t.select(F.col("seq").alias("id"), "video_id", *[F.expr(sql.format("array(", ")")).cast(typed.get(c, "string")).alias(c) for c, sql in _PARTS.items()])
    durations = t.groupBy("video_id").agg((F.max("ms") + 20000).alias("duration_ms"))
    return M.judged_moments(moments, frames(spark, d), durations)


@query("v16_all_errors", with_views("timeline frames", "SELECT id, video_id, e1 IS NULL AND e2 IS NULL AND e3 IS NULL AS valid, concat_ws('; ', 'frame_existence: ' || e1, 'intro_outro: ' || e2, 'dual_cue: ' || e3) AS errors FROM j", more=_MOMENTS_SQL))
def v16(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(F.transform("errors", lambda e: F.concat(e["rule"], F.lit(": "), e["error"])), "; ")
    return _judged(spark, d).select("id", "video_id", (F.size("errors") == 0).alias("valid"), text.alias("errors"))


@query("v16_validation_summary", with_views("timeline frames", "SELECT video_id, count(*) AS total, count(*) FILTER (e1 IS NULL AND e2 IS NULL AND e3 IS NULL) AS validated, count(*) FILTER (e1 IS NOT NULL OR e2 IS NOT NULL OR e3 IS NOT NULL) AS rejected, count(e1) AS frame_existence_failed, 0::BIGINT AS transcript_match_failed, 0::BIGINT AS timestamp_alignment_failed, count(e2) AS intro_outro_failed, count(e3) AS dual_cue_failed FROM j GROUP BY 1", more=_MOMENTS_SQL))
def v16_summary(spark: SparkSession, d: str) -> DataFrame:
    return M.summary(_judged(spark, d))


_NEEDED_SQL = "needed AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', {n})" for t, n in MIN_COVERAGE.items()) + ") v(type, need))"
_OFFICIAL = "CASE raw " + " ".join(f"WHEN '{a}' THEN '{t}'" for a, t in TYPE_ALIASES.items()) + " ELSE raw END"


@query("v16_coverage_check", with_views("timeline frames", f"SELECT video_id, n.type, coalesce(k.n, 0) AS n, need, coalesce(k.n, 0) >= need AS met FROM (SELECT DISTINCT video_id FROM j) v CROSS JOIN needed n LEFT JOIN (SELECT video_id, {_OFFICIAL} AS type, count(*) AS n FROM (SELECT video_id, unnest(list_concat([\"primary\"], secondary)) AS raw FROM j WHERE e1 IS NULL AND e2 IS NULL AND e3 IS NULL) GROUP BY ALL) k USING (video_id, type)", more=f"{_MOMENTS_SQL}, {_NEEDED_SQL}"))
def v16_coverage(spark: SparkSession, d: str) -> DataFrame:
    return M.coverage(_judged(spark, d), MIN_COVERAGE, TYPE_ALIASES)


_SHORT = "CASE raw " + " ".join(f"WHEN '{n}' THEN '{s}'" for n, s in SHORT_NAMES.items()) + " ELSE raw END"
_RAW = "CASE seq % 3 " + " ".join(f"WHEN {k} THEN CASE (seq // 3) % 14 " + " ".join(f"WHEN {i} THEN '{names[k]}'" for i, names in enumerate(TYPE_NAMES)) + " ELSE 'Unheard Of' END" for k in range(3)) + " END"


@query("f35_name_maps", with_views("timeline", f"SELECT seq, raw, {_OFFICIAL} AS official, {_SHORT} AS short FROM (SELECT seq, {_RAW} AS raw FROM timeline)"))
def f35(spark: SparkSession, d: str) -> DataFrame:
    """Official and short name of a type under any of its names; others stay."""
    named = lambda names: F.coalesce(F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("raw")], F.col("raw"))
    raw = F.expr(_RAW.replace("(seq // 3)", "(seq DIV 3)"))
    return timeline(spark, d).select("seq", raw.alias("raw")).select("seq", "raw", named(TYPE_ALIASES).alias("official"), named(SHORT_NAMES).alias("short"))


# Opposites, colours and words of order that answers are compared by; words that add nothing.
OPPOSITES = [("yes", "no"), ("true", "false"), ("left", "right"), ("red", "blue"), ("before", "after"), ("inside", "outside")]
COLORS = ["red", "blue", "green", "yellow", "black", "white"]
ORDER_WORDS = ["before", "after", "first", "then", "next", "finally", "earlier", "later", "beginning", "end"]
STOP_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for"]
NAME_PATTERNS = [W.BEFORE + "[A-Z][a-z]+ [A-Z][a-z]+" + W.AFTER, W.BEFORE + "(he|she|him|her|his|hers)" + W.AFTER]
MAX_ADDED = 10
#: What was expected and what was given, by kind of question.
_ANSWERS = {
    "golden": "CASE k % 5 WHEN 0 THEN 'The left lamp is red before the bell, then ' || reply8 WHEN 1 THEN reply8 WHEN 2 THEN 'A white car stands inside the yard' WHEN 3 THEN 'It is green and black near ' || reply8 ELSE 'The bell rings before ' || reply8 END",
    "given": "CASE k % 4 WHEN 0 THEN 'The right lamp is blue after the bell, ' || reply8 WHEN 1 THEN 'Anna Smith holds a yellow sign that nobody else in this large and noisy room has seen so far, ' || answer WHEN 2 THEN reply8 || ' and he waits' ELSE 'After that it is black, outside' END",
}
_LOW = {"g": "lower(golden)", "m": "lower(given)", "q": "lower(question)"}
_held = lambda c, words: "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def _checks(has: W.Has) -> dict[str, str]:
    """The confidence of each kind of hallucination, null where there is none."""
    against = " OR ".join(f"contains({_LOW['g']}, '{a}') AND contains({_LOW['m']}, '{b}') OR contains({_LOW['g']}, '{b}') AND contains({_LOW['m']}, '{a}')" for a, b in OPPOSITES)
    other = " OR ".join(f"contains({_LOW['g']}, '{c}') <> contains({_LOW['m']}, '{c}')" for c in COLORS)
    return {
        "invented": f"CASE WHEN n_new > {MAX_ADDED} THEN least(CAST(1 AS DOUBLE), n_new / CAST(20 AS DOUBLE)) END",
        "contradicted": f"CASE WHEN {against} THEN CAST(0.8 AS DOUBLE) END",
        "mistaken": f"CASE WHEN {_held(_LOW['g'], COLORS)} AND {_held(_LOW['m'], COLORS)} AND ({other}) THEN CAST(0.9 AS DOUBLE) END",
        "reversed": f"CASE WHEN {_held(_LOW['q'], ORDER_WORDS)} AND contains({_LOW['g']}, 'before') AND contains({_LOW['m']}, 'after') THEN CAST(0.8 AS DOUBLE) END",
        "named": f"CASE WHEN {' OR '.join(has('given', p) for p in NAME_PATTERNS)} THEN CAST(0.7 AS DOUBLE) END",
    }


_KINDS = {"invented": "invented_detail", "contradicted": "factual_error", "mistaken": "misidentification", "reversed": "temporal_error", "named": "factual_error"}
_SUM = "(" + " + ".join(f"coalesce({c}, 0)" for c in _KINDS) + ")"
_N = "(" + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _KINDS) + ")"
_MOST = "greatest(" + ", ".join(f"coalesce({c}, 0)" for c in _KINDS) + ")"
#: The surest kind, the first of equals; the mean of the confidences and a share for what was added, at most 1.
_RESULT = {
    "kinds": f"{_N}", "primary_type": "CASE " + " ".join(f"WHEN {c} = {_MOST} THEN '{kind}'" for c, kind in _KINDS.items()) + " END",
    "score": f"round(CASE WHEN {_N} = 0 AND n_added = 0 THEN CAST(0 AS DOUBLE) ELSE least(CAST(1 AS DOUBLE), CASE WHEN {_N} = 0 THEN CAST(0 AS DOUBLE) ELSE {_SUM} / {_N} END + least(CAST(0.3 AS DOUBLE), n_added / CAST(50 AS DOUBLE))) END, 6)",
}
_SEVERITY = "CASE WHEN score < 0.3 THEN 'none' WHEN score < 0.5 THEN 'low' WHEN score < 0.7 THEN 'medium' ELSE 'high' END"
_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> ''))"
_LESS = "list_filter({0}, lambda x: NOT list_contains({1}, x))"
_GIVEN, _GOLDEN = _TOKENS.format("given"), _TOKENS.format("golden")
_F36_SQL = f"""{CUED_SQL}, h AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _ANSWERS.items())} FROM c),
i AS (SELECT *, len({_LESS.format(_GIVEN, _GOLDEN)}) AS n_added, len({_LESS.format(_GOLDEN, _GIVEN)}) AS n_missing, len({_LESS.format(_GIVEN, f"list_concat(list_concat({_GOLDEN}, {_TOKENS.format('audio')}), {STOP_WORDS})")}) AS n_new FROM h),
o AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _checks(W.duck_has).items())} FROM i),
r AS (SELECT id, n_added, n_missing, {', '.join(f'{sql} AS {c}' for c, sql in _RESULT.items())} FROM o)"""


@query("f36_added_tokens", with_views("segments", f"SELECT id, kinds > 0 OR score > 0.3 AS has_hallucination, kinds, primary_type, score, {_SEVERITY} AS severity, n_added, n_missing FROM r", more=_F36_SQL))
def f36(spark: SparkSession, d: str) -> DataFrame:
    tokens = lambda c: F.array_distinct(F.array_remove(F.split(F.lower(c), r"\s+"), ""))
    told = cued(spark, d).select("*", *[F.expr(sql).alias(c) for c, sql in _ANSWERS.items()])
    given, golden = tokens("given"), tokens("golden")
    counted = told.withColumns({
        "n_added": F.size(F.array_except(given, golden)).cast("long"), "n_missing": F.size(F.array_except(golden, given)).cast("long"),
        "n_new": F.size(F.array_except(given, F.concat(golden, tokens("audio"), F.array(*[F.lit(w) for w in STOP_WORDS])))),
    })
    checked = counted.select("*", *[F.expr(sql).alias(c) for c, sql in _checks(W.spark_has).items()])
    scored = checked.select("id", "n_added", "n_missing", *[F.expr(sql).alias(c) for c, sql in _RESULT.items()])
    return scored.select("id", F.expr("kinds > 0 OR score > 0.3").alias("has_hallucination"), "kinds", "primary_type", "score", F.expr(_SEVERITY).alias("severity"), "n_added", "n_missing")


_INSIDE = "s.start_ms >= 10000 AND s.end_ms <= (SELECT max(z.end_ms) - 30000 FROM segments z WHERE z.video_id = s.video_id)"
_VAGUE_WORDS = ["they", "it", "that", "this", "referring", "he", "she"]


def _away_from_ends(spark: SparkSession, d: str) -> DataFrame:
    """Segments that lie neither in the first 10 nor in the last 30 seconds of their video."""
    s = segments(spark, d)
    ends = s.groupBy("video_id").agg((F.max("end_ms") - 30000).alias("outro_ms"))
    return s.join(ends, "video_id").filter("start_ms >= 10000 AND end_ms <= outro_ms").drop("outro_ms")


@query("q21_spurious_context", with_views("segments timeline", f"SELECT video_id, arg_min(turn, o) AS turn, arg_min(seq, o) AS seq, arg_min(event_type, o) AS shown, arg_min(least(start_ms, ms), o) AS start_ms, arg_min(greatest(start_ms + 2000, ms + 1000), o) AS end_ms FROM (SELECT s.video_id, s.seq AS turn, s.start_ms, t.seq, t.ms, t.event_type, row(s.start_ms, s.seq, t.ms, t.seq) AS o FROM segments s JOIN timeline t ON t.video_id = s.video_id AND abs(t.ms - s.start_ms) < 2000 WHERE {_INSIDE} AND ({' OR '.join(f'contains(lower(s.text), {chr(39)}{w}{chr(39)})' for w in _VAGUE_WORDS)})) GROUP BY 1"))
def q21(spark: SparkSession, d: str) -> DataFrame:
    """A vague word in the speech, and what is seen less than two seconds from it: the first of each video."""
    said = _away_from_ends(spark, d).filter(F.expr(" OR ".join(f"contains(lower(text), '{w}')" for w in _VAGUE_WORDS))).select("video_id", F.col("seq").alias("turn"), "start_ms")
    seen = band_join(said, timeline(spark, d).select("video_id", "seq", "ms", "event_type"), "video_id", "start_ms", "ms", 2000, strict=True)
    first = seen.groupBy("video_id").agg(F.min(F.struct("start_ms", "turn", "ms", "seq", "event_type")).alias("f"))
    return first.select("video_id", "f.turn", "f.seq", F.col("f.event_type").alias("shown"), F.least("f.start_ms", "f.ms").alias("start_ms"), F.greatest(F.col("f.start_ms") + 2000, F.col("f.ms") + 1000).alias("end_ms"))


@query("q23_stitching_reference", with_views("segments timeline", "SELECT video_id, turn, n, first_change, start_ms, last_change + 2000 AS end_ms FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_ms, turn) AS place FROM (SELECT s.video_id, s.seq AS turn, s.start_ms, count(*) AS n, min(c.ms) AS first_change, max(c.ms) AS last_change FROM segments s JOIN changes c ON c.video_id = s.video_id AND c.ms BETWEEN s.start_ms AND s.end_ms GROUP BY ALL)) WHERE place = 1", more="changes AS (SELECT video_id, ms FROM (SELECT video_id, ms, event_type, lag(event_type) OVER (PARTITION BY video_id ORDER BY ms, seq) AS before FROM timeline) WHERE before IS NOT NULL AND event_type <> before)"))
def q23(spark: SparkSession, d: str) -> DataFrame:
    """Scene changes while the speech goes on: the first such segment of each video, with its changes."""
    before = F.lag("event_type").over(Window.partitionBy("video_id").orderBy("ms", "seq"))
    changes = timeline(spark, d).withColumn("before", before).filter("before IS NOT NULL AND event_type <> before").select("video_id", "ms")
    spans = segments(spark, d).select("video_id", F.col("seq").alias("turn"), "start_ms", "end_ms")
    inside = range_join(changes, spans, "video_id", "ms", "start_ms", "end_ms").groupBy("video_id", "turn", "start_ms").agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("first_change"), F.max("ms").alias("last_change"))
    first = inside.groupBy("video_id").agg(F.min(F.struct("start_ms", "turn", "n", "first_change", "last_change")).alias("f"))
    return first.select("video_id", "f.turn", "f.n", "f.first_change", "f.start_ms", (F.col("f.last_change") + 2000).alias("end_ms"))
