"""Checks and classes of wording: types of questions, names, noise, structure, spans; and cues that are looked up in transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import wording as W
from quillstone.operators.skew import dealt_join
from quillstone.plans.base import query
from quillstone.plans.gate import TYPE_ALIASES
from quillstone.plans.validation import _NAMES, CUED_SQL, _any, _named, cued
from quillstone.sources.adapters import segments, timeline, with_views

_Q, _A = "lower(question)", "lower(answer)"

# Keyword patterns and phrases of each type of question; words of sub-types.
TYPE_WORDS: dict[str, tuple[list[str], list[str]]] = {
    "Temporal Understanding": (["before", "after", "when", "first", "then", "prior to", "following"], ["what happens", "what does", "what is"]),
    "Sequential": (["order", "sequence", "first", "second", "third", "next"], ["what is the order", "which happens first", "in what sequence"]),
    "Subscene": (["describe", "caption", "when the score", "in the quarter", "during"], ["describe what happens", "what occurs when"]),
    "General Holistic Reasoning": (["point of video", "overall", "entire video", "throughout", "whole video"], ["what was the point", "how does", "what happens to"]),
    "Inference": (["why", "purpose", "intention", "reason", "because", "feeling"], ["why does", "why did", "what is the purpose"]),
    "Context": (["background", "foreground", "behind", "top left", "bottom right", "visible in"], ["what is", "what does", "what visual elements"]),
    "Needle": (["specific", "exact", "who is the player", "describe the graphic", "which player"], ["who is", "describe", "which"]),
    "Referential Grounding": (["who are", "what creates", "what does.*say when", "present when"], ["who are", "what creates", "what causes"]),
    "Counting": (["how many", "count", "number of", "total"], ["how many"]),
    "Comparative": (["difference", "compare", "distinction", "versus", "before and after"], ["what is the difference", "what are the distinctions"]),
    "Object Interaction Reasoning": (["how does.*change", "what happens to", "effect", "transformation"], ["how does", "what causes", "what is the effect"]),
    "Audio-Visual Stitching": (["splice", "clip", "editing", "same room", "separate clip"], ["is.*in the same room", "how do.*clips"]),
    "Spurious Correlations": (["who are they referring to", "unique event", "unexpected", "unusual"], ["who are they referring", "describe the unique"]),
}
SUB_TYPES = {
    "Human Behavior Understanding": ["person", "man", "woman", "wave", "pick up"], "Scene Recognition": ["location", "kitchen", "park", "indoor", "outdoor"], "OCR Recognition": ["text", "title", "number", "sign", "displayed"],
    "Causal Reasoning": ["before", "after", "cause", "result"], "Intent Understanding": ["glance", "check", "look", "heading"],
}


def _type_scores(has: W.Has) -> dict[str, str]:
    """Of each type its score in tenths: four a keyword, three a phrase, ten at most."""
    case = lambda c, w: f"CASE WHEN {c} THEN {w} ELSE 0 END"
    return {t: "least(10, " + " + ".join([*[case(has(_Q, k), 4) for k in keys], *[case(f"contains({_Q}, '{p}')", 3) for p in phrases]]) + ")" for t, (keys, phrases) in TYPE_WORDS.items()}


_FALLBACK = f"CASE WHEN {_any(_Q, ['before', 'after', 'when'])} THEN 'Temporal Understanding' WHEN contains({_Q}, 'how many') THEN 'Counting' WHEN {_Q} LIKE 'why%' THEN 'Inference' ELSE 'Temporal Understanding' END"
_DUCK_TYPES = "list_transform(list_sort(list_filter([" + ", ".join(f"{{'n': -({s}), 'i': {i}, 't': '{t}'}}" for i, (t, s) in enumerate(_type_scores(W.duck_has).items())) + "], lambda x: x.n <= -3)), lambda x: x.t)"


@query("f32_keyword_classifier", with_views("segments", f"SELECT id, coalesce(nullif(array_to_string({_DUCK_TYPES}, '; '), ''), {_FALLBACK}) AS types FROM c", more=CUED_SQL))
def f32(spark: SparkSession, d: str) -> DataFrame:
    scored = F.array(*[F.struct((-F.expr(s)).alias("n"), F.lit(i).alias("i"), F.lit(t).alias("t")) for i, (t, s) in enumerate(_type_scores(W.spark_has).items())])
    found = F.transform(F.array_sort(F.filter(scored, lambda x: x["n"] <= -3)), lambda x: x["t"])
    return cued(spark, d).select("id", F.when(F.size(found) > 0, F.array_join(found, "; ")).otherwise(F.expr(_FALLBACK)).alias("types"))


_SUBS = "concat_ws('; ', " + ", ".join(f"CASE WHEN {_any(_Q, words)} THEN '{t}' END" for t, words in SUB_TYPES.items()) + ")"


@query("f33_sub_types", with_views("segments", f"SELECT id, {_SUBS} AS types FROM c", more=CUED_SQL))
def f33(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).select("id", F.expr(_SUBS).alias("types"))


# Patterns of names, with the group that is the name; the last stands after the end of a sentence.
_NAME = "[A-Z][a-z]+"
NAME_PATTERNS = [
    (W.BEFORE + f"({_NAME}(?:\\s+{_NAME})*\\s+(?:says|mentions|performs|holds|wears|stands|moves))", 2), (W.BEFORE + f"({_NAME}(?:\\x27s|s\\x27)\\s+(?:hand|arm|action|position|movement))", 2),
    (W.BEFORE + "(LEGO|Nike|Adidas|Lakers|Warriors|Ferrari|Tesla|Apple|Google|Microsoft|Amazon)" + W.AFTER, 2), *[(W.BEFORE + f"({t}\\.\\s+{_NAME})" + W.AFTER, 2) for t in ("Mr", "Mrs", "Ms", "Dr")],
    (W.BEFORE + f"((?:when|where|what|how|why)\\s+{_NAME}\\s+(?:does|is|moves|says|performs))", 2), (f"[.!?]\\s({_NAME}\\s+(?:is|does|has|moves|says|performs))", 1),
]
#: A text in which the words of a turn stand where names would.
_SPOKEN = "audio || ' says so. Reply is ' || reply8 || '; Dr. ' || audio || CASE k % 4 WHEN 0 THEN ' at Google' WHEN 1 THEN ', and Anna''s hand. He moves' WHEN 2 THEN '? Tom has when Ivy does' ELSE ' Mr. Lee' END"


def _names(literal) -> str:
    return "concat_ws('|', " + ", ".join(f"nullif(regexp_extract(spoken, {literal(p)}, {g}), '')" for p, g in NAME_PATTERNS) + ")"


@query("v04_titled_names", with_views("segments", f"SELECT id, {_names(W.duck_literal)} AS names FROM (SELECT id, {_SPOKEN} AS spoken FROM c)", more=CUED_SQL))
def v04(spark: SparkSession, d: str) -> DataFrame:
    """The first match of each of nine patterns of names, case as written."""
    spoken = F.expr(_SPOKEN.replace("''s hand", "\\'s hand"))
    return cued(spark, d).select("id", spoken.alias("spoken")).select("id", F.expr(_names(W.spark_literal)).alias("names"))


def _anchored(has: W.Has) -> dict[str, str]:
    any_of = lambda c, patterns: "(" + " OR ".join(has(c, p) for p in patterns) + ")"
    return {"yes_no": has(_Q, "^(" + W.YES_NO + ")" + W.AFTER), "multi_part": any_of(_Q, W.TWO_PARTS), "generic": any_of(_A, W.GENERIC), "cue_suffix": has("lower(cue_heard)", r"is heard\.?$"), "cue_prefix": has("lower(cue_heard)", "^(the phrase|the audio)")}


@query("v06_anchored_checks", with_views("segments", "SELECT id, " + ", ".join(f"{sql} AS {c}" for c, sql in _anchored(W.duck_has).items()) + " FROM c", more=CUED_SQL))
def v06(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).select("id", *[F.expr(sql).alias(c) for c, sql in _anchored(W.spark_has).items()])


# What a transcriber puts for noise; marks that aren't speech; words beside a year in a watermark; ways to name who made subtitles.
NOISE = ["i'm sorry", "i don't know", "thank you", "thank you for watching", "please subscribe", "thanks for watching", "bye", "goodbye", "see you next time", "¶¶", "♪♪", "...", "[music]", "[silence]"]
WATERMARKS = ["copyright", "rights reserved", "all rights", "tv", "production", "media", "broadcast", "inc", "llc", "ltd", "corp"]
CREDITS = ["subtitle by", "subtitles by", "translated by", "captioned by"]
#: What was heard: every ninth segment or so is noise of one kind or another.
_HEARD = "CASE (video_id + seq) % 11 WHEN 0 THEN ' Thank you ' WHEN 1 THEN '♪ ¶ - ♪' WHEN 2 THEN 'ab' WHEN 3 THEN '© ' || text WHEN 4 THEN 'In 2019 the media said ' || text WHEN 5 THEN 'Subtitles by ' || text WHEN 6 THEN 'In 2019 ' || text ELSE text END"
_SILENT = "CAST((video_id * 7 + seq * 3) % 10 AS DOUBLE) / 10"


def _noise(has: W.Has) -> str:
    quoted = ", ".join("'" + n.replace("'", "{q}") + "'" for n in NOISE)
    mark = f"(contains(t, '©') OR contains(t, '®') OR contains(t, '™') OR ({has('t', W.BEFORE + '20[0-9][0-9]' + W.AFTER)} AND {_any('lower(t)', WATERMARKS)}) OR {_any('lower(t)', CREDITS)})"
    symbols = has("t", r"^[¶♪.,!? \n\t_-]+$")
    return f"CASE WHEN lower(t) IN ({quoted}) OR {symbols} OR {mark} THEN '[Music or background audio]' WHEN silent > 0.6 THEN '[No speech detected]' WHEN length(t) < 3 THEN '[Brief audio]' ELSE 'kept' END"


_TRIMMED = "trim(coalesce(heard, ''))"


@query("v13_noise_filter", with_views("segments", f"SELECT video_id, seq, {_noise(W.duck_has).replace('{q}', chr(39) * 2)} AS state FROM (SELECT video_id, seq, silent, {_TRIMMED} AS t FROM (SELECT *, {_HEARD} AS heard, {_SILENT} AS silent FROM segments))"))
def v13(spark: SparkSession, d: str) -> DataFrame:
    heard = segments(spark, d).select("video_id", "seq", F.expr(_HEARD).alias("heard"), F.expr(_SILENT).alias("silent"))
    return heard.select("video_id", "seq", "silent", F.expr(_TRIMMED).alias("t")).select("video_id", "seq", F.expr(_noise(W.spark_has).replace("{q}", "\\'")).alias("state"))


# Hedges that a moment's cues must not hold.
CUE_HEDGES = [r"appears?\s+to", r"seems?\s+to", r"looks?\s+like", r"could\s+be", r"may\s+be", r"might\s+be", "suggests?", "likely", "probably", "possibly"]


def _cue_issues(has: W.Has) -> str:
    both = "lower(visual || ' ' || audio || ' ' || question)"
    return "(" + " + ".join(f"CASE WHEN {has(both, W.word(p))} THEN 1 ELSE 0 END" for p in [*CUE_HEDGES, *W.PRONOUN_WORDS]) + ")"


@query("v14_cue_quality", with_views("segments", f"SELECT id, {_cue_issues(W.duck_has)} AS issues, {_cue_issues(W.duck_has)} = 0 AS clean FROM c", more=CUED_SQL))
def v14(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).select("id", F.expr(_cue_issues(W.spark_has)).alias("issues")).withColumn("clean", F.col("issues") == 0)


_KIND = "CASE k % 5 WHEN 0 THEN 'counting' WHEN 1 THEN 'temporal' WHEN 2 THEN 'needle' WHEN 3 THEN 'referential' ELSE 'other' END"


def _structure(has: W.Has) -> str:
    """The first reason of four; types without a known structure pass."""
    quoted = has("question", "[\"\\x27][^\\n]*[\"\\x27]")
    return f"CASE WHEN kind = 'other' THEN 'ok' WHEN trim(question) NOT LIKE '%?' THEN 'Question must end with ?' WHEN trim(answer) NOT LIKE '%.' THEN 'Answer must end with .' WHEN NOT {quoted} THEN 'Question must contain quoted audio cue' WHEN kind = 'counting' AND NOT {has('answer', '[0-9]')} THEN 'Counting answer must contain number' ELSE 'ok' END"


@query("v18_structure", with_views("segments", f"SELECT id, kind, {_structure(W.duck_has)} AS reason FROM (SELECT *, {_KIND} AS kind FROM c)", more=CUED_SQL))
def v18(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).withColumn("kind", F.expr(_KIND)).select("id", "kind", F.expr(_structure(W.spark_has)).alias("reason"))


_UNIFIED = f"CASE WHEN audio = '' OR visual = '' THEN 'Missing audio or visual cue' WHEN name_asked OR name_told THEN 'Contains name' WHEN NOT {_any(_Q, ['says', 'said', 'hear', 'audio', 'spoken', 'when someone'])} THEN 'No audio reference' WHEN NOT {_any(_Q, ['see', 'visible', 'screen', 'appears', 'shown', 'wearing', 'on screen'])} THEN 'No visual reference' ELSE 'Valid' END"
_TOLD = "m AS (SELECT c.*, EXISTS (SELECT 1 FROM names n WHERE n.video_id = c.video_id AND contains(lower(c.question), n.name)) AS name_asked, EXISTS (SELECT 1 FROM names n WHERE n.video_id = c.video_id AND contains(lower(c.answer), n.name)) AS name_told FROM c)"


@query("v19_unified_first_reason", with_views("segments", f"SELECT id, {_UNIFIED} AS reason FROM m", more=f"{_NAMES}, {CUED_SQL}, {_TOLD}"))
def v19(spark: SparkSession, d: str) -> DataFrame:
    return _named(spark, d)(cued(spark, d)).select("id", F.expr(_UNIFIED).alias("reason"))


_LOW, _HIGH = "least(audio_ms, visual_ms)", "greatest(audio_ms, visual_ms)"
#: Times in whole milliseconds: a time is precise if it is at most half a tenth of a second above one.
_SPAN = {
    "coverage": f"CASE WHEN {_LOW} < s THEN 'Cue before start' WHEN {_HIGH} > e THEN 'Cue after end' WHEN done > e THEN 'Action ends after end' WHEN e - s > {_HIGH} - {_LOW} + 5000 THEN 'Timestamps too long' ELSE 'ok' END",
    "precision": f"CASE WHEN s % 100 > 50 THEN 'Start timestamp not precise' WHEN e % 100 > 50 THEN 'End timestamp not precise' WHEN s < {_LOW} - 3000 THEN 'Start too early' WHEN e > {_HIGH} + 5000 THEN 'End too late' ELSE 'ok' END",
}
_TIMES = {"s": "start_ms + CASE k WHEN 3 THEN 1500 WHEN 4 THEN 70 ELSE 0 END", "e": "end_ms + CASE k WHEN 2 THEN 9000 WHEN 7 THEN 60 ELSE 0 END", "done": "CASE WHEN k % 2 = 0 THEN end_ms - CASE k WHEN 8 THEN -200 ELSE 500 END END"}


@query("v21_span_precision", with_views("segments", f"SELECT id, {', '.join(f'{sql} AS {c}' for c, sql in _SPAN.items())} FROM (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _TIMES.items())} FROM c)", more=CUED_SQL))
def v21(spark: SparkSession, d: str) -> DataFrame:
    timed = cued(spark, d).select("*", *[F.expr(sql).alias(c) for c, sql in _TIMES.items()])
    return timed.select("id", *[F.expr(sql).alias(c) for c, sql in _SPAN.items()])


def _parts(seconds: str, div: str) -> str:
    h, m, s = f"({seconds} {div} 3600)", f"({seconds} % 3600 {div} 60)", f"({seconds} % 60)"
    text = lambda x, unit: f"CAST({x} AS VARCHAR(20)) || '{unit}'"
    return f"concat_ws(' ', CASE WHEN {h} > 0 THEN {text(h, 'h')} END, CASE WHEN {m} > 0 THEN {text(m, 'm')} END, {text(s, 's')})"


def _left(div: str) -> str:
    """Time left of 100 items at the mean rate so far, in hours and minutes; none while nothing is done."""
    left = f"((ms {div} 10) * (100 - marker) {div} marker)"
    h, m = f"({left} {div} 3600)", f"({left} % 3600 {div} 60)"
    return f"CASE WHEN marker > 0 THEN CASE WHEN {h} > 0 THEN CAST({h} AS VARCHAR(20)) || 'h ' ELSE '' END || CAST({m} AS VARCHAR(20)) || 'm' END"


@query("f13_elapsed_and_left", with_views("timeline", f"SELECT seq, {_parts('(ms // 10)', '//')} AS elapsed, {_left('//')} AS time_left FROM timeline"))
def f13_elapsed(spark: SparkSession, d: str) -> DataFrame:
    """Hundredths of a media second as seconds of work; markers as items done."""
    return timeline(spark, d).select("seq", F.expr(_parts("(ms DIV 10)", "DIV")).alias("elapsed"), F.expr(_left("DIV")).alias("time_left"))


_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> ''))"
_SPLIT = "list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')"
#: What is looked up, from the words of the turn after: a beginning, the words in another order, or all of them and one more.
_LOOKED = """cues AS (SELECT video_id, seq - 1 AS cue_seq, '"' || lower(CASE seq % 3 WHEN 0 THEN array_to_string(w[1:4], ' ') WHEN 1 THEN array_to_string(list_reverse(w[1:40]), ' ') ELSE array_to_string(list_append(w, 'extra'), ' ') END) || '"' AS cue FROM (SELECT video_id, seq, """ + _SPLIT + """ AS w FROM segments))"""
_FOUND = f"""p AS (SELECT c.video_id, c.cue_seq, s.seq, contains(t, q) OR contains(q, t) AS exact, len(list_intersect({_TOKENS.format('t')}, {_TOKENS.format('q')})) / greatest(1, len(list_distinct(list_concat({_TOKENS.format('t')}, {_TOKENS.format('q')})))) AS score
  FROM (SELECT video_id, cue_seq, trim(cue, '"') AS q FROM cues) c JOIN (SELECT video_id, seq, trim(lower(text)) AS t FROM segments) s ON s.video_id = c.video_id)"""


@query("j24_containment_or_overlap", with_views("segments", "SELECT video_id, cue_seq, CASE WHEN count(*) FILTER (exact) > 0 THEN 'exact' WHEN max(score) > 0.5 THEN 'overlap' ELSE 'none' END AS found, CASE WHEN count(*) FILTER (exact) > 0 THEN min(seq) FILTER (exact) WHEN max(score) > 0.5 THEN arg_max(seq, row(score, -seq)) END AS seq FROM p GROUP BY 1, 2", more=f"{_LOOKED}, {_FOUND}"))
def j24(spark: SparkSession, d: str) -> DataFrame:
    """Where each cue is said: the first segment that holds it or that it holds, else the one that shares most words, over a half of all."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    s = segments(spark, d).select("video_id", "seq", "text", words.alias("w"))
    cue = F.when(F.col("seq") % 3 == 0, F.array_join(F.slice("w", 1, 4), " ")).when(F.col("seq") % 3 == 1, F.array_join(F.reverse(F.slice("w", 1, 40)), " ")).otherwise(F.array_join(F.array_append("w", "extra"), " "))
    cues = s.select("video_id", (F.col("seq") - 1).alias("cue_seq"), F.lower(F.trim(cue)).alias("q"))
    tokens = lambda c: F.array_distinct(F.array_remove(F.split(c, r"\s+"), ""))
    met = dealt_join(cues.withColumn("wq", tokens("q")), s.select("video_id", "seq", F.trim(F.lower("text")).alias("t")).withColumn("wt", tokens("t")), ["video_id"], ["seq"])
    exact = F.contains("t", F.col("q")) | F.contains("q", F.col("t"))
    score = F.size(F.array_intersect("wt", "wq")) / F.greatest(F.lit(1), F.size(F.array_union("wt", "wq")))
    best = met.select("video_id", "cue_seq", "seq", exact.alias("exact"), score.alias("score")).groupBy("video_id", "cue_seq").agg(
        F.min(F.when(F.col("exact"), F.col("seq"))).alias("first"), F.max("score").alias("score"), F.max_by("seq", F.struct("score", -F.col("seq"))).alias("most")
    )
    return best.select("video_id", "cue_seq", F.when(F.col("first").isNotNull(), "exact").when(F.col("score") > 0.5, "overlap").otherwise("none").alias("found"), F.coalesce("first", F.when(F.col("score") > 0.5, F.col("most"))).alias("seq"))


# How well types go together.
COMBINATIONS = {
    ("Temporal Understanding", "Sequential", "Counting"): 1.0, ("Temporal Understanding", "Sequential", "Needle"): 0.9, ("Temporal Understanding", "Sequential", "Inference"): 0.9, ("Subscene", "Needle"): 0.9, ("General Holistic Reasoning", "Inference"): 0.9,
    ("Context", "Inference", "Counting"): 0.8, ("Sequential", "Object Interaction Reasoning"): 0.8, ("Tackling Spurious Correlations", "Context"): 0.9, ("Referential Grounding", "Tackling Spurious Correlations"): 0.8, ("Audio-Visual Stitching", "Referential Grounding"): 0.8,
    ("Sequential", "Subscene", "General Holistic Reasoning"): 0.8, ("Temporal Understanding", "Counting"): 0.6, ("Sequential", "Counting"): 0.6, ("Temporal Understanding", "Comparative"): 0.7, ("Comparative", "Inference"): 0.6, ("Needle", "Referential Grounding"): 0.6, ("Context", "Counting"): 0.5,
    ("Audio-Visual Stitching", "Counting"): 0.0, ("Subscene", "Audio-Visual Stitching"): 0.0, ("Comparative", "Counting"): 0.2, ("Needle", "General Holistic Reasoning"): 0.1, ("Object Interaction Reasoning", "Audio-Visual Stitching"): 0.0,
}
#: The type that an event stands for.
_TYPED = {"view": "Temporal Understanding", "click": "Sequential", "purchase": "Counting", "signup": "Needle", "refund": "Comparative", "error": "Inference"}
_TYPE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{t}'" for e, t in _TYPED.items()) + " ELSE 'Context' END"
_SCORE = "CAST(CASE WHEN types NOT LIKE '%|%' THEN 1.0 " + " ".join(f"WHEN types = '{'|'.join(sorted(c))}' THEN {s}" for c, s in COMBINATIONS.items()) + " ELSE 0.0 END AS DOUBLE)"
_SETS = f"k AS (SELECT video_id, ms // 10000 AS part, string_agg(DISTINCT t, '|' ORDER BY t) AS types FROM (SELECT *, {_TYPE} AS t FROM timeline) GROUP BY 1, 2)"


def _type_sets(spark: SparkSession, d: str) -> DataFrame:
    """The types that stand in each ten seconds of a video."""
    typed = timeline(spark, d).select("video_id", F.expr("ms DIV 10000").alias("part"), F.expr(_TYPE).alias("t"))
    return typed.groupBy("video_id", "part").agg(F.array_join(F.array_sort(F.collect_set("t")), "|").alias("types"))


@query("j38_set_keyed_lookup", with_views("timeline", f"SELECT video_id, part, types, {_SCORE} AS score FROM k", more=_SETS))
def j38(spark: SparkSession, d: str) -> DataFrame:
    return _type_sets(spark, d).select("video_id", "part", "types", F.expr(_SCORE).alias("score"))


@query("v17_combination_validity", with_views("timeline", f"SELECT video_id, part, {_SCORE} >= 0.5 AS valid FROM k", more=_SETS))
def v17(spark: SparkSession, d: str) -> DataFrame:
    return _type_sets(spark, d).select("video_id", "part", (F.expr(_SCORE) >= 0.5).alias("valid"))


@query("f34_cooccurrence_rule", with_views("timeline", "SELECT video_id, part, array_to_string(list_transform(CASE WHEN list_contains(l, 'Sequential') AND NOT list_contains(l, 'Temporal Understanding') THEN list_concat(list_append(l[1:list_position(l, 'Sequential')], 'Temporal Understanding'), l[list_position(l, 'Sequential') + 1:]) ELSE l END, lambda x: x), '; ') AS types FROM (SELECT video_id, part, string_split(types, '|') AS l FROM k)", more=_SETS))
def f34(spark: SparkSession, d: str) -> DataFrame:
    """Temporal Understanding is put right behind Sequential where it is missing."""
    lists = _type_sets(spark, d).withColumn("l", F.split("types", r"\|"))
    at = F.array_position("l", "Sequential").cast("int")
    lacks = (at > 0) & ~F.array_contains("l", "Temporal Understanding")
    return lists.select("video_id", "part", F.array_join(F.when(lacks, F.array_insert("l", at + 1, F.lit("Temporal Understanding"))).otherwise(F.col("l")), "; ").alias("types"))


@query("f48_progress", with_views("timeline", "SELECT video_id, ms // 60000 AS part, round(count(DISTINCT event_type) / 9, 6) AS progress FROM timeline GROUP BY ALL"))
def f48(spark: SparkSession, d: str) -> DataFrame:
    """Share of nine phases that are done, minute by minute."""
    return timeline(spark, d).groupBy("video_id", F.expr("ms DIV 60000").alias("part")).agg(F.round(F.size(F.collect_set("event_type")) / 9, 6).alias("progress"))


# What each template needs of a video, and its types (short names).
_T = {short: official for short, official in TYPE_ALIASES.items()}
TEMPLATES = [
    ("Counting", "objects >= 3 AND segs >= 2", ["Counting"]), ("Temporal", "events >= 3 AND segs >= 3", ["Temporal"]), ("Sequential", "events >= 3", ["Sequential"]), ("Needle", "texts >= 2 AND segs >= 3", ["Needle"]), ("Referential", "persons >= 2 AND segs >= 3", ["Referential"]),
    ("Context", "scenes >= 2 AND segs >= 3", ["Context"]), ("Comparative", "persons >= 4 AND segs >= 2", ["Comparative"]), ("Inference", "events >= 3 AND segs >= 3", ["Inference"]), ("ObjectInteraction", "objects >= 3 AND actions >= 2", ["ObjectInteraction"]), ("Subscene", "events >= 5 AND segs >= 3", ["Subscene"]),
    ("Holistic", "changes >= 3 AND events >= 5", ["Holistic"]), ("AVStitching", "changes >= 2 AND segs >= 2", ["AVStitching"]), ("Spurious", "segs >= 3 AND objects >= 3", ["Spurious"]),
    ("TemporalSequentialCounting", "events >= 3 AND actions >= 3 AND segs >= 2", ["Temporal", "Sequential", "Counting"]), ("TemporalSequentialNeedle", "segs >= 3 AND texts >= 1 AND events >= 2", ["Temporal", "Sequential", "Needle"]), ("TemporalSequentialInference", "events >= 3 AND sounds >= 1 AND segs >= 2", ["Temporal", "Sequential", "Inference"]),
    ("SubsceneNeedle", "events >= 3 AND marked >= 1 AND segs >= 2", ["Subscene", "Needle"]), ("HolisticInference", "changes >= 3 AND events >= 5 AND segs >= 5", ["Holistic", "Inference"]), ("ContextInferenceCounting", "segs >= 3 AND persons >= 3 AND sounds >= 1", ["Context", "Inference", "Counting"]),
    ("SequentialObjectInteraction", "objects >= 3 AND actions >= 2 AND segs >= 2", ["Sequential", "ObjectInteraction"]), ("SpuriousContext", "segs >= 3 AND objects >= 2", ["Spurious", "Context"]), ("ReferentialSpurious", "segs >= 2 AND actions >= 1 AND objects >= 1", ["Referential", "Spurious"]),
    ("AVStitchingReferential", "changes >= 2 AND segs >= 2", ["AVStitching", "Referential"]), ("SequentialSubsceneHolistic", "events >= 5 AND changes >= 3 AND marked >= 1", ["Sequential", "Subscene", "Holistic"]),
]
_COMPATIBLE = {tuple(sorted(c)): s for c, s in COMBINATIONS.items()}
#: (place, name, need, compatibility): single types are compatible with themselves.
_RANKED = [(i, name, need, 1.0 if len(types) == 1 else _COMPATIBLE.get(tuple(sorted(_T[t] for t in types)), 0.0)) for i, (name, need, types) in enumerate(TEMPLATES)]
_TEMPLATE_CAP = 10
_COUNTS = {"events": "count(*)", "objects": "count(CASE WHEN event_type = 'view' THEN 1 END)", "persons": "count(CASE WHEN event_type = 'click' THEN 1 END)", "actions": "count(CASE WHEN event_type = 'purchase' THEN 1 END)", "texts": "count(CASE WHEN event_type = 'signup' AND marker > 80 THEN 1 END)", "sounds": "count(CASE WHEN event_type = 'error' AND marker > 90 THEN 1 END)", "scenes": "count(CASE WHEN event_type = 'signup' THEN 1 END)", "marked": "count(CASE WHEN marker > 97 THEN 1 END)", "changes": "count(CASE WHEN before <> event_type AND marker > 85 THEN 1 END)"}
_STATS = f"""stats AS (SELECT coalesce(a.video_id, b.video_id) AS video_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _COUNTS)}, coalesce(segs, 0) AS segs FROM (SELECT video_id, {', '.join(f'{sql} AS {c}' for c, sql in _COUNTS.items())} FROM (SELECT *, lag(event_type) OVER (PARTITION BY video_id ORDER BY ms, seq) AS before FROM timeline) GROUP BY 1) a FULL JOIN (SELECT video_id, count(*) AS segs FROM segments GROUP BY 1) b ON a.video_id = b.video_id)"""
_FITTING = " UNION ALL ".join(f"SELECT video_id, {i} AS place, '{name}' AS template, CAST({score} AS DOUBLE) AS score FROM stats WHERE {need}" for i, name, need, score in _RANKED if score >= 0.7)


@query("t17_template_selection", with_views("timeline segments", f"SELECT video_id, template, score, n FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, place) AS n FROM ({_FITTING})) WHERE n <= {_TEMPLATE_CAP}", more=_STATS))
def t17(spark: SparkSession, d: str) -> DataFrame:
    """The ten most compatible of all templates that a video's evidence allows."""
    before = F.lag("event_type").over(Window.partitionBy("video_id").orderBy("ms", "seq"))
    counts = timeline(spark, d).withColumn("before", before).groupBy("video_id").agg(*[F.expr(sql).alias(c) for c, sql in _COUNTS.items()])
    spoken = segments(spark, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("segs"))
    stats = counts.join(spoken, "video_id", "full").na.fill(0)
    fits = F.array_compact(F.array(*[F.when(F.expr(need), F.struct(F.lit(-score).alias("against"), F.lit(i).alias("place"), F.lit(name).alias("template"))) for i, name, need, score in _RANKED if score >= 0.7]))
    best = F.slice(F.array_sort(fits), 1, _TEMPLATE_CAP)
    return stats.select("video_id", F.posexplode(best).alias("n", "t")).select("video_id", "t.template", (-F.col("t.against")).alias("score"), (F.col("n") + 1).alias("n"))
