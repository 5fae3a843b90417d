"""Guideline validators that list every rule a question or an answer breaks, over the questions with cues of ``validation``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import wording as W
from quillstone.operators.skew import dealt_join
from quillstone.plans.base import query
from quillstone.plans.validation import CUED_SQL, _any, _flagged, cued
from quillstone.sources.adapters import detections, segments, timeline, with_views

_Q, _A, _BOTH = "lower(question)", "lower(answer)", "lower(question || ' ' || answer)"
#: The audio cue as it is described, with the words quoted.
_HEARD = "CASE WHEN audio = '' THEN '' WHEN k % 2 = 0 THEN 'music plays while the voice says \"' || audio || '\"' ELSE 'the voice says \"' || audio || '\"' END"
# Colours that a visual cue may name.
COLORS = ["red", "blue", "green", "yellow", "orange", "purple", "pink", "black", "white", "gray", "grey", "brown", "navy", "maroon"]
_SHOWN = "CASE marker % 40 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(COLORS)) + " END"
_PARTED = "list_filter(regexp_split_to_array({0}, '{1}'), lambda x: regexp_matches(x, '\\S'))"
_EVIDENCE = f"""h AS (SELECT *, {_HEARD} AS heard FROM c),
col AS (SELECT video_id, list(DISTINCT shown) AS shown FROM (SELECT video_id, {_SHOWN} AS shown FROM timeline) WHERE shown IS NOT NULL GROUP BY 1),
ocr AS (SELECT video_id, count(*) FILTER (y > 80) / count(*) AS low_share FROM detections GROUP BY 1),
tr AS (SELECT video_id, string_agg(lower(text), chr(10)) AS all_text FROM segments GROUP BY 1),
g AS (SELECT h.*, coalesce(low_share, 0) AS low_share, coalesce(shown, []) AS shown, len({_PARTED.format('answer', '[.!?]+')}) AS n_sentences,
  len(list_filter({_PARTED.format('answer', '[.!?]+')}, lambda s: len(list_filter(regexp_split_to_array(s, '\\s+'), lambda x: x <> '')) < 3)) > 0 AS short_sentence,
  len(list_filter(regexp_split_to_array(answer, '\\s+'), lambda x: x <> '')) AS n_answer, len(list_filter(regexp_split_to_array(question, '\\s+'), lambda x: x <> '')) AS n_question, len(list_filter(regexp_split_to_array(heard, '\\s+'), lambda x: x <> '')) AS n_heard,
  (SELECT count(*) FROM segments s WHERE s.video_id = h.video_id AND contains(lower(s.text), lower(h.audio))) > 0 AS audio_said, (SELECT count(*) FROM segments s WHERE s.video_id = h.video_id AND contains(s.text, h.audio)) > 0 AS audio_exact,
  (SELECT count(*) FROM segments s WHERE s.video_id = h.video_id AND contains(lower(s.text), lower(h.answer))) > 0 AS answer_said, (SELECT count(*) FROM segments s WHERE s.video_id = h.video_id AND contains(lower(s.text), lower(h.visual))) > 0 AS visual_seen,
  len(list_filter(list_filter(regexp_split_to_array(lower(audio), '\\s+'), lambda x: x <> ''), lambda w: NOT contains(coalesce(all_text, ''), w))) = 0 AS words_said
  FROM h LEFT JOIN col USING (video_id) LEFT JOIN ocr USING (video_id) LEFT JOIN tr USING (video_id))"""
_ALL = f"{CUED_SQL}, {_EVIDENCE}"


def _evident(spark: SparkSession, d: str) -> DataFrame:
    """The questions with what the rules need to know of their video."""
    q = cued(spark, d).withColumn("heard", F.expr(_HEARD))
    shown = timeline(spark, d).withColumn("shown", F.expr(_SHOWN)).groupBy("video_id").agg(F.collect_set("shown").alias("shown"))  # as many as there are colours
    low = detections(spark, d).groupBy("video_id").agg((F.count_if(F.col("y") > 80) / F.count(F.lit(1))).alias("low_share"))
    words = lambda c: F.array_remove(F.split(c, r"\s+"), "")
    sentences = F.filter(F.split("answer", "[.!?]+"), lambda s: s.rlike(r"\S"))
    q = q.join(shown, "video_id", "left").join(low, "video_id", "left").withColumns({
        "shown": F.coalesce("shown", F.array().cast("array<string>")), "low_share": F.coalesce("low_share", F.lit(0.0)), "n_sentences": F.size(sentences), "short_sentence": F.exists(sentences, lambda s: F.size(F.array_remove(F.split(s, r"\s+"), "")) < 3),
        "n_answer": F.size(words("answer")), "n_question": F.size(words("question")), "n_heard": F.size(words("heard")),
    })
    texts = segments(spark, d).select("video_id", "seq", "text", F.lower("text").alias("low"))
    held = lambda text, part: F.bool_or(F.contains(F.col(text), F.col(part)))
    met = dealt_join(q.select("video_id", "id", "audio", *[F.lower(c).alias(f"l_{c}") for c in ("audio", "answer", "visual")]), texts, ["video_id"], ["seq"])
    found = met.groupBy("id").agg(held("low", "l_audio").alias("audio_said"), held("text", "audio").alias("audio_exact"), held("low", "l_answer").alias("answer_said"), held("low", "l_visual").alias("visual_seen"))
    q = _flagged(q, found, "audio_said", "audio_exact", "answer_said", "visual_seen")
    each = q.select("video_id", "id", F.explode(F.array_distinct(words(F.lower("audio")))).alias("w"))
    said = dealt_join(each, texts, ["video_id"], ["seq"]).groupBy("id", "w").agg(F.bool_or(F.contains("low", F.col("w"))).alias("said"))
    lacking = each.join(said.filter("said").select("id", "w"), ["id", "w"], "left_anti").select("id").distinct().withColumn("lacks", F.lit(True))
    return q.join(lacking, "id", "left").withColumn("words_said", F.col("lacks").isNull()).drop("lacks")


def _or(has: W.Has, column: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(has(column, p) for p in patterns) + ")"


# Pattern and word lists of the fifteen guidelines.
VAGUE_WORDS = ["something", "someone", "somewhere", "might", "maybe", "possibly", "probably", "approximately", "around", "roughly", "several", "a few", "some", "most"]
DIVERSE_AUDIO = "music song sound noise tone ring crowd applause clapping cheering roaring whistle buzzer bell alarm siren silence quiet pause ambient beat rhythm melody chord instrument laugh laughter gasp grunt sigh scream crash bang knock thud splash".split()
UNSAFE = ["violence", "gun", "shoot", "blood", "kill", "death", "sexual", "obscene", "explicit", "nude"]


def _fifteen(has: W.Has) -> list[str]:
    """Conditions under which the rules 1 to 15 are kept."""
    hear, see = ["hear", "say", "says", "said", "speaks", "announces", "sound", "music", "applause"], ["see", "sees", "appears", "shows", "visible", "wearing", "holding", "color", "count", "number"]
    both = f"({has(_Q, 'when\\s+.+[,.]?\\s*what\\s+.*(says|said|hear|sound|announce)')} OR ({has(_Q, 'what\\s+(.*)\\s+when\\s+')} AND {_any(_Q, ['show', 'appears', 'visible'])}) OR {has(_Q, '(how many|count).+\\s+(while|when)\\s+.+(says|hear|sound)')} OR ({_any(_Q, hear)} AND {_any(_Q, see)} AND {_any(_Q, ['when', 'while', 'as', 'during', 'and'])}))"
    parts = _or(has, _Q, [r"\(a\)", r"\(b\)", r"\(c\)", "what.*and.*what", "describe.*and", "first.*then", "both.*and.*and"])
    vague = _or(has, _BOTH, [*[W.word(w) for w in VAGUE_WORDS], W.BEFORE + r"like\s+[a-z]", W.BEFORE + r"et\s+al" + W.AFTER, W.BEFORE + r"etc"])
    wrong_color = "(" + " OR ".join(f"(contains(lower(visual), '{c}') AND NOT array_contains(shown, '{c}'))" for c in COLORS) + ")"
    order = ["before", "after", "when", "while", "during"]
    told = f"({has(_Q, '(before|after)\\s+.+\\s+(says|said|speaks)')} OR {has(_Q, 'when\\s+.+,\\s*what\\s+(do|does).+say')} OR {has(_Q, '(when|while)\\s+.+,\\s*what\\s+(do|does|hear|sound)')} OR {_any(_Q, ['says', 'said', 'speaks', 'hears', 'sound', 'music', 'applause'])})"
    return [
        "audio <> '' AND visual <> ''", both, f"NOT {parts}", f"NOT {_any(_BOTH, UNSAFE)}", "low_share < 0.3", f"NOT {_or(has, _Q, [W.word(p) for p in W.PRONOUN_WORDS])}", f"NOT {_or(has, _Q, ['at what time', 'what time', 'when does.*timestamp', 'what timestamp'])}",
        f"NOT {vague} AND NOT ({has(_Q, '^what\\s+happens')} AND length(question) < 30)", "start_ms >= 5000 AND end_ms <= duration_ms - 10000", f"NOT {wrong_color}", "start_ms < end_ms AND start_ms >= 0 AND end_ms - start_ms BETWEEN 1000 AND 60000 AND (audio = '' OR end_ms - start_ms >= n_heard * 400)",
        "audio = '' OR audio_said OR words_said OR length(audio) <= 5", f"audio <> '' AND {_any('lower(heard)', DIVERSE_AUDIO)}", _or(has, _Q, [r"when\s+you\s+see", r"when\s+.*\s+happens", r"what\s+do\s+you\s+hear\s+when", r"what\s+visual.*\s+when", r"how\s+do", r"describe\s+"]), f"NOT {_any(_Q, order)} OR {told}",
    ]


def _rules_columns(kept: list[str], tolerated: set[int] = frozenset()) -> dict[str, str]:
    """rules_passed, score, broken (numbers of the rules not kept) and valid."""
    passed = "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in kept) + ")"
    broken = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({c}) THEN '{i}' END" for i, c in enumerate(kept, 1)) + ")"
    valid = " AND ".join(f"({c})" for i, c in enumerate(kept, 1) if i not in tolerated)
    return {"rules_passed": passed, "score": f"round({passed} / CAST({len(kept)} AS DOUBLE), 6)", "broken": broken, "valid": f"({valid})"}


def _select(columns: dict[str, str]) -> str:
    return "SELECT id, " + ", ".join(f"{sql} AS {c}" for c, sql in columns.items()) + " FROM g"


_DUCK_CONTAINS = lambda sql: sql.replace("array_contains(", "list_contains(")


@query("v07_guideline_score", with_views("segments timeline detections", _DUCK_CONTAINS(_select(_rules_columns(_fifteen(W.duck_has)))), more=_ALL))
def v07(spark: SparkSession, d: str) -> DataFrame:
    return _evident(spark, d).select("id", *[F.expr(sql).alias(c) for c, sql in _rules_columns(_fifteen(W.spark_has)).items()])


# Word lists of the enhanced rules.
INTRO_OUTRO = ["at the beginning", "at the start", "in the intro", "opening scene", "first thing", "video begins", "at the end", "in the outro", "closing scene", "last thing", "video ends", "final scene"]
VIOLENT = ["gunshot", "shooting", "violence", "blood", "stabbing", "killing", "murder", "assault", "fight", "beating", "sexual", "obscene", "nude", "naked", "explicit"]
UNSURE = ["some", "several", "many", "few", "thing", "stuff", "maybe", "might", "could", "possibly", "approximately"]
POINTING = ["it", "that", "this", "these", "those"]
NOT_SPEECH = ["music", "sound", "noise", "clapping", "applause", "chirping", "playing", "melody", "tune", "tone", "pitch", "humming", "buzzing", "beep"]


def _enhanced(has: W.Has) -> dict[str, str]:
    """Violations, warnings and confidence of the enhanced rules. Penalties are in hundredths, so that both dialects add alike."""
    n = lambda conditions, weight: " + ".join(f"CASE WHEN {c} THEN {weight} ELSE 0 END" for c in conditions)
    ambiguity = f"({n([f'contains({_Q}, {chr(39)}{w}{chr(39)})' for w in UNSURE], 10)} + {n([f'contains({chr(39)} {chr(39)} || {_Q} || {chr(39)} {chr(39)}, {chr(39)} {w} {chr(39)})' for w in POINTING], 5)} + {n(['n_question > 30'], 10)})"
    several = f"({has(_Q, W.BEFORE + 'and' + W.AFTER + '[^\\n]*\\?')} OR {has('question', '[0-9]+\\)')} OR {has(_Q, '[a-z]\\)')})"
    low, high = "least(audio_ms, visual_ms)", "greatest(audio_ms, visual_ms)"
    violations = [
        ("audio = '' OR visual = ''", 50), ("(visual <> '' AND visual_seen AND answer_said) OR (audio <> '' AND audio_said AND answer_said)", 40), (f"{several} AND n_parts > 1", 30), (_any(_BOTH, VIOLENT), 100), ("low_share >= 0.3", 100), (_or(has, _BOTH, [W.word(p) for p in ("he", "she", "his", "her", "him")]), 20),
        (_or(has, _Q, ["at what time", "what timestamp", r"when \(time\)"]), 20), (_any(_BOTH, INTRO_OUTRO), 30), ("(audio <> '' AND NOT audio_said) OR (visual <> '' AND NOT visual_seen)", 30),
        (f"start_ms > {low} + 500", 20), (f"(end_ms - start_ms) * 10 > ({high} - {low} + 2000) * 15", 20), ("contains(question, '\"' || audio || '\"') AND NOT audio_exact", 20),
    ]
    unclear = f"{ambiguity} > 30"
    temporal = _or(has, _Q, [W.word(w) for w in ("before", "after", "when")])
    warnings = [unclear, f"NOT {_any('lower(heard)', NOT_SPEECH)}", f"NOT {has(_Q, 'when.*see.*hear')}", f"{temporal} AND NOT contains({_Q}, 'after') AND contains({_Q}, 'when')"]
    count = "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c, _ in violations) + ")"
    left = f"greatest(0, 100 - ({' + '.join(f'CASE WHEN {c} THEN {w} ELSE 0 END' for c, w in violations)} + CASE WHEN {unclear} THEN 10 ELSE 0 END))"
    return {"violations": count, "warnings": f"({n(warnings, 1)})", "confidence": f"CAST({left} AS DOUBLE) / 100", "valid": f"{count} = 0 AND {left} >= 70"}


_PARTS_SQL = f"p AS (SELECT g.*, len(list_filter(regexp_split_to_array(regexp_replace(question, '{W.BEFORE}and{W.AFTER}', '\\1?\\2', 'g'), '\\?'), lambda x: regexp_matches(x, '\\S'))) AS n_parts FROM g)"


@query("v10_confidence_rules", with_views("segments timeline detections", _select(_enhanced(W.duck_has)).replace("FROM g", "FROM p"), more=f"{_ALL}, {_PARTS_SQL}"))
def v10(spark: SparkSession, d: str) -> DataFrame:
    parts = F.filter(F.split(F.regexp_replace("question", f"{W.BEFORE}and{W.AFTER}", "$1?$2"), r"\?"), lambda x: x.rlike(r"\S"))
    q = _evident(spark, d).withColumn("n_parts", F.size(parts))
    return q.select("id", *[F.expr(sql).alias(c) for c, sql in _enhanced(W.spark_has).items()])


# Lists of the ten answer rules.
ANSWER_PRONOUNS = ["he", "she", "him", "her", "his", "they", "them", "their", "they're", "there"]
TEAMS = ["Lakers", "Warriors", "Celtics", "Heat", "Bulls", "Spurs", "Nets", "Knicks", "Mavericks", "Nuggets"]
AMBIGUOUS = ["something", "someone", "somewhere", "might", "maybe", "possibly", "seems", "appears", "looks", "perhaps", "apparently", "somewhat", "rather", "quite", "fairly"]
FILLERS = ["um ", "uh ", "like", "you know", "basically", "literally", "actually", "in my opinion"]
_OVER_1000 = "(^|[^0-9])0*(1000[0-9]+|100[1-9]|10[1-9][0-9]|1[1-9][0-9][0-9]|[2-9][0-9][0-9][0-9]|[1-9][0-9][0-9][0-9][0-9]+)($|[^0-9])"


def _ten(has: W.Has) -> list[str]:
    """Conditions under which the answer rules 1 to 10 are kept."""
    first = "substr(answer, 1, 1)"
    return [
        f"NOT {_or(has, _A, [W.word(p) for p in ANSWER_PRONOUNS])}", f"NOT {_or(has, 'answer', [W.BEFORE + '[A-Z][a-z]+\\s+[A-Z][a-z]+' + W.AFTER, W.BEFORE + '[A-Z]{2,}' + W.AFTER, W.word('Michael|LeBron|Kobe|Tom|John|Sarah|James')])} AND NOT {_any('answer', TEAMS)}",
        "NOT (" + " OR ".join(f"contains(' ' || {_A} || ' ', ' {w} ')" for w in AMBIGUOUS) + f") AND NOT (length(answer) < 15 AND {has(_A, 'kind of|sort of|type of|a|some')})", "n_sentences <= 3 AND n_answer BETWEEN 3 AND 40", f"visual = '' OR NOT {has('answer', _OVER_1000)}", "id IS NOT NULL",
        f"NOT short_sentence AND NOT (n_sentences = 1 AND {has('answer', '^(And|Or|But|While|After|Before) ')})", f"NOT (lower({first}) = {first} AND upper({first}) <> {first}) AND {has('answer', '[.!?]$')}", f"NOT {_any(_A, FILLERS)}",
        f"NOT (contains({_Q}, 'what') AND {_A} IN ('yes', 'no', 'yes.', 'no.')) AND NOT ({_any(_Q, ['how many', 'count'])} AND NOT {has('answer', '[0-9]')}) AND NOT ({_any(_Q, ['why', 'reason'])} AND NOT {_any(_A, ['because', 'due to', 'caused by', 'result of', 'reason'])} AND length(answer) < 20)",
    ]


@query("v11_answer_rules", with_views("segments timeline detections", _select(_rules_columns(_ten(W.duck_has), {8})), more=_ALL))
def v11(spark: SparkSession, d: str) -> DataFrame:
    """Rule 8 only warns; rule 6 is lenient and never broken."""
    return _evident(spark, d).select("id", *[F.expr(sql).alias(c) for c, sql in _rules_columns(_ten(W.spark_has), {8}).items()])
