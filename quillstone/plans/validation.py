"""Validators of questions with cues, on every turn of every conversation, with texts as they are.

Conditions are SQL text that Spark and DuckDB both read; what differs between them is made a column beforehand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import wording as W
from quillstone.functions.layers import Layer, validated, validated_sql
from quillstone.operators.joins import band_join
from quillstone.operators.skew import dealt_join
from quillstone.plans.base import query
from quillstone.sources.adapters import segments, timeline, with_views

#: Of each question: what it asks, its answer, cues and times, by kind (k), over the first words of a turn (said) and of the reply to it.
_TEXTS = {
    "audio": "CASE k WHEN 1 THEN '' WHEN 3 THEN said || ' zz' ELSE said END",
    "visual": "CASE k WHEN 4 THEN '' WHEN 9 THEN 'the person in ' || reply2 ELSE 'the ' || reply2 || ' sign' END",
    "start_ms": "start_ms", "end_ms": "start_ms + CASE k WHEN 6 THEN 65000 ELSE 22000 END",
    "audio_ms": "start_ms + CASE k WHEN 8 THEN -500 ELSE 2000 END", "visual_ms": "start_ms + CASE WHEN k = 5 THEN 30000 ELSE 19000 END",
    "complexity": "CAST(40 + 7 * k AS DOUBLE) / 100", "duration_ms": "duration_ms", "intro_ms": "10000", "outro_ms": "duration_ms - 30000",
}
_ASKED = {
    "question": "CASE k WHEN 0 THEN 'When the voice says \"' || audio || '\", what does ' || visual || ' show after that?' WHEN 1 THEN 'After the music stops, which man or which woman with ' || visual || ' appears on the left?' "
    "WHEN 2 THEN 'What color is ' || visual || ' near \"' || audio || '\" and is it large?' WHEN 3 THEN 'What does the speaker say about ' || audio || ' and ' || visual || '?' WHEN 4 THEN 'Is it shown while \"' || audio || '\" plays?' "
    "WHEN 5 THEN 'when he says ' || audio || ' who is visible near ' || visual WHEN 6 THEN 'How many people near ' || visual || ' stand up after the voice says \"' || audio || '\"?' WHEN 7 THEN 'What happens to the person when \"' || audio || '\" and ' || visual || ' are seen??' "
    "WHEN 8 THEN 'Which of the two figures might wear ' || visual || ' when someone says \"' || audio || '\", compared to before?' WHEN 9 THEN 'While \"' || audio || '\" is said, what does ' || visual || ' hold up?' ELSE 'During \"' || audio || '\", how does ' || visual || ' seem to move?' END",
    "answer": "CASE k WHEN 2 THEN 'Probably ' || reply8 WHEN 4 THEN 'Yes, it is ' || reply8 || '.' WHEN 5 THEN 'Her.' WHEN 6 THEN 'Typical of the scene, 3 people.' WHEN 9 THEN 'The figure holds ' || reply8 || ', and this is clear.' ELSE 'The sign shows ' || reply8 || '.' END",
    "audio_ref": "'audio:' || CAST(CASE k WHEN 7 THEN start_ms + 3000 ELSE start_ms END AS VARCHAR(20))", "event_ref_ms": "start_ms - start_ms % 3000 + 1500",
    "cue_heard": "CASE WHEN k % 3 = 0 THEN 'The phrase ' || audio WHEN k % 3 = 1 THEN audio || ' is heard.' ELSE audio END",
}
_SPLIT = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> '')"
_LISTED = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> ''))"
_NAMES = f"names AS (SELECT video_id, lower(name) AS name FROM (SELECT DISTINCT video_id, {_SPLIT.format('text')}[1] AS name FROM segments WHERE seq = 0) WHERE length(name) >= 5)"
CUED_SQL = f"""w AS (SELECT s.video_id, s.video_id * 1000000 + s.seq AS id, s.start_ms, max(s.end_ms) OVER (PARTITION BY s.video_id) AS duration_ms, (s.video_id * 3 + s.seq) % 11 AS k, {_SPLIT.format("coalesce(s.text, '')")} AS a, {_SPLIT.format("coalesce(n.text, '')")} AS b
  FROM segments s LEFT JOIN segments n ON n.video_id = s.video_id AND n.seq = s.seq + 1),
u AS (SELECT video_id, id, k, start_ms, duration_ms, array_to_string(a[1:3], ' ') AS said, array_to_string(b[1:2], ' ') AS reply2, array_to_string(b[1:8], ' ') AS reply8 FROM w),
t AS (SELECT video_id, id, k, reply8, {', '.join(f'{sql} AS {c}' for c, sql in _TEXTS.items())} FROM u),
c AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _ASKED.items())} FROM t)"""


def cued(spark: SparkSession, d: str) -> DataFrame:
    """Questions with cues and times: one of each turn."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    s = segments(spark, d).select("video_id", "seq", "start_ms", "end_ms", words.alias("a"))
    after = s.select("video_id", (F.col("seq") - 1).alias("seq"), F.col("a").alias("b"))
    length = s.groupBy("video_id").agg(F.max("end_ms").alias("duration_ms"))
    first = lambda c, n: F.array_join(F.slice(F.coalesce(F.col(c), F.array().cast("array<string>")), 1, n), " ")
    u = s.join(after, ["video_id", "seq"], "left").join(length, "video_id").select(
        "video_id", (F.col("video_id") * 1000000 + F.col("seq")).alias("id"), ((F.col("video_id") * 3 + F.col("seq")) % 11).alias("k"), "start_ms", "duration_ms", first("a", 3).alias("said"), first("b", 2).alias("reply2"), first("b", 8).alias("reply8")
    )
    t = u.select("video_id", "id", "k", "reply8", *[F.expr(sql).alias(c) for c, sql in _TEXTS.items()])
    return t.select("*", *[F.expr(sql).alias(c) for c, sql in _ASKED.items()])


def _word_columns(q: DataFrame) -> DataFrame:
    """What Spark and DuckDB compute in different words."""
    words = lambda c: F.array_remove(F.split(F.lower(c), r"\s+"), "")
    asked, told = words("question"), words("answer")
    return q.withColumns({
        "n_question": F.size(asked), "n_answer": F.size(told), "n_told": F.size(F.array_distinct(told)), "n_both": F.size(F.array_intersect(asked, told)),
        "has_pronoun": F.arrays_overlap(F.concat(asked, told), F.array(*[F.lit(p) for p in LAYER_PRONOUNS])),
        "n_quotes": F.length(F.regexp_replace("question", '[^"]', "")),
        "vague": F.greatest(*[F.floor((F.length(both := F.lower(F.concat_ws(" ", "question", "answer"))) - F.length(F.replace(both, F.lit(w), F.lit("")))) / len(w)) for w in LAYER_VAGUE]),
    })


# Word lists of the layers.
LAYER_PRONOUNS = ["he", "she", "they", "him", "her", "them", "his", "hers", "their"]
LAYER_VAGUE = ["someone", "something", "person", "object", "thing"]
_WORDS_SQL = f"""x AS (SELECT *, len({_SPLIT.format('question')}) AS n_question, len({_SPLIT.format('answer')}) AS n_answer, len({_LISTED.format('answer')}) AS n_told, len(list_intersect({_LISTED.format('question')}, {_LISTED.format('answer')})) AS n_both,
  list_has_any(list_concat({_LISTED.format('question')}, {_LISTED.format('answer')}), {LAYER_PRONOUNS}) AS has_pronoun, length(regexp_replace(question, '[^"]', '', 'g')) AS n_quotes,
  greatest({', '.join(f"(length(lower(question || ' ' || answer)) - length(replace(lower(question || ' ' || answer), '{w}', ''))) // {len(w)}" for w in LAYER_VAGUE)}) AS vague FROM c)"""


def _any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_Q, _A = "lower(question)", "lower(answer)"
_OUT_OF_RANGE = "(audio <> '' AND (audio_ms < start_ms OR audio_ms > end_ms)) OR (visual <> '' AND (visual_ms < start_ms OR visual_ms > end_ms))"
#: The ten layers of the orchestrator, in order; a layer's evidence is joined before it.
ORCHESTRATED = [
    ("Evidence Grounding", [("Audio cue not found in evidence", "audio <> '' AND NOT audio_said")]),
    ("Dual Cue Check", [("No audio cues present", "audio = ''"), ("No visual cues present", "visual = ''"), ("Audio cue not referenced in question", f"NOT contains({_Q}, lower(audio))"), ("Visual cue not referenced in question", f"NOT contains({_Q}, lower(visual))")]),
    ("Name Detection", [("Name detected in question", "name_asked"), ("Name detected in answer", "name_told")]),
    ("Timestamp Validation", [("Invalid timestamp range", "start_ms >= end_ms"), ("Negative start timestamp", "start_ms < 0"), ("End timestamp exceeds video duration", "end_ms > duration_ms"), ("Cue timestamp outside range", _OUT_OF_RANGE), ("Timestamp range too long", "end_ms - start_ms > 30000")]),
    ("Single Cue Answerable", [
        ("Question answerable with audio only", f"NOT (contains({_Q}, 'when') AND contains({_Q}, 'says')) AND NOT (contains({_Q}, 'after') AND {_any(_Q, ['appears', 'visible'])}) AND contains({_Q}, 'say') AND NOT contains({_Q}, 'when')"),
        ("Question answerable with visual only", f"NOT (contains({_Q}, 'when') AND contains({_Q}, 'says')) AND NOT (contains({_Q}, 'after') AND {_any(_Q, ['appears', 'visible'])}) AND {_any(_Q, ['color', 'wearing'])} AND NOT {_any(_Q, ['when', 'after'])}"),
    ]),
    ("Intro/Outro Check", [("Question starts in intro segment", "start_ms < intro_ms"), ("Question ends in outro segment", "end_ms > outro_ms")]),
    ("Complexity Check", [("Complexity score too low", "complexity < 0.5"), ("Question too short (< 8 words)", "n_question < 8"), ("Answer too short (< 5 words)", "n_answer < 5"), ("Yes/no questions too simple", f"({_Q} LIKE 'is %' OR {_Q} LIKE 'does %') AND ({_A} LIKE 'yes%' OR {_A} LIKE 'no%')")]),
    ("Descriptor Validation", [("Pronoun used instead of descriptor", "has_pronoun"), ("Too many vague references", "vague > 2")]),
    ("Cue Necessity", [("Question doesn't clearly require both cues", f"NOT {_any(_Q, ['when', 'after', 'before', 'during', 'while'])} AND NOT ({_any(_Q, ['says', 'said', 'speaks', 'shouts', 'whispers', 'hears'])} AND {_any(_Q, ['see', 'sees', 'visible', 'appears', 'shown', 'displays'])})")]),
    ("Final QC", [
        ("Question must end with ?", "question NOT LIKE '%?'"), ("Answer must end with .", "answer NOT LIKE '%.'"), ("Question must start with capital letter", "upper(substr(question, 1, 1)) <> substr(question, 1, 1)"), ("Answer must start with capital letter", "upper(substr(answer, 1, 1)) <> substr(answer, 1, 1)"),
        ("Contains double spaces", "contains(question, '  ') OR contains(answer, '  ')"), ("Unbalanced quotes in question", "n_quotes % 2 <> 0"), ("Excessive punctuation", "contains(question, '??') OR contains(question, '!!')"), ("Answer too similar to question", "n_both * 10 > n_told * 7"),
    ]),
]


def _strict(has: W.Has, unless) -> list[tuple[str, list[tuple[str, str]]]]:
    """The ten layers of the strict validator that need no model; where a model was to be asked, its failure's default holds."""
    both = "(" + " OR ".join(has(_Q, p) for p in ["after.*says.*and.*see", "when.*says.*what.*see", "what.*see.*when.*hear", "who.*visible.*when.*says", "how many.*after.*says"]) + ")"
    audio = "(" + " OR ".join(has(_Q, p) for p in [r"what.*says?\?$", r"what.*audio\?$", r"what.*heard?\?$"]) + ")"
    visual = "(" + " OR ".join(has(_Q, p) for p in [r"what.*see\?$", r"what.*visible\?$", r"what.*shown\?$"]) + ")"
    low, high = "least(audio_ms, visual_ms)", "greatest(audio_ms, visual_ms)"
    return [
        ("Dual Cue", [("No audio cues present", "trim(audio) = ''"), ("No visual cues present", "trim(visual) = ''")]),
        ("Name Blocking", [("Name found in question", "name_asked"), ("Name found in answer", "name_told"), ("Name found in cue", "name_cued")]),
        ("Descriptor", [("Pronoun found without descriptor", has(_Q, W.BEFORE + r"(he|she|his|her|him)\s")), ("Generic the person without descriptor", unless(_Q, "the person", r"\s+(?:in|with|wearing|on)"))]),
        ("Timestamp Accuracy", [("Cue before start", f"{low} < start_ms"), ("Cue after end", f"{high} > end_ms"), ("Start timestamp too early", f"start_ms < {low} - 3000"), ("End timestamp too late", f"end_ms > {high} + 5000"), ("Timestamp range too long", "end_ms - start_ms > 60000")]),
        ("Single Cue", [("Question answerable with audio only", f"NOT {both} AND {audio}"), ("Question answerable with visual only", f"NOT {both} AND NOT {_any(_Q, ['when', 'after'])} AND {visual}")]),
        ("Intro/Outro", [("Cue in intro", f"{low} < intro_ms"), ("Cue in outro", f"{high} > outro_ms")]),
        ("Spurious Correlation", []),
        ("Audio Variety", []),
        ("Complexity", [("Complexity too low", "complexity < 0.6")]),
        ("Evidence Grounding", [("Evidence reference not found", "NOT audio_near OR NOT event_near")]),
    ]


_EVIDENCE_SQL = """e AS (SELECT x.*, EXISTS (SELECT 1 FROM segments s WHERE s.video_id = x.video_id AND contains(lower(s.text), lower(x.audio))) AS audio_said,
  EXISTS (SELECT 1 FROM names n WHERE n.video_id = x.video_id AND contains(lower(x.question), n.name)) AS name_asked, EXISTS (SELECT 1 FROM names n WHERE n.video_id = x.video_id AND contains(lower(x.answer), n.name)) AS name_told,
  EXISTS (SELECT 1 FROM names n WHERE n.video_id = x.video_id AND (contains(lower(x.audio), n.name) OR contains(lower(x.visual), n.name))) AS name_cued,
  EXISTS (SELECT 1 FROM segments s WHERE s.video_id = x.video_id AND abs(s.start_ms - CAST(substr(audio_ref, 7) AS BIGINT)) < 1000) AS audio_near, EXISTS (SELECT 1 FROM timeline t WHERE t.video_id = x.video_id AND abs(t.ms - event_ref_ms) < 1000) AS event_near FROM x)"""
_ALL = f"{_NAMES}, {CUED_SQL}, {_WORDS_SQL}, {_EVIDENCE_SQL}"


def _flagged(q: DataFrame, found: DataFrame, *flags: str) -> DataFrame:
    """q with flags, false where found has no row of the id."""
    return q.join(found, "id", "left").withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def _said(spark: SparkSession, d: str):
    texts = segments(spark, d).select("video_id", "seq", F.lower("text").alias("text"))

    def add(q: DataFrame) -> DataFrame:
        hits = dealt_join(q.filter("audio <> ''").select("video_id", "id", F.lower("audio").alias("cue")), texts, ["video_id"], ["seq"]).filter("contains(text, cue)")
        return _flagged(q, hits.select("id").distinct().withColumn("audio_said", F.lit(True)), "audio_said")

    return add


def _named(spark: SparkSession, d: str):
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    names = segments(spark, d).filter("seq = 0").select("video_id", F.lower(F.get(words, 0)).alias("name")).filter("length(name) >= 5").distinct()

    def add(q: DataFrame) -> DataFrame:
        holds = lambda c: F.bool_or(F.contains(F.lower(c), F.col("name")))
        met = dealt_join(q.select("video_id", "id", "question", "answer", "audio", "visual"), names, ["video_id"], ["name"])
        found = met.groupBy("id").agg(holds("question").alias("name_asked"), holds("answer").alias("name_told"), (holds("audio") | holds("visual")).alias("name_cued"))
        return _flagged(q, found, "name_asked", "name_told", "name_cued")

    return add


def _near(spark: SparkSession, d: str):
    starts, events = segments(spark, d).select("video_id", F.col("start_ms").alias("at")), timeline(spark, d).select("video_id", F.col("ms").alias("at"))

    def add(q: DataFrame) -> DataFrame:
        refs = q.select("video_id", "id", F.expr("CAST(substr(audio_ref, 7) AS BIGINT)").alias("audio_at"), "event_ref_ms")
        heard = band_join(refs, starts, "video_id", "audio_at", "at", 1000, strict=True).select("id").distinct().withColumn("audio_near", F.lit(True))
        seen = band_join(refs, events, "video_id", "event_ref_ms", "at", 1000, strict=True).select("id").distinct().withColumn("event_near", F.lit(True))
        return _flagged(_flagged(q, heard, "audio_near"), seen, "event_near")

    return add


_PLAIN = [Layer(name, reasons) for name, reasons in ORCHESTRATED]


@query("v08_first_failure", with_views("segments timeline", validated_sql("e", _PLAIN, ["id"]), more=_ALL))
def v08(spark: SparkSession, d: str) -> DataFrame:
    evidence = {"Evidence Grounding": _said(spark, d), "Name Detection": _named(spark, d)}
    return validated(_word_columns(cued(spark, d)), [Layer(x.name, x.reasons, evidence.get(x.name)) for x in _PLAIN], ["id"])


_STRICT_SQL = [Layer(name, reasons) for name, reasons in _strict(W.duck_has, W.duck_unless)]


@query("v09_strict_layers", with_views("segments timeline", validated_sql("e", _STRICT_SQL, ["id"]), more=_ALL))
def v09(spark: SparkSession, d: str) -> DataFrame:
    evidence = {"Name Blocking": _named(spark, d), "Evidence Grounding": _near(spark, d)}
    return validated(_word_columns(cued(spark, d)), [Layer(name, reasons, evidence.get(name)) for name, reasons in _strict(W.spark_has, W.spark_unless)], ["id"])


def _vague(has: W.Has, unless, column: str) -> list[str]:
    return [unless(column, p, e) for p, e in W.VAGUE] + [has(column, W.BEFORE + f"{p}(?:{e})") for p, e in W.VAGUE_FOLLOWED]


def _count(conditions: list[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conditions) + ")"


def _vague_counts(has: W.Has, unless) -> dict[str, str]:
    return {"in_question": _count(_vague(has, unless, _Q)), "in_answer": _count(_vague(has, unless, _A))}


@query("v03_vague_references", with_views("segments", "SELECT id, " + ", ".join(f"{sql} AS {c}" for c, sql in _vague_counts(W.duck_has, W.duck_unless).items()) + " FROM c", more=CUED_SQL))
def v03(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).select("id", *[F.expr(sql).cast("int").alias(c) for c, sql in _vague_counts(W.spark_has, W.spark_unless).items()])


def _quality(has: W.Has, unless, literal: Callable[[str], str]) -> dict[str, str]:
    """Violations of the quality checker's six rules, by severity."""
    hedged = lambda c: [has(c, W.word(p)) for p in W.HEDGING_WORDS]
    # Of a single hedging word in the question, the first form found decides.
    strong = [f"regexp_extract({_Q}, {literal(W.BEFORE + '(' + p + ')' + W.AFTER)}, 2) = '{w}'" for p, w in (("might", "might"), ("seems?", "seems"), ("appears?", "appears"))]
    critical = [_count(strong), _count(hedged(_A)), _count([has(_Q, "^(" + W.YES_NO + ")" + W.AFTER)]), _count(["(" + " OR ".join(has(_Q, p) for p in W.TWO_PARTS) + ")"])]
    moderate = [f"({_count(hedged(_Q))} - {_count(strong)})", _count(hedged("lower(visual)")), _count(_vague(has, unless, _Q)), _count(_vague(has, unless, _A)), _count([has(_A, p) for p in W.GENERIC])]
    minor = [_count([has("lower(cue_heard)", r"is heard\.?$")]), _count([has("lower(cue_heard)", "^(the phrase|the audio)")])]
    return {"critical": " + ".join(critical), "moderate": " + ".join(moderate), "minor": " + ".join(minor), "valid": f"({' + '.join(critical)}) = 0"}


@query("v05_quality_checker", with_views("segments", "SELECT id, " + ", ".join(f"{sql} AS {c}" for c, sql in _quality(W.duck_has, W.duck_unless, W.duck_literal).items()) + " FROM c", more=CUED_SQL))
def v05(spark: SparkSession, d: str) -> DataFrame:
    return cued(spark, d).select("id", *[F.expr(sql).alias(c) for c, sql in _quality(W.spark_has, W.spark_unless, W.spark_literal).items()])
