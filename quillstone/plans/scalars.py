"""Scalar-function queries, over table columns and over questions and answers made of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import rules as R
from quillstone.functions import scalars as S
from quillstone.functions import wording as W
from quillstone.operators.joins import dot
from quillstone.plans.base import query
from quillstone.sources.adapters import as_double, detections, frames, questions, segments, table, timeline, with_views

#: By kind of question: its text, answer, audio and visual cue, as SQL over what a turn of a conversation said and the reply to it.
SENTENCES = {
    "temporal": ("'What happens before the whistle and ' || said || '?'", "reply", "'whistle'", "'raised hand'"),
    "counting": ("'How many people appear to be running when she says \"' || said || '\"?'", "'Maybe 15 people, at 3.5 seconds. ' || reply", "'she says ' || said", "''"),
    "needle": ("'Why does the faint sign seem to say ' || said || '?'", "'It could be the light, probably ' || reply", "''", "'faint sign in ' || reply"),
    "inference": ("'Is the speaker not similar to ' || said || '?'", "'They are.'", "'none'", "'clear face'"),
    "comparative": ("'Compare the first and the last scene, and explain ' || said || '?'", "reply || ' the first shows 2 lamps.'", "'music and clapping'", "'2 lamps'"),
    "subscene": ("said", "reply", "''", "''"),
    "context": ("'Does Nike pay? Dr. Smith says \"' || said || '\" and \"no\".'", "'Mr. Jones holds it at 12.25. ' || reply", "'applause grows'", "'obvious hidden logo'"),
}
_KIND = "CASE pmod7 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(SENTENCES)) + " END"
_PARTS = {name: "CASE kind " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in SENTENCES.items()) + " END" for i, name in enumerate(("question", "answer", "audio", "visual"))}


def _line(c: str, options: str = "") -> str:
    """The text with line ends and tabs as spaces."""
    return f"regexp_replace(coalesce({c}, ''), '[\\n\\t\\r]', ' '{options})"


SENTENCES_SQL = (
    f"turns AS (SELECT c.conv_id * 1000000 + c.turn AS id, (c.conv_id + c.turn) % 7 AS pmod7, {_line('c.text', ', ' + chr(39) + 'g' + chr(39))} AS said, {_line('n.text', ', ' + chr(39) + 'g' + chr(39))} AS reply "
    f"FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1), kinds AS (SELECT id, {_KIND} AS kind, said, reply FROM turns), "
    f"q AS (SELECT id, kind, {', '.join(f'{sql} AS {name}' for name, sql in _PARTS.items())} FROM kinds)"
)


def sentences(spark: SparkSession, d: str) -> DataFrame:
    """Questions on every turn of every conversation: id, kind, question, answer, audio, visual. Null texts are empty; the last turn has no reply."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "text")
    said = turns.select((F.col("conv_id") * 1000000 + F.col("turn")).alias("id"), ((F.col("conv_id") + F.col("turn")) % 7).alias("pmod7"), "conv_id", "turn", F.expr(_line("text")).alias("said"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    both = said.join(after, ["conv_id", "turn"], "left").select("id", F.expr(_KIND).alias("kind"), "said", F.expr(_line("next")).alias("reply"))
    return both.select("id", "kind", *[F.expr(sql).alias(name) for name, sql in _PARTS.items()])


def over_sentences(body: str) -> str:
    return f"WITH {SENTENCES_SQL} {body}"


@query("f01_parse_timestamp", with_views("timeline", "SELECT seq, CAST(ms // 1000 AS DOUBLE) AS seconds FROM timeline"))
def f01(spark: SparkSession, d: str) -> DataFrame:
    text = S.format_timestamp(F.col("ms") / 1000)
    return timeline(spark, d).select("seq", S.parse_timestamp(text).alias("seconds"))


@query("f02_mmss_to_seconds", as_double(with_views("timeline", "SELECT seq, CASE WHEN seq % 3 = 0 THEN -(ms // 1000) WHEN seq % 3 = 1 THEN ms // 1000 ELSE 0 END * 1.0 AS seconds FROM timeline"), "seconds"))
def f02(spark: SparkSession, d: str) -> DataFrame:
    code = S.seconds_to_mmss(F.col("ms") / 1000)
    text = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("-"), code)).when(F.col("seq") % 3 == 1, code).otherwise("bad")
    return timeline(spark, d).select("seq", (S.mmss_to_seconds(text) + 0.0).alias("seconds"))


@query("f03_format_timestamp", with_views("timeline", "SELECT seq, printf('%02d:%02d:%02d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60) AS code, printf('%02d:%02d', ms // 60000 % 60, ms // 1000 % 60) AS short FROM timeline"))
def f03(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("ms") / 1000
    return timeline(spark, d).select("seq", S.format_timestamp(s).alias("code"), S.format_timestamp(s, hours=False).alias("short"))


@query("f04_seconds_to_mmss", with_views("timeline", "SELECT seq, printf('%02d:%02d', greatest(ms // 1000 - 100, 0) // 60, greatest(ms // 1000 - 100, 0) % 60) AS code FROM timeline"))
def f04(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).select("seq", S.seconds_to_mmss(F.expr("ms DIV 1000") - 100).alias("code"))


@query("f05_format_check", "SELECT c_custkey, regexp_matches(c_name, '^Customer#[0-9]{9}$') AS ok FROM customer")
def f05(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.col("c_name").rlike(r"^Customer#[0-9]{9}$").alias("ok"))


@query("f06_window_expansion", with_views("timeline", "SELECT seq, CASE WHEN marker < 20 THEN greatest(0, least(lo, hi - 20000)) ELSE ms END AS start_ms, CASE WHEN marker < 20 THEN hi ELSE ms + marker * 1000 END AS end_ms FROM (SELECT *, least(720000, lo + 20000) AS hi FROM (SELECT *, greatest(0, ms - 10000) AS lo FROM timeline))"))
def f06(spark: SparkSession, d: str) -> DataFrame:
    ms = F.col("ms")
    lo, hi = S.expand_window(ms, ms + F.col("marker") * 1000, F.lit(20000), F.lit(720000), ms)
    return timeline(spark, d).select("seq", lo.cast("long").alias("start_ms"), hi.cast("long").alias("end_ms"))


@query("f07_normalize_space", with_views("segments", r"SELECT video_id, seq, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS n FROM segments"))
def f07(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("video_id", "seq", F.length(S.normalize_space(F.col("text"))).cast("long").alias("n"))


@query("f08_extract_quotes", over_sentences("SELECT id, regexp_extract_all(question, '\"([^\"]*)\"', 1) AS quotes FROM q"))
def f08(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select("id", S.extract_quotes(F.col("question")).alias("quotes"))


@query("f09_extract_numbers", over_sentences(r"SELECT id, list_transform(regexp_extract_all(answer, '\b\d+\.?\d*\b'), lambda x: CAST(x AS DOUBLE)) AS numbers FROM q"))
def f09(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select("id", S.extract_numbers(F.col("answer")).alias("numbers"))


@query("f10_md5", "SELECT doc_id, md5(text) AS h FROM documents")
def f10(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("h"))


@query("f11_id_from_url", "SELECT page_id, coalesce(nullif(regexp_extract(url, '/(?:en|fr)/([0-9]+)', 1), ''), substr(md5(url), 1, 16)) AS id FROM pages")
def f11(spark: SparkSession, d: str) -> DataFrame:
    short = F.nullif(F.regexp_extract("url", "/(?:en|fr)/([0-9]+)", 1), F.lit(""))
    return table(spark, d, "pages").select("page_id", F.coalesce(short, S.video_id_of_url(F.col("url"))).alias("id"))


@query("f12_url_checks", r"SELECT page_id, regexp_matches(url, '^https?://[^\s/$.?#].[^\s]*$') AS valid, contains(url, 'example.com') AS known FROM pages")
def f12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", S.is_url(F.col("url")).alias("valid"), F.contains("url", F.lit("example.com")).alias("known"))


_FILE_SIZE = "SELECT doc_id, CASE WHEN n_chars < 1024 THEN printf('%.1f B', CAST(n_chars AS DOUBLE)) WHEN n_chars < 1048576 THEN printf('%.1f KB', n_chars / 1024) WHEN n_chars < 1073741824 THEN printf('%.1f MB', n_chars / 1048576) ELSE printf('%.1f GB', n_chars / 1073741824) END AS size FROM documents"


@query("f13_file_size", _FILE_SIZE)
def f13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.file_size(F.col("n_chars")).alias("size"))


@query("f14_safe_json", "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k FROM events")
def f14(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.coalesce(F.from_json("props", "k INT", {"mode": "PERMISSIVE"})["k"], F.lit(-1)).alias("k"))


@query("f16_cosine", "SELECT a.vec_id, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def f16(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(dot(F.col("embedding"), F.col("other")), 6).alias("s"))


@query("f17_best_prompt", with_views("frames", "SELECT f.frame_id, p.scene_type, round(max(list_dot_product(CAST(f.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[]))), 6) AS best FROM frames f, (SELECT scene_type, embedding FROM frames WHERE frame_id < 20) p GROUP BY ALL"))
def f17(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    prompts = f.filter("frame_id < 20").agg(F.collect_list(F.struct("scene_type", "embedding")).alias("prompts"))  # twenty vectors at most
    scored = f.join(F.broadcast(prompts)).select("frame_id", F.explode(F.transform("prompts", lambda p: F.struct(p["scene_type"].alias("scene_type"), dot(F.col("embedding"), p["embedding"]).alias("s")))).alias("x"))
    return scored.groupBy("frame_id", F.col("x.scene_type").alias("scene_type")).agg(F.round(F.max("x.s"), 6).alias("best"))


@query("f19_box_geometry", with_views("detections", "SELECT video_id, part, supp, line, w * h AS area, CASE WHEN x + w / 2 < 33 THEN 'left' WHEN x + w / 2 < 66 THEN 'center' ELSE 'right' END AS side FROM detections"))
def f19(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("x") + F.col("w") / 2
    return detections(spark, d).select("video_id", "part", "supp", "line", (F.col("w") * F.col("h")).alias("area"), F.when(c < 33, "left").when(c < 66, "center").otherwise("right").alias("side"))


@query("f21_quality_class", as_double(with_views("detections", "SELECT video_id, part, supp, line, CASE WHEN w > 10 AND confidence BETWEEN 0.92 AND 0.99 THEN 1.0 WHEN w > 10 OR confidence BETWEEN 0.92 AND 0.99 THEN 0.5 ELSE 0.0 END AS quality FROM detections"), "quality"))
def f21(spark: SparkSession, d: str) -> DataFrame:
    sharp, lit = F.col("w") > 10, F.col("confidence").between(0.92, 0.99)
    return detections(spark, d).select("video_id", "part", "supp", "line", F.when(sharp & lit, 1.0).when(sharp | lit, 0.5).otherwise(0.0).alias("quality"))


@query("f22_transition_class", with_views("timeline", "SELECT seq, CASE WHEN marker > 70 THEN CASE WHEN score > 10 THEN 'cut' ELSE 'fade' END WHEN marker > 40 THEN 'dissolve' ELSE 'unknown' END AS kind FROM timeline"))
def f22(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("marker")
    return timeline(spark, d).select("seq", F.when(m > 70, F.when(F.col("score") > 10, "cut").otherwise("fade")).when(m > 40, "dissolve").otherwise("unknown").alias("kind"))


@query("f23_highlight_score", with_views("detections", "SELECT video_id, part, supp, line, round(0.4 * confidence + 0.6 * (0.3 * least(w / 50, 1) + 0.2 * least(h / 70, 1)), 6) AS score FROM detections"))
def f23(spark: SparkSession, d: str) -> DataFrame:
    one = F.lit(1.0)
    s = F.col("confidence") * 0.4 + (F.least(F.col("w") / 50, one) * 0.3 + F.least(F.col("h") / 70, one) * 0.2) * 0.6
    return detections(spark, d).select("video_id", "part", "supp", "line", F.round(s, 6).alias("score"))


@query("f24_hamming", "SELECT doc_id, CAST(bit_count(xor(doc_id, n_chars)) AS INTEGER) AS distance, round(1 - bit_count(xor(doc_id, n_chars)) / 128, 6) AS likeness FROM documents")
def f24(spark: SparkSession, d: str) -> DataFrame:
    h = F.bit_count(F.col("doc_id").bitwiseXOR(F.col("n_chars")))
    return table(spark, d, "documents").select("doc_id", h.alias("distance"), F.round(1 - h / 128, 6).alias("likeness"))


def _contained(column: str, words: list[str], join: str) -> str:
    return "(" + join.join(f"contains(lower({column}), '{w}')" + ("::INT" if join.strip() == "+" else "") for w in words) + ")"


_N_AUDIO, _N_VISUAL = "len(list_filter(string_split(audio, ' '), lambda x: x <> ''))", "len(list_filter(string_split(visual, ' '), lambda x: x <> ''))"
_BASE = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.TYPE_INFERENCE.items()) + " ELSE 5.0 END"
_INFERENCE = f"least(10.0, {_BASE} + {_contained('question', S.WHY_WORDS, ' OR ')}::INT + {_contained('question', S.COMPARE_WORDS, ' OR ')}::INT + {_contained('question', ['not', 'except'], ' OR ')}::INT * 0.5 + ({_N_VISUAL} > 2 OR {_N_AUDIO} > 2)::INT)"
_TEMPORAL = f"least(10.0, least({_contained('question', S.TEMPORAL_WORDS, ' + ')} * 2.0, 5.0) + CASE WHEN id * 15 > 60 THEN 3 WHEN id * 15 > 30 THEN 2 WHEN id * 15 > 10 THEN 1 ELSE 0 END + (kind IN ('temporal', 'sequential'))::INT * 2)"
_MULTI = f"CASE WHEN {_N_VISUAL} > 0 AND {_N_AUDIO} > 0 THEN 6.0 + least({_N_VISUAL} * 0.5, 2.0) + least({_N_AUDIO} * 0.5, 2.0) WHEN {_N_VISUAL} > 0 OR {_N_AUDIO} > 0 THEN 3.0 ELSE 1.0 END"
_SUBTLE = f"greatest(0.0, least(10.0, CASE kind WHEN 'needle' THEN 9.0 WHEN 'spurious_correlation' THEN 8.0 WHEN 'subscene' THEN 7.0 WHEN 'counting' THEN 3.0 WHEN 'context' THEN 3.0 ELSE 5.0 END + {_contained('audio', S.SUBTLE_WORDS, ' OR ')}::INT - {_contained('audio', S.CLEAR_WORDS, ' OR ')}::INT * 0.5 + {_contained('visual', S.SUBTLE_WORDS, ' OR ')}::INT - {_contained('visual', S.CLEAR_WORDS, ' OR ')}::INT * 0.5))"


def difficulty(spark: SparkSession, d: str) -> DataFrame:
    k, q = F.col("kind"), F.col("question")
    n = lambda c: F.size(S.tokens(F.col(c)))
    return sentences(spark, d).select(
        "id", S.inference_difficulty(k, q, n("visual"), n("audio")).alias("inference"), S.temporal_difficulty(k, q, F.col("id") * 15).alias("temporal"),
        S.multimodal_difficulty(k, n("visual"), n("audio")).alias("multimodal"), S.subtlety_difficulty(k, F.array("audio", "visual")).alias("subtlety"),
    )


@query("f25_to_f28_difficulty", over_sentences(f"SELECT id, CAST({_INFERENCE} AS DOUBLE) AS inference, CAST({_TEMPORAL} AS DOUBLE) AS temporal, CAST({_MULTI} AS DOUBLE) AS multimodal, CAST({_SUBTLE} AS DOUBLE) AS subtlety FROM q"))
def f25(spark: SparkSession, d: str) -> DataFrame:
    return difficulty(spark, d)


@query("f29_failure_severity", as_double(with_views("questions", "SELECT question_id, CASE status WHEN 'rejected' THEN 10 WHEN 'pending' THEN 4 ELSE 0 END * CASE WHEN hallucinated = 1 THEN 2.0 WHEN hallucinated = 0 THEN 1.0 ELSE 1.5 END AS severity FROM questions"), "severity"))
def f29(spark: SparkSession, d: str) -> DataFrame:
    base = F.when(F.col("status") == "rejected", 10).when(F.col("status") == "pending", 4).otherwise(0)
    boost = F.when(F.col("hallucinated") == 1, 2.0).when(F.col("hallucinated") == 0, 1.0).otherwise(1.5)
    return questions(spark, d).select("question_id", (base * boost).alias("severity"))


@query("f30_weighted_level", as_double(over_sentences(f"SELECT id, round(s, 6) AS score, CASE WHEN s >= 8 THEN 'expert' WHEN s >= 6 THEN 'hard' WHEN s >= 3 THEN 'medium' ELSE 'easy' END AS level FROM (SELECT id, 0.25 * {_INFERENCE} + 0.20 * {_TEMPORAL} + 0.20 * ({_MULTI}) + 0.15 * {_SUBTLE} + 0.20 * 5 AS s FROM q)"), "score"))
def f30(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("inference") * 0.25 + F.col("temporal") * 0.20 + F.col("multimodal") * 0.20 + F.col("subtlety") * 0.15 + 1.0
    return difficulty(spark, d).select("id", F.round(s, 6).alias("score"), S.level_of(s).alias("level"))


#: Keywords of question types.
TYPE_WORDS = {"temporal": ["before", "after", "when"], "counting": ["how many", "count", "number of", "total"], "comparative": ["difference", "compare", "distinction", "versus"], "inference": ["why", "purpose", "reason", "because"]}


@query("f37_severity_class", with_views("timeline", "SELECT seq, CASE WHEN marker / 100 < 0.3 THEN 'none' WHEN marker / 100 < 0.5 THEN 'low' WHEN marker / 100 < 0.7 THEN 'medium' ELSE 'high' END AS severity FROM timeline"))
def f37(spark: SparkSession, d: str) -> DataFrame:
    return timeline(spark, d).select("seq", S.severity_of(F.col("marker") / 100).alias("severity"))


@query("f38_answer_comparison", over_sentences("SELECT id, other, CASE WHEN lower(trim(answer)) = lower(trim(expected)) THEN 'correct' WHEN j >= 0.8 THEN 'close' WHEN j >= 0.2 THEN 'partial' ELSE 'wrong' END AS verdict FROM (SELECT a.id, b.id AS other, a.answer, b.answer AS expected, coalesce(len(list_intersect(list_filter(string_split(lower(a.answer), ' '), lambda x: x <> ''), list_filter(string_split(lower(b.answer), ' '), lambda x: x <> ''))) / nullif(len(list_distinct(list_filter(string_split(lower(b.answer), ' '), lambda x: x <> ''))), 0), 0) AS j FROM q a JOIN q b ON b.id = a.id + 7000000)"))
def f38(spark: SparkSession, d: str) -> DataFrame:
    """Against the answer to the question of the same kind and turn seven conversations later."""
    q = sentences(spark, d)
    expected = q.select((F.col("id") - 7_000_000).alias("id"), F.col("id").alias("other"), F.col("answer").alias("expected"))
    a, b = S.tokens(F.col("answer")), S.tokens(F.col("expected"))
    j = F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_distinct(b))), F.lit(0.0))
    same = F.lower(F.trim("answer")) == F.lower(F.trim("expected"))
    return q.join(expected, "id").select("id", "other", F.when(same, "correct").when(j >= 0.8, "close").when(j >= 0.2, "partial").otherwise("wrong").alias("verdict"))


@query("f40_token_price", "SELECT doc_id, n_chars // 4 AS tokens, round(n_chars // 4 * 0.003 / 1000, 9) AS price FROM documents")
def f40(spark: SparkSession, d: str) -> DataFrame:
    t = F.expr("n_chars DIV 4")
    return table(spark, d, "documents").select("doc_id", t.alias("tokens"), F.round(t * 0.003 / 1000, 9).alias("price"))


_SHORT = """SELECT video_id, seq, CASE WHEN length(text) <= 60 THEN text WHEN sentence <> '' AND length(sentence) <= 60 THEN sentence WHEN clause <> '' AND length(clause) <= 60 THEN clause ELSE
  list_reduce(list_prepend('', string_split(text, ' ')), lambda acc, w: CASE WHEN acc = '' THEN CASE WHEN length(w) <= 60 THEN w ELSE '' END WHEN length(acc) + 1 + length(w) <= 60 THEN acc || ' ' || w ELSE acc END) END AS quote
FROM (SELECT *, regexp_extract(text, '^([^.!?]*[.!?])', 1) AS sentence, regexp_extract(text, '^([^,;]*)[,;]', 1) AS clause FROM segments)"""


@query("f41_shorten_quote", with_views("segments", _SHORT))
def f41(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("video_id", "seq", S.shorten(F.col("text"), 60).alias("quote"))


@query("f42_event_text", with_views("timeline", "SELECT seq, CASE event_type WHEN 'view' THEN printf('a view at %d ms', ms) WHEN 'click' THEN printf('a click (%d)', marker) ELSE event_type END AS text FROM timeline"))
def f42(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_type")
    return timeline(spark, d).select("seq", F.when(k == "view", F.format_string("a view at %d ms", "ms")).when(k == "click", F.format_string("a click (%d)", "marker")).otherwise(k).alias("text"))


@query("f43_replace_names", over_sentences("SELECT id, regexp_replace(regexp_replace(question, 'Nike', 'someone', 'gi'), 'Smith', 'someone', 'gi') AS text FROM q"))
def f43(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select("id", S.replace_names(F.col("question"), ["Nike", "Smith"], "someone").alias("text"))


@query("f45_reason_text", with_views("questions", "SELECT question_id, concat_ws('; ', CASE WHEN n_chars > 3000 THEN 'long' END, CASE WHEN status = 'rejected' THEN 'rejected' END, CASE WHEN hallucinated = 1 THEN 'doubtful' END) AS reasons FROM questions"))
def f45(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).select("question_id", F.concat_ws("; ", F.when(F.col("n_chars") > 3000, "long"), F.when(F.col("status") == "rejected", "rejected"), F.when(F.col("hallucinated") == 1, "doubtful")).alias("reasons"))


@query("f46_recommendations", with_views("questions", "SELECT video_id, concat_ws('; ', CASE WHEN count(*) FILTER (status = 'rejected') >= 3 THEN 'review more' END, CASE WHEN avg(n_chars) > 2500 THEN 'shorten' END) AS advice FROM questions GROUP BY 1"))
def f46(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).groupBy("video_id").agg(F.concat_ws("; ", F.when(F.count_if(F.col("status") == "rejected") >= 3, "review more"), F.when(F.avg("n_chars") > 2500, "shorten")).alias("advice"))


@query("f47_parse_lines", over_sentences("SELECT id, trim(regexp_extract('Question: x' || chr(10) || 'Answer: ' || answer, 'Answer: (.*)$', 1)) AS answer FROM q"))
def f47(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split(F.concat(F.lit("Question: x\nAnswer: "), F.col("answer")), "\n")
    last = F.try_element_at(F.filter(lines, lambda x: F.startswith(x, F.lit("Answer:"))), F.lit(-1))
    return sentences(spark, d).select("id", F.trim(F.substr(last, F.lit(len("Answer:") + 1))).alias("answer"))


@query("f49_allocation", with_views("timeline", "SELECT video_id, CASE WHEN n >= 20 THEN 20 ELSE n END AS premium, CASE WHEN n >= 20 THEN 10 ELSE 30 - n END AS rest FROM (SELECT video_id, count(*) FILTER (marker > 70) AS n FROM timeline GROUP BY 1)"))
def f49(spark: SparkSession, d: str) -> DataFrame:
    g = timeline(spark, d).groupBy("video_id").agg(F.count_if(F.col("marker") > 70).alias("n"))
    many = F.col("n") >= 20
    return g.select("video_id", F.when(many, 20).otherwise(F.col("n")).alias("premium"), F.when(many, 10).otherwise(30 - F.col("n")).alias("rest"))


@query("f50_name_confidence", as_double(with_views("timeline", "SELECT seq, round(CASE WHEN marker % 7 = 0 THEN 1.0 WHEN event_type = 'view' THEN greatest(0.5, 1 - 0.1 * (marker % 7)) ELSE greatest(0.7, 1 - 0.05 * (marker % 7)) END, 6) AS confidence FROM timeline"), "confidence"))
def f50(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("marker") % 7
    return timeline(spark, d).select("seq", F.round(F.when(n == 0, 1.0).when(F.col("event_type") == "view", F.greatest(F.lit(0.5), 1 - n * 0.1)).otherwise(F.greatest(F.lit(0.7), 1 - n * 0.05)), 6).alias("confidence"))


# Rule engines.


def _bounded(pattern: str) -> str:
    """A word pattern with its bounds written out, as DuckDB's own know no letters beyond ASCII."""
    return W.word(pattern.removeprefix(r"\b").removesuffix(r"\b"))


#: Every character between words twice, so that neighbours don't share one.
_APART = r"regexp_replace(lower({0}), '([^\p{{L}}\p{{N}}_])', '\1\1', 'g')"


def _pattern_counts(patterns: list[str], column: str) -> str:
    return " + ".join(f"len(regexp_extract_all({_APART.format(column)}, '{_bounded(p)}'))" for p in patterns)


def _pattern_hits(patterns: list[str], column: str) -> str:
    return " + ".join(f"regexp_matches({_APART.format(column)}, '{_bounded(p)}')::INT" for p in patterns)


@query("v01_hedging", over_sentences(f"SELECT id, {_pattern_hits(R.HEDGING, 'answer')} AS violations, CAST({_pattern_counts(R.HEDGING, 'answer')} AS BIGINT) AS occurrences, ({_pattern_hits(R.HEDGING, 'answer')}) = 0 AS valid FROM q"))
def v01(spark: SparkSession, d: str) -> DataFrame:
    rules = R.rule_table(spark, {"hedging": R.HEDGING}, {"hedging": "CRITICAL"})
    return R.verdicts(sentences(spark, d), rules, ["id"], "answer").withColumn("violations", F.col("violations").cast("int"))


@query("v02_pronouns", over_sentences(f"SELECT id, {_pattern_hits(R.PRONOUNS, 'question || answer')} AS violations, CAST({_pattern_counts(R.PRONOUNS, 'question || answer')} AS BIGINT) AS occurrences, ({_pattern_hits(R.PRONOUNS, 'question || answer')}) = 0 AS valid FROM q"))
def v02(spark: SparkSession, d: str) -> DataFrame:
    rules = R.rule_table(spark, {"pronoun": R.PRONOUNS}, {"pronoun": "CRITICAL"})
    return R.verdicts(sentences(spark, d).withColumn("text", F.concat("question", "answer")), rules, ["id"]).withColumn("violations", F.col("violations").cast("int"))


@query("v12_audio_cue", over_sentences("SELECT id, CASE WHEN contains(lower(audio), 'none') THEN 'placeholder' WHEN lower(audio) IN ('music', 'whistle') THEN 'vague' WHEN length(audio) < 5 THEN 'short' WHEN len(list_filter(string_split(audio, ' '), lambda x: x <> '')) < 2 THEN 'one word' ELSE 'ok' END AS reason FROM q"))
def v12(spark: SparkSession, d: str) -> DataFrame:
    a = F.lower("audio")
    return sentences(spark, d).select("id", F.when(F.contains(a, F.lit("none")), "placeholder").when(a.isin("music", "whistle"), "vague").when(F.length(a) < 5, "short").when(F.size(S.tokens(a)) < 2, "one word").otherwise("ok").alias("reason"))


@query("v15_dual_cue", over_sentences("SELECT id, trim(audio) <> '' AND trim(visual) <> '' AS dual FROM q"))
def v15(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select("id", F.forall(F.array("audio", "visual"), lambda c: F.trim(c) != "").alias("dual"))
