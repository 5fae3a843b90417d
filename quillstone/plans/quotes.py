"""Queries that look for quotes and cues of one turn in the words of others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.fuzzy import fuzzy_quotes, quotes_in, word_sequences, word_times
from quillstone.plans.base import query
from quillstone.sources.adapters import segments, with_views

#: Milliseconds that a word of a segment is taken to last.
WORD_MS = 300
_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '\\s+'), lambda x: x <> '')"
_CUES = f"""cues AS (SELECT video_id, seq - 1 AS cue_seq, 'says "' || array_to_string({_WORDS.format('text')}[1:2], ' ') || '" and ''' || array_to_string({_WORDS.format('text')}[3:4], ' ') || '''' AS cue FROM segments),
quotes AS (SELECT video_id, cue_seq, quote FROM (SELECT video_id, cue_seq, unnest(list_concat(regexp_extract_all(cue, '"([^"]*)"', 1), regexp_extract_all(cue, '''([^'']*)''', 1))) AS quote FROM cues) WHERE quote <> '')"""


def quotes(spark: SparkSession, d: str) -> DataFrame:
    """video_id, cue_seq, quote: what the cue of each turn quotes, which is words of the turn after it."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    part = lambda i: F.array_join(F.slice(words, i, 2), " ")
    cue = F.concat(F.lit('says "'), part(1), F.lit("\" and '"), part(3), F.lit("'"))
    return segments(spark, d).select("video_id", (F.col("seq") - 1).alias("cue_seq"), F.explode(quotes_in(cue)).alias("quote")).filter("quote <> ''")


@query("j25_verbatim_quote", with_views("segments", "SELECT q.video_id, q.cue_seq, q.quote, s.seq, contains(lower(s.text), lower(q.quote)) AS verbatim FROM quotes q JOIN segments s ON s.video_id = q.video_id AND s.seq <> q.cue_seq + 1", more=_CUES))
def j25(spark: SparkSession, d: str) -> DataFrame:
    texts = segments(spark, d).select("video_id", "seq", "text")
    return quotes(spark, d).join(texts, "video_id").filter("seq <> cue_seq + 1").select("video_id", "cue_seq", "quote", "seq", F.contains(F.lower("text"), F.lower("quote")).alias("verbatim"))


@query("j25_fuzzy_quote")
def j25_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    texts = segments(spark, d).select("video_id", "seq", "text")
    return fuzzy_quotes(quotes(spark, d), texts, "video_id", "quote", "text", ["seq"]).filter("seq <> cue_seq + 1").drop("text")


@query("j40_word_sequence")
def j40(spark: SparkSession, d: str) -> DataFrame:
    """Where four words of each turn, with other vowels, are said, near the time at which the turn starts."""
    s = segments(spark, d)
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    cues = s.select("video_id", "seq", (F.col("start_ms") + 1000).alias("near"), F.translate(F.array_join(F.slice(words, 4, 4), " "), "ea", "ae").alias("cue"))
    return word_sequences(cues, word_times(s, "video_id", "seq", "start_ms", "text", WORD_MS), "video_id", "seq", "near", "cue")
