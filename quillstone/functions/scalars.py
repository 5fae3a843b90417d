"""Scalar functions as column expressions: time codes, text, geometry, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(c: Column) -> Column:
    """Seconds of ``H:M:S``, ``M:S`` or ``S``; null for anything else."""
    text = F.trim(c)
    parts = F.transform(F.split(text, ":"), lambda p: F.expr("0D") + p.try_cast("int"))
    ok = text.rlike(r"^\d+(:\d+){0,2}$")
    return F.when(ok, F.aggregate(parts, F.lit(0.0), lambda acc, p: acc * 60 + p))


def format_timestamp(seconds: Column, hours: bool = True) -> Column:
    """``HH:MM:SS``, or ``MM:SS`` of the minutes within the hour."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.format_string("%02d:%02d:%02d", h, m, r) if hours else F.format_string("%02d:%02d", m, r)


def seconds_to_mmss(seconds: Column) -> Column:
    s = F.greatest(F.floor(seconds).cast("long"), F.lit(0))
    return F.format_string("%02d:%02d", F.floor(s / 60).cast("long"), s % 60)


def mmss_to_seconds(c: Column) -> Column:
    """Seconds of ``[-]MM:SS``; 0 for anything else."""
    minutes, rest = F.regexp_extract(c, r"^-?(\d+):(\d+)$", 1), F.regexp_extract(c, r"^-?(\d+):(\d+)$", 2)
    value = minutes.try_cast("double") * 60 + rest.try_cast("double")
    return F.coalesce(F.when(F.startswith(c, F.lit("-")), -value).otherwise(value), F.lit(0.0))


def normalize_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def extract_quotes(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit('"([^"]*)"'), 1)


def extract_numbers(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(r"\b\d+\.?\d*\b"), 0), lambda x: x.cast("double"))


def video_id_of_url(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"/d/([A-Za-z0-9_-]+)", 1), F.lit("")), F.substring(F.md5(c), 1, 16))


def is_url(c: Column) -> Column:
    return c.rlike(r"^https?://[^\s/$.?#].[^\s]*$")


def tokens(c: Column) -> Column:
    """Lower-cased words at white space; none for an empty text."""
    return F.array_remove(F.split(F.lower(F.trim(c)), r"\s+"), "")


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def expand_window(start: Column, end: Column, least: Column, duration: Column, at: Column) -> tuple[Column, Column]:
    """A window shorter than ``least`` is centred at ``at`` and moved inside [0, duration]."""
    short = end - start < least
    lo = F.greatest(F.lit(0.0), at - least / 2)
    hi = F.least(duration, lo + least)
    lo = F.greatest(F.lit(0.0), F.least(lo, hi - least))
    return F.when(short, lo).otherwise(start), F.when(short, hi).otherwise(end)


def count_contained(text: Column, words: list[str]) -> Column:
    """How many of the words are substrings of the text; a word inside another counts."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(w)).cast("int") for w in words])


def any_contained(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


# Scores and word lists of the difficulty model.
TYPE_INFERENCE = {
    "counting": 2.0, "context": 3.0, "temporal": 5.0, "sequential": 6.0, "inference": 8.0, "comparative": 7.0, "object_interaction": 6.0,
    "general_holistic": 7.0, "audio_visual_stitching": 8.0, "spurious_correlation": 9.0, "needle": 8.0, "referential_grounding": 5.0, "subscene": 6.0,
}
WHY_WORDS = ["why", "explain", "reasoning", "because"]
COMPARE_WORDS = ["compare", "contrast", "difference", "similar"]
TEMPORAL_WORDS = ["before", "after", "during", "while", "when", "first", "last", "earlier", "later", "previous", "next", "simultaneous", "sequence"]
SUBTLE_WORDS = ["subtle", "faint", "brief", "hidden", "background"]
CLEAR_WORDS = ["prominent", "obvious", "clear", "visible"]


def inference_difficulty(kind: Column, question: Column, n_visual: Column, n_audio: Column) -> Column:
    """0 to 10: a base by type, more for explanations, comparisons, negation and many cues."""
    q = F.lower(question)
    base = F.coalesce(F.create_map(*[x for k, v in TYPE_INFERENCE.items() for x in (F.lit(k), F.lit(v))])[F.lower(kind)], F.lit(5.0))
    bonus = any_contained(q, WHY_WORDS).cast("double") + any_contained(q, COMPARE_WORDS).cast("double") + any_contained(q, ["not", "except"]).cast("double") * 0.5
    return F.least(F.lit(10.0), base + bonus + ((n_visual > 2) | (n_audio > 2)).cast("double"))


def temporal_difficulty(kind: Column, question: Column, span_s: Column) -> Column:
    """0 to 10: time words, the span of the cues, and the type."""
    words = F.least(count_contained(F.lower(question), TEMPORAL_WORDS) * 2.0, F.lit(5.0))
    span = F.when(span_s > 60, 3.0).when(span_s > 30, 2.0).when(span_s > 10, 1.0).otherwise(0.0)
    return F.least(F.lit(10.0), words + span + F.lower(kind).isin("temporal", "sequential").cast("double") * 2)


def multimodal_difficulty(kind: Column, n_visual: Column, n_audio: Column) -> Column:
    both = 6.0 + F.least(n_visual * 0.5, F.lit(2.0)) + F.least(n_audio * 0.5, F.lit(2.0))
    base = F.when((n_visual > 0) & (n_audio > 0), both).when((n_visual > 0) | (n_audio > 0), 3.0).otherwise(1.0)
    return F.least(F.lit(10.0), base + (F.lower(kind) == "audio_visual_stitching").cast("double") * 2)


def subtlety_difficulty(kind: Column, cues: Column) -> Column:
    k = F.lower(kind)
    base = F.when(k == "needle", 9.0).when(k == "spurious_correlation", 8.0).when(k == "subscene", 7.0).when(k.isin("counting", "context"), 3.0).otherwise(5.0)
    score = F.aggregate(cues, base, lambda s, c: s + any_contained(F.lower(c), SUBTLE_WORDS).cast("double") - any_contained(F.lower(c), CLEAR_WORDS).cast("double") * 0.5)
    return F.least(F.lit(10.0), F.greatest(F.lit(0.0), score))


def severity_of(score: Column) -> Column:
    return F.when(score < 0.3, "none").when(score < 0.5, "low").when(score < 0.7, "medium").otherwise("high")


def level_of(score: Column) -> Column:
    return F.when(score >= 8, "expert").when(score >= 6, "hard").when(score >= 3, "medium").otherwise("easy")


def replace_names(text: Column, names: list[str], by: str) -> Column:
    """Every occurrence of each name, in any case, replaced."""
    return reduce(lambda t, n: F.regexp_replace(t, f"(?i){n}", by), names, text)


def shorten(c: Column, most: int) -> Column:
    """The text if it fits; else its first sentence, else its first clause, else words up to ``most``."""
    sentence, clause = F.regexp_extract(c, r"^([^.!?]*[.!?])", 1), F.regexp_extract(c, r"^([^,;]*)[,;]", 1)
    fits = lambda x: (x != "") & (F.length(x) <= most)
    words = F.aggregate(F.split(c, " "), F.lit(""), lambda acc, w: F.when(acc == "", F.when(F.length(w) <= most, w).otherwise("")).when(F.length(acc) + 1 + F.length(w) <= most, F.concat(acc, F.lit(" "), w)).otherwise(acc))
    return F.when(F.length(c) <= most, c).when(fits(sentence), sentence).when(fits(clause), clause).otherwise(words)


def file_size(n: Column) -> Column:
    """One decimal; a tie goes to the even tenth, as in Python and DuckDB."""
    kb = 1024.0
    tenths = lambda unit, x: F.format_string(f"%.1f {unit}", F.bround(x, 1))
    return (
        F.when(n < kb, tenths("B", n.cast("double"))).when(n < kb**2, tenths("KB", n / kb))
        .when(n < kb**3, tenths("MB", n / kb**2)).otherwise(tenths("GB", n / kb**3))
    )
