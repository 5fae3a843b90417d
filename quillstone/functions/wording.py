"""Wording rules as text that Spark and DuckDB both read.

Word bounds are written out, so that letters of all scripts count as letters in both. A look-ahead, which one of them lacks, is
stated as a match and its exceptions: the excepted places are blanked, then the rest is searched.
"""

from __future__ import annotations

from collections.abc import Callable

#: What stands before and after a word.
BEFORE, AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"

Has = Callable[[str, str], str]


def spark_literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def duck_literal(pattern: str) -> str:
    return "'" + pattern.replace("'", r"\x27") + "'"


def spark_has(column: str, pattern: str) -> str:
    return f"regexp_like({column}, {spark_literal(pattern)})"


def duck_has(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {duck_literal(pattern)})"


def word(pattern: str) -> str:
    """The pattern between word bounds."""
    return BEFORE + "(?:" + pattern + ")" + AFTER


def spark_unless(column: str, pattern: str, exceptions: str) -> str:
    """Whether the words of pattern stand somewhere without any of the exceptions behind them."""
    once = lambda c: f"regexp_replace({c}, {spark_literal(BEFORE + '(?:' + pattern + ')(?:' + exceptions + ')')}, '$1~ ')"
    # Neighbours share the character between them, so every second one is found in a second pass.
    return spark_has(once(once(column)), word(pattern))


def duck_unless(column: str, pattern: str, exceptions: str) -> str:
    once = lambda c: f"regexp_replace({c}, {duck_literal(BEFORE + '(?:' + pattern + ')(?:' + exceptions + ')')}, '\\1~ ', 'g')"
    return duck_has(once(once(column)), word(pattern))


# References that say nothing without what follows, with what may follow; and those that something must follow.
VAGUE = [("the figure", " with | in "), ("the model", " with | in "), ("the person", " with | in | who | wearing "), ("the object", " with | in "), ("it", " is | was | appears | shows"), ("the scene", " with | depicts "), ("the structure", " with | in ")]
VAGUE_FOLLOWED = [("this", " is | was | suggests | indicates ")]
# How yes-no questions begin, what generic answers say, how a question asks two things.
YES_NO = "is|are|isn't|aren't|does|do|doesn't|don't|was|were|wasn't|weren't|did|didn't|has|have|had|hasn't|haven't|hadn't|will|won't|can|can't|could|couldn't|would|wouldn't|should|shouldn't|may|might|must"
GENERIC = ["^the scene (depicts|shows|displays)", "^the visual (shows|depicts)", "^the context suggests", "suggests a scenario", "indicating a", "typical (in|of)"]
TWO_PARTS = [BEFORE + "or" + AFTER + r"[^\n]*\?", BEFORE + r"or\?", "compared to", "differences[^\n]*before and after"]
# Hedging words, as word patterns.
HEDGING_WORDS = [
    r"appears?\s+to", "appears?", r"seems?\s+to", "seems?", r"looks?\s+like", r"could\s+be", r"may\s+be", r"might\s+be", "might", "may", "maybe", "likely", "probably", "possibly", "perhaps", "suggest(?:s|ing|ed)?",
]
PRONOUN_WORDS = ["he", "she", "they", "him", "her", "them", "his", "hers", "their", "theirs"]
