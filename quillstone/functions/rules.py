"""One engine for all text rules: a table of patterns joined to texts, then aggregated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pattern lists of the guideline rules.
HEDGING = [
    r"\bappears?\s+to\b", r"\bappears?\b", r"\bseems?\s+to\b", r"\bseems?\b", r"\blooks?\s+like\b", r"\bcould\s+be\b", r"\bmay\s+be\b", r"\bmight\s+be\b",
    r"\bmight\b", r"\bmay\b", r"\bmaybe\b", r"\blikely\b", r"\bprobably\b", r"\bpossibly\b", r"\bperhaps\b", r"\bsuggest(s|ing|ed)?\b",
]
PRONOUNS = [r"\bhe\b", r"\bshe\b", r"\bthey\b", r"\bhim\b", r"\bher\b", r"\bthem\b", r"\bhis\b", r"\bhers\b", r"\btheir\b", r"\btheirs\b"]


def rule_table(spark: SparkSession, rules: dict[str, list[str]], severity: dict[str, str], *, ignore_case: bool = True) -> DataFrame:
    """rule, ordinal, pattern, severity: one row per pattern, a fixed few."""
    flag = "(?i)" if ignore_case else ""
    rows = [(rule, i, flag + p, severity.get(rule, "MODERATE")) for rule, patterns in rules.items() for i, p in enumerate(patterns)]
    quoted = ", ".join("('{}', {}, r'{}', '{}')".format(r, i, p.replace("'", "\\x27"), s) for r, i, p, s in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS r(rule, ordinal, pattern, severity)")


def matches(texts: DataFrame, rules: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key, rule, severity, ordinal and n (occurrences) of every rule pattern found in a text.

    The rules are a fixed few and travel as one array in each row, so no join multiplies the texts.
    """
    listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.asDict().items()]) for r in rules.collect()])
    hits = F.filter(F.transform(listed, lambda r: r.withField("n", F.regexp_count(F.col(text), r["pattern"]))), lambda r: r["n"] > 0)
    return texts.select(*key, F.explode(hits).alias("r")).select(*key, "r.rule", "r.severity", "r.ordinal", "r.n")


def verdicts(texts: DataFrame, rules: DataFrame, key: list[str], text: str = "text", stop: str = "CRITICAL") -> DataFrame:
    """key, violations, occurrences, valid: a text is valid if no rule of the severity ``stop`` matches."""
    found = matches(texts, rules, key, text).groupBy(*key).agg(F.count(F.lit(1)).alias("violations"), F.sum("n").alias("occurrences"), F.bool_or(F.col("severity") == stop).alias("stopped"))
    return texts.select(*key).join(found, key, "left").select(*key, F.coalesce("violations", F.lit(0)).alias("violations"), F.coalesce("occurrences", F.lit(0)).alias("occurrences"), (~F.coalesce("stopped", F.lit(False))).alias("valid"))
