"""Line dedup: overlapping three-line windows, found globally, later occurrences removed.

Every three consecutive lines are hashed to 128 bits. Windows that occur more than once are found by a
pre-aggregated group-by that keeps only the first place and a count, so a very common window never
gathers its rows. Joined back, the most frequent by broadcast, all places but the first are covered, and what the covered places of
a document add up to is cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import HOT_KEYS, checkpointed, text_or_empty

WINDOW = 3


def line_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """h1, h2, place (doc_id, th, pos) of every window of three lines that isn't blank."""
    trimmed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("th"), F.transform(F.split(text_or_empty(text_col), "\n", -1), lambda x: F.trim(x)).alias("lines"))
    at = lambda i, k: F.get("lines", i + k)
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("lines") - WINDOW),
        lambda i: F.when(
            (at(i, 0) != "") | (at(i, 1) != "") | (at(i, 2) != ""),
            F.struct(F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).alias("h1"), F.xxhash64(F.lit(1), at(i, 2), at(i, 1), at(i, 0)).alias("h2")),
        ),
    )
    return (
        trimmed.filter(F.size("lines") >= WINDOW).select("doc_id", "th", F.posexplode(hashed).alias("pos", "h")).filter(F.col("h").isNotNull())
        .select(F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"), F.struct("doc_id", "th", "pos").alias("place"))
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs, with text_col rewritten, plus n_lines and n_removed_lines.

    Lines are split at ``\\n`` and compare without outer spaces. A window of three lines that occurs
    at an earlier place (smaller id, then smaller text hash, then smaller line number) is removed;
    windows of blank lines alone and texts of under three lines are left alone. A null text becomes
    empty. Null ids sort first. Repeated rows (same id, same text) are one document and get the same
    result. Extra columns pass through; n_lines and n_removed_lines replace columns of those names.
    """
    windows = line_windows(docs, id_col, text_col)
    repeated = checkpointed(windows.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # The most frequent windows are broadcast, and their places dealt out; any other window has fewer than a HOT_KEYS-th of all places.
    hot = checkpointed(repeated.orderBy(F.desc("n"), "h1", "h2").limit(HOT_KEYS).select("h1", "h2", F.col("first").alias("hot")))
    marked = windows.join(F.broadcast(hot), ["h1", "h2"], "left").select("h2", "place", "hot", F.when(F.col("hot").isNull(), F.col("h1")).otherwise(F.xxhash64("place")).alias("key"))
    met = marked.join(repeated.select(F.col("h1").alias("key"), "h2", "first"), ["key", "h2"], "left")
    covered = (
        met.filter(F.col("place") > F.coalesce("hot", "first"))
        .groupBy(F.col("place.doc_id").alias("__id"), F.col("place.th").alias("__th")).agg(F.array_sort(F.collect_set("place.pos")).alias("__at"))
    )
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    joined = docs.select(*own, F.xxhash64(text_or_empty(text_col)).alias("__key")).join(covered, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__th")), "left")
    lines, at = F.split(text_or_empty(text_col), "\n", -1), F.col("__at")
    # What lies between the end of one covered window and the start of the next is kept; overlapping windows leave nothing between.
    start = lambda i: F.when(i == 0, 0).otherwise(F.get(at, i - 1) + WINDOW)
    stop = lambda i: F.coalesce(F.get(at, i), F.size(lines))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(at)), lambda i: F.slice(lines, start(i) + 1, F.greatest(F.lit(0), stop(i) - start(i)))))
    cut = joined.withColumn("__kept", F.when(at.isNull(), lines).otherwise(kept))
    return cut.select(
        *[F.when(at.isNull(), text_or_empty(c)).otherwise(F.array_join("__kept", "\n")).alias(c) if c == text_col else F.col(c) for c in own],
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size("__kept")).cast("long").alias("n_removed_lines"),
    )


OP3_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), w AS (
  SELECT doc_id, i, trim(lines[i]) || chr(10) || trim(lines[i + 1]) || chr(10) || trim(lines[i + 2]) AS win
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM d WHERE len(lines) >= 3)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w WHERE win <> chr(10) || chr(10)) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS spots FROM later, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
)
SELECT d.doc_id,
       array_to_string(list_filter(lines, lambda x, i: spots IS NULL OR NOT list_contains(spots, i)), chr(10)) AS text,
       len(lines) AS n_lines, len(list_filter(lines, lambda x, i: spots IS NOT NULL AND list_contains(spots, i))) AS n_removed_lines
FROM d LEFT JOIN gone USING (doc_id)
"""
