"""Quotes and word sequences found in transcripts, allowing for errors.

Likeness of a quote and a window is 2 * LCS / (lengths), in whole percent: the share of characters that stay when one is edited into
the other by insertions and deletions. Words are compared by matching blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.operators.joins import band_join
from quillstone.operators.similarity import common_length, ratio
from quillstone.operators.skew import kept

#: A likeness that rounds to this many percent is found.
PERCENT = 80
#: Quotes and texts of a cell, and pairs of them that a task takes; a text costs as much as EACH pairs before any quote is looked for.
QUOTES, TEXTS, WORK, EACH = 2000, 500, 500_000, 50
#: Kinds of characters that the first bound tells apart; quotes and windows that are bounded at once, and those compared at once.
KINDS, SOME, WINDOWS, MATCHED = 48, 64, 4096, 1 << 16
#: What Python's split takes for white space, as a Java pattern.
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def _common_lengths(masks: np.ndarray, full: np.ndarray, q: np.ndarray, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``common_length`` of many quotes of up to 64 characters with a window each; each row of the table is one 64-bit number."""
    every = full[q]
    free = every.copy()
    for i in range(sizes.max(initial=0)):
        hit = free & masks[q, np.where(i < sizes, ids[np.minimum(starts + i, len(ids) - 1)], 0)]
        free = (free + hit | free - hit) & every
    return np.bitwise_count(every).astype(np.int64) - np.bitwise_count(free)


def best_windows(quotes: list[str], texts: list[str], least: int = PERCENT) -> np.ndarray:
    """Per quote and text 100 if it is held verbatim, else the best percent of the windows of as many words as the quote has, -1 if none reaches ``least``.

    How many characters of each kind a window shares with the quote bounds its likeness; only windows whose bound reaches ``least`` are compared.
    """
    best = np.full((len(quotes), len(texts)), -1, np.int16)
    words = [t.split() for t in texts]
    flat = [w for some in words for w in some]
    if flat and quotes:
        whole = " ".join(flat)
        sizes = np.array([len(w) for w in flat])
        begins = np.cumsum(sizes + 1) - sizes - 1
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        # Characters are numbered from 1; 0 is one that no quote has.
        lengths = np.array([len(q) for q in quotes])
        asked = np.frombuffer("".join(quotes).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(quotes)), lengths)
        place = np.arange(len(asked)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        known, number = np.unique(asked, return_inverse=True)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at = np.searchsorted(known, codes).clip(max=max(len(known) - 1, 0))
        ids = np.where(known[at] == codes, at + 1, 0) if len(known) else np.zeros(len(codes), np.int64)
        masks = np.zeros((len(quotes), len(known) + 1), np.uint64)
        short = lengths[row] <= 64
        np.bitwise_or.at(masks, (row[short], number[short] + 1), np.uint64(1) << place[short].astype(np.uint64))
        full = np.where(lengths > 0, np.uint64(2**64 - 1) >> (64 - lengths.clip(1, 64)).astype(np.uint64), np.uint64(0))
        kinds, narrow = ids % KINDS + KINDS * (ids > 0), np.min_scalar_type(int(lengths.max()))
        wanted = np.zeros((len(quotes), KINDS), np.int64)
        np.add.at(wanted, (row, (number + 1) % KINDS), 1)
        wanted = wanted.astype(narrow)
        counts = np.array([len(q.split()) for q in quotes])
        for n in np.unique(counts[counts > 0]):
            first = np.arange(len(flat) - n + 1)
            first = first[owner[first] == owner[first + n - 1]] if len(first) else first
            mine = np.flatnonzero(counts == n)
            have = np.flatnonzero(wanted[mine].any(axis=0))
            for i in range(0, len(first), WINDOWS):
                w = first[i : i + WINDOWS]
                start, end = begins[w], begins[w + n - 1] + sizes[w + n - 1]
                size = end - start
                stretch = kinds[start[0] : end[-1]]
                held = {}
                for k in have:
                    upto = np.concatenate([[0], np.cumsum(stretch == k + KINDS)])
                    held[k] = (upto[end - start[0]] - upto[start - start[0]]).clip(max=int(lengths.max())).astype(narrow)
                for j in range(0, len(mine), SOME):
                    q = mine[j : j + SOME]
                    shared = np.zeros((len(q), len(w)), narrow)
                    for k in have:
                        shared += np.minimum(wanted[q, k, None], held[k])
                    top = int(lengths[q].max() + size.max())
                    limit = np.ceil((least - 0.5) / 200 * np.arange(top + 1) - 1e-9)
                    near, win = np.nonzero(shared >= limit.clip(max=np.iinfo(narrow).max).astype(narrow)[lengths[q][:, None] + size])
                    for m in range(0, len(near), MATCHED):
                        a, b = q[near[m : m + MATCHED]], win[m : m + MATCHED]
                        common = np.zeros(len(a), np.int64)
                        fit = lengths[a] <= 64
                        common[fit] = _common_lengths(masks, full, a[fit], ids, start[b[fit]], size[b[fit]])
                        for x in np.flatnonzero(~fit):
                            common[x] = common_length(quotes[a[x]], whole[start[b[x]] : end[b[x]]])
                        found = np.rint(200 * common / (lengths[a] + size[b])).astype(np.int16)
                        like = found >= least
                        np.maximum.at(best, (a[like], owner[w[b[like]]]), found[like])
    for q, quote in enumerate(quotes):
        best[q, [quote in t for t in texts]] = 100
    return best


def _found(quotes: list[str], texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and texts, and percents, of what is found; equal quotes and equal texts are compared once."""
    one, other = {q: i for i, q in enumerate(dict.fromkeys(quotes))}, {t: i for i, t in enumerate(dict.fromkeys(texts))}
    best = best_windows(list(one), list(other), least)[np.ix_([one[q] for q in quotes], [other[t] for t in texts])]
    q, t = np.nonzero(best >= 0)
    return q, t, best[q, t]


def quotes_in(text: Column) -> Column:
    """What stands between double quotes, then between single ones."""
    return F.concat(F.regexp_extract_all(text, F.lit('"([^"]*)"'), 1), F.regexp_extract_all(text, F.lit("'([^']*)'"), 1))


def fuzzy_quotes(quotes: DataFrame, texts: DataFrame, by: str, quote: str, text: str, deal: list[str], least: int = PERCENT) -> DataFrame:
    """Pairs of a quote and a text of the same ``by`` that holds it, with ``percent`` (100 if verbatim). Case is ignored; other columns than ``by`` must differ.

    Quotes and texts of a ``by`` meet in cells of about QUOTES and TEXTS; texts are dealt to them by a hash of ``deal``, quotes by one of all columns. The number of
    tasks follows from that of pairs, not from bytes. A null or empty quote is in every text that isn't null.
    """

    @F.arrow_udf("array<struct<q:int,t:int,percent:int>>")
    def found(q: pa.Array, t: pa.Array) -> pa.Array:
        parts = [_found(a, b, least) for a, b in zip(q.to_pylist(), t.to_pylist(), strict=True)]
        columns = [pa.array(np.concatenate([p[i] for p in parts]).astype(np.int32) if parts else [], pa.int32()) for i in range(3)]
        ends = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=["q", "t", "percent"]))

    quotes, t = kept(quotes), texts.filter(F.col(text).isNotNull())
    # A key is split only if it has over TEXTS texts or QUOTES quotes, so a row is broadcast for as many of them at most.
    counts = kept(t.groupBy(by).agg(F.count(F.lit(1)).alias("__n")).join(quotes.groupBy(by).agg(F.count(F.lit(1)).alias("__m")), by))
    work = counts.agg(F.sum(F.col("__n") * (F.col("__m") + EACH))).first()[0] or 0
    tasks = max(1, -(-int(work) // WORK))
    cells = counts.filter((F.col("__n") > TEXTS) | (F.col("__m") > QUOTES)).select(by, F.ceil(F.col("__m") / QUOTES).cast("int").alias("__qs"), F.ceil(F.col("__n") / TEXTS).cast("int").alias("__ts"))
    qs, ts = F.coalesce("__qs", F.lit(1)), F.coalesce("__ts", F.lit(1))

    def dealt(rows: DataFrame, own: str, parts: Column, key: list[str], other: str, others: Column, name: str) -> DataFrame:
        """A row for each cell of one side, with its rows as an array, for each cell of the other side."""
        placed = rows.join(F.broadcast(cells), by, "left").withColumn(own, F.pmod(F.xxhash64(*key), parts).cast("int")).withColumn(other, others)
        lists = placed.groupBy(by, own, other).agg(F.collect_list(F.struct(*[c for c in rows.columns if c != by])).alias(name))
        return lists.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).repartition(tasks, by, "__q", "__t")

    left = dealt(quotes, "__q", qs, quotes.columns, "__t", ts, "__quotes")
    right = dealt(t, "__t", ts, deal, "__q", qs, "__texts")
    both = left.join(right, [by, "__q", "__t"])
    # Lower case is Spark's.
    low = lambda name, column: F.transform(name, lambda x: F.lower(F.coalesce(x[column], F.lit(""))))
    hits = both.withColumn("__hit", F.explode(found(low("__quotes", quote), low("__texts", text))))
    q, t = F.get("__quotes", F.col("__hit.q")), F.get("__texts", F.col("__hit.t"))
    return hits.select(by, *[q[c].alias(c) for c in quotes.columns if c != by], *[t[c].alias(c) for c in texts.columns if c != by], F.col("__hit.percent").alias("percent"))


def word_times(segments: DataFrame, by: str, seq: str, start: str, text: str, word_ms: int) -> DataFrame:
    """(by, pos, word, word_ms) of every word: its place among all words of ``by``, and its start if each takes ``word_ms``.

    Places are running sums of the word counts of segments, so only segments are sorted, not words.
    """
    words = segments.select(by, seq, start, F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SPACE), "").alias("__words"))
    before = Window.partitionBy(by).orderBy(seq, start).rowsBetween(Window.unboundedPreceding, -1)
    placed = words.withColumn("__before", F.coalesce(F.sum(F.size("__words")).over(before), F.lit(0)))
    return placed.select(by, start, "__before", F.posexplode("__words").alias("__i", "word")).select(by, (F.col("__before") + F.col("__i")).alias("pos"), "word", (F.col(start) + F.col("__i") * word_ms).alias("word_ms"))


def word_sequences(cues: DataFrame, words: DataFrame, by: str, key: str, near: str, text: str, within_ms: int = 5000, share: float = 0.7, each_ms: int = 500) -> DataFrame:
    """(by, key, start_ms, end_ms, matched) of each cue: where its words are said one after the other, nearest to the time ``near``.

    words: by, pos, word, word_ms. A run of as many words matches if a ``share`` of them are like the cue's at the same place: equal, or of a ratio of
    ``share`` or more. Runs start within ``within_ms``; of two as near, the earlier counts. end_ms is the start of the last word. A cue that is said nowhere near, or has no
    words, gets its own time, ``each_ms`` a word, and matched is false.
    """

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio(x, y) >= share for x, y in zip(a, b, strict=True)], dtype="bool")

    own = cues.select(by, key, F.col(near).alias("__when"), F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SPACE), "").alias("__cue")).withColumn("__n", F.size("__cue"))
    starts = band_join(own, words.select(by, "pos", F.col("word_ms").alias("__start")), by, "__when", "__start", within_ms)
    # Word i of the cue meets the word at place p + i.
    asked = starts.select(by, key, "__when", "__start", "pos", "__n", F.posexplode("__cue").alias("__i", "__want")).withColumn("__at", F.col("pos") + F.col("__i"))
    met = kept(asked.join(words.select(by, F.col("pos").alias("__at"), "word", "word_ms"), [by, "__at"]))
    # Unequal words are compared once, however often they meet; lengths alone rule out most.
    a, b = F.length("word"), F.length("__want")
    differ = met.filter((F.col("word") != F.col("__want")) & (2 * F.least(a, b) >= share * (a + b) - 1e-9)).select("word", "__want").distinct()
    like = differ.filter(alike("word", "__want")).withColumn("__like", F.lit(1))
    hits = met.join(like, ["word", "__want"], "left").withColumn("__hit", F.when(F.col("word") == F.col("__want"), 1).otherwise(F.coalesce("__like", F.lit(0))))
    runs = hits.groupBy(by, key, "pos", "__when", "__start", "__n").agg(F.sum("__hit").alias("__hits"), F.count(F.lit(1)).alias("__found"), F.max("word_ms").alias("__end"))
    whole = runs.filter((F.col("__found") == F.col("__n")) & (F.col("__hits") / F.col("__n") >= share))
    best = whole.groupBy(by, key).agg(F.min_by(F.struct("__start", "__end"), F.struct(F.abs(F.col("__start") - F.col("__when")), "pos")).alias("__best"))
    return own.join(best, [by, key], "left").select(
        by, key, F.coalesce("__best.__start", "__when").alias("start_ms"), F.coalesce(F.col("__best.__end"), F.col("__when") + F.col("__n") * each_ms).alias("end_ms"), F.col("__best").isNotNull().alias("matched")
    )
