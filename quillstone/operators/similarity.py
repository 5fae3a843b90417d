"""String similarity by matching blocks, and order-dependent deduplication that needs it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.operators.graph import components
from quillstone.operators.skew import dealt_join, kept

#: Kinds of characters told apart by a first bound; pairs of texts that a task compares.
KINDS, PAIRS = 128, 100_000
#: What Python's strip takes for white space, as a Java pattern.
_SPACE = r"[\s\x1c-\x1f]+"


def ratio(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, (a or "").lower().strip(), (b or "").lower().strip()).ratio()


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence; the rows of the table are bits of one number."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    free = every
    for c in b:
        hit = free & at.get(c, 0)
        free = (free + hit | free - hit) & every
    return len(a) - free.bit_count()


def _shared(a: pd.Series, b: pd.Series) -> np.ndarray:
    """How many characters of each kind both texts of a pair have, in sum. Kinds that are equal modulo KINDS count as one, which only adds to it."""
    texts, place = np.unique(np.concatenate([a.to_numpy(object), b.to_numpy(object)]).astype(object), return_inverse=True)
    counts = np.stack([np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) % KINDS, minlength=KINDS) for t in texts])
    one, other = place[: len(a)], place[len(a) :]
    return np.concatenate([np.minimum(counts[one[at : at + 1000]], counts[other[at : at + 1000]]).sum(axis=1) for at in range(0, len(a), 1000)])


def can_exceed(a: str, b: str, above: float) -> bool:
    """Whether matching blocks can cover more than the share ``above``, by the bounds of ``ratios_above``, for one pair."""
    least = above * (len(a) + len(b))
    if not a or not b:
        return a == b
    return 2 * sum((Counter(a) & Counter(b)).values()) > least and 2 * common_length(a, b) > least


def ratios_above(a: pd.Series, b: pd.Series, above: float) -> np.ndarray:
    """Ratios of pairs of texts, 0 where not over the share ``above``.

    Matching blocks hold no more than the characters of each kind that both have, nor than the longest common subsequence; only pairs that pass both bounds are matched.
    """
    out = np.zeros(len(a))
    if not len(a):
        return out
    total = a.str.len().to_numpy() + b.str.len().to_numpy()
    least = above * total
    match = SequenceMatcher(None)
    near = np.flatnonzero((2 * _shared(a, b) > least) | (total == 0))
    for i in sorted(near, key=lambda i: b.iat[i]):  # what is prepared for b is used again
        x, y = a.iat[i], b.iat[i]
        if x == y or 2 * common_length(x, y) > least[i]:
            if match.b != y:
                match.set_seq2(y)
            match.set_seq1(x)
            found = match.ratio()
            out[i] = found if found > above else 0.0
    return out


def _compared(text: str) -> Column:
    """The text as ratio compares it: lower case, without white space of any kind at its ends."""
    return F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"(?U)^{_SPACE}|{_SPACE}$", ""))


def _length_bucket(text: str, above: float) -> Column:
    """A ratio over r needs lengths within (2 - r) / r of each other: such texts meet in this bucket or one beside it."""
    return F.floor(F.log(F.length(text) + F.lit(1.0)) / F.log(F.lit((2 - above) / above))).cast("int")


def similar_pairs(rows: DataFrame, by: str, key: str, text: str, above: float) -> DataFrame:
    """(by, a, b, ratio) of texts of one ``by`` with a < b and a ratio over ``above``.

    Pairs meet in buckets of like lengths; crowded buckets are dealt out. Upper bounds rule most pairs out before blocks are matched.
    """

    @F.pandas_udf("double")
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(ratios_above(a, b, above))

    own = rows.select(by, F.col(key).alias("a"), _compared(text).alias("ta")).withColumn("k", _length_bucket("ta", above))
    other = own.select(by, F.col("a").alias("b"), F.col("ta").alias("tb"), F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)).alias("k"))
    pairs = dealt_join(own, other, [by, "k"], ["b"], work=PAIRS).filter("a < b")
    return pairs.withColumn("ratio", ratios("ta", "tb")).filter(F.col("ratio") > above).select(by, "a", "b", "ratio")


def dedupe_replacing(rows: DataFrame, by: str, order: str, text: str, score: str, above: float) -> DataFrame:
    """(by, order) of the texts kept: in order, a text like a kept one replaces it if its score is higher, else it goes. A missing score neither replaces nor is replaced.

    Only texts that are alike, or linked by others that are, act on each other: equal texts are one node, likeness over ``above`` an edge, and components are folded
    one by one. A task streams a component's rows in order, and holds its edges and what is kept of it; many copies of a text are one node.
    """

    @F.pandas_udf("struct<ab:boolean,ba:boolean>")
    def alike(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        # Ratios depend on the order.
        return pd.DataFrame({"ab": ratios_above(a, b, above) > 0, "ba": ratios_above(b, a, above) > 0})

    own = kept(rows.select(by, order, score, _compared(text).alias("t")).withColumn("node", F.md5(F.concat_ws("\x1f", F.coalesce(F.col(by).cast("string"), F.lit("\x1e")), "t"))))
    texts = own.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("\x1e")).alias("v"), "node").agg(F.first("t").alias("t")).withColumn("k", _length_bucket("t", above))
    one = texts.select("v", "k", F.col("node").alias("a"), F.col("t").alias("ta"))
    other = texts.select("v", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)).alias("k"), F.col("node").alias("b"), F.col("t").alias("tb"))
    pairs = dealt_join(one, other, ["v", "k"], ["b"], work=PAIRS).filter("a < b").select("a", "b", alike("ta", "tb").alias("is")).filter("is.ab OR is.ba")
    edges = kept(pairs.select("a", "b", "is.ab", "is.ba"))
    roots = components(edges)
    rooted = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # ab: b may stand in for a, when a comes later.
    directed = edges.filter("ab").select(F.col("a").alias("node"), F.col("b").alias("old")).unionByName(edges.filter("ba").select(F.col("b").alias("node"), F.col("a").alias("old")))
    links = directed.join(roots, "node").select("root", "node", "old")
    stream = rooted.select("root", F.lit(1).alias("kind"), by, order, F.col(score).cast("double").alias("score"), "node").unionByName(links.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, near, slots, places = None, {}, [], {}
        kinds: list[pa.DataType] = []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([s[k] for s in slots], kinds[k]) for k in (0, 1)], names=[by, order])

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in (by, order)]
            for root, kind, v, i, points, node, old in zip(*[batch.column(c).to_pylist() for c in ("root", "kind", by, order, "score", "node", "old")], strict=True):
                if root != at:
                    if slots:
                        yield done()
                    at, near, slots, places = root, {}, [], {}
                if kind == 0:
                    near.setdefault(node, []).append(old)
                    continue
                like = [min(places[n]) for n in (node, *near.get(node, ())) if places.get(n)]
                if not like:
                    places.setdefault(node, set()).add(len(slots))
                    slots.append((v, i, points, node))
                elif points is not None and slots[min(like)][2] is not None and points > slots[min(like)][2]:
                    j = min(like)
                    places[slots[j][3]].discard(j)
                    places.setdefault(node, set()).add(j)
                    slots[j] = (v, i, points, node)
        if slots:
            yield done()

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return stream.repartition("root").sortWithinPartitions("root", "kind", order).mapInArrow(fold, f"{by} {types[by]}, {order} {types[order]}")


def pick_diverse(rows: DataFrame, by: str, key: str, kind: str, difficulty: str, failure: str, k: int = 4) -> DataFrame:
    """(by, key, place) of k rows per key: each round takes the best score given the kinds already chosen.

    Score: half the difficulty, a fifth of the failure, and 0.3 of a bonus for a new kind less a penalty that
    grows with the rows of that kind. Ties go to the smaller key. Of a kind, the bonus is the same for all rows, so only
    its k best can be chosen; a window keeps those, and a task gets k rows per key and kind.
    """
    best_first = Window.partitionBy(by, kind).orderBy((F.col(difficulty) * 0.5 + F.col(failure) * 0.2).desc(), key)
    rows = rows.withColumn("__nth", F.row_number().over(best_first)).filter(F.col("__nth") <= k)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        left, taken = group.sort_values(key).to_dict("records"), []
        while left and len(taken) < k:
            def score(r: dict) -> float:
                n = sum(t[kind] == r[kind] for t in taken)
                return 0.5 * r[difficulty] + 0.3 * ((2.0 if n == 0 else 0.0) - (3.0 * n + (10.0 if n >= 2 else 0.0))) + 0.2 * r[failure]

            best = max(range(len(left)), key=lambda i: (score(left[i]), -i))
            taken.append(left.pop(best))
        return pd.DataFrame({by: [t[by] for t in taken], key: [t[key] for t in taken], "place": range(1, len(taken) + 1)})

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select(by, key, kind, difficulty, failure).groupBy(by).applyInPandas(choose, f"{by} {types[by]}, {key} {types[key]}, place long")
