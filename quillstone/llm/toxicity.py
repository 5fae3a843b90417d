"""Toxicity by a convolutional text classifier trained in numpy, in Spark's tasks, on all labelled rows.

Words and their beginnings are hashed to embeddings, a word's being the sum of both, so that rare words of a stem are known by it;
filters of several widths slide over a text, and the largest value of each filter goes into a logistic layer. A threshold per language, chosen on rows kept out of the
training, shifts the logit so that 0.5 is the decision in every language. The language is guessed
from the hashed words of the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import broadcast_if_small, checkpointed, ship, text_or_empty

#: Labelled documents that one task trains on, and their characters; labels of fixed width that may be broadcast.
PART_ROWS, PART_CHARS, LABEL_ROWS = 8_000, 100_000_000, 500_000
BUCKETS, DIM, FILTERS, WIDTHS = 2**19, 8, 16, (1, 2, 3)
#: Letters of a word's beginning.
STEM = 5
LANG_BUCKETS = 2**13
#: Passes over the rows, or more until so many steps are done by a task.
EPOCHS, STEPS, BATCH, RATE = 6, 1000, 32, 0.05
#: Words held by a worker, of up to so many characters; words scored at a time.
KEPT_WORDS, KEPT_LENGTH, STEP = 400_000, 64, 200_000
#: Changes of numbers are summed in this unit's inverse; logits are counted up to so far, on so many points a unit.
UNIT, LOGITS, GRID = 2.0**32, 64, 1024
_WORD = re.compile(r"[^\W\d_]+")
_PAD = BUCKETS  # its embedding stays zero


@dataclass
class ToxicityModel:
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    langs: list[str] = field(default_factory=list)
    lang_logs: np.ndarray | None = None  # hashed words x languages
    thresholds: dict[str, float] = field(default_factory=dict)  # by language; "" for any other


def buckets_of(word: str) -> tuple[int, int]:
    """The buckets of a word and of its beginning."""
    return crc32(word.encode()) % BUCKETS, crc32(b"^" + word[:STEM].encode()) % BUCKETS


class WordHasher:
    """Buckets of the words of a text and of their beginnings in turn, remembered by word."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str) -> list[int]:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        words = _WORD.findall(text.lower())
        for w in {w for w in words if w not in known and len(w) <= KEPT_LENGTH}:
            known[w] = buckets_of(w)
        return [b for w in words for b in (known.get(w) or buckets_of(w))]


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents' buckets (words x 2) in one array, each followed by padding; where they start, and where the last window of each begins, plus one.

    An empty document has one window, of padding.
    """
    gap = np.full((max(WIDTHS), 2), _PAD)
    starts = np.cumsum([0, *(len(d) + len(gap) for d in docs)])[:-1]
    ends = starts + np.array([max(len(d), 1) for d in docs])
    return np.concatenate([x for d in docs for x in (d, gap)] + [gap]), starts, ends


def _pooled(model: ToxicityModel, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Per document the largest rectified value of every filter, over the windows that begin in it; the filters' values by place; and the words' embeddings."""
    n = len(ids) - max(WIDTHS)
    x = model.embed[ids[:, 0]] + model.embed[ids[:, 1]]
    values = [sum(x[j : j + n] @ w[j] for j in range(len(w))) for w in model.filters]
    # Every second stretch lies between documents, and is left out.
    bounds = np.column_stack([starts, ends]).ravel()
    pooled = np.concatenate([np.maximum.reduceat(v, bounds)[::2] for v in values], axis=1)
    return np.maximum(pooled + model.bias, 0), values, x


def logits(model: ToxicityModel, docs: list[np.ndarray]) -> np.ndarray:
    if not docs:
        return np.zeros(0)
    pooled = _pooled(model, *_laid_out(docs))[0]
    return pooled @ model.out + model.out_bias


def guess_languages(model: ToxicityModel, docs: list[np.ndarray]) -> list[str]:
    if not model.langs:
        return [""] * len(docs)
    return [model.langs[int(model.lang_logs[d[:, 0] % LANG_BUCKETS].sum(axis=0).argmax())] if len(d) else "" for d in docs]


@dataclass
class Training:
    """A model under training, and its sums of squared gradients, for step sizes."""

    model: ToxicityModel
    seen: list[np.ndarray]  # of the filters, the filters' biases and the weights on them
    seen_embed: np.ndarray
    seen_bias: float = 1e-6

    @classmethod
    def begun(cls, seed: int = 7) -> Training:
        rng = np.random.default_rng(seed)
        embed = rng.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32)
        embed[_PAD] = 0
        filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        total = FILTERS * len(WIDTHS)
        model = ToxicityModel(embed, filters, np.zeros(total, np.float32), rng.normal(0, 0.3, total).astype(np.float32), 0.0)
        return cls(model, [np.full_like(p, 1e-6) for p in (*filters, model.bias, model.out)], np.full(BUCKETS + 1, 1e-6, np.float32))

    def dense(self) -> np.ndarray:
        """All numbers but the embeddings' in one row."""
        m = self.model
        return np.concatenate([x.ravel() for x in (*m.filters, m.bias, m.out, *self.seen)] + [[m.out_bias, self.seen_bias]]).astype(np.float64)

    def set_dense(self, values: np.ndarray) -> None:
        m, at = self.model, 0
        for x in (*m.filters, m.bias, m.out, *self.seen):
            x[...] = values[at : at + x.size].reshape(x.shape)
            at += x.size
        m.out_bias, self.seen_bias = float(values[at]), float(values[at + 1])

    def embedded(self, places: np.ndarray) -> np.ndarray:
        """Embeddings and their sums."""
        return np.column_stack([self.model.embed[places], self.seen_embed[places]]).astype(np.float64)

    def run(self, docs: list[np.ndarray], labels: np.ndarray, class_weight: tuple[float, float], epochs: int, rng: np.random.Generator) -> np.ndarray:
        """Steps over the documents, ``epochs`` times; the buckets whose embeddings changed."""
        model, embed, seen_embed = self.model, self.model.embed, self.seen_embed
        filters, params = model.filters, [*model.filters, model.bias, model.out]
        weight, changed = np.where(labels == 1, class_weight[1], class_weight[0]), np.zeros(BUCKETS + 1, bool)
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                ids, starts, ends = _laid_out([docs[i] for i in some])
                pooled, values, x = _pooled(model, ids, starts, ends)
                p = 1 / (1 + np.exp(-(pooled @ model.out + model.out_bias)))
                error = ((p - labels[some]) * weight[some] / len(some)).astype(np.float32)
                back = (error[:, None] * model.out) * (pooled > 0)
                grads = [np.zeros_like(f) for f in filters]
                places, pushes = [], []
                for k, (f, v) in enumerate(zip(filters, values, strict=True)):
                    best = np.array([v[a:b].argmax(axis=0) + a for a, b in zip(starts, ends, strict=True)])  # documents x filters
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(len(f)):
                        grads[k][j] = np.einsum("dfe,df->ef", x[best + j], g)
                        push = (g[..., None] * f[j].T[None]).reshape(-1, DIM)
                        for part in (0, 1):  # the word's embedding and its beginning's
                            places.append(ids[best + j, part].ravel())
                            pushes.append(push)
                for p_, g_, s_ in zip(params, [*grads, back.sum(axis=0), pooled.T @ error], self.seen, strict=True):
                    s_ += g_ * g_
                    p_ -= RATE * g_ / np.sqrt(s_)
                self.seen_bias += float(error.sum()) ** 2
                model.out_bias -= RATE * float(error.sum()) / self.seen_bias**0.5
                where, inverse = np.unique(np.concatenate(places), return_inverse=True)
                push = np.zeros((len(where), DIM), np.float32)
                np.add.at(push, inverse, np.concatenate(pushes))
                push[where == _PAD] = 0
                seen_embed[where] += (push * push).mean(axis=1)
                embed[where] -= RATE * push / np.sqrt(seen_embed[where])[:, None]
                changed[where] = True
        return np.flatnonzero(changed)


def _best_threshold(scores: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> float:
    """The logit that makes the fewest errors, each class weighing by its square-rooted share; the middle of the best gap.

    scores are distinct, each with its numbers of documents of both classes.
    """
    order = np.argsort(scores)
    s, share = scores[order], toxic.sum() / (toxic.sum() + other.sum())
    missed = np.concatenate([[0.0], np.cumsum(toxic[order])]) / np.sqrt(share)
    wrong = (other.sum() - np.concatenate([[0.0], np.cumsum(other[order])])) / np.sqrt(1 - share)
    edges = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    cost = missed + wrong
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    return float(edges[best[len(best) // 2]])


def _constant(score: float) -> ToxicityModel:
    """For labels with nothing to tell apart."""
    total = FILTERS * len(WIDTHS)
    return ToxicityModel(np.zeros((BUCKETS + 1, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS], np.zeros(total, np.float32), np.zeros(total, np.float32), score, thresholds={"": 0.0})


def _docs(words: pd.Series) -> list[np.ndarray]:
    return [np.asarray(w, np.int32).reshape(-1, 2) for w in words]


def _trained(rows: DataFrame, parts: int, size: float, class_weight: tuple[float, float]) -> ToxicityModel:
    """Train on all rows (part, label, words): in each round every part trains a copy of its own, and the changes are averaged.

    A bucket's change is averaged over the parts that changed it. Changes are summed as whole numbers, so the order of tasks doesn't matter.
    """
    sc, training = rows.sparkSession.sparkContext, Training.begun()
    least = -(-STEPS * BATCH // max(size, 1))
    rounds, epochs = (1, int(max(EPOCHS, least))) if parts == 1 else (EPOCHS, int(max(1, -(-least // EPOCHS))))
    names = [f"v{i}" for i in range(DIM + 1)]
    for r in range(rounds):
        sent = sc.broadcast(training)

        def changes(frames: Iterator[pd.DataFrame], r: int = r, sent: Broadcast = sent) -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []

            def made() -> pd.DataFrame:
                own = deepcopy(sent.value)
                part = pd.concat(held) if len(held) > 1 else held[0]
                where = own.run(_docs(part["words"]), part["label"].to_numpy(np.float32), class_weight, epochs, np.random.default_rng((11, r, int(part["part"].iloc[0]))))
                # Rows of the other numbers follow the buckets'.
                rest = own.dense() - sent.value.dense()
                rest = np.concatenate([rest, np.zeros(-len(rest) % (DIM + 1))]).reshape(-1, DIM + 1)
                moved = np.concatenate([own.embedded(where) - sent.value.embedded(where), rest])
                out = pd.DataFrame(np.rint(moved * UNIT).astype(np.int64), columns=names)
                out.insert(0, "place", np.concatenate([where, BUCKETS + 1 + np.arange(len(rest))]).astype(np.int32))
                return out

            for f in frames:  # sorted by part
                for _, some in f.groupby("part"):
                    if held and held[0]["part"].iloc[0] != some["part"].iloc[0]:
                        yield made()
                        held = []
                    held.append(some)
            if held:
                yield made()

        moved = rows.mapInPandas(changes, "place int, " + ", ".join(f"{c} long" for c in names))
        found = moved.groupBy("place").agg(*[(F.sum(c) / F.count(F.lit(1)) / F.lit(UNIT)).cast("float").alias(c) for c in names]).toArrow()
        place = found.column("place").to_numpy()
        mean = np.column_stack([found.column(c).to_numpy() for c in names])
        bucket = place <= BUCKETS
        training.model.embed[place[bucket]] += mean[bucket, :DIM]
        training.seen_embed[place[bucket]] += mean[bucket, DIM]
        dense = training.dense()
        training.set_dense(dense + mean[~bucket][np.argsort(place[~bucket])].ravel()[: len(dense)])
        sent.unpersist()
    return training.model


def _learn_languages(model: ToxicityModel, rows: DataFrame) -> None:
    """Counts of hashed words by language, over all rows (lang, words)."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for f in frames:
            for lang, own in f[f["lang"].notna()].groupby("lang"):
                words = np.concatenate(_docs(own["words"]))[:, 0] % LANG_BUCKETS
                counts[lang] = counts.get(lang, 0) + np.bincount(words, minlength=LANG_BUCKETS)
        for lang, n in counts.items():
            yield pd.DataFrame({"lang": lang, "bucket": np.arange(LANG_BUCKETS, dtype=np.int32), "n": n})

    found = rows.select("lang", "words").mapInPandas(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    model.langs = sorted(found["lang"].unique())
    if model.langs:
        counts = found.pivot(index="bucket", columns="lang", values="n").sort_index()[model.langs].to_numpy() + 0.1
        model.lang_logs = np.log(counts / counts.sum(axis=0))


def _calibrate(model: ToxicityModel, rows: DataFrame) -> None:
    """Thresholds from all rows (label, words), by the languages guessed there; the counts of logits on a grid come to the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            docs = _docs(f["words"])
            z = np.concatenate([logits(sent.value, [d]) for d in docs]) if docs else np.zeros(0)
            yield pd.DataFrame({"guess": guess_languages(sent.value, docs), "at": np.rint(np.clip(z, -LOGITS, LOGITS) * GRID).astype(np.int32), "label": f["label"]})

    some = rows.select("label", "words").mapInPandas(scored, "guess string, at int, label int")
    found = some.groupBy("guess", "at").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("other")).toArrow().to_pandas()

    def chosen(own: pd.DataFrame, least: int) -> float | None:
        own = own.groupby("at", as_index=False)[["toxic", "other"]].sum()
        if min(own["toxic"].sum(), own["other"].sum()) < least:
            return None
        return _best_threshold(own["at"].to_numpy() / GRID, own["toxic"].to_numpy(float), own["other"].to_numpy(float))

    model.thresholds[""] = chosen(found, 1) or 0.0
    for lang in model.langs:
        if (own := chosen(found[found["guess"] == lang], 10)) is not None:
            model.thresholds[lang] = own


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", part_rows: int = PART_ROWS) -> ToxicityModel:
    """Learn from all labelled documents: four fifths of each class are trained on, thresholds are chosen on the rest.

    Texts become arrays of word buckets in Spark's tasks and are dealt into parts of about ``part_rows`` by a hash of the id; the driver receives
    sums by bucket. Rows without a label are not used; a null text counts as empty; repeated labels count repeatedly.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    joined = texts.join(broadcast_if_small(known, LABEL_ROWS), "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0)
    found = {(r["label"], r["held"]): r for r in joined.groupBy("label", "held").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    n = {c: sum(r["n"] for (x, _), r in found.items() if x == c) for c in (0, 1)}
    if not n[0] or not n[1]:
        return _constant(1.0 if n[1] else -1.0)
    if not all((c, False) in found for c in n):  # very few labels: all are trained on
        joined, found = joined.withColumn("held", F.lit(False)), {(c, False): {"n": k, "chars": 0} for c, k in n.items()}
    trained = {c: found[c, False]["n"] for c in n}
    total = sum(trained.values())
    parts = max(1, -(-sum(n.values()) // part_rows), -(-sum(r["chars"] for r in found.values()) // PART_CHARS))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHasher()
        for f in frames:
            yield pd.DataFrame({"part": f["part"], "doc_id": f["doc_id"].astype(str), "label": f["label"], "held": f["held"], "lang": f["lang"], "words": [words(t) for t in f["text"]]})

    dealt = joined.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")).mapInPandas(hashed, "part int, doc_id string, label int, held boolean, lang string, words array<int>")
    # The fit must not depend on the order of tasks.
    rows = checkpointed(dealt.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "label", F.hash("words")))
    train = rows.filter("NOT held")
    model = _trained(train.select("part", "label", "words"), parts, total / parts, (0.5 * total / trained[0], 0.5 * total / trained[1]))
    _learn_languages(model, train)
    model.thresholds[""] = 0.0
    _calibrate(model, rows.filter("held"))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, predicted, language (as guessed, empty if unknown).

    score is a logistic function of the logit above the language's threshold, and depends on the text alone. A null text
    counts as empty; empty texts have a score too. Repeated rows give repeated rows with one score; ids may be null. Only the two columns are read.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, words = sent.value, WordHasher()
        for f in frames:
            z, langs, run, size = [], [], [], 0
            for k, text in enumerate(f["text"], 1):
                run.append(np.array(words(text), np.int64).reshape(-1, 2))
                size += len(run[-1])
                if size >= STEP or k == len(f):
                    z.append(logits(model, run))
                    langs += guess_languages(model, run)
                    run, size = [], 0
            shift = np.array([model.thresholds.get(x, model.thresholds[""]) for x in langs])
            score = 1 / (1 + np.exp(-np.clip(np.concatenate(z) - shift, -50, 50))) if z else np.zeros(0)
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": score.astype(float), "predicted": (score >= 0.5).astype("int32"), "language": langs})

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(scored, f"doc_id {id_type}, score double, predicted int, language string")
