"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of a word
is the sum over all its segmentations into pieces, by a forward algorithm over end positions; that of
a text is the product over its words, as no piece crosses a word start. Probabilities are learned by
expectation-maximisation: forward-backward gives the expected number of times each piece is used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import checkpointed, ship, text_or_empty
from quillstone.llm.pieces import SPACE, SubstringIndex, code_points, model_bytes, vocabulary

#: Expected documents per language in the fit; whole texts are used, and a language with fewer gives all.
FIT_DOCS = 600
ROUNDS, SMOOTHING = 2, 0.05
#: Probability of a character that is no piece, alike in all languages.
UNKNOWN = 1e-7
#: Words held by a worker, and their characters.
KEPT_WORDS, KEPT_CHARS = 200_000, 8_000_000
#: Keeps products of small probabilities in range: each character counts this many times more, and sums are brought
#: back to 1 every STEP characters. Characters of the words looked at together, and starts of very long ones.
_LIFT, STEP, CELLS, COLUMNS = 32.0, 8, 1 << 16, 1 << 14
#: A letter, then letters and the marks that combine with them; numbers of any kind are none.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")


@dataclass
class LanguageModel:
    langs: list[str]
    probs: np.ndarray  # pieces x languages
    prior: np.ndarray  # log, by language
    letters: dict[str, float]  # log probabilities of single characters, in all languages together


def words_of(text: str) -> list[str]:
    """The runs of letters; other characters say nothing of the language."""
    return _WORD.findall(text.lower())


def _batches(words: list[str]) -> Iterator[list[int]]:
    """Places of words of like lengths, CELLS characters or one word at a time."""
    some: list[int] = []
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if some and (len(some) + 1) * len(words[i]) > CELLS:
            yield some
            some = []
        some.append(i)
    if some:
        yield some


Arcs = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _lattice(index: SubstringIndex, probs: np.ndarray, codes: np.ndarray) -> Arcs:
    """Per substring length: the words, starts, piece ids and lifted probabilities of what is a piece or an unknown character (-1)."""
    arcs = []
    for n, ids in enumerate(index.by_length(codes), 1):
        starts, rows = np.nonzero((((ids >= 0) | (codes != 0)) if n == 1 else (ids >= 0)).T)
        pieces = ids[rows, starts]
        arcs.append((rows, starts, pieces, np.where((pieces < 0)[:, None], UNKNOWN, probs[pieces]) * _LIFT**n))
    return arcs


def _forward(arcs: Arcs, begin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the segmentations of every prefix, from those of the first ones: (width + len(arcs) + 1) x words x languages.

    A sum at t is in units of the exponential of the second result at min(t, width - 1) // STEP. Arcs come sorted by start.
    """
    alpha = np.zeros((width + len(arcs) + 1, *begin.shape[1:]))
    alpha[: len(begin)] = begin
    logs = np.zeros((width // STEP + 1, *begin.shape[1:]))
    edges = [np.searchsorted(starts, np.arange(width + 1)) for _, starts, _, _ in arcs]
    counts = np.array([np.diff(e) for e in edges])
    for start in range(width):
        if start % STEP == 0 and start:
            here = alpha[start]
            unit = np.where(here > 0, here, 1.0)
            alpha[start : start + len(arcs)] /= unit
            logs[start // STEP] = logs[start // STEP - 1] + np.log(unit)
        for k in np.flatnonzero(counts[:, start]):
            rows, _, _, weights = arcs[k]
            some = slice(edges[k][start], edges[k][start + 1])
            alpha[start + k + 1, rows[some]] += alpha[start, rows[some]] * weights[some]
    return alpha, logs


def _one(n: int, langs: int) -> np.ndarray:
    return np.ones((1, n, langs))


def word_log_likelihoods(index: SubstringIndex, probs: np.ndarray, words: list[str]) -> np.ndarray:
    """words x languages: the logarithm of the sum over all segmentations, for words of any length."""
    out = np.empty((len(words), probs.shape[1]))
    for some in _batches(words):
        lengths = np.array([len(words[i]) for i in some])
        codes = code_points([words[i] for i in some], int(lengths.max()))
        begin, unit = _one(len(some), probs.shape[1]), np.zeros((len(some), probs.shape[1]))
        for at in range(0, codes.shape[1], COLUMNS):
            width = min(COLUMNS, codes.shape[1] - at)
            arcs = _lattice(index, probs, codes[:, at : at + width + index.longest - 1])
            alpha, logs = _forward(arcs, begin, width)
            ends = np.flatnonzero((lengths > at) & (lengths <= at + width))
            t = lengths[ends] - at
            out[np.array(some)[ends]] = np.log(alpha[t, ends]) + logs[np.minimum(t, width - 1) // STEP, ends] + unit[ends] - lengths[ends, None] * np.log(_LIFT)
            begin, unit = alpha[width:], unit + logs[(width - 1) // STEP]
    return out


def expected_pieces(index: SubstringIndex, probs: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (of one language: probs is pieces x 1) in words that occur counts times."""
    total = np.zeros(len(probs))
    for some in _batches(words):
        lengths = np.array([len(words[i]) for i in some])
        width = int(lengths.max())
        arcs = _lattice(index, probs, code_points([words[i] for i in some], width))
        back: Arcs = []  # the same from the words' ends
        for size, (rows, starts, pieces, weights) in enumerate(arcs, 1):
            left = lengths[rows] - starts - size
            order = np.argsort(left, kind="stable")
            back.append((rows[order], left[order], pieces[order], weights[order]))
        alpha, alpha_logs = _forward(arcs, _one(len(some), 1), width)
        beta, beta_logs = _forward(back, _one(len(some), 1), width)
        unit = lambda logs, t, rows: logs[np.minimum(t, width - 1) // STEP, rows, 0]
        own = np.arange(len(some))
        whole = np.log(alpha[lengths, own, 0]) + unit(alpha_logs, lengths, own)
        for size, (rows, starts, pieces, weights) in enumerate(arcs, 1):
            left = lengths[rows] - starts - size
            share = alpha[starts, rows, 0] * weights[:, 0] * beta[left, rows, 0] * np.exp(unit(alpha_logs, starts, rows) + unit(beta_logs, left, rows) - whole[rows])
            total += np.bincount(np.where(pieces < 0, len(total), pieces), share * counts[some][rows], len(total) + 1)[:-1]
    return total


_INDEXES: dict[int, SubstringIndex] = {}


def _index(proto: bytes) -> SubstringIndex:
    vocab = vocabulary(proto)
    if id(vocab) not in _INDEXES:
        _INDEXES[id(vocab)] = SubstringIndex(vocab.ids)
    return _INDEXES[id(vocab)]


def fit_language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS, model_path: str | None = None, id_col: str = "doc_id") -> LanguageModel:
    """Learn from the rows of docs that have a language and a text.

    The fit reads a bounded sample: about ``fit_docs`` whole texts of each language, picked by a hash of
    the id and the text, so copies under other ids are picked each by its own chance. Word counts are gathered by Spark
    and expectation steps run in its tasks; the driver receives one row per language and piece, and one per character.
    """
    spark = docs.sparkSession
    ship(spark)
    proto_bytes = model_bytes(model_path)
    proto = spark.sparkContext.broadcast(proto_bytes)
    size = vocabulary(proto_bytes).size
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    n_by_lang = {r["lang"]: r["n"] for r in docs.filter(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(n_by_lang)
    if not langs:
        return LanguageModel([], np.zeros((size, 0)), np.zeros(0), {})
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(int(min(1.0, fit_docs / n_by_lang[lang]) * 2**31)))])
    picked = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(2**31)) < share[F.col("lang")]).select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                by_lang.setdefault(lang, Counter()).update(SPACE + w for w in words_of(text))
            for lang, c in by_lang.items():
                yield pd.DataFrame({"lang": lang, "word": list(c), "n": list(c.values())})

    counted = checkpointed(picked.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    probs = np.full((size, len(langs)), 1.0 / size)
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(probs)

        def expect(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            totals = np.zeros((size, len(langs)))
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    k = langs.index(lang)
                    totals[:, k] += expected_pieces(_index(proto.value), sent.value[:, [k]], part["word"].tolist(), part["n"].to_numpy(float))
            i, k = np.nonzero(totals)
            yield pd.DataFrame({"piece": i, "k": k, "uses": totals[i, k]})

        found = counted.mapInPandas(expect, "piece long, k long, uses double").groupBy("piece", "k").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full((size, len(langs)), SMOOTHING)
        uses[found["piece"], found["k"]] += found["uses"]
        probs = uses / uses.sum(axis=0)
        sent.unpersist()
    n = np.array([n_by_lang[x] for x in langs], float)
    letters = counted.select(F.explode(F.split("word", "")).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n")).collect()  # one row a character of Unicode at most
    seen = sum(r["n"] for r in letters)
    return LanguageModel(langs, probs, np.log(n / n.sum()), {r["c"]: float(np.log(r["n"] / seen)) for r in letters})


class Scorer:
    """Language of texts; remembers the likelihoods of words."""

    def __init__(self, model: LanguageModel, proto: bytes):
        self.model, self.index = model, _index(proto)
        self.place: dict[str, int] = {}
        self.chars = 0
        self.table = np.empty((KEPT_WORDS, len(model.langs) + 1))  # log likelihoods by language, and by letters

    def _learn(self, words: set[str]) -> None:
        new = sorted(w for w in words if w not in self.place)
        if len(self.place) + len(new) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.place.clear()
            self.chars = 0
            new = sorted(words)
        if len(new) > len(self.table):
            self.table = np.empty((len(new), self.table.shape[1]))
        if new:
            self.chars += sum(map(len, new))
            begin, usual = len(self.place), sum(np.exp(x) * x for x in self.model.letters.values())  # a strange letter counts like others on average
            rows = self.table[begin : begin + len(new)]
            rows[:, :-1] = word_log_likelihoods(self.index, self.model.probs, [SPACE + w for w in new])
            rows[:, -1] = [sum(self.model.letters.get(c, usual) for c in SPACE + w) for w in new]
            self.place.update(zip(new, range(begin, begin + len(new)), strict=True))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float], list[int]]:
        langs, scores, evidence, letters = [], [], [], []
        for at in range(0, len(texts), 256):
            split = [words_of(t) for t in texts[at : at + 256]]
            if self.model.langs:
                self._learn({w for ws in split for w in ws})
            for ws in split:
                letters.append(sum(map(len, ws)))
                if not ws or not self.model.langs:
                    langs.append("und")
                    scores.append(0.0)
                    evidence.append(0.0)
                    continue
                sums = self.table[[self.place[w] for w in ws]].sum(axis=0)
                logs = sums[:-1] + self.model.prior
                shares = np.exp(logs - logs.max())
                best = int(shares.argmax())
                langs.append(self.model.langs[best])
                scores.append(float(shares[best] / shares.sum()))
                evidence.append(float(sums[best] - sums[-1]))
        return langs, scores, evidence, letters


def language_column(model: LanguageModel, spark, text: Column, model_path: str | None = None) -> Column:
    """struct(lang_pred, score, evidence, letters) of a text column; null texts and texts without a letter get ('und', 0, 0, 0)."""
    ship(spark)
    sent = spark.sparkContext.broadcast((model, model_bytes(model_path)))

    @F.pandas_udf("lang_pred string, score double, evidence double, letters long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*sent.value)
        for texts in batches:
            langs, scores, evidence, letters = scorer.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(langs, dtype="object"), "score": pd.Series(scores, dtype="float64"), "evidence": pd.Series(evidence, dtype="float64"), "letters": pd.Series(letters, dtype="int64")})

    return predict(F.coalesce(text, F.lit("")))


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """All columns of docs plus lang_pred, score, evidence and letters.

    lang_pred is a learned language, the first by name of equal ones, and ``und`` for a null text, one
    without a letter, or a model without languages; score is its posterior probability, 0 for ``und``.
    evidence tells how much better that language explains the text than letters drawn one by one from all
    languages do: the difference of the text's log likelihoods, far below 0 for text of no learned language.
    letters counts letters and their marks. Only text_col is read. Columns of these names are replaced. Repeated rows give repeated rows.
    """
    new = ("lang_pred", "score", "evidence", "letters")
    own = [c for c in docs.columns if c not in new]
    found = docs.select(*own, language_column(model, docs.sparkSession, text_or_empty(text_col), model_path).alias("__found"))
    return found.select(*own, *[F.col(f"__found.{c}").alias(c) for c in new])
