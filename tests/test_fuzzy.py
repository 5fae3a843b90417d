"""Quotes and word sequences against brute force."""

import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillstone.operators import fuzzy, skew


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_length_is_that_of_the_table():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcé ", k=rng.randrange(90))) for _ in "ab")
        assert fuzzy.common_length(a, b) == lcs(a, b)


def brute_quote(quote, text):
    q = (quote or "").lower()
    if q in text.lower():
        return 100
    words, n = text.lower().split(), len(q.split())
    found = [round(200 * lcs(q, w) / (len(q) + len(w))) for w in (" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) if q or w]
    return max((f for f in found if f >= 80), default=None)


def quotes_and_texts():
    rng = random.Random(2)
    said = ["the red car stops", "a man in white runs off", "ça va très bien", "is", "no", "we never go there again", "x"]

    def bent(t):
        t = list(t)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(t) + 1)
            t[i : i + rng.choice([0, 1, 1])] = rng.choice(["", "z", " ", "e", "E"])
        return "".join(t)

    quotes = [(v, i, bent(rng.choice(said))) for v in (1, 2) for i in range(25)] + [(1, 90, ""), (1, 91, None), (2, 92, "two  spaced\twords"), (2, 93, "  is "), (None, 94, "is"), (3, 95, "is")]
    texts = [(v, i, " ".join(bent(rng.choice(said)) for _ in range(rng.randrange(1, 4)))) for v in (1, 1, 1, 2) for i in range(12)]
    texts += [(1, 70, None), (1, 71, ""), (2, 72, "two spaced\n\nwords here"), (None, 73, "is"), (2, 74, "lead " + "and on " * 3000), (1, 71, "")]
    return quotes, texts


@pytest.mark.parametrize("cell", [skew.CELL, 3])
def test_no_quote_is_missed(spark, cell, monkeypatch):
    quotes, texts = quotes_and_texts()
    monkeypatch.setattr(skew.dealt_join, "__defaults__", (cell,))
    got = fuzzy.fuzzy_quotes(spark.createDataFrame(quotes, "v long, q int, quote string"), spark.createDataFrame(texts, "v long, s int, text string"), "v", "quote", "text", ["s"])
    want = Counter((v, q, s, brute_quote(quote, text)) for v, q, quote in quotes for w, s, text in texts if v == w and v is not None and text is not None and brute_quote(quote, text) is not None)
    assert Counter((r["v"], r["q"], r["s"], r["percent"]) for r in got.collect()) == want
    assert {100} < {k[3] for k in want}


def test_quotes_of_crowded_keys_meet_in_cells(spark, monkeypatch):
    quotes, texts = quotes_and_texts()
    monkeypatch.setattr(fuzzy, "QUOTES", 7), monkeypatch.setattr(fuzzy, "TEXTS", 3), monkeypatch.setattr(fuzzy, "WORK", 200), monkeypatch.setattr(fuzzy, "EACH", 0)
    quotes += [(4, 200 + i, q) for i in range(30) for q in ("we never go", "a man in white")]
    texts += [(4, i, "we never go there again, a man in whhte said") for i in range(40)] + [(5, 1, "no quote")]
    rows = spark.createDataFrame(quotes, "v long, q int, quote string"), spark.createDataFrame(texts, "v long, s int, text string")
    got = fuzzy.fuzzy_quotes(*rows, "v", "quote", "text", ["s"])
    want = Counter((v, q, s, brute_quote(quote, text)) for v, q, quote in quotes for w, s, text in texts if v == w and v is not None and text is not None and brute_quote(quote, text) is not None)
    assert Counter((r["v"], r["q"], r["s"], r["percent"]) for r in got.collect()) == want
    # 4,000 pairs and more are many tasks, however few bytes they are, and key 4 is spread over them.
    spread = got.filter("v = 4").groupBy(F.spark_partition_id().alias("p")).count().agg(F.count("p"), F.max("count")).first()
    assert got.rdd.getNumPartitions() >= 20 and spread[0] > 5 and spread[1] < 1200


def test_best_windows_against_brute_force(monkeypatch):
    monkeypatch.setattr(fuzzy, "SOME", 5), monkeypatch.setattr(fuzzy, "WINDOWS", 7), monkeypatch.setattr(fuzzy, "MATCHED", 11)
    rng = random.Random(5)
    made = lambda n, letters: " ".join("".join(rng.choices(letters, k=rng.randrange(1, 7))) for _ in range(n))
    for letters in ("abc", "abcdefgh\u0131\U0001f600", [chr(0x4E00 + i) for i in range(90)]):
        quotes = [made(rng.randrange(1, 4), letters) for _ in range(25)] + [made(30, letters), "a" * 300, "a" * 64, "ab" * 32 + "c", "", " ", "\x1d", "a\u00a0 b"]
        texts = [made(rng.randrange(0, 12), letters) for _ in range(12)] + ["", "  ", "a" * 290, "a" * 61 + " x", quotes[25][1:] + " b", "\ta\x1cb\n", "ab" * 31 + "cc"]
        for least in (80, 55):
            got = fuzzy.best_windows(quotes, texts, least)
            for q, quote in enumerate(quotes):
                for t, text in enumerate(texts):
                    words, n = text.split(), len(quote.split())
                    found = [round(200 * fuzzy.common_length(quote, w) / (len(quote) + len(w))) for w in (" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) if n]
                    assert got[q, t] == (100 if quote in text else max((f for f in found if f >= least), default=-1)), (quote, text, least)


def brute_sequence(near, cue, words):
    cue = (cue or "").lower().split()
    runs = [words[i : i + len(cue)] for i in range(len(words) - len(cue) + 1)] if cue else []
    like = lambda a, b: a == b or SequenceMatcher(None, a, b).ratio() >= 0.7
    fit = [r for r in runs if sum(like(w, c) for (w, _), c in zip(r, cue, strict=True)) / len(cue) >= 0.7 and abs(r[0][1] - near) <= 5000]
    if not fit:
        return near, near + len(cue) * 500, False
    best = min(fit, key=lambda r: abs(r[0][1] - near))
    return best[0][1], best[-1][1], True


def test_word_sequences(spark):
    rng = random.Random(3)
    vocabulary = ["the", "them", "then", "horse", "horses", "house", "runs", "ran", "rune", "a", "an"]
    segments = [(v, s, s * 2000, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 9)))) for v in (1, 2) for s in range(12)] + [(3, 0, 0, None), (1, 20, 90000, "  far\taway \n words ")]
    cues = [(v, i, rng.randrange(0, 26000), " ".join(rng.choices(vocabulary, k=rng.randrange(1, 5)))) for v in (1, 2) for i in range(60)] + [(1, 80, 500, None), (2, 81, 500, ""), (3, 82, 500, "a"), (9, 83, 500, "a an"), (1, 84, 90100, "far away words"), (1, 85, 90100, "fax awaj wards")]
    words = {}
    for v, _, start, text in sorted(segments, key=lambda x: x[:3]):
        words.setdefault(v, []).extend((w, start + i * 300) for i, w in enumerate((text or "").lower().split()))
    frame = fuzzy.word_times(spark.createDataFrame(segments, "v long, s int, start long, text string"), "v", "s", "start", "text", 300)
    got = fuzzy.word_sequences(spark.createDataFrame(cues, "v long, c int, near long, cue string"), frame, "v", "c", "near", "cue").collect()
    want = {(v, c): brute_sequence(near, cue, words.get(v, [])) for v, c, near, cue in cues}
    assert {(r["v"], r["c"]): (r["start_ms"], r["end_ms"], r["matched"]) for r in got} == want
    assert {m for _, _, m in want.values()} == {True, False}


def test_dealt_join_is_a_join(spark):
    few = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, x string")
    many = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 7), (None, 8), (3, 9)], "k int, y int")
    want = Counter(map(tuple, few.join(many, "k").collect()))
    assert Counter(map(tuple, skew.dealt_join(few, many, ["k"], ["y"], cell=5).select("k", "x", "y").collect())) == want
    assert skew.dealt_join(few.filter("k > 9"), many, ["k"], ["y"]).count() == 0 and skew.dealt_join(few, many.filter(F.lit(False)), ["k"], ["y"]).count() == 0


def test_dealt_join_deals_by_pairs(spark):
    few = spark.createDataFrame([(1, i) for i in range(30)] + [(k, k) for k in range(2, 40)] + [(None, 0)], "k int, x int")
    many = spark.createDataFrame([(1, i) for i in range(40)] + [(k, -k) for k in range(3, 50)] + [(None, 8)], "k int, y int")
    dealt = skew.dealt_join(few, many, ["k"], ["y"], work=100)
    assert Counter(map(tuple, dealt.select("k", "x", "y").collect())) == Counter(map(tuple, few.join(many, "k").collect()))
    # 1,237 pairs, however few bytes they are; all parts of key 1 are spread.
    assert dealt.rdd.getNumPartitions() == 13 and dealt.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0] < 900
    assert skew.dealt_join(few.filter("k > 99"), many, ["k"], ["y"], work=5).count() == 0
