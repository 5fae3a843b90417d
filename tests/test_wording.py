"""Wording rules against the look-ahead patterns that they stand for, and layered validators against a plain loop."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from quillstone.functions import wording as W
from quillstone.functions.layers import Layer, validated, validated_sql

LOOKING = [
    (r"\bthe figure\b(?! with | in )", "the figure", " with | in "),
    (r"\bthe person\b(?! with | in | who | wearing )", "the person", " with | in | who | wearing "),
    (r"\bit\b(?! is | was | appears | shows)", "it", " is | was | appears | shows"),
    (r"\bthe person\b(?!\s+(in|with|wearing|on))", "the person", r"\s+(?:in|with|wearing|on)"),
]


def texts():
    rng = random.Random(1)
    bits = ["the figure", "the person", "it", "in", "with", "is", "shows", "who", "item", "a", "été", "itß", "_it", "it's", ".", ",", "the  person", "\n", "on"]
    return ["", "it", "it it it", "it is it is it", "the figure in the figure in x", "it is", "éit", "it\nis "] + [rng.choice([" ", ""]).join(rng.choices(bits, k=rng.randrange(1, 9))) for _ in range(1500)]


def test_exceptions_stand_for_look_ahead(spark):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "i long, t string")
    con = duckdb.connect()
    con.register("rows", frame.toPandas())
    for looking, pattern, exceptions in LOOKING:
        want = {i: bool(re.search(looking, t)) for i, t in rows}
        assert {r["i"]: r["x"] for r in frame.select("i", F.expr(W.spark_unless("t", pattern, exceptions)).alias("x")).collect()} == want
        assert dict(con.execute(f"SELECT i, {W.duck_unless('t', pattern, exceptions)} FROM rows").fetchall()) == want
    follows = W.BEFORE + "this(?: is | was )"
    assert {r["i"]: r["x"] for r in frame.select("i", F.expr(W.spark_has("replace(t, 'it', 'this')", follows)).alias("x")).collect()} == {i: bool(re.search(r"\bthis\b(?= is | was )", t.replace("it", "this"))) for i, t in rows}


def test_words_of_all_scripts_have_bounds(spark):
    row = spark.sql(f"SELECT {W.spark_has(chr(39) + 'été may' + chr(39), W.word('may'))} a, {W.spark_has(chr(39) + 'émay' + chr(39), W.word('may'))} b, {W.spark_has(chr(39) + 'may' + chr(39), W.word('may'))} c").first()
    assert tuple(row) == (True, False, True)


def test_layers_stop_at_the_first_failure(spark):
    rng = random.Random(2)
    rows = [(i, *[rng.randrange(4) for _ in range(3)]) for i in range(200)]
    evidence = {i: rng.random() < 0.5 for i in range(0, 200, 2)}
    asked = []

    def joined(q):
        asked.append(sorted(r["i"] for r in q.select("i").collect()))
        return q.join(spark.createDataFrame(list(evidence.items()), "i long, e boolean"), "i", "left").withColumn("e", F.coalesce("e", F.lit(False)))

    layers = [Layer("first", [("a is 0", "a = 0"), ("a over 2", "a > 2")]), Layer("none"), Layer("second", [("no evidence", "NOT e")], joined), Layer("third", [("b is c", "b = c")])]
    want = {}
    for i, a, b, c in rows:
        found = (0, "first", "a is 0") if a == 0 else (0, "first", "a over 2") if a > 2 else (2, "second", "no evidence") if not evidence.get(i, False) else (3, "third", "b is c") if b == c else (4, None, None)
        want[i] = (found[0] == 4, *found)
    got = validated(spark.createDataFrame(rows, "i long, a int, b int, c int"), layers, ["i"]).collect()
    assert {r["i"]: (r["valid"], r["passed_layers"], r["failed_layer"], r["error"]) for r in got} == want and len(got) == len(rows)
    # Only what passed was joined.
    assert asked == [sorted(i for i, a, _, _ in rows if a in (1, 2))]
    con = duckdb.connect()
    con.execute("CREATE TABLE q AS SELECT * FROM (VALUES " + ", ".join(f"({i}, {a}, {b}, {c}, {evidence.get(i, False)})" for i, a, b, c in rows) + ") t(i, a, b, c, e)")
    assert {r[0]: r[1:] for r in con.execute(validated_sql("q", layers, ["i"])).fetchall()} == want
