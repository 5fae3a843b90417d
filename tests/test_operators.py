"""Operators against small models written from their definitions, with ties, nulls and boundaries."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillstone.functions import rules, scalars
from quillstone.operators import exclusion, graph, joins, pieces, similarity
from quillstone.sources import files
from quillstone.streaming import events as streaming


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "value"), [("01:23:45", 5025.0), ("23:45", 1425.0), ("45", 45.0), (" 7 ", 7.0), ("x", None), ("1:2:3:4", None), ("", None)])
def test_parse_timestamp(spark, text, value):
    assert one(spark, scalars.parse_timestamp(F.lit(text))) == value


def test_formats(spark):
    assert one(spark, scalars.format_timestamp(F.lit(5025))) == "01:23:45"
    assert one(spark, scalars.format_timestamp(F.lit(1425), hours=False)) == "23:45"
    assert one(spark, scalars.seconds_to_mmss(F.lit(-3))) == "00:00"
    assert one(spark, scalars.mmss_to_seconds(F.lit("-01:30"))) == -90.0
    assert one(spark, scalars.mmss_to_seconds(F.lit("x"))) == 0.0
    assert one(spark, scalars.extract_quotes(F.lit('He said "hello" and "goodbye"'))) == ["hello", "goodbye"]
    assert one(spark, scalars.extract_numbers(F.lit("We see 15 times at 3.5 seconds"))) == [15.0, 3.5]
    assert one(spark, scalars.is_url(F.lit("https://google.com")))
    assert one(spark, scalars.video_id_of_url(F.lit("https://drive.google.com/file/d/abc123/view"))) == "abc123"
    assert one(spark, scalars.shorten(F.lit("one two three"), 8)) == "one two"


def test_nearest_joins(spark):
    rng = random.Random(3)
    left = [(v, i, rng.randrange(100)) for v in range(3) for i in range(20)]
    right = [(v, i, rng.randrange(100)) for v in range(2) for i in range(15)]  # video 2 has none
    a = spark.createDataFrame(left, "v long, i long, at long")
    b = spark.createDataFrame(right, "v long, j long, ms long")
    near = {(r["v"], r["i"]): r["near_j"] for r in joins.nearest(a, b, "v", ["i"], "at", "ms", "j", ["j"]).collect()}
    within = {(r["v"], r["i"]): r["near_j"] for r in joins.nearest_within(a, b, "v", ["i"], "at", "ms", ["j"], 3, ["j"]).collect()}
    for v, i, at in left:
        by = sorted((abs(ms - at), j) for w, j, ms in right if w == v)
        assert near[v, i] == (by[0][1] if by else None)
        assert within[v, i] == (by[0][1] if by and by[0][0] <= 3 else None)


def test_range_join_bounds(spark):
    points = spark.createDataFrame([(1, 0), (1, 10), (1, 20), (1, 21), (2, 10)], "v long, at long")
    spans = spark.createDataFrame([(1, 10, 20), (1, 30, 5)], "v long, lo long, hi long")
    inside = lambda **kw: sorted(r["at"] for r in joins.range_join(points, spans, "v", "at", "lo", "hi", bucket_ms=7, **kw).collect())
    assert inside() == [10, 20]
    assert inside(end_inclusive=False) == [10]


def test_folds(spark):
    rng = random.Random(5)
    rows = [(v, rng.randrange(60), s, rng.random()) for v in range(6) for s in range(rng.randrange(1, 15))]
    frame = spark.createDataFrame(rows, "v long, at long, seq long, c double")
    of = lambda df: {v: sorted((r["at"], r["seq"], r["c"]) for r in df if r["v"] == v) for v in range(6)}
    gaps = of(pieces.greedy_min_gap(frame, ["v"], "at", ["seq"], 5, 3).collect())
    better = of(pieces.dedupe_keep_better(frame, ["v"], "at", ["seq"], "c", 5).collect())
    for v in range(6):
        mine = sorted((at, s, c) for w, at, s, c in rows if w == v)
        taken = []
        for at, s, _ in mine:
            if len(taken) < 3 and (not taken or at - taken[-1][0] >= 5):
                taken.append((at, s))
        assert [x[:2] for x in gaps[v]] == taken
        last, kept = mine[0][0], [mine[0]]
        for x in mine[1:]:
            if x[0] - last >= 5:
                kept.append(x)
                last = x[0]
            elif x[2] > kept[-1][2]:
                kept[-1] = x
        assert better[v] == sorted(kept)


def test_no_overlap_is_greedy(spark):
    rng = random.Random(8)
    rows = [(1, i, s, s + rng.randrange(1, 9)) for i, s in enumerate(rng.sample(range(100), 30))]
    frame = spark.createDataFrame(rows, "v long, rank long, lo long, hi long").withColumn("priority", -F.col("rank"))
    judged = exclusion.exclusive_spans(frame, "v", "rank", "priority", "lo", "hi", F.lit(False), [])
    got = sorted(r["rank"] for r in judged.filter("reason IS NULL").collect())
    taken = []
    for _, i, lo, hi in rows:
        if all(hi <= a or b <= lo for _, a, b in taken):
            taken.append((i, lo, hi))
    assert got == [t[0] for t in taken]


def test_similar_pairs_match_all_pairs(spark):
    rng = random.Random(4)
    words = ["red", "blue", "green", "tree", "house", "a"]
    rows = [(1, i, " ".join(rng.choices(words, k=rng.randrange(0, 5)))) for i in range(25)]
    got = {(r["a"], r["b"]) for r in similarity.similar_pairs(spark.createDataFrame(rows, "v long, i long, t string"), "v", "i", "t", 0.7).collect()}
    assert got == {(i, j) for _, i, a in rows for _, j, b in rows if i < j and SequenceMatcher(None, a, b).ratio() > 0.7}


def test_rules_count_occurrences(spark):
    table = rules.rule_table(spark, {"hedging": rules.HEDGING}, {"hedging": "CRITICAL"})
    texts = spark.createDataFrame([(1, "Maybe it might be, maybe not."), (2, "It is."), (3, None)], "id long, text string")
    got = {r["id"]: (r["violations"], r["occurrences"], r["valid"]) for r in rules.verdicts(texts, table, ["id"]).collect()}
    assert got == {1: (3, 4, False), 2: (0, 0, True), 3: (0, 0, True)}


def test_files_and_resume(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"video_id": "v1", "phase": 1}))
    (tmp_path / "in/b.json").write_text("{broken")
    rows = {r["_file"]: r for r in files.read_checkpoints(spark, str(tmp_path / "in"), "video_id STRING, phase INT").collect()}
    assert rows["a.json"]["phase"] == 1 and rows["b.json"]["_corrupt"] is not None
    done = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 4, True), ("b", 1, False)], "video_id string, phase int, valid boolean")
    assert {r["video_id"]: r["phase"] for r in files.resume_phase(done).collect()} == {"a": 3, "b": 1}
    files.write_report(done, str(tmp_path / "out"), ["video_id", "phase"])
    assert files.read_csv(spark, str(tmp_path / "out"), "video_id STRING, phase INT").count() == 4
    (tmp_path / "list.txt").write_text("# no\n x \n\ny\n")
    assert [r["line"] for r in files.read_lines(spark, str(tmp_path / "list.txt")).collect()] == ["x", "y"]


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [("a", "view", 10, 1.0, "approved"), ("a", "click", 20, 2.0, "pending"), ("b", "view", 5, 9.5, "rejected")]
    frame = spark.createDataFrame(rows, "video_id string, event_type string, progress int, amount double, status string").withColumn("ts", F.to_timestamp(F.concat(F.lit("2024-01-01 00:00:"), F.col("progress"))))
    frame.write.parquet(str(tmp_path / "in"))
    for k, view in enumerate((streaming.counts_by_video, streaming.review_progress, streaming.latest_state, lambda e: streaming.budget_state(e, 10.0))):
        out = []
        streaming.run_available(view(streaming.read_events(spark, str(tmp_path / "in"))), lambda batch, _, out=out: out.extend(batch.collect()), str(tmp_path / f"c{k}"), "complete")
        assert sorted(map(tuple, out)) == sorted(map(tuple, view(frame).collect()))


def test_pick_diverse_matches_choosing_from_all_rows(spark):
    rng = random.Random(41)
    rows = [(v, i, rng.choice("abc"), rng.randrange(40) / 4, rng.randrange(8) / 4) for v in range(6) for i in range(v * 9)]
    want = []
    for v in range(6):
        left, taken = [r for r in rows if r[0] == v], []
        while left and len(taken) < 4:
            def score(r, taken=taken):
                n = sum(t[2] == r[2] for t in taken)
                return 0.5 * r[3] + 0.3 * ((2.0 if n == 0 else 0.0) - (3.0 * n + (10.0 if n >= 2 else 0.0))) + 0.2 * r[4]

            best = max(left, key=lambda r: (round(score(r), 9), -r[1]))
            left.remove(best)
            taken.append(best)
            want.append((v, best[1], len(taken)))
    frame = spark.createDataFrame(rows, "video long, id long, kind string, hard double, failed double")
    assert sorted(tuple(r) for r in similarity.pick_diverse(frame, "video", "id", "kind", "hard", "failed").collect()) == sorted(want)


def test_similar_pairs_ignore_white_space_at_the_ends(spark):
    text = "a text of some length"
    frame = spark.createDataFrame([(1, 1, text), (1, 2, text + "\n\n" * 40), (1, 3, "\u00a0\t" * 60 + text.upper()), (1, 4, None)], "v long, id long, text string")
    assert sorted((r["a"], r["b"], r["ratio"]) for r in similarity.similar_pairs(frame, "v", "id", "text", 0.8).collect()) == [(1, 2, 1.0), (1, 3, 1.0), (2, 3, 1.0)]


@pytest.mark.parametrize("above", [0.5, 0.8])
def test_dedupe_replacing_matches_a_plain_fold(spark, above):
    rng = random.Random(42)
    words = ["go", "stop", "run", "wait"]
    rows = [(v, i, " ".join(rng.choices(words, k=rng.randrange(1, 4))), rng.choice([None, *range(10)])) for v in (0, 1, None) for i in range(40)]
    rows += [(3, i, rng.choice(["hot text", "Hot text ", "hot  text", "cold texts"]), i % 17) for i in range(300)] + [(4, 0, None, 1), (4, 1, "", 2), (4, 2, " \t", 0), (4, 3, "go", 1)]
    want = []
    for v in (0, 1, 3, 4, None):
        kept = []
        for r in (r for r in rows if r[0] == v):
            like = [i for i, k in enumerate(kept) if similarity.ratio(r[2], k[2]) > above]
            if not like:
                kept.append(r)
            elif r[3] is not None and kept[like[0]][3] is not None and r[3] > kept[like[0]][3]:
                kept[like[0]] = r
        want += [(v, k[1]) for k in kept]
    frame = spark.createDataFrame(rows, "v long, i long, text string, score long").repartition(5)
    got = similarity.dedupe_replacing(frame, "v", "i", "text", "score", above).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert similarity.dedupe_replacing(frame.limit(0), "v", "i", "text", "score", above).count() == 0


def test_bounds_never_hide_a_ratio():
    rng = random.Random(43)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc d", k=rng.randrange(40))) for _ in "ab")
        r = similarity.ratio(a, b)
        assert all(similarity.can_exceed(a.strip(), b.strip(), above) for above in (0.3, 0.5, 0.7, 0.9) if r > above)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 250), (7, 3)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 250: 200, 300: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
