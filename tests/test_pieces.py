"""Folds in pieces against plain folds, with one key on most partitions; spans by priority against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.operators import exclusion, pieces


def plain_min_gap(rows, gap):
    taken, last = [], None
    for at, *_ in rows:
        take = last is None or at - last >= gap
        last = at if take else last
        taken.append((take, last))
    return taken


def plain_scenes(rows, threshold, least, history=5):
    last, past, out = rows[0][0] if rows else None, [], []
    for at, value, *_ in rows:
        past = past[-(history - 1) :] + [value]
        cut = None not in past and sum(past) / len(past) > threshold and at - last >= least
        if cut:
            last, past = at, []
        out.append((cut, last))
    return out


def plain_islands(rows):
    end, island, out = None, None, []
    for at, value, *_ in rows:
        new = end is None or at >= end
        island = at if new else island
        end = value if end is None else max(end, value)
        out.append((new, island))
    return out


FOLDS = {
    "gap": (pieces.MinGap(7), lambda rows: plain_min_gap(rows, 7)),
    "long gap": (pieces.MinGap(500), lambda rows: plain_min_gap(rows, 500)),
    "scenes": (pieces.Scenes(6, 10), lambda rows: plain_scenes(rows, 6, 10)),
    "short scenes": (pieces.Scenes(5, 1, 3), lambda rows: plain_scenes(rows, 5, 1, 3)),
    "islands": (pieces.Islands(), plain_islands),
}


def rows_of(rng, n, step):
    at = 0
    for i in range(n):
        at += rng.choice(step)
        yield at, float(rng.choice([1, 3, 5, 6, 7, 9, 12])), i


@pytest.mark.parametrize("name", FOLDS)
def test_pieces_carry_the_state_of_the_plain_fold(name):
    fold, plain = FOLDS[name]
    for seed in range(150):
        rng = random.Random(seed)
        rows = list(rows_of(rng, rng.randrange(1, 80), rng.choice([[0, 1], [0, 1, 2, 9], [5, 40], [1]])))
        if name == "islands":
            rows = [(at, at + v, i) for at, v, i in rows]
        at, value = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(6)))) if len(rows) > 1 else []
        carried = folded = None
        got = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            assert carried == folded
            taken, last, folded = fold.run(folded, at[a:b], value[a:b])
            carried = fold.carry(carried, fold.summary(at[a:b], value[a:b]))
            got += zip(taken.tolist(), last.tolist(), strict=True)
        assert carried == folded and got == plain(rows)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_hot_key_over_many_partitions(spark, parts):
    rng = random.Random(5)
    rows = [(v, *r) for v, n in (("hot", 400), ("a", 3), ("b", 1), (None, 30)) for r in rows_of(rng, n, [0, 1, 2, 30])]
    frame = spark.createDataFrame([*rows, ("a", None, 1.0, 99)], "v string, at long, c double, i long").select("*", F.lit(1).alias("state"))
    by_key = {v: [r[1:] for r in rows if r[0] == v] for v in ("hot", "a", "b", None)}
    for name in ("gap", "scenes"):
        fold, plain = FOLDS[name]
        want = Counter((v, r[2], *m) for v, rs in by_key.items() for r, m in zip(rs, plain(rs), strict=True))
        got = pieces.fold_pieces(frame.repartition(4), ["v"], "at", ["i"], fold, value="c", parts=parts)
        assert Counter((r["v"], r["i"], r["taken"], r["last"]) for r in got.collect()) == want
    best = pieces.dedupe_keep_better(frame, ["v"], "at", ["i"], "c", 7, parts=parts)
    want = set()
    for v, rs in by_key.items():
        kept = []
        for r, (take, _) in zip(rs, plain_min_gap(rs, 7), strict=True):
            if take:
                kept.append(r)
            elif r[1] > kept[-1][1]:
                kept[-1] = r
        want |= {(v, r[2]) for r in kept}
    assert sorted(((r["v"], r["i"]) for r in best.collect()), key=repr) == sorted(want, key=repr)
    three = pieces.greedy_min_gap(frame, ["v"], "at", ["i"], 7, 3, parts=parts).collect()
    assert Counter(r["v"] for r in three) == {v: min(3, sum(t for t, _ in plain_min_gap(rs, 7))) for v, rs in by_key.items()}
    assert pieces.scene_cuts(frame.limit(0), ["v"], "at", ["i"], "c", 6, 10).count() == 0


def brute_exclusive(rows, most=0.5):
    taken, out = {}, {}
    for v, k, p, s, e, cluster, bad in sorted(rows, key=lambda r: (-(r[2] if r[2] is not None else float("-inf")), r[1])):
        if bad:
            out[k] = ("content", None)
            continue
        first = None
        if s is not None and e is not None:
            for k2, s2, e2, cluster2 in taken.get(v, []):
                if bool(cluster) != cluster2 or not (s < e2 and e > s2):
                    continue
                if not cluster or min(e, e2) - max(s, s2) > most * min(e - s, e2 - s2):
                    first = k2
                    break
        if first is None and s is not None and e is not None:
            taken.setdefault(v, []).append((k, s, e, bool(cluster)))
        out[k] = (None if first is None else "overlap", first)
    return out


@pytest.mark.parametrize("parts", [1, 9])
def test_exclusive_spans(spark, parts):
    rng = random.Random(6)
    rows = []
    for k in range(500):
        s = rng.choice([None, *[rng.randrange(900)] * 30])
        rows.append((rng.choice(["hot", "hot", "hot", "a", "b", None]), k, rng.choice([0.1, 0.5, 0.5, 0.9, None]), s, None if s is None else s + rng.choice([0, 3, 10, 60]), rng.choice([True, False, False, None]), rng.random() < 0.1))
    frame = spark.createDataFrame(rows, "v string, k long, p double, s long, e long, c boolean, bad boolean")
    got = exclusion.exclusive_spans(frame, "v", "k", "p", "s", "e", F.col("c"), [("content", F.col("bad"))], parts=parts).collect()
    assert {r["k"]: (r["reason"], r["against"]) for r in got} == brute_exclusive(rows) and len(got) == len(rows)
