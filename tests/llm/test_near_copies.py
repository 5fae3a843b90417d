"""Near copies against all pairs, and the pipeline's stage."""

import random

import pytest

import corpus_pipeline
from quillstone.llm import near_copies, simhash

SCHEMA = "doc_id long, text string"


def shingles(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows):
    """component_id of every row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) / len(a | b) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for (i, _), g in zip(rows, group, strict=True):
        ids.setdefault(g, []).append(i)
    return [min((i for i in ids[g] if i is not None), default=None) for g in group]


def edited(rng, words, edits):
    """words with single words replaced; each breaks up to five shingles."""
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def cases():
    rng = random.Random(9)
    rows = [(1, "a b"), (2, None), (3, ""), (4, "A  b"), (4, "a b"), (None, "a b"), (None, "z"), (7, "x " * 3000), (8, " \n")]
    for i in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((100 + i, " ".join(base)))
        rows += [(1000 * k + i, edited(rng, base, k)) for k in (1, 2, 3, 4, 5, 8)]
    hot = [f"h{rng.randrange(5000)}" for _ in range(200)]  # a large group with chains: members differ from each other by up to twice as much
    rows += [(20000 + i, edited(rng, hot, 3)) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell", [near_copies.CELL, 4])
def test_components_are_those_of_all_pairs(spark, cell):
    rows = cases()
    got = near_copies.near_copy_components(spark.createDataFrame(rows, SCHEMA).repartition(3), cell=cell).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == sorted(zip((i for i, _ in rows), brute(rows), strict=True), key=repr)
    assert near_copies.near_copy_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_drops_what_four_bits_left(spark):
    rows = [r for r in cases() if r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(set(brute(rows)))
    got = sorted({r["doc_id"] for r in corpus_pipeline.dedup_near_copies(spark, docs, "").select("doc_id").collect()})
    assert got == want
    assert simhash.simhash_components(docs).select("component_id").distinct().count() > len(want)
