"""The pipeline's stages and its whole run on a small table with nulls, empties, repeated ids, ties and clashing names."""

import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import language_id, near_copies, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the old river runs slowly past the quiet village and many people walk along its green banks every morning with their dogs while children play near the wooden bridge until the evening bell rings over all of the roofs".split()
DE = "der alte Fluss fließt langsam am stillen Dorf vorbei und viele Leute gehen jeden Morgen mit ihren Hunden an den grünen Ufern entlang während Kinder nahe der hölzernen Brücke spielen bis die Abendglocke über allen Dächern läutet".split()
ITEM = "what is the smallest number that divides both sides of the second equation when the first one holds for every whole number under ninety nine and above seven"


def prose(words, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choices(words, k=n)) + "."


def table():
    rows = [(i, prose(EN if i % 2 else DE, 120, i), "en" if i % 2 else "de") for i in range(40)]
    base = rows[1][1]
    rows += [
        (50, base, "en"), (51, base.replace("river", "stream", 1), None),  # copies of 1
        (52, f"{prose(EN, 60, 99)} {ITEM} {prose(EN, 60, 98)}", "en"),  # a benchmark passage
        (53, None, "en"), (54, "", None), (55, "123 ²³ ½ !!", "en"),
        (56, "Wczoraj poszedłem do sklepu i kupiłem chleb oraz mleko dla całej rodziny.", None),
        (3, f"{prose(EN, 60, 97)} {ITEM}", "en"),  # shares its id with a clean document
        (5, rows[5][1], "de"), (None, prose(EN, 110, 201), "en"), (None, prose(EN, 110, 202), None), (None, base, None),
    ]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(table(), SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def kept(df):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in df.collect()))


def test_language_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.keep_identified(spark, docs.withColumn("score", F.lit(9)).withColumn("letters", F.lit(1)), folder)
    assert out.columns == [*docs.columns, "score", "letters"]
    gone = {r[0] for r in table()} - {r["doc_id"] for r in out.collect()}
    assert gone == {53, 54, 55, 56} and out.count() == len(table()) - 4


def brute_components(texts, size, at):
    sets = [{tuple(t.split()[i : i + size]) for i in range(max(1, len(t.split()) - size + 1))} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if len(a & b) >= at * len(a | b) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    return root


def test_near_dedup_stage_keeps_one_row_of_each_component(spark, folder):
    rows = [r for r in table() if r[1] and r[0] != 55]
    rows += [(3, "a b c d e f g", None, "s", 1), (5, "x y z u v w", None, "s", 1), (5, "a b c d e f g", None, "s", 1), (None, "a b c d e f g", None, "s", 1), (None, "only one here at all", None, "s", 1)]
    got = kept(corpus_pipeline.dedup_near_copies(spark, spark.createDataFrame(rows, SCHEMA), folder))
    root = brute_components([r[1] for r in rows], 5, 0.8)
    best = {}
    for r, c in zip(rows, root, strict=True):
        best.setdefault(c, []).append((r[0] is None, r[0] or 0, r[1]))
    assert {(x[0], x[1]) for x in got} == {(not min(v)[0], min(v)[1]) for v in best.values()}
    assert len(got) == len(best)


def test_repeated_rows_leave_one(spark, folder):
    rows = [(7, "one two three four five six", "en", "s", 1)] * 3 + [(None, "", "en", "s", 1)] * 2
    assert near_copies.drop_near_copies(spark.createDataFrame(rows, SCHEMA)).count() == 2
    assert near_copies.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_decontamination_stage_judges_texts_not_ids(spark, folder):
    docs = spark.createDataFrame(table(), SCHEMA)
    got = corpus_pipeline.drop_benchmark(spark, docs, folder)
    assert got.columns == docs.columns
    want = [r for r in table() if r[1] is None or ITEM not in r[1]]
    assert kept(got.na.fill("")) == kept(spark.createDataFrame(want, SCHEMA).na.fill(""))


def test_line_stage(spark, folder):
    lines = "l one\nl two\nl three\n"
    rows = [(1, lines + "own", None, "s", 1), (2, lines, None, "s", 1), (3, None, None, "s", None), (2, "other " + lines, None, "s", 1)]
    got = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, SCHEMA), folder)
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()} == {(1, lines + "own", len(lines) + 3), (3, "", 0), (2, "other " + lines, len(lines) + 6)}


def test_run(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, folder).collect()
    assert all(r["library_agrees"] and r["n_tokens"] == len(r["ids"]) and library.decode(r["ids"]) == r["decoded"] for r in got)
    ids = [r["doc_id"] for r in got]
    # Documents 0 to 39 but the copies of others, and the two texts without an id; 3 stands once, as its other text holds an item.
    assert sorted(i for i in ids if i is not None) == list(range(40)) and ids.count(None) == 2


# What the stages rest on


@pytest.mark.parametrize("text", ["²³", "½ ①", "Ⅷ", "12 34", "", "़", "🙂"])
def test_no_letters(text):
    assert language_id.words_of(text) == []


def test_marks_stay_with_their_letters():
    assert language_id.words_of("हिन्दी में x2y É") == ["हिन्दी", "में", "x", "y", "é"]


def test_toxicity_of_a_text_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(1)
    model = toxicity._train([rng.integers(0, 400, (n, 2)) for n in rng.integers(0, 30, 60)], rng.integers(0, 2, 60).astype(np.float32))
    docs = [np.empty((0, 2), np.int64), np.array([[3, 5]]), *[rng.integers(0, 400, (n, 2)) for n in (2, 3, 7, 200)], np.array([[3, 5]]), np.empty((0, 2), np.int64)]
    alone = np.array([toxicity.logits(model, [d])[0] for d in docs])
    for seed in range(6):
        order = np.random.default_rng(seed).permutation(len(docs))
        assert np.allclose(toxicity.logits(model, [docs[i] for i in order]), alone[order], atol=2e-6)
    # Each pool is over the windows that begin in the text, and no others.
    for d, z in zip(docs, alone, strict=True):
        words = model.embed[np.concatenate([d, np.full((3, 2), toxicity._PAD)])].sum(axis=1)
        pooled = [max(sum(words[i + j] @ w[j][:, f] for j in range(len(w))) for i in range(max(len(d), 1))) for w in model.filters for f in range(toxicity.FILTERS)]
        assert abs(np.maximum(np.array(pooled) + model.bias, 0) @ model.out + model.out_bias - z) < 1e-4


def test_rare_words_are_known_by_their_beginning():
    rng = random.Random(3)
    hasher = toxicity.WordHasher()
    text = lambda bad: " ".join(rng.choices(EN, k=30) + (["scumm" + "".join(rng.choices("abcdefgh", k=6))] if bad else []))
    rows = [(text(i % 3 == 0), i % 3 == 0) for i in range(600)]
    ids = [np.array(hasher(t), np.int64).reshape(-1, 2) for t, _ in rows]
    model = toxicity.fit(ids, np.array([y for _, y in rows], float), [None] * 600)
    new = [(text(i % 3 == 0), i % 3 == 0) for i in range(150)]
    z = toxicity.logits(model, [np.array(hasher(t), np.int64).reshape(-1, 2) for t, _ in new]) - model.thresholds[""]
    assert np.mean((z > 0) == np.array([y for _, y in new])) > 0.97
