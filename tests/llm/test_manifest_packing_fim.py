"""Merkle manifest, packing and fill-in-middle against brute force: nulls, empties, long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm import byte_bpe, fill_middle, merkle, packing

H = merkle.node_hash


# Merkle manifest


def levels_of(leaves, arity):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def brute_path(levels, at, arity):
    path = []
    for level in levels[:-1]:
        run = at - at % arity
        path += ["".join(level[run:at]), "".join(level[at + 1 : run + arity])]
        at //= arity
    return path


@pytest.mark.parametrize("subtree_levels", [1, 2, 3])
@pytest.mark.parametrize("arity", [2, 3, 16])
def test_traversal_gives_every_path_in_turn(arity, subtree_levels):
    for n in [1, 2, 3, 4, 5, 15, 16, 17, 31, 81, 82, 257]:
        leaves = [H(str(i)) for i in range(n)]
        levels = levels_of(leaves, arity)
        high = merkle.height(n, arity)
        assert high == len(levels) - 1
        assert list(merkle.authentication_paths(leaves, high, arity, subtree_levels)) == [brute_path(levels, i, arity) for i in range(n)]
        assert merkle.block_top(leaves, high, arity) == levels[-1][0]


def test_traversal_holds_two_subtrees_a_level():
    leaves = [str(i) for i in range(16**3)]
    sizes, made = [], []
    old = merkle.Subtree.__init__

    def spied(self, *a):
        old(self, *a)
        made.append(self)

    merkle.Subtree.__init__ = spied
    try:
        for _ in merkle.authentication_paths(leaves, 3):
            live = made[-6:]
            sizes.append(max(sum(map(len, s.kept.values())) + sum(map(len, s.open)) for s in live))
    finally:
        merkle.Subtree.__init__ = old
    assert max(sizes) <= 16 + 3 * 16


def show(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, arity):
    trees = {}
    for r in rows:
        leaf = H("".join(map(show, r)))
        low = None if r[4] is None else r[4].translate({c: c + 32 for c in range(65, 91)})
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        other = H("".join(map(show, (*r[:4], low)))) if tampered else leaf
        trees.setdefault(b"" if r[1] is None else b"s" + r[1].encode(), []).append((r[0] is not None, r[0] or 0, leaf, other, r[0]))
    subroots = {t: levels_of([x[2] for x in sorted(v)], arity) for t, v in trees.items()}
    order = sorted(trees)
    top = levels_of([subroots[t][-1][0] for t in order], arity)
    out = Counter()
    for k, t in enumerate(order):
        for at, (_, _, leaf, other, doc_id) in enumerate(sorted(trees[t])):
            p = brute_path(subroots[t], at, arity) + brute_path(top, k, arity)
            back = merkle.folded(other, p)
            out[doc_id, leaf, subroots[t][-1][0], top[-1][0], H("".join(p)), back, back == top[-1][0]] += 1
    return out


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize(("arity", "block_levels"), [(2, 1), (3, 2), (16, 3)])
def test_manifest(spark, arity, block_levels, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot", "hot", "hot", "é", "z", "Ž", "", None, str(i)]), rng.choice(["en", None]), rng.choice([None, 3]), rng.choice(["Ab", "ab", "", None, "É A"])) for i in range(150)]
    rows += [(7, "hot", "en", 1, "tie"), (7, "hot", "en", 2, "tie"), (None, "hot", None, None, None), (None, None, None, None, "X"), (9, "hot", "en", 1, "same"), (9, "hot", "en", 1, "same"), (500, "long", "en", 1, "Yz " * 50000)]
    frame = spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("tree"), F.lit(2).alias("rank"), F.lit(3).alias("node"), F.lit(4).alias("path"), F.lit(5).alias("block"))
    for name in ("ranked", "tops", "walked", "manifest"):
        f = getattr(merkle, name)
        monkeypatch.setattr(f, "__defaults__", tuple(arity if d is merkle.ARITY or d == merkle.ARITY else block_levels if d == merkle.BLOCK_LEVELS else d for d in f.__defaults__))
    got = merkle.dataset_manifest(frame.repartition(5), tampered=merkle.tampered_text())
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows, arity)


def test_manifest_of_no_rows_and_of_one(spark):
    assert merkle.dataset_manifest(spark.createDataFrame([], DOCS)).count() == 0
    one = merkle.dataset_manifest(spark.createDataFrame([(1, None, None, None, "a")], DOCS)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == H("")


# Packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


def test_chunks_give_the_library_s_ids(library):
    rng = random.Random(6)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", "\r\n", "a", "B", "é", "1", "²", "!", "'s", "'", "<|endoftext|>", "<|", "中", "हि", "👍🏽", "x" * 70, "\x00"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(6000)] + ["", " ", "w " * 5000, "q" * 20000]
    bpe = byte_bpe.ByteBpe(byte_bpe.model_json())
    got = [np.frombuffer(x, bpe.width).tolist() for x in bpe.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, bpe.width).tolist() for x in bpe.encode(texts)] == got


def check_packed(rows, sequences, library, size):
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows)
    total = sum(len(k[1]) * n for k, n in want.items())
    assert sorted(s["sequence_id"] for s in sequences) == list(range(-(-total // size)))
    by_doc = []
    for s in sorted(sequences, key=lambda s: s["sequence_id"]):
        ids = np.frombuffer(s["ids"], "<u4").tolist()
        last = s["sequence_id"] == (total - 1) // size
        n = total - s["sequence_id"] * size if last else size
        assert s["length"] == n == sum(p["length"] for p in s["pieces"])
        assert len(ids) == s["padded_to"] == (n if n & (n - 1) == 0 else size) and not any(ids[n:])
        at = 0
        for p in s["pieces"]:
            assert p["offset"] == at and p["length"] > 0
            cut = ids[at : at + p["length"]]
            at += p["length"]
            if p["start"] == 0:
                by_doc.append((p["doc_id"], p["doc_tokens"], cut))
            else:
                assert by_doc[-1][0] == p["doc_id"] and len(by_doc[-1][2]) == p["start"]
                by_doc[-1] = (*by_doc[-1][:2], by_doc[-1][2] + cut)
    assert all(n == len(ids) for _, n, ids in by_doc)
    assert Counter((i, tuple(ids)) for i, _, ids in by_doc) == want


@pytest.mark.parametrize(("size", "parts"), [(4, 3), (64, 7), (1024, 2), (1024, 60)])
def test_packing(spark, library, size, parts):
    rng = random.Random(7)
    rows = [(i, rng.choice(["", None, "one", "two words", "é " * 30, "some longer text, again and again. " * rng.randrange(40)])) for i in range(80)]
    rows += [(3, "same"), (3, "same"), (None, "no id"), (None, None), (99, "long " * 20000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).select("*", F.lit(0).alias("ids"), F.lit(0).alias("n"), F.lit(0).alias("base"), F.lit("x").alias("part"))
    sequences = packing.pack(frame, size=size)
    check_packed(rows, sequences.collect(), library, size)
    digest = packing.pieces_digest(sequences).collect()
    held = {(s["sequence_id"], p["offset"]): s["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])] for s in sequences.collect() for p in s["pieces"]}
    assert all(r["ids_crc32"] == zlib.crc32(held[r["sequence_id"], r["offset"]]) for r in digest) and len(digest) == len(held)


def test_packing_nothing_and_powers_of_two(spark, library):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty).count() == 0 and packing.pieces_digest(packing.pack(empty)).count() == 0
    for n, padded in [(8, 8), (9, 1024), (1024, 1024)]:
        one = packing.pack(spark.createDataFrame([(i, None) for i in range(n)], "doc_id long, text string")).collect()
        assert [(s["length"], s["padded_to"], len(s["ids"])) for s in one] == [(n, padded, 4 * padded)]


# Fill-in-middle


def brute_fim(doc_id, text, seed=7, rate=100, share=50, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    P, S, M = markers
    if not text or any(x in text for x in markers) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text, text
    spm = h[3] % 100 < share
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), f"{S}{s}{P}{p}{M}{m}" if spm else f"{P}{p}{S}{s}{M}{m}", text


FIM = ("n", "form", "prefix_chars", "middle_chars", "output", "restored", "output_sha256", "restored_sha256")


@pytest.mark.parametrize("options", [{}, {"seed": 1, "rate": 40, "spm_share": 0}, {"markers": ("[pre]'", "[suf]", "[mid]"), "spm_share": 100}])
def test_fill_middle(spark, options):
    rng = random.Random(8)
    bits = ["\n", "\n\n", "a", "é👍", "<P", ">", "<S>", "<M", "\r\n", "\\n", "'", "<", " ", " ", "line\n", "S>", "[suf"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(14)))) for i in range(400)]
    rows += [(1, None), (1, ""), (None, "a\nb\nc"), (5, "same\nrow"), (5, "same\nrow"), (6, "x\n" * 60000), (7, "no end of line " * 20000), (-3, "a\nb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("n"), F.lit(2).alias("units"), F.lit(3).alias("h"), F.lit("q").alias("form"))
    got = fill_middle.fill_middle(frame, FIM, **options).collect()
    keyed = {"share" if k == "spm_share" else k: v for k, v in options.items()}
    want = Counter((*brute_fim(i, t, **keyed), H(brute_fim(i, t, **keyed)[5]), H(t or "")) for i, t in rows)
    assert Counter(map(tuple, got)) == want
    assert {r["form"] for r in got} == ({"plain", "psm"} if "rate" in options else {"plain", "spm"} if "markers" in options else {"plain", "psm", "spm"})


def test_fill_middle_of_no_rows_and_bad_markers(spark):
    assert fill_middle.fill_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    for markers in [("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("<P>", "a<P>b", "x")]:
        with pytest.raises(ValueError):
            fill_middle.fill_middle(spark.createDataFrame([], "doc_id long, text string"), markers=markers)
