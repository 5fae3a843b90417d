"""Operators on small tables: nulls, blanks, ties, repeated rows, empty tables, clashing names, and brute force."""

import hashlib
import math
import random
import time
from collections import Counter

import numpy as np
import pytest
import regex
import sentencepiece
import xxhash
from public_tokenizers import path
from pyspark.sql import functions as F

from quillstone.llm import chat_format, decontaminate, exact_dedup, html_text, language_id, line_dedup, piece_codec, pieces, repeats, simhash, toxicity

ROWS = [(1, "a b"), (2, None), (3, ""), (4, "a b"), (4, "a b"), (None, "a b"), (None, "z"), (7, "x " * 30000)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(frame, *names):
    """frame with columns of names that operators use within."""
    return frame.select("*", *[F.lit(f"clash {n}").alias(n) for n in names])


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


# Exact dedup


@pytest.mark.parametrize("counters", [1, 2, 4096])
def test_exact_dedup(spark, docs, empty, counters):
    rng = random.Random(1)
    rows = ROWS + [(i, rng.choice(["hot", "hot", "hot", "p", "q", str(i)])) for i in range(10, 200)]
    got = exact_dedup.exact_dedup(clashing(spark.createDataFrame(rows, SCHEMA), "digest", "low", "keep_id", "group_size", "kept"), counters=counters).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t or ""), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r["text_sha256"]]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(ids), r["doc_id"] == keep)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_misra_gries_bounds():
    import pyarrow as pa

    rng = random.Random(2)
    data = [bytes([min(int(rng.expovariate(0.2)), 60)]) for _ in range(3000)]
    batches = [pa.record_batch([pa.array(data[i : i + 100], pa.binary())], names=["d"]) for i in range(0, 3000, 100)]
    out = next(exact_dedup.misra_gries(iter(batches), 10)).to_pydict()
    low, true = dict(zip(out["digest"], out["low"], strict=True)), Counter(data)
    assert len(low) <= 10
    assert all(true[d] - 3000 / 11 <= low.get(d, 0) <= true[d] for d in true)


# Chat formatting


def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<sep>", "\\", "<", "s>", "/s>", "[", "é", "\n", "INST]", "<\\s>", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "<s>"]), "".join(rng.choices(bits, k=rng.randrange(8))) if rng.random() > 0.1 else None) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, None, "x"), (None, None, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chat(clashing(turns, "formatted", "turns", "n_turns", "said"))
    for r in chat_format.read_back(formatted).collect():
        mine = sorted(((t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]), key=lambda x: (x[0] is not None, x))
        assert [(x["role"], x["text"]) for x in r["turns"]] == [m[1:] for m in mine]
        assert r["loss_text"] == "".join(m[2] for m in mine if m[1] == "assistant")
    assert formatted.filter("formatted LIKE '%<s>[INST]%'").count() == len({r[0] for r in rows})
    assert chat_format.format_chat(turns.limit(0)).count() == 0


# Line dedup


def brute_lines(rows):
    keyed = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    order = sorted(keyed, key=lambda k: (k[0], k[1], xxhash.xxh64(k[2].encode(), seed=42).intdigest() - (1 << 64 if xxhash.xxh64(k[2].encode(), seed=42).intdigest() >> 63 else 0)))
    seen, out = set(), {}
    for key in order:
        lines = key[2].split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(x.strip(" ") for x in lines[p : p + 3])
            if any(w):
                gone |= {p, p + 1, p + 2} if w in seen else set()
                seen.add(w)
        out[key] = ("\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone))
    return out


@pytest.mark.parametrize("hot", [line_dedup.HOT_KEYS, 0, 2])
def test_line_dedup(spark, docs, empty, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot)
    rng = random.Random(4)
    rows = ROWS + [(i, "\n".join(rng.choices(["a", "b", " a", "", "c d"], k=rng.randrange(0, 14)))) for i in range(20, 60)] + [(20, "a\nb\na"), (20, "a\nb\na")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", n_lines int")  # a name that clashes
    want = brute_lines(rows)
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed_lines"]) for r in line_dedup.line_dedup(frame).collect())
    assert got == Counter((i, *want[i is not None, i or 0, t or ""]) for i, t in rows)
    assert line_dedup.line_dedup(empty).count() == 0


# SentencePiece


def test_codec_equals_library():
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    rng = random.Random(5)
    alphabet = list("abcdeé ▁\n\t\x00<>/s日𝔘") + ["the", " ", "  ", "</s>", "<0x0A>", "ing"]
    texts = ["", " ", "▁", "  a  b ", "a" * 3000, " " * 100, "</s><unk><s>"] + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    codec = piece_codec.Codec(pieces.model_bytes())
    for at in range(0, len(texts), 50):
        got = list(codec.encode(texts[at : at + 50]))
        assert [g[0] for g in got] == library.encode(texts[at : at + 50])
        assert all(g[1] for g in got)
        assert codec.decode([g[0] for g in got]) == library.decode([g[0] for g in got])


def test_list_and_heap_agendas_agree():
    agenda = piece_codec.Agenda(pieces.vocabulary(pieces.model_bytes()))
    rng = random.Random(6)
    for _ in range(300):
        chunk = "▁" + "".join(rng.choices("aeinrst", k=rng.randrange(45)))
        assert agenda._merge_list(chunk) == agenda._merge_heap(chunk)


def test_codec_table(docs, empty):
    rows = piece_codec.piece_codec(docs).collect()
    assert len(rows) == len(ROWS) and all(r["library_agrees"] for r in rows)
    assert [r["ids"] for r in rows if r["doc_id"] == 2] == [[]]
    assert piece_codec.piece_codec(empty).count() == 0
    digests = piece_codec.piece_digest(clashing(docs, "n_tokens", "ids", "ids_sha256", "decoded", "library_agrees")).collect()
    n = {r["doc_id"]: r["n_tokens"] for r in digests}
    assert n[3] == 0 and n[7] > 30000 and len(digests) == len(ROWS)
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = Counter((i, len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in ROWS)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in digests) == want


def test_long_chunks_and_many_generations(monkeypatch):
    """Texts without white space are one chunk each; a memory of a few chunks gives the same ids."""
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    rng = random.Random(61)
    texts = ["".join(rng.choices("日本語のabc", k=rng.randrange(1, 400))) for _ in range(40)] + ["w%d x%d" % (i % 7, i) for i in range(60)]
    monkeypatch.setattr(piece_codec, "KEPT_CHUNKS", 5)
    codec = piece_codec.Codec(pieces.model_bytes())
    for _ in range(2):
        for at in range(0, len(texts), 9):
            assert [g[0] for g in codec.encode(texts[at : at + 9])] == library.encode(texts[at : at + 9])
        codec.rest()


# Language ID


def test_forward_sums_all_segmentations():
    vocab = pieces.vocabulary(pieces.model_bytes())
    index = pieces.SubstringIndex(vocab.ids)
    probs = np.random.default_rng(0).dirichlet(np.ones(vocab.size), 2).T
    rng = random.Random(31)
    words = ["▁the", "▁ça", "▁日本x", "▁" + "ab" * 10] + ["▁" + "".join(rng.choices("etaoin日本語", k=n)) for n in (7, 8, 9, 48, 49, 80, 170, 1000, 20_000)]
    together = language_id.word_log_likelihoods(index, probs, words)
    for word, found in zip(words, together, strict=True):
        logs = np.zeros((len(word) + 1, 2))
        for end in range(1, len(word) + 1):
            terms = [(start, vocab.ids.get(word[start:end])) for start in range(max(end - vocab.longest, 0), end)]
            parts = [logs[start] + np.log(probs[i] if i is not None else language_id.UNKNOWN) for start, i in terms if i is not None or end - start == 1]
            logs[end] = np.logaddexp.reduce(parts, axis=0)
        assert np.allclose(language_id.word_log_likelihoods(index, probs, [word])[0], logs[-1], rtol=1e-9) and np.allclose(found, logs[-1], rtol=1e-9)
        # Every segmentation has as many pieces' expected uses as it has pieces; characters add up to the word.
        uses = language_id.expected_pieces(index, probs[:, [0]], [word], np.array([3.0]))
        known = sum(u * len(p) for p, u in ((p, uses[i]) for p, i in vocab.ids.items()) if u)
        assert known <= 3 * len(word) + 1e-6 and known > 3 * (len(word) - 3)


def test_language_accuracy_and_undetermined(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit_language_model(docs.filter("doc_id % 2 = 0"), fit_docs=40)
    found = language_id.identify_language(docs.filter("doc_id % 2 = 1").withColumnRenamed("source", "score"), model).toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97
    odd = spark.createDataFrame([(1, None), (2, "12 ... 3"), (3, ""), (4, "the " * 50), (5, "x" * 100000)], SCHEMA)
    assert (found["evidence"] > 0).mean() > 0.97
    strange = spark.createDataFrame([(i, " ".join("".join(random.Random(i * 99 + k).choices("qzxjwkvy", k=6)) for k in range(20)), "en") for i in range(5)], SCHEMA + ", lang string")
    assert all(r["evidence"] < 0 for r in language_id.identify_language(strange, model).collect())
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify_language(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and 0 <= got[5][1] <= 1
    none = language_id.fit_language_model(spark.createDataFrame([], SCHEMA + ", lang string"))
    assert {r["lang_pred"] for r in language_id.identify_language(odd, none).collect()} == {"und"}
    assert language_id.identify_language(empty, model).count() == 0


# HTML


@pytest.mark.parametrize(("html", "text"), [
    ("", ""),
    ("words  only &amp; more", "words only & more"),
    ("<p>a<p>b", "a\n\nb"),
    ("<nav><a href=x>menu</a></nav><article><h1>T &lt;1&gt;</h1><p>one<br>two <b>bold</b>\n</p><div class='ad'>buy</div><p></p><ul><li>i<li>j</ul></article><footer>f</footer>", "T <1>\n\none two bold\n\ni\n\nj"),
    ("<body><script>if (a<b) '</p>'</script><style>p{}</style><div id=main-text><h1>H</h1><p>A long paragraph of text, quite long.</p><p>And a second one.</p></div><div class='sidebar'><a href=1>l</a><a href=2>m</a></div><section id='comments'><p>Reader says hello and a lot more words than the text has, really a lot of words.</p></section></body>", "H\n\nA long paragraph of text, quite long.\n\nAnd a second one."),
    ("<div role=navigation>x</div><div hidden>y</div><div style='display: none'>z</div><p>kept", "kept"),
    ("<!-- c --><header>h</header><main><p>m</p><form><input><button>go</button></form></main>", "m"),
    ('<article><p title="the hidden cost of x">a</p><h2 class="section-header">b</h2><p class="form-factor">c</p><p hidden>no</p><p class="x ad">no</p></article>', "a\n\nb\n\nc"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>text</p><div class='post-comments'>no</div></article>", "Title\n\ntext"),
    ("<html><head><title>t</title><meta charset=utf-8><p>no body tag</p>", "no body tag"),
    ("<p>&am<b>p;</b> it's <a href='x'>1 < 2</a> <p title=it's>b", "&amp; it's 1 < 2\n\nb"),
    ("a <b and no end", "a <b and no end"),
    ("<div class=a><div class=sidebar>one two three</div></div><div>kept</div>", "kept"),
    ("<div class=widget><p>only this</p></div>", "only this"),
    ("<article><fieldset><label>Size</label> ten</fieldset><p>text</p><form><label>Mail</label></form></article>", "Size ten\n\ntext"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


ARTICLE = "<h1>A title of some words</h1>" + "".join(f"<p>Sentence {i} of an article has a number of words in it, and {i} more of them.</p>" for i in range(5))
TEXT = "\n\n".join(["A title of some words", *(f"Sentence {i} of an article has a number of words in it, and {i} more of them." for i in range(5))])


@pytest.mark.parametrize("wrapped", [
    '<div class="site has-sidebar">{}<div class="sidebar"><a href=1>one</a> <a href=2>two</a></div></div>', '<div class="comment-article">{}</div><p>foot</p>', '<div id="toolbar-content">{}</div>', '<div class="layout-no-sidebar">{}</div><div>the foot</div>',
    '<div class="page withSidebar">{}</div>', '<div class="post-comments">{}</div>', "<div class=x><div class=ad-box>Buy this now, it is cheap and good.</div>{}</div>", "<div>{}</div><div class='related-links'><a href=1>Other news of the day</a></div>", "<div class=post>{}<div id=comments-area><p>Nice text, said a reader.</p></div></div>",
])
def test_names_of_layout_take_nothing_away(wrapped):
    assert html_text.main_text(wrapped.format(ARTICLE)) == TEXT


@pytest.mark.parametrize("part", ['<h2 class="notice">part</h2>', '<p class="related">part</p>', '<div class="ad-hoc-analysis">part</div>', '<table class="widget-sizes"><tr><td>part</table>', '<figure class="banner-image">part</figure>', "<fieldset>part</fieldset>", "<p><label>part</label></p>", "<span class=menu>part</span>", '<div class="menu-prices-of-1900">part</div>'])
def test_parts_of_an_article_stay(part):
    assert html_text.main_text(f"<article>{ARTICLE}{part}<p>last of all</p></article>") == f"{TEXT}\n\npart\n\nlast of all"


@pytest.mark.parametrize("part", ["<div class=ad>part</div>", "<p class=notice>part</p>", "<div class=newsletter-box>part</div>", "<ul class=share-buttons><li><a href=1>part</a></ul>", "<span class=share><a href=1>part</a></span>", "<div class=commentList><p>part</p></div>", "<div id=sidebar-1>part</div>", "<aside>part</aside>", "<form><label>part</label></form>"])
def test_clutter_in_an_article_goes(part):
    assert html_text.main_text(f"<article>{ARTICLE}{part}<p>last of all</p></article>") == f"{TEXT}\n\nlast of all"


def test_densities_alone_find_the_text_of_real_pages(spark):
    """Pages of which all tags that tell parts apart, and all names, are taken away: the text is what they give with them, and not the whole page."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").orderBy("page_id").limit(60).collect()]
    found = whole = 0
    for html in pages:
        want = html_text.main_text(html)
        bare = regex.sub(r"<(/?)(?:nav|footer|aside|header|article|main|section)\b[^>]*>", r"<\1div>", html)
        bare = regex.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", bare)
        root = html_text.parse(bare)
        for n in html_text._walk(root):
            n.dropped = n.boilerplate
        whole += "\n\n".join(html_text.blocks(root)) != want
        found += html_text.main_text(bare) == want
    assert whole == len(pages) and found >= 0.9 * len(pages)


@pytest.mark.parametrize("part", ["<a ", "<a '", "<a b='", '<p x="', "<", "</", "<!", "<!--", "<p>", "<div>", "<i>", "<table><td><i>", "<li>", "<p><table><td><i><div>", "<p aaaaaaaa aa", "<a = = =", "<script>", "&amp;", "</p>"])
def test_broken_pages_take_time_in_proportion(part):
    """The bound is about ten times what a slow machine needs for a megabyte; a square of it would take hours."""
    html = part * (500_000 // len(part))
    began = time.process_time()
    html_text.main_text(html)
    html_text.main_text(html + ">")
    assert time.process_time() - began < 40


def plain_densities(node, whole=None):
    """(characters, tags, characters of links, tags of links, density, sum) by the formulas, from the leaves up, by recursion."""
    kids = [(c, plain_densities(c, whole)) for c in node.children if isinstance(c, html_text.Node)]
    text = "".join(c for c in node.children if isinstance(c, str))
    chars = len("".join(text.split())) + sum(k[0] for _, k in kids)
    tags = len(kids) + sum(k[1] for _, k in kids)
    links, link_tags = (chars, tags + 1) if node.tag == "a" else (sum(k[2] for _, k in kids), sum(k[3] for _, k in kids))
    if whole is None:
        return chars, tags, links, link_tags, 0, 0
    c, t, lc, lt = chars, max(tags, 1), max(links, 1), max(link_tags, 1)
    base = math.log(c / max(c - links, 1) * links + whole[2] / max(whole[0], 1) * c + math.e)
    density = 0.0
    if c:
        factor = math.log(c / lc * t / lt) / math.log(base) if base > 1.0001 else math.log(c * t + math.e)
        density = c / t * max(factor, 0.0)
    return chars, tags, links, link_tags, density, sum(k[4] for _, k in kids)


def test_choice_is_the_largest_density_sum_over_the_threshold():
    rng = random.Random(21)

    def page(deep):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            tag = rng.choice(["div", "p", "a", "section", "b"])
            inner = page(deep - 1) if deep and rng.random() < 0.6 else "word " * rng.randrange(0, 12)
            parts.append(f"<{tag}>{inner}</{tag}>" + "x" * rng.randrange(3))
        return "".join(parts)

    for _ in range(150):
        root = html_text.parse(page(3))
        whole = plain_densities(root)
        left, all_nodes = [root], []
        while left:
            n = left.pop()
            all_nodes.append((n, plain_densities(n, whole)))
            left += [c for c in n.children if isinstance(c, html_text.Node)]
        best = html_text.densest_subtree(root)
        if not whole[0]:
            assert best is None
            continue
        values = {id(n): v for n, v in all_nodes}
        densest = max((n for n, _ in all_nodes), key=lambda n: (values[id(n)][4]))
        top = max(v[4] for _, v in all_nodes)
        thresholds = set()
        for n, v in all_nodes:
            if v[4] == top:
                path_min, at = v[4], n
                while at is not root:
                    at = at.parent
                    path_min = min(path_min, values[id(at)][4])
                thresholds.add(path_min)
        assert densest is not None
        assert any((values[id(best)][5], values[id(best)][0]) == max((v[5], v[0]) for _, v in all_nodes if v[4] >= t) for t in thresholds)


def test_extract_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<p>é x</p>"), (2, None, "<p>é x</p>"), (3, "d", "<div>" * 3000 + "deep")], "page_id long, text string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_text(pages).collect())
    assert got == [(1, "", 0), (2, "é x", 3), (2, "é x", 3), (3, "deep", 4)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


# SimHash


def brute_fingerprint(text):
    words = regex.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    grams = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    out = {}
    for i, d in enumerate(ids):
        out.setdefault(find(i), []).append(d)
    return [min((d for d in out[find(i)] if d is not None), default=None) for i in range(len(fps))]


def test_simhash(spark, empty):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(60)]
    rows = list(ROWS)
    for i in range(100, 160):
        base = rng.choices(words, k=300)
        rows += [(i, " ".join(base)), (i + 1000, " ".join(base[:150] + ["New"] + base[150:])), (i + 2000, " ".join(base).upper())]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], components(fps, [i for i, _ in rows]), strict=True), key=repr)
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA).withColumns({"fp": F.lit("f"), "component_id": F.lit(1), "n": F.lit(None)}))
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()), key=repr) == want
    assert simhash.simhash_components(empty).count() == 0


@pytest.mark.parametrize("cell", [4096, 6])
def test_anchor_links_connect_all_near_pairs(spark, cell):
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps)[:100]:
        for bit in rng.sample(range(64), rng.randrange(6)):
            f ^= 1 << bit
        fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(6) for b in range(6)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), cell).collect()
    at = {f: i for i, f in enumerate(signed)}
    assert all((fps[at[r["a"]]] ^ fps[at[r["b"]]]).bit_count() <= 4 for r in links)
    root = list(range(len(fps)))
    for r in links:
        a, b = root[at[r["a"]]], root[at[r["b"]]]
        root = [min(a, b) if x in (a, b) else x for x in root]
    want = components(fps, list(range(len(fps))))
    assert [want[x] for x in root] == want and len(set(root)) == len(set(want))


# Decontamination


def brute_matches(docs, items, k=5):
    cut = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    out = {}
    for item, text in items:
        words = cut(text)
        if not words:
            continue
        size = min(k, len(words))
        wanted = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        for doc, body in docs:
            w = cut(body)
            if len(w) < size:
                continue
            width = min(len(words), len(w))
            for s in range(len(w) - width + 1):
                have = Counter(tuple(w[i : i + size]) for i in range(s, s + width - size + 1))
                common = sum((have & wanted).values())
                score = common / (sum(have.values()) + sum(wanted.values()) - common)
                if score >= 0.8 and score > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (score, s)
    return out


def test_decontamination(spark, empty):
    rng = random.Random(9)
    words = ["v%d" % i for i in range(200)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 8, 30, 60])))) for i in range(12)] + [(90, None), (91, "..."), (92, "one two three four five six " * 4)]
    docs = [(1, None), (2, ""), (3, items[3][1]), (4, "pre fix " + items[4][1].upper() + " post, fix"), (5, "one two three four five six " * 9)]
    for d, (_, text) in enumerate(items[:12], 100):
        w = text.split()
        docs.append((d, " ".join(rng.choices(words, k=40) + w[: len(w) // 2] + ["changed"] + w[len(w) // 2 + 1 :] + rng.choices(words, k=20))))
        docs.append((d + 50, " ".join(w[:-1])))
    docs += [(3, items[3][1])]
    want = brute_matches(docs, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, SCHEMA), bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in got} == want
    assert len(got) == len(want) > 10
    assert decontaminate.benchmark_matches(empty, bench).count() == 0
    assert decontaminate.benchmark_matches(spark.createDataFrame(docs, SCHEMA), bench.limit(0)).count() == 0
    left = decontaminate.decontaminate(spark.createDataFrame(docs, SCHEMA), bench)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_decontamination_finds_items_by_blocks_alone(spark, monkeypatch):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    clashing = spark.createDataFrame([(1, text, 7, "a"), (2, "x " + text, 8, None), (None, text, 9, "")], "doc_id long, text string, item long, fp string").withColumns({"length": F.lit("l"), "th": F.lit(1), "k": F.lit(2)})
    bench = spark.createDataFrame([(5, text, "q"), (5, text, "q"), (None, text, "r")], "item_id long, text string, doc_id string")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.benchmark_matches(clashing, bench).collect())
    assert got == Counter([(d, i) for d in (1, 2, None) for i in (5, None)])
    assert decontaminate.decontaminate(clashing, bench).columns == clashing.columns
    monkeypatch.setattr(decontaminate, "_masks", lambda radius: [-1])
    assert decontaminate.benchmark_matches(clashing, bench).count() == 0


def test_decontamination_radius_loses_nothing_that_is_similar_enough(spark):
    """Against the exact similarity alone: within 64 bits, everything meets."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    get = lambda radius: sorted(decontaminate.benchmark_matches(docs, bench, radius=radius).collect())
    assert get(decontaminate.RADIUS) == get(64) != []


# Toxicity


def test_toxicity_held_out(spark, empty):
    rng = random.Random(10)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(600):
        w = rng.choices(words, k=rng.randrange(5, 60))
        if i % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "awful", "nasty"]))
        rows.append((i, " ".join(w), "en" if i % 3 else None, int(i % 4 == 0)))
    rows += [(9000, None, None, 0), (9001, "", "en", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit_toxicity(frame, frame.filter("doc_id % 3 <> 0").select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame.withColumnRenamed("toxic", "score"), model).collect()}
    held = [r for r in rows if r[0] % 3 == 0 and r[0] < 9000]
    assert sum(got[r[0]]["predicted"] == r[3] for r in held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values()) and len(got) == len(rows)
    assert toxicity.score_toxicity(empty, model).count() == 0
    blank = toxicity.fit_toxicity(frame, frame.limit(0).select("doc_id", "toxic"))
    assert toxicity.score_toxicity(frame, blank).count() == len(rows)


@pytest.mark.parametrize("part_rows", [2000, 20_000])
def test_toxicity_learns_from_every_label(spark, part_rows):
    rows = [(i, "vile talk" if i % 13 == 0 else "same", "en", int(i % 13 == 0)) for i in range(5200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    one, two = (toxicity.fit_toxicity(f, f.select("doc_id", "toxic"), part_rows=part_rows) for f in (frame, frame.orderBy(F.desc("doc_id")).repartition(7)))
    trained = frame.filter((F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) != 0) & (F.col("toxic") == 0)).count()
    share = np.exp(one.lang_logs[toxicity.buckets_of("same")[0] % toxicity.LANG_BUCKETS, 0] - one.lang_logs.min())
    assert round(share * 0.1 - 0.1) == trained > 3700
    assert (one.embed == two.embed).all() and one.thresholds == two.thresholds and (one.out == two.out).all()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in toxicity.score_toxicity(spark.createDataFrame([(0, "same"), (1, "so vile")], SCHEMA), one).collect())


# Repeats


def brute_repeats(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out[d] = (len(data), sum(gone), runs, sha(bytes(x for x, g in zip(data, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("options", [{}, {"collection": 5}, {"hot_places": 1, "sample": 1}, {"gram": 20, "collection": 300}, {"hot_places": 20, "sample": 1, "crowded": 2}])
def test_repeats(spark, options):
    rng = random.Random(11)
    base = ["".join(rng.choices("abé \n", k=rng.randrange(260))) for _ in range(15)]
    rows = [(i, "".join(rng.choice(base)[: rng.randrange(1, 260)] if rng.random() < 0.7 else "".join(rng.choices("xyz", k=20)) for _ in range(3))) for i in range(50)]
    rows += [(100, "ab" * 300), (101, "a" * 400), (102, None), (103, "")]
    got = repeats.repeats_digest(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA), **options)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_repeats(rows, 100) and len(got) == len(rows)


def test_repeats_of_repeated_ids(spark, empty):
    text = "".join(random.Random(12).choices("abcdef", k=300))
    once = "".join(random.Random(14).choices("abcdef", k=500))
    rows = [(5, text), (5, text), (None, text), (None, "short"), (6, text[:150]), (7, once), (7, once), (8, once[:200] + text[:99])]
    got = Counter((r["doc_id"], r["n_removed"]) for r in repeats.repeats_digest(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA))).collect())
    assert got == Counter([(None, 0), (None, 0), (5, 300), (5, 300), (6, 150), (7, 0), (7, 0), (8, 200)])
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_with_text_ids_and_clashing_columns(spark):
    text = "".join(random.Random(15).choices("abcdef", k=240))
    rows = [("b", text, 1, "x"), ("a", "zz" + text, 2, None), (None, text[:130], 3, "gram"), ("", "", 4, "")]
    clashing = spark.createDataFrame(rows, "doc_id string, text string, span long, gram string").withColumn("id", F.lit(0)).withColumn("tie", F.lit(None))
    got = {r["doc_id"]: r["n_removed"] for r in repeats.repeats_digest(repeats.remove_repeats(clashing)).collect()}
    assert got == {None: 0, "": 0, "a": 130, "b": 240}


@pytest.mark.parametrize("block", [7, 64, 1 << 18])
def test_suffixes_are_sorted_with_common_prefixes(tmp_path, block):
    rng = random.Random(13)
    texts = ["".join(rng.choices("ab", k=rng.randrange(1, 12))).encode() for _ in range(40)]
    lengths = np.array([len(t) for t in texts])
    padded = np.zeros((40, 12), np.uint16)
    for i, t in enumerate(texts):
        padded[i, : len(t)] = np.frombuffer(t, np.uint8)
    with repeats.Transform(str(tmp_path), block) as transform:
        repeats.sort_suffixes(transform, padded, lengths)
        rows = [x for symbol, common, label in transform.blocks() for x in zip(symbol.tolist(), common.tolist(), *(y.tolist() for y in repeats.labels(label)), strict=True)]
    expected = sorted((t[a:], i) for i, t in enumerate(texts) for a in range(len(t) + 1))
    assert [(texts[r][lengths[r] - n :], r) for _, _, r, n in rows] == expected
    assert [s for s, *_ in rows] == [0 if n == lengths[r] else texts[r][lengths[r] - n - 1] for _, _, r, n in rows]
    same = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert [c for _, c, *_ in rows] == [0] + [same(a[0], b[0]) for a, b in zip(expected, expected[1:], strict=False)]
