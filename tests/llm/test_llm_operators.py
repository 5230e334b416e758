"""The training-data operators against plain versions, and their defined edge cases."""

import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm import bpe, components, cover_tree, exact_dedup, html_text, licenses, mixing, near_dedup, quality, sharding, shingles, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, size string, text2 string"


def docs_of(spark, rows):
    """Rows (id, text[, source]) with extra columns whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS)


def words_of(seed, n):
    rnd = random.Random(seed)
    return [rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda my ny xi omikron pi rho sigma".split()) + str(rnd.randrange(99)) for _ in range(n)]


EDGES = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "ONE  "), (None, "two words"), (7, "two words"), (8, "x " * 30000), (9, "é ü 日本")]


# --- shared parts ---------------------------------------------------------------------------------------------------


def test_components_against_plain_union(spark):
    rnd = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(7, 7)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_whole_and_per_text():
    import pyarrow as pa

    texts = ["a b c d e f", None, "A  B\tC d E F", "e f", "", "a b c d e", "e f "]
    sets = dict(shingles.shingle_sets(pa.array(texts)))
    assert [len(sets[i]) for i in range(7)] == [2, 0, 2, 1, 0, 1, 1]
    assert np.array_equal(sets[0], sets[2]) and np.array_equal(sets[3], sets[6]) and sets[5][0] in sets[0]
    assert sets[3][0] not in sets[0]


# --- op1 ------------------------------------------------------------------------------------------------------------


def test_cover_tree_links_are_exact(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(60, 8))
    x = np.concatenate([base, base[:20] + 0.15 * rnd.normal(size=(20, 8)), base[:1] + 0.05 * rnd.normal(size=(40, 8)), base[:3], base[3:4] * 2.5])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 8), (902, [1.0, None] + [0.0] * 6), (903, [float("nan")] + [1.0] * 7), (904, [float("inf")] + [1.0] * 7), (905, [1.0, 2.0]), (906, [1.0, 2.0]), (None, rows[0][1]), (907, [])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), block=30).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[link[i]].min() for i in range(len(x))])
    for i in range(len(x)):
        assert got[i] == (int(link[i].sum()) - 1, int(label[i]), bool(label[i] == i)), i
    for i in (900, 901, 902, 903, 904, 907):
        assert got[i] == (0, i, True)
    assert got[905] == (1, 905, True) and got[906] == (1, 905, False) and got[None][:2] == (0, None)
    assert cover_tree.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_cover_tree_of_an_id_with_several_vectors(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (3, [0.01, 1.0, 0.0]), (8, [1.0, 0.01, 0.0]), (9, [0.0, 0.01, 1.0]), (5, [0.0, 0.0, 1.0])]
    got = cover_tree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 5, True), (5, 1, 5, True), (8, 1, 5, False), (9, 1, 5, False)]


def test_cover_tree_levels_cover():
    x = np.random.default_rng(1).normal(size=(500, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    path = cover_tree.build(x)
    for level in range(path.shape[1]):
        far = np.linalg.norm(x - x[path[:, level]], axis=1)
        assert (far <= 2.0**-level + 1e-9).all()
        if level:  # nested: points with one centre had one centre before
            assert len(np.unique(path[:, level])) == len(np.unique(path[:, level - 1 : level + 1], axis=0))


def test_cover_tree_prunes_blocks_of_clusters(spark):
    rnd = np.random.default_rng(9)
    centres = rnd.normal(size=(24, 16))
    x = np.concatenate([c / np.linalg.norm(c) + 0.04 * rnd.normal(size=(50, 16)) for c in centres])
    rows = [(i, [float(v) for v in r], "a", 0.5) for i, r in enumerate(x)] + [(7, [float(v) for v in x[7]], "b", 0.1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string, block double")
    met = []
    pairs = cover_tree.block_pairs
    cover_tree.block_pairs = lambda nodes, pivots, cosine: met.append((nodes.select("block").distinct().count(), (out := pairs(nodes, pivots, cosine)).count())) or out
    try:
        got = {r.vec_id: r for r in cover_tree.near_vectors(vectors, block=50).collect()}
    finally:
        cover_tree.block_pairs = pairs
    blocks, near = met[0]
    assert blocks == 24 and near < blocks * (blocks + 1) / 2 / 2  # more than half of the pairs of blocks never meet
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.95
    n = link.sum(axis=1) - 1 + link[:, 7]  # the row that repeats id 7 links with what 7 links with
    assert {i: got[i].n_links for i in got} == dict(enumerate(n.tolist()))


def test_cover_tree_vectors_travel_once_for_each_run(spark, monkeypatch):
    rnd = np.random.default_rng(12)
    x = rnd.normal(size=(400, 40))
    x = np.concatenate([x, x[:60] + 0.12 * rnd.normal(size=(60, 40)), x[:1] + 0.1 * rnd.normal(size=(40, 40))])
    travelled, paired = spark.sparkContext.accumulator(0), cover_tree._paired

    def counted(*args):
        pair = paired(*args)

        def run(rows):
            travelled.add(len(rows))
            return pair(rows)

        return run

    monkeypatch.setattr(cover_tree, "_paired", counted)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=20).collect()}
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    link = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[row].min() for row in link])
    assert got == {i: (int(link[i].sum()) - 1, int(label[i])) for i in range(len(x))}
    assert travelled.value <= 8 * len(x)  # 25 blocks: a vector that travels once for each block it meets makes 26


@pytest.mark.parametrize("dim", [3, 20, 64])
def test_cover_tree_shadows_lose_no_link(dim):
    rnd = np.random.default_rng(dim)
    base = rnd.normal(size=(900, dim)) * np.linspace(2, 0.2, dim) + 0.3
    x = np.concatenate([base, base[:300] + 0.1 * rnd.normal(size=(300, dim)), base[:1] + 0.15 * rnd.normal(size=(200, dim)) * rnd.random((200, 1))])[rnd.permutation(1400)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    axes = cover_tree._axes(x, 0.95)
    assert (np.linalg.norm(cover_tree._shadow(x[:700], axes) - cover_tree._shadow(x[700:], axes), axis=1) <= np.linalg.norm(x[:700] - x[700:], axis=1) + 1e-6).all()
    links = cover_tree._Links(np.ones(1400, np.int64))
    a, b = (cover_tree._Tree(x[s], cover_tree.build(x[s]), axes, 0.95, s.start) for s in (slice(0, 700), slice(700, 1400)))
    for first, second in ((a, a), (a, b), (b, b)):
        cover_tree.traverse(first, second, links, 0.95)
    assert np.array_equal(links.n, (x @ x.T >= 0.95).sum(axis=1) - 1)


def test_cover_tree_opens_past_a_level_that_groups_by_chance():
    x = np.random.default_rng(2).normal(size=(1500, 64)) + 0.5  # cosines near 0.2: some centres hold points, at nearly the whole radius
    x /= np.linalg.norm(x, axis=1)[:, None]
    path = cover_tree.build(x)
    tree = cover_tree._Tree(x, path, cover_tree._axes(x, 0.95), 0.95)
    assert len(np.unique(path[:, 0])) < len(x) and tree.top > 0


# --- op2 ------------------------------------------------------------------------------------------------------------


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(11)
    spans = [(32, 127), (0xA0, 0x250), (0x370, 0x400), (0x4E00, 0x4F00), (0x1F600, 0x1F640), (9, 33)]
    texts = ["", " ", "Hello world's I'LL 123", "<|startoftext|>hi<|endoftext|> a<|endoftext|>b <|startof", "aaaaaaa bbbbbbbbb aaaa", "ΑΣ ΣΑΣ.", "a\x1cb"]
    texts += ["".join(chr(rnd.randrange(*rnd.choice(spans))) for _ in range(rnd.randrange(60))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1000, None)]
    library = Tokenizer.from_file(bpe.default_path())
    docs = docs_of(spark, rows)
    out = {r.doc_id: r for r in bpe.digests(docs, with_ids=True).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        r = out[i]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    encoded = bpe.encode(docs)
    back = {r.doc_id: r.text for r in bpe.decode(encoded).collect()}
    assert back[3] == library.decode(out[3].ids, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0)).count() == 0


# --- op3 ------------------------------------------------------------------------------------------------------------


def plain_groups(rows, least):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("least", [80, 85])
def test_near_groups_are_exact(spark, least):
    rnd = random.Random(least)
    rows = [(i, " ".join(words_of(i, 80))) for i in range(25)]
    base = words_of(1, 80)
    for i in range(100, 170):  # one group of many near copies, at various distances
        w = list(base)
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(80)] = "changed%d" % rnd.randrange(5)
        rows.append((i, "  ".join(w).upper() if i % 2 else " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t"), (203, "one two"), (204, "ONE two"), (205, "a b c d e"), (206, "a b c d e f"), (207, "z " * 20000)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs_of(spark, rows), least).collect()}
    assert got == plain_groups(rows, least)


def test_dedups_decide_by_row(spark):
    other, text = " ".join(words_of(1, 60)), " ".join(words_of(2, 60))
    copy = [(1, text), (5, text), (5, other), (None, text), (None, other)]
    assert sorted(str(r.doc_id) + r.text[:9] for r in exact_dedup.dedup_exact(docs_of(spark, copy)).collect()) == sorted(
        str(i) + t[:9] for i, t in copy if (i, t) != (5, text)
    )
    near = [(1, text), (5, text + " more"), (5, ""), (None, text), (None, other)]
    assert sorted(str(r.doc_id) + r.text[:9] for r in near_dedup.dedup_near(docs_of(spark, near)).collect()) == sorted(
        str(i) + t[:9] for i, t in near if (i, t) != (5, text + " more")
    )


def test_near_groups_of_an_id_with_several_texts(spark):
    a, b, c = words_of(1, 60), words_of(2, 90), words_of(3, 60)
    rows = [(5, a), (5, b), (5, c), (3, [*b, "more"]), (8, [*c, "more"]), (9, [*a, "more"]), (None, b)]
    got = near_dedup.near_groups(docs_of(spark, [(i, " ".join(w)) for i, w in rows]), 80).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == [(0, 86, 3), (3, 87, 3), (5, 56, 5), (5, 56, 5), (5, 86, 3), (8, 57, 5), (9, 57, 5)]
    texts = [(1, a), (5, [*a, "more"]), (5, b), (None, a), (None, b)]
    kept = near_dedup.dedup_near(docs_of(spark, [(i, " ".join(w)) for i, w in texts])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((i or 0, " ".join(w)) for i, w in texts if w != [*a, "more"])


def test_near_groups_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    base = words_of(4, 60)
    rows = [(i, " ".join(w if (k * 31 + i) % 29 else f"n{i}" for k, w in enumerate(base))) for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs_of(spark, rows), 40).collect()}
    assert got == plain_groups(rows, 40)
    odd = near_dedup.near_groups(docs_of(spark, EDGES)).collect()
    assert len(odd) == len(EDGES) and sum(r.doc_id == 5 and r.component_id == 4 for r in odd) == 2
    assert near_dedup.near_groups(docs_of(spark, [])).count() == 0


def test_super_minhash_estimates_and_permutes():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 2**63, 400).astype(np.uint64)
    a, b = x[:300], x[60:360]
    s = near_dedup.super_minhash(np.concatenate([a, b]), np.array([300, 300]))
    assert abs((s[0] == s[1]).mean() - 240 / 360) < 0.15
    one = near_dedup.super_minhash(x[:1], np.array([1]))[0]
    assert sorted((one >> np.uint32(24)).tolist()) == list(range(near_dedup.REGISTERS))  # every rank once


# --- op4 ------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav>
<div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>First   part.<br><p>Second 1 < 2 &copy;&nbsp;x</p><div class="comments"><p>me too</p></div></article>
<footer>&copy; them</footer></body></html>"""


def test_main_text_of_pages(spark):
    assert html_text.main_text(PAGE) == "Head & line\nFirst part.\nSecond 1 < 2 © x"
    no_article = """<body><div id="cookie-bar">We use cookies</div><div class="wrap"><h2>Title</h2><p>A first paragraph that is long enough.</p>
      <p>And the <a href="x">second</a> one, long enough too.</p><ul><li>one<li>two</ul></div><div class="sidebar"><a href=1>l</a> <a href=2>m</a></div>
      <section id="comments"><article><p>Great!</p></article></section><form><button>Go</button></form></body>"""
    assert html_text.main_text(no_article) == "Title\nA first paragraph that is long enough.\nAnd the second one, long enough too.\none\ntwo"
    assert [html_text.main_text(h) for h in (None, "", "<p>", "<script>x</script>", "plain", "<p>a<p>b", "<b", "<!-- x")] == ["", "", "", "", "plain", "a\nb", "<b", ""]
    long_comments = "<p>A comment that goes on and on, as reader comments do at times.</p>" * 30
    page = f"""<body class="has-sidebar"><div class="page menu-open content-with-sidebar"><header><h1>Site</h1></header><article class="post no-comments">
      <div class="post-header"><h1>Title</h1></div><p>The story is short but it is the story.</p><div class="cookie-notice">We use cookies</div>
      <div class="share-links">Share</div></article><div class="page-sidebar"><p>Other things that are not the story at all.</p></div>
      <section class="reader-comments">{long_comments}</section></div></body>"""
    assert html_text.main_text(page) == "Title\nThe story is short but it is the story."
    deep = "<div>" * 50000 + "deep" + "</div>" * 50000
    assert html_text.main_text(deep) == "deep"
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, "v", None, "x"), (2, "v", None, "x")], "page_id long, url string, html string, n_chars string")
    out = sorted((r.page_id, r.url, r.n_chars) for r in html_text.extract(pages).collect())
    assert out == [(1, "u", 40), (2, "v", 0), (2, "v", 0)]


def test_main_text_of_sibling_articles():
    articles = ["".join(f"<p>{chr(97 + k)}{i} {'word ' * 79}</p>" for i in range(n)) for k, n in enumerate((8, 6))]
    page = "<body><div><h1>Head</h1><p>By them</p></div>" + "".join(f"<article>{a}</article>" for a in articles) + "</body>"
    assert [line.split()[0] for line in html_text.main_text(page).split("\n")] == [f"a{i}" for i in range(8)] + [f"b{i}" for i in range(6)]


P = "The committee met on Tuesday to discuss the plans for the new bridge, which has been delayed for years by a lack of funds."
Q = "Residents of both banks said that they were tired of waiting, and that the ferry no longer meets the needs of the town."
STORY, TEXT = f"<h1>Title</h1><p>{P}</p><p>{Q}</p><p>{P}</p><p>{Q}</p>", "\n".join(["Title", P, Q, P, Q])
FOOT = "Copyright 2024 The Daily Example. All rights reserved."
LINKS = "<li><a href=1>One thing</a></li><li><a href=2>Another thing</a></li>"
PAGES = {
    "plain boxes": (f"<div><div>The Daily</div><div><a href=a>Home</a></div></div><div>{STORY}</div><div><h3>Most read</h3><ul>{LINKS}</ul></div><div>{FOOT}</div>", TEXT),
    "hashed classes": (f"<div class=a1><a href=a>Home</a></div><div class=b2><div class=c3>{STORY}</div><div class=d4><div>Most read</div><div>{LINKS}</div></div></div><div class=z9><p>{FOOT}</p></div>", TEXT),
    "table": (f"<table><tr><td colspan=2><a href=a>Home</a> | <a href=b>News</a></td></tr><tr><td>{STORY}</td><td><b>Most read</b><br><a href=1>One</a></td></tr><tr><td>{FOOT}</td></tr></table>", TEXT),
    "flat": (f"{STORY}<div>{FOOT}</div>", TEXT),
    "flat, footer as text": (f"{STORY}<p>{FOOT}</p>", TEXT),
    "comments": (f"<div>{STORY}</div><div>" + "".join(f"<div><b>Reader {i}</b><p>{Q}</p></div>" for i in range(12)) + "</div>", TEXT),
    "comments without a heading": (f"<div><p>{P}</p><p>{Q}</p></div><div>" + "".join(f"<div><b>Reader {i}</b><p>{Q}</p></div>" for i in range(9)) + "</div>", f"{P}\n{Q}"),
    "comments beside an article": (f"<article><p>{P}</p><p>{Q}</p></article><div>" + f"<p>{Q}</p>" * 12 + "</div>", f"{P}\n{Q}"),
    "comments in an article": (f"<article>{STORY}" + f"<article><p>{P}</p></article>" * 9 + "</article>", TEXT),
    "an article's class": (f"<article class=post-share>{STORY}</article>", TEXT),
    "two articles in main": (f"<main><article>{STORY}</article><article>{STORY}</article></main>", f"{TEXT}\n{TEXT}"),
    "a notice that is text": (f"<article>{STORY}<div class=legal-notice><p>{P}</p></div></article>", f"{TEXT}\n{P}"),
    "names that begin with a word": (f"<div>{STORY}<div class=share-price><p>{P}</p></div><div class=social-history>{Q}</div><div id=comment-free><p>{P}</p></div></div>", f"{TEXT}\n{P}\n{Q}\n{P}"),
    "many short lines": (f"<div><p>{P}</p><p>{Q}</p><p>{P}</p></div><div>" + "<p>Most read now</p>" * 12 + "</div>", f"{P}\n{Q}\n{P}"),
    "lines before a text": ("<div>" + "<p>Short</p>" * 9 + f"</div><table><tr><td><p>{P}</p><p>{Q}</p></td></tr></table>", f"{P}\n{Q}"),
    "a name that cannot be right": (f"<div class=sidebar>{STORY}</div><div>Short</div>", TEXT),
}


@pytest.mark.parametrize("kind", PAGES)
def test_main_text_by_density(kind):
    html, text = PAGES[kind]
    assert html_text.main_text(f"<html><body>{html}</body></html>") == text


def test_density_decides(monkeypatch):
    monkeypatch.setattr(html_text, "ctd", lambda c, t, lc, lt, share: float(c > 0))
    wrong = [k for k, (html, text) in PAGES.items() if html_text.main_text(f"<body>{html}</body>") != text]
    assert {"many short lines", "lines before a text"} <= set(wrong)


def test_densities_are_the_formula():
    page = html_text._Page("<body><div><p>abcde <a href=x>fgh</a></p><p>ijklmnopqrst</p></div><nav><a>uvw</a></nav></body>")
    d = html_text._Densities(page, page._below(lambda k: page.sign[k] == html_text.OUT))
    at = {tag: k for k, tag in enumerate(page.tag)}

    def formula(c, t, lc, lt):  # the page has 23 characters, 6 of them links
        base = math.log(c / max(c - lc, 1) * lc + 6 / 23 * c + math.e**2)
        return c / t * math.log(c / max(lc, 1) * t / max(lt, 1), base)

    first, second = (k for k, tag in enumerate(page.tag) if tag == "p")
    assert [d.chars[k] for k in (at["div"], first, second, at["nav"])] == [20, 8, 12, 0]
    assert d.density[second] == pytest.approx(formula(12, 1, 0, 0)) and d.density[first] == pytest.approx(formula(8, 1, 3, 1))
    assert d.density[at["div"]] == pytest.approx(formula(20, 3, 3, 1)) and d.density[at["nav"]] == 0
    assert d.total[at["div"]] == pytest.approx(d.density[first] + d.density[second]) and d.total[at["body"]] == pytest.approx(d.density[at["div"]])
    assert d.top[0] == at["div"]


def test_main_text_of_no_pages(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- op5 ------------------------------------------------------------------------------------------------------------


def plain_jump(key, shards):
    key &= 2**64 - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_shards(spark):
    rows = [(i, "t" * (i % 5)) for i in range(3000)] + [(-7, "é"), (2**62, None), (None, "n"), (5, "ttttt"), (5, "ttttt")]
    out = sharding.shard(docs_of(spark, rows), 16).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["shard"] == plain_jump(r.doc_id or 0, 16) and r.grown_shard == plain_jump(r.doc_id or 0, 17)
        assert r.grown_shard in (r["shard"], 16) and r.law == "key"
    by_id = {r.doc_id: r for r in out}
    assert by_id[-7]["size"] == 3 and by_id[-7].text_crc32 == zlib.crc32("é".encode()) and by_id[2**62]["size"] == 1 and by_id[2**62].text_crc32 == 0
    for s in range(16):
        slots = sorted(r.slot for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(docs_of(spark, []), 16).count() == 0


# --- op6 ------------------------------------------------------------------------------------------------------------


def test_token_counts_are_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.read_vocabulary(token_counts.default_path())
    full = [("<unk>", -1.0)] + [(f"<0x{b:02X}>", -1.0) for b in range(256)] + vocabulary
    library = Tokenizer(models.Unigram(full, 0, True))
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
    rnd = random.Random(3)
    spans = [(32, 127), (0xA0, 0x250), (0x4E00, 0x6000), (0x1F600, 0x1F640)]
    texts = ["", "hello there world", "a\x1cb"] + ["".join(chr(rnd.randrange(*rnd.choice(spans))) for _ in range(rnd.randrange(50))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(999, None)]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs_of(spark, rows)).collect()}
    assert got == {i: len(library.encode(t or "").ids) for i, t in rows}


def test_whole_token_counts_are_the_library(spark, tmp_path):
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = token_counts.read_vocabulary(token_counts.default_path())
    full = [("<unk>", -1.0)] + [(f"<0x{b:02X}>", -1.0) for b in range(256)] + vocabulary
    library = Tokenizer(models.Unigram(full, 0, True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    rnd = random.Random(4)
    spans = [(32, 127), (9, 14), (32, 33), (0xA0, 0x250), (0x4E00, 0x6000), (0x2000, 0x2010), (0x2581, 0x2582)]
    texts = ["a\nb c d", "", " ", "\n", "  a  b   ", "\t\tif x:\r\n    y", "a\u3000b\x1cc", "x" + " " * 40 + "y"]
    texts += ["".join(chr(rnd.randrange(*rnd.choice(spans))) for _ in range(rnd.randrange(50))) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(50).collect()]
    counts = token_counts.load(token_counts.default_path(), True).texts(texts)[0].tolist()
    assert counts == [len(library.encode(t).ids) for t in texts]
    docs_of(spark, [(i, t) for i, t in enumerate(texts)] + [(999, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_tokens for r in token_counts.op6_token_counts(spark, str(tmp_path)).collect()} == dict(enumerate(counts)) | {999: 0}


def test_token_parts_suit_the_vocabulary():
    across = token_counts.Counter([("▁", -1.0), ("a", -1.0), ("a▁a", -1.0), ("\n\n", -0.5)], True)
    assert across.texts(["a a\n\n\ta"])[0].tolist() == [5]  # ▁, a▁a, two line feeds, a tab, a


def test_token_count_ties_take_the_longest_last_piece():
    counter = token_counts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abb", -3.0), ("bb", -2.0)])
    assert counter.count("ab") == (1, -2.0) and counter.count("abb") == (1, -3.0)
    assert counter.count("é") == (2, -13.0) and counter.count("") == (0, 0.0)


# --- op7 ------------------------------------------------------------------------------------------------------------


def test_license_scan(spark):
    mit = licenses.NOTICES[0][0]
    rows = [
        (1, "Under the MIT License, or the Mit-License. gnu general public license"),
        (2, mit.replace("charge", "any charge at all").upper()),
        (3, "mit  licenses; the gnu general license; cc\nby"),
        (4, None), (5, ""), (6, "word"), (7, "ümit license"), (None, "apache license"), (8, "cc by"), (8, "mit license"), (8, "mit license"),
    ]
    out = licenses.scan(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert (by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels, by[1].score) == (3, 2, 8, "gpl,mit", 1.0)
    assert (by[2].n_base, by[2].base_labels, by[2].labels) == (0, "", "mit") and 0.6 <= by[2].score < 1
    assert (by[3].n_base, by[3].base_labels, by[3].first_word) == (1, "cc-by", 6)
    assert (by[4].n_words, by[4].n_base, by[4].first_word, by[4].labels, by[4].score) == (0, 0, None, "", 0.0)
    assert by[6].n_words == 1 and by[7].n_base == 0 and by[None].base_labels == "apache"
    assert sorted(r.base_labels for r in out if r.doc_id == 8) == ["cc-by", "mit", "mit"]
    assert licenses.scan(docs_of(spark, [])).count() == 0


def test_license_spans_survive_what_stands_around(spark):
    rnd = random.Random(8)
    mit, isc = licenses.NOTICES[0][0], licenses.NOTICES[-1][0]
    rows = [(1, mit + " the software" * 40), (2, mit + " and the software" * 30), (3, "the software " * 40 + mit), (4, mit), (5, mit + " " + isc), (6, "the software " * 3000)]
    for k in range(10, 40):  # a notice with words put in and left out, between any words of notices
        words = [w for w in rnd.choice((mit, isc)).split() for w in ([w] if rnd.random() < 0.93 else rnd.choice(([], [w, "indeed"])))]
        noise = lambda: [rnd.choice((mit + " " + isc).split()) for _ in range(rnd.randrange(60))]
        rows.append((k, " ".join(noise() + words + noise())))
    templates = [(t.split(), label) for t, label in licenses.NOTICES]

    def plain(text):
        words, best, labels = text.split(), 0.0, set()
        for template, label in templates:
            grams, hits = len(template) - 1, set()
            for w in range(len(words) - 1):
                hits |= {(w - p, p) for p in range(grams) if words[w : w + 2] == template[p : p + 2]}
            for lo in {d for d, _ in hits}:
                share = len({p for d, p in hits if lo <= d <= lo + licenses.reach(grams)}) / grams
                best = max(best, share)
                labels |= {label} if share >= licenses.COVERAGE else set()
        return ",".join(sorted(labels)), best

    out = {r.doc_id: r for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert [out[i].labels for i in range(1, 7)] == ["mit", "mit", "mit", "mit", "isc,mit", ""] and out[1].score == 1.0
    for i, text in rows:
        labels, best = plain(text)
        assert out[i].labels == labels and out[i].score == pytest.approx(best)


# --- op8 ------------------------------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randrange(60), rnd.choice(["a"] * 30 + ["b"] * 5 + ["c", None])) for i in range(800)] + [(900, None, "empty"), (None, "x y", "a"), (7, "a b", "b")]
    out = mixing.allocate(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    sources = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        s = sources.setdefault(r.source, [0, 0, r.target])
        s[0] += r["size"]
        s[1] += r.taken
    total = sum(s[0] for s in sources.values())
    names = sorted([n for n in sources if n is not None]) + [None]
    weight = {n: 1 + k % 3 for k, n in enumerate(names)}
    open_, target, left = set(names), {}, total  # the excess reshared, round by round
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > 3 * sources[n][0]}
        for n in over or open_:
            target[n] = 3.0 * sources[n][0] if over else level * weight[n]
        if not over:
            break
        left -= sum(target[n] for n in over)
        open_ -= over
    for n in names:
        assert math.isclose(sources[n][2], target[n], rel_tol=1e-9, abs_tol=1e-6) and abs(sources[n][1] - target[n]) <= 1
    again = mixing.allocate(docs_of(spark, rows).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert mixing.allocate(docs_of(spark, [])).count() == 0


def test_schedule_is_the_ordered_stream(spark):
    rows = [(i, "w " * (i % 7), "abc"[min(2, i % 8)] if i % 11 else None) for i in range(300)] + [(None, "x y", "c"), (7, "w w", "b"), (7, "w w", "b")]
    docs = docs_of(spark, rows)
    got, plan = mixing.schedule(docs).collect(), mixing.allocate(docs)
    runs = sorted((r.position, r.doc_id, r["pass"], r.words) for r in mixing.stream(plan).filter("doc_id is not null and doc_id <> 7").collect())
    assert len(got) == len(rows) and sum(r.taken for r in got) == sum(r.taken for r in plan.collect())
    places = [r.first_place for r in got]
    taken = [p for p in places if p is not None]
    assert taken == sorted(taken) and places[len(taken) :] == [None] * (len(rows) - len(taken)) and taken[0] == 0
    by = {r.doc_id: r for r in got}
    for i in {r[1] for r in runs}:
        own = [r for r in runs if r[1] == i]
        assert by[i].taken == sum(r[3] for r in own) and by[i].first_position == own[0][0]
    for source, slope in (("a", -0.5), ("b", 0.0), ("c", 0.5)):  # by half of the time, a source has given the integral of its weight
        own = [r for r in mixing.stream(plan).filter(F.col("source") == source).collect()]
        assert abs(sum(r.words for r in own if r.position < 0.5) / own[0].target - ((1 - slope) / 2 + slope / 4)) < 0.05
    assert mixing.schedule(docs_of(spark, [])).count() == 0


def test_targets_of_many_sources(spark):
    sizes = [(f"s{i:04}", (i * 37) % 101) for i in range(1000)] + [(None, 50)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    names = [n for n, _ in sizes]
    left, open_, want = sum(n for _, n in sizes), set(names), {}
    weight, size = {n: 1 + k % 3 for k, n in enumerate(names)}, dict(sizes)
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > 3 * size[n]}
        want.update({n: 3.0 * size[n] if over else level * weight[n] for n in over or open_})
        if not over:
            break
        left, open_ = left - sum(want[n] for n in over), open_ - over
    assert got == pytest.approx(want)


def test_positions_invert_the_schedule(spark):
    grid = [(u / 10, s) for u in range(11) for s in (-0.5, 0.0, 0.5, 1.0)]
    for r in spark.createDataFrame(grid, "u double, s double").select("u", "s", mixing.position(F.col("u"), F.col("s")).alias("t")).collect():
        assert abs((1 - r.s) * r.t + r.s * r.t**2 - r.u) < 1e-9
    rows = [(i, "w " * 5, "ab"[i % 2]) for i in range(200)]
    mixed = mixing.mix(docs_of(spark, rows))
    assert mixed.columns == docs_of(spark, rows).columns and mixed.count() >= 200


def test_mix_takes_rows_not_ids(spark):
    rows = [(None, f"n{i} x y", "a") for i in range(30)] + [(7, "b b", "b")] * 20 + [(i, f"c{i} z", "c") for i in range(100, 130)] + [(None, "same", None)] * 4
    docs = docs_of(spark, rows)
    due = {}
    for r in mixing.stream(mixing.allocate(docs)).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).collect():
        due[r.source] = r["n"]
    mixed = mixing.mix(docs).collect()
    taken, texts = {}, {}
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + 1
        texts[r.text] = texts.get(r.text, 0) + 1
    assert taken == due
    copies = {"b b": 20, "same": 4}
    assert max(n / copies.get(t, 1) for t, n in texts.items()) <= 3
    again = mixing.allocate(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixing.allocate(docs).collect()))


# --- op9 ------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = quality.scores(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    tested = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    # held-out labels are not learnt from
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.scores(docs, flipped).collect()} == pytest.approx({r.doc_id: r.score for r in out})


def test_keep_good_decides_by_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    texts = {r.predicted: r.doc_id for r in quality.scores(docs, labels).collect()}
    bad, good = (docs.filter(F.col("doc_id") == texts[k]) for k in (0, 1))
    no_id, twice = F.lit(None).cast("long"), F.lit(10**12)
    rows = docs
    for id_ in (no_id, twice):
        for d in (bad, good):
            rows = rows.unionByName(d.withColumn("doc_id", id_))
    kept = quality.keep_good(rows, labels)
    assert kept.columns == docs.columns
    text = good.first().text
    assert [r.text for r in kept.filter("doc_id is null").collect()] == [text] and [r.text for r in kept.filter(f"doc_id = {10**12}").collect()] == [text]


def test_statistics_are_plain_counts(spark):
    import pyarrow as pa

    texts = ["", "One two TWO two two! 42 times; a|b\n\nstop. the the the", "é ü 日本 #hash", "x" * 30, "A\tB  C\n", None, "!!! ||| ..."]
    got = np.concatenate([quality.statistics(data, offsets) for _, _, data, offsets in shingles.runs(pa.array(texts))])
    share = lambda part, whole: math.asin(math.sqrt(min(1.0, max(0.0, part / max(whole, 1)))))
    for row, text in zip(got, texts, strict=True):
        raw = (text or "").encode()
        words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
        seen = [b for b in raw if b not in b" \t\n\x0b\x0c\r"]
        upper, lower = (sum(a <= b <= z for b in raw) for a, z in ((65, 90), (97, 122)))
        wide, digits = sum(b > 127 for b in raw), sum(48 <= b <= 57 for b in raw)
        shout, bar, stops = raw.count(b"!"), raw.count(b"|"), sum(b in b".,;:'\"?()-" for b in raw)
        sizes, low = [len(w) for w in words], [w.lower() for w in words]
        mean = sum(sizes) / max(len(sizes), 1)
        spread = math.sqrt(max(0.0, sum(n * n for n in sizes) / max(len(sizes), 1) - mean * mean))
        counts = [low.count(w) for w in set(low)]
        want = [
            math.log1p(len(words)), share(len(seen) - upper - lower - wide - digits - shout - bar - stops, len(seen)), share(upper, upper + lower), share(digits, len(seen)),
            share(shout, len(seen)), share(bar, len(seen)), share(wide, len(seen)), math.log1p(mean), math.log1p(spread),
            share(sum(a == b for a, b in zip(low, low[1:])), len(words)), share(len(counts), len(words)), share(max(counts, default=0) - 1, len(words)), share(stops, len(seen)),
            share(raw.count(b"\n"), len(words)),
        ]
        assert row.tolist() == pytest.approx(want, abs=1e-9), text


def test_scores_are_a_plain_discriminant(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    x = {r.id: np.array(r.x) for r in quality.measure(docs).collect()}
    y = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    groups = [np.array([x[i] for i in x if y.get(i) == k]) for k in (0, 1)]
    covs = [np.cov(g.T, bias=True) for g in groups]
    pooled = np.maximum(sum(len(g) * np.diag(c) for g, c in zip(groups, covs, strict=True)) / sum(map(len, groups)), 1e-6)

    def density(v, k):
        cov = (1 - quality.SHRINK) * covs[k] + quality.SHRINK * np.diag(pooled)
        diff = v - groups[k].mean(axis=0)
        return math.log(len(groups[k]) / sum(map(len, groups))) - 0.5 * (diff @ np.linalg.solve(cov, diff) + np.linalg.slogdet(cov)[1])

    for r in quality.scores(docs, labels).collect():
        gap = density(x[r.doc_id], 0) - density(x[r.doc_id], 1)
        assert r.score == pytest.approx(1 / (1 + math.exp(min(500, max(-500, gap)))), abs=1e-6)


def test_quality_edges(spark):
    docs = docs_of(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, quality int")
    assert {r.score for r in quality.scores(docs, one).collect()} == {1.0}
    assert quality.scores(docs_of(spark, []), one).count() == 0


def test_discriminant_is_the_gaussian_posterior():
    rnd = np.random.default_rng(2)
    d = len(quality.NAMES)
    x = [rnd.normal(size=(400, d)) @ rnd.normal(size=(d, d)) + k for k in (0, 1)]
    sums = {k: np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for k, v in enumerate(x)}
    model = quality.Discriminant.fit(sums, 0.2)
    pooled = np.mean([np.var(v, axis=0) for v in x], axis=0)
    density = []
    for v in x:
        cov = 0.8 * np.cov(v.T, bias=True) + 0.2 * np.diag(pooled)
        diff = x[0][:5] - v.mean(axis=0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x[0][:5]), 1 / (1 + np.exp(density[0] - density[1])))


# --- op10 -----------------------------------------------------------------------------------------------------------


def test_exact_dedup(spark):
    rows = EDGES + [(20, "a\t\nb"), (10, "a b"), (11, "a  b"), (12, "a b "), (13, "a b")]
    out = exact_dedup.resolve(docs_of(spark, rows), exact_dedup.fresh_index(spark)).collect()
    assert len(out) == len(rows)
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    for r in out:
        text, ids = next((t, g) for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        keep = min((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), r.doc_id == keep)
    assert exact_dedup.resolve(docs_of(spark, []), exact_dedup.fresh_index(spark)).count() == 0


def test_queries_leave_no_index(spark, tmp_path):
    docs_of(spark, [(1, "a"), (2, "a"), (3, "b")]).write.parquet(f"{tmp_path}/documents.parquet")
    before = {t.name for t in spark.catalog.listTables()}
    assert {r.doc_id: r.kept for r in exact_dedup.op10_exact_dedup(spark, str(tmp_path)).collect()} == {1: True, 2: False, 3: True}
    assert exact_dedup.dedup_exact(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 2
    assert {t.name for t in spark.catalog.listTables()} == before


def test_index_has_a_file_a_bucket(spark, tmp_path):
    at = f"file:{tmp_path}/index"
    index = exact_dedup.DigestIndex(spark, "digests_c", at, buckets=3)
    exact_dedup.resolve(docs_of(spark, [(i, f"t{i}") for i in range(200)]).repartition(5), index).count()
    assert len([p for p in (tmp_path / "index").iterdir() if p.name.startswith("part-")]) == 3
    index.drop()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from quillmill.llm import common

    def session(master, at):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: at), sparkContext=SimpleNamespace(master=master, applicationId="x-" + master))

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.shared_dir(session(master, ""))
        assert common.shared_dir(session(master, "hdfs://x/y/")) == "hdfs://x/y"
    path = common.saved(spark.range(3), "test")
    assert path.count() == 3
    common.drop(path)
    assert not common._located(spark, path._qm_path)[0].exists(common._located(spark, path._qm_path)[1])


def test_digest_index_persists(spark, tmp_path):
    at = f"file:{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, "digests_a", at, buckets=3)
    assert {r.doc_id: r.kept for r in exact_dedup.resolve(docs_of(spark, [(5, "x"), (6, "y")]), first).collect()} == {5: True, 6: True}
    spark.sql("DROP TABLE digests_a")  # an external table: the files stay
    again = exact_dedup.DigestIndex(spark, "digests_b", at, buckets=3)
    out = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.resolve(docs_of(spark, [(1, "x"), (2, "z"), (3, "z")]), again).collect()}
    assert out == {1: (5, False), 2: (2, True), 3: (2, False)}
    assert again.rows().count() == 3
    again.drop()


def test_hot_groups_are_attached_whole(spark):
    from quillmill.llm.common import attach

    rows = spark.range(5000).select((F.col("id") % 1500).alias("k0"), F.col("id").alias("v")).select(F.when(F.col("k0") < 1000, 0).otherwise(F.col("k0")).alias("k"), "v")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = attach(rows, groups, "k", "n", 5000, most_hot=10)
    assert out.count() == 5000 and out.filter("n is null").count() == 0 and out.agg(F.sum(F.when(F.col("k") == 0, 1))).first()[0] == groups.filter("k = 0").first().n


def test_oracles_are_sql():
    from quillmill.llm.queries import ORACLE_SQL, QUERIES

    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) == 10
    assert all(isinstance(sql, str) and "SELECT" in sql for sql in ORACLE_SQL.values())
