"""Near-duplicate vectors against brute force; page extraction against known articles."""

import html
import math
import re

import numpy as np
import pytest

from geoweave.llm import embeddings, htmltext as ht
from geoweave.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = {}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, x) in enumerate(good):
        for m, (j, y) in enumerate(good):
            if k != m and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[k] = links.get(k, 0) + 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    at = {}
    for k, (i, _) in enumerate(good):
        at.setdefault(i, []).append(links.get(k, 0))
    return {i: (max(at.get(i, [0])), find(i)) for i, _ in rows}


def clusters(seed, n, dims, sizes, noise):
    r = np.random.default_rng(seed)
    x = [r.normal(size=dims) for _ in range(n)]
    for s in sizes:
        c = r.normal(size=dims)
        x += [c + noise * r.normal(size=dims) for _ in range(s)]
    return [(i, [float(np.float32(a)) for a in v]) for i, v in zip(r.permutation(len(x)).tolist(), x)]


@pytest.mark.parametrize("noise", [0.02, 0.17])
def test_equals_brute_force(spark, noise):
    rows = clusters(1, 500, 24, [2] * 20 + [5, 9, 40, 130], noise)
    report = {}
    out = embeddings.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), count_block=32, report=report).collect()
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert len(out) == len(rows) and report["recall"] >= 0.9
    if noise < 0.1:
        assert got == want
    else:  # links around the threshold: none false, nearly all found
        assert all(got[i][0] <= want[i][0] for i in got)
        assert sum(g for g, _ in got.values()) >= 0.97 * sum(w for w, _ in want.values())


def _tight_groups(sizes, dims=32, between=0.965):
    """Groups whose centres are at cosine ``between``, every pair across them a link too."""
    r = np.random.default_rng(5)
    u, v = np.linalg.qr(r.normal(size=(dims, 2)))[0].T
    centres = [u, between * u + math.sqrt(1 - between * between) * v]
    x = [c + 0.005 * r.normal(size=dims) for c, size in zip(centres, sizes) for _ in range(size)]
    return [(i, [float(np.float32(a)) for a in w]) for i, w in enumerate(x)]


def test_links_between_large_tight_groups(spark):
    rows = _tight_groups([300, 300])
    out = embeddings.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), audit_rows=0).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(599, 0)} and sum(r.kept for r in out) == 1


def test_recall_is_a_mean_over_vectors_and_a_low_one_is_an_error(spark, monkeypatch):
    clique = [(a, b) for a in range(20) for b in range(20) if a != b]
    truth = spark.createDataFrame(clique + [(30, 31), (32, 33)], "a long, b long")
    labels = spark.createDataFrame([(i, 0) for i in range(20)] + [(i, i) for i in range(30, 34)], "rep long, component long")
    assert embeddings._recall(truth, labels, 8) == 0.0  # 380 of 382 links found, but none of the vectors with one
    monkeypatch.setattr(embeddings, "_recall", lambda *_: 0.5)
    with pytest.raises(RuntimeError, match="recall"):
        embeddings.near_duplicates(spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.01], 1)], SCHEMA), rounds=1)


def test_tables_keep_the_chance_of_meeting():
    for bits in (1, 4, 13, 15, 24):
        assert (1 - (1 - math.acos(0.95) / math.pi) ** bits) ** embeddings._tables(bits, 0.95, 4) <= 0.01


def test_unusable_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, []), (9, [1.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (12, [1.0, 0.0]), (13, [1e-30, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows] + [(None, [1.0, 0.0], 0)], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert embeddings.near_duplicates(df).count() == 15
    assert got[1] == (4, 1, True) and got[2] == (4, 1, False) and got[12] == (4, 1, False) and got[13] == (4, 1, False)
    assert got[10] == (1, 10, True) and got[11] == (1, 10, False)
    for i in (3, 4, 5, 6, 7, 8, 9):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, True)
    assert embeddings.near_duplicates(df.where("false")).collect() == []


def _article(h):
    """The text of the <article> of the given pages, by hand."""
    a = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", h, re.S)[1])
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in re.split(r"</?(?:p|h1)>", a)]
    return "\n\n".join(p for p in parts if p)


def test_given_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = QUERIES["op10_boosted_html_text"](spark, sf).collect()
    assert len(out) == len(pages) and all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in out)
    assert sum(r.text == _article(pages[r.page_id].html) for r in out) >= 0.99 * len(out)


@pytest.fixture(scope="module")
def model():
    return ht.fit([])


def test_held_out_templates(model):
    compose = ht._composer("some plain words that make up a page of text for this test".split(), np.random.default_rng(77))
    pages = [ht.parse(compose()) for _ in range(150)]
    x, rows = ht.features(pages)
    right = wrong = 0
    for p, kept in zip(pages, ht.decode(pages, model.margin(x), rows)):
        chars, main = np.array([s[0] for s in p.stats]), np.array(p.truth) == 1
        right += (chars * (main == kept)).sum()
        wrong += (chars * (main != kept)).sum()
        assert all(kept[p.parent[i]] for i in np.flatnonzero(kept) if i)  # no kept element below a dropped one
    assert right / (right + wrong) > 0.93


LONG = "Sentence one of the text is here, and it goes on. Another one follows it. " * 4
BOX = "<div class='cookie-notice'><p>We use cookies. Accept them all.</p></div><nav><a href=1>Home</a> <a href=2>News</a></nav>"


def test_parsing_rules(model):
    page = (f"{BOX}<article><h1>A &amp; B&copy; title</h1><p>{LONG}<p>Second&nbsp;&#233;&#x1F642;\n  part <b>bold<br>x</b> y &am"
            f"<ul><li>one {LONG}<li>two {LONG}</ul><!-- <p>no</p> --><script>var a = '<p>no</p>';</script><style>p {{}}</style></article>"
            f"<footer><p>&copy; 2020 Site. <a href=3>Imprint</a></p></footer></body></html>")
    want = ["A & B© title", LONG.strip(), "Second é🙂 part boldx y &am".replace("boldx", "bold x"), f"one {LONG}".strip(), f"two {LONG}".strip()]
    assert ht.extract_pages([page], model) == ["\n\n".join(want)]


def _all_text(source):
    page = ht.parse(source)
    return ht.blocks(page, np.ones(len(page.tag), bool))


@pytest.mark.parametrize("tag", ["button", "svg", "noscript", "object", "canvas", "select", "video", "template"])
def test_unclosed_and_nested_hidden_elements(tag):
    for page in (f"<{tag}>x<article><p>Main text</p></article>", f"<article><{tag}><p>Main text</p></article><p>More</p>",
                 f"<nav><{tag}>x</nav><p>Main text</p><{tag}>y</{tag}>", f"<p>a<{tag}><{tag}/></{tag}></p><p>Main text</p>",
                 f"<{tag}><script>'</{tag}>'</script>x</{tag}><p>Main text</p>"):
        assert "Main text" in _all_text(page)
    assert _all_text(f"<div>a <{tag}>x <{tag}>y</{tag}><p>z</p></{tag}>b</div>") == "a b"
    assert _all_text("<p>So <math><mi>x</mi> = 1</math> holds</p>") == "So x = 1 holds"


@pytest.mark.parametrize("source", [
    "<svg>" * 100_000 + "</svg>", "<svg><button>" * 50_000 + "</svg></button>", "<div><svg>" * 50_000 + "</div>" * 50_000,
    "<div>" * 30_000 + "<svg>" * 30_000 + "</div>" * 30_000 + "</svg>", "<div>" * 50_000 + "</p>" * 50_000,
    "<span>" * 50_000 + "</b>" * 50_000, "<li><span>" * 50_000], ids=["svg", "two", "nested", "closed", "blocks", "stray", "items"])
def test_hostile_pages_take_linear_time(source):
    import time
    start = time.process_time()
    ht.parse(source)
    assert time.process_time() - start < 10  # quadratic parsing takes minutes


def test_odd_pages(spark, model):
    sources = ["", None, "   ", "plain text,  no\nmarkup &lt;x&gt;", "<p>unclosed <b>markup", "<<>< <p>", "<div" * 50, "<p>" + "a " * 200_000 + "</p>",
               "<html><body></body></html>", "</p></div>", "<script>only()</script>", "<p class='x", "<![CDATA[ data ]]>", "<div>" * 3000 + "deep"]
    out = ht.extract_pages(sources, model)
    assert out[:3] == ["", "", ""] and out[3] == "plain text, no markup <x>" and out[8] == out[10] == "" and all(isinstance(t, str) for t in out)
    df = spark.createDataFrame([(i, "u", s, "clash") for i, s in enumerate(sources)] + [(None, None, None, None), (0, "u", "", "x")],
                               "page_id long, url string, html string, text string")
    got = ht.extract(df, model).collect()
    assert len(got) == len(sources) + 2 and {r.page_id: r.text for r in got}[3] == out[3]
    assert ht.extract(df.where("false"), model).collect() == []
    assert ht.train(df.where("false")).margin(ht.features([ht.parse("<p>x</p>")])[0]).shape == (1 + 2,)
