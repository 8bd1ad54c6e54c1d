"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded hierarchically.

A page is parsed into elements.  Every block element gets features of its
subtree (text density, links, tags, sentence marks), its attribute tokens, its
depth, its place among its siblings and its ancestors; boosted trees give the
probability that main text is inside.  Choices are made for the whole tree at
once: a kept element needs a kept parent, a dropped one drops all below it, and
the best such assignment is found bottom-up.

The trees are fitted here, on pages composed from the words of a bounded sample
of the given pages: an article and many kinds of page furniture, with and
without telling tags and class names.
"""

from __future__ import annotations

import html
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- parsing

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)|</[^>]*+(?:>|\Z)""", re.S)
ATTR = re.compile(r"""(class|id|role|itemprop|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page at all.
HIDDEN = frozenset("head script style noscript template svg iframe object select option button textarea title "
                   "canvas audio video datalist".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre "
                  "section summary table tbody td tfoot th thead tr ul caption".split())
#: What an opening tag ends if it is open (up to the nearest of the second set).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
ENDS_P = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "legend"}
SCOPE = frozenset("td th table body html button object".split())

GROUPS = {t: i for i, names in enumerate((
    "p pre blockquote dd", "h1 h2 h3 h4 h5 h6 hgroup", "div", "article main", "section", "nav menu", "header", "footer",
    "aside", "form fieldset legend", "ul ol dl dir", "li dt", "table tbody thead tfoot tr td th caption",
    "figure figcaption", "html body", "address details summary dialog center hr")) for t in names.split()}
N_GROUPS = 16

# What class, id and role tokens usually stand for.
TOKENS = {w: i for i, words in enumerate((
    "article content main post entry story body text prose page lead",
    "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs",
    "header head masthead topbar top logo brand",
    "footer foot bottom colophon copyright legal imprint contentinfo",
    "sidebar aside side rail widget related recommended recommendations trending popular teaser teasers complementary more",
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted",
    "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe subscription signup paywall notification",
    "form search login register",
    "comment comments reply replies discussion disqus respond reader readers feedback reactions",
    "share sharing social follow tweet tags byline meta")) for w in words.split()}
N_TOKENS = 10
STOPS = re.compile(r"[.!?;:,]")


@dataclass
class Page:
    """Elements in document order; ``end`` is one past the last element below."""
    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    nth: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)   # tokens of all ancestors
    groups: list[int] = field(default_factory=list)  # tag groups of all ancestors
    link: list[bool] = field(default_factory=list)
    truth: list[int] = field(default_factory=list)
    stats: list[list[int]] = field(default_factory=list)  # own chars, words, link chars, stops
    items: list[tuple[int, str]] = field(default_factory=list)  # (element, text); ("", a break) between blocks


def _tokens(attrs: str) -> tuple[int, int]:
    mask, truth = 0, -1
    for name, a, b, c in ATTR.findall(attrs):
        if name == "data-y":
            truth = int(a or b or c or 0)
            continue
        for word in PART.findall(a or b or c):
            k = TOKENS.get(word.lower())
            if k is not None:
                mask |= 1 << k
    return mask, truth


def _raw_end(source: str, tag: str, at: int) -> int:
    found = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
    return found.end() if found else len(source)


class _HiddenEnds:
    """Where the hidden elements of a page end, found in one scan per name and stretch of the page."""

    def __init__(self, source: str):
        self.source = source
        self.known: dict[int, int | None] = {}  # by the start of the content

    def find(self, tag: str, at: int, around: dict) -> int | None:
        """End of the hidden element whose content starts at ``at``; None if it is never closed.

        That is so if the page or a block ``around`` it (a name with open
        elements) ends first.  A head also ends where the body or its first
        block begins.  Elements of the same name below it are settled in the
        same scan.
        """
        if at in self.known:
            return self.known[at]
        opens, alive, inside = [at], [0], {}  # starts; which of them can still be closed; blocks below, by len(opens)
        pos = at
        while m := TOKEN.search(self.source, pos):
            pos = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            attrs = m["attrs"] or m["attrs2"] or ""
            if m["end"] or m["end2"]:
                if name == tag:
                    start = opens.pop()
                    if alive[-1] == len(opens):
                        alive.pop()
                        self.known[start] = pos
                    if not opens:
                        return pos
                elif inside.get(name):
                    below = inside[name].pop()
                    while alive[-1] >= below:  # opened in the block that ends here
                        self.known[opens[alive.pop()]] = None
                elif tag != "head" and name in BLOCK and around.get(name):
                    break
            elif not name or attrs.endswith("/") or name in VOID:
                continue
            elif tag == "head" and name in BLOCK and name != "html":
                self.known[at] = m.start()
                return m.start()
            elif name == tag:
                alive.append(len(opens))
                opens.append(pos)
            elif name in HIDDEN and name in RAW:
                pos = _raw_end(self.source, name, pos)
            elif name in BLOCK:
                inside.setdefault(name, []).append(len(opens))
        self.known.update((opens[k], None) for k in alive)
        return None


def parse(source: str | None) -> Page:
    """Elements and text of a page, with the usual repairs of unclosed and misnested tags.

    The tag of a hidden element that is never closed is ignored, so that what
    follows it stays.
    """
    page, stack = Page(), []
    source = source or ""
    last_end: dict[str, int] = {}  # where the last end tag of a hidden element is
    hidden = _HiddenEnds(source)
    where: dict[str, list[int]] = {}  # stack positions of the open elements of a name

    def last(names) -> int:
        """Highest stack position of an open element with one of the names, or -1; html and body do not count."""
        return max((where[n][-1] for n in names if where.get(n) and where[n][-1] > 1), default=-1)

    def open_(tag, attrs):
        at, up = len(page.tag), stack[-1] if stack else -1
        mask, truth = _tokens(attrs) if attrs and "=" in attrs else (0, -1)
        page.tag.append(tag)
        page.parent.append(up)
        page.end.append(-1)
        page.depth.append(len(stack))
        page.nth.append(page.children[up] if stack else 0)
        page.children.append(0)
        page.tokens.append(mask)
        page.above.append(page.above[up] | page.tokens[up] if stack else 0)
        page.groups.append(page.groups[up] | (1 << GROUPS[page.tag[up]] if page.tag[up] in GROUPS else 0) if stack else 0)
        page.link.append(tag == "a" or bool(stack and page.link[up]))
        page.truth.append(truth if truth >= 0 else page.truth[up] if stack else -1)
        page.stats.append([0, 0, 0, 0])
        if stack:
            page.children[up] += 1
        where.setdefault(tag, []).append(len(stack))
        stack.append(at)
        if tag in BLOCK:
            page.items.append((at, ""))

    def close(to):
        """Close open elements down to and with stack position ``to``."""
        for at in stack[to:]:
            where[page.tag[at]].pop()
            page.end[at] = len(page.tag)
            if page.tag[at] in BLOCK:
                page.items.append((at, ""))
        del stack[to:]

    def text(raw):
        if not raw:
            return
        value = html.unescape(raw) if "&" in raw else raw
        if stack:
            flat = " ".join(value.split())
            if flat:
                s = page.stats[stack[-1]]
                s[0] += len(flat)
                s[1] += flat.count(" ") + 1
                s[2] += len(flat) if page.link[stack[-1]] else 0
                s[3] += len(STOPS.findall(flat))
        page.items.append((stack[-1], value))

    open_("html", "")
    open_("body", "")
    at = 0
    while at < len(source):
        m = TOKEN.search(source, at)
        text(source[at:m.start() if m else len(source)])
        if m is None:
            break
        at = m.end()
        tag = (m["name"] or m["name2"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        ending, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if m["name"] is None and not m[0].endswith(">"):
            break  # the page ends inside a tag
        if tag in HIDDEN:
            if not ending and not attrs.endswith("/"):
                if tag in RAW:
                    at = _raw_end(source, tag, at)
                    continue
                if tag not in last_end:
                    last_end[tag] = max((e.start() for e in re.finditer(rf"</{tag}\b", source, re.I)), default=-1)
                if tag == "head" or last_end[tag] >= at:
                    end = hidden.find(tag, at, where)
                    at = at if end is None else end
            continue
        if tag in ("html", "body"):
            if not ending and attrs:
                k = 0 if tag == "html" else 1
                mask, truth = _tokens(attrs)
                page.tokens[k] |= mask
            continue
        if ending:
            k = last((tag,))
            if k > 1:
                close(k)
            continue
        if tag in ENDS_P:
            k = last(("p",))
            if k > last(SCOPE):
                close(k)
        if tag in CLOSES:
            own, stop = CLOSES[tag]
            k = last(own)
            if k > last(stop):
                close(k)
        if tag in VOID or attrs.endswith("/"):
            if tag in ("br", "hr"):
                page.items.append((stack[-1], " " if tag == "br" else "\0"))
            continue
        open_(tag, attrs)
    close(0)
    return page


def blocks(page: Page, kept: np.ndarray) -> str:
    """Text of the kept elements: white space collapsed inside a block, blocks joined by a blank line."""
    out, run = [], []
    for at, value in [*page.items, (0, "")]:
        if value in ("", "\0"):
            if run:
                flat = " ".join("".join(run).split())
                if flat:
                    out.append(flat)
                run = []
        elif kept[at]:
            run.append(value)
    return "\n\n".join(out)


# ---------------------------------------------------------------- features

def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of features of all block elements of the pages, and their numbers in the concatenation of all elements."""
    sizes = np.array([len(p.tag) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = int(sizes.sum())

    def gather(name, kind=np.int64):
        return np.fromiter((x for p in pages for x in getattr(p, name)), kind, n)
    parent, end = gather("parent") + base, gather("end") + base
    root = gather("parent") < 0
    parent[root] = np.flatnonzero(root)
    group = np.fromiter((GROUPS.get(t, -1) for p in pages for t in p.tag), np.int64, n)
    tags = [t for p in pages for t in p.tag]
    own = np.array([s for p in pages for s in p.stats], np.int64).reshape(n, 4)
    flags = np.column_stack([np.ones(n, np.int64), *(np.fromiter((t in s for t in tags), np.int64, n) for s in (
        {"p"}, {"li"}, {"a"}, {"input", "label"}, {"h1", "h2", "h3", "h4"}))])
    direct = np.column_stack([own, flags])
    total = np.concatenate([np.zeros((1, direct.shape[1]), np.int64), np.cumsum(direct, axis=0)])
    below = (total[end] - total[np.arange(n)]).astype(float)
    chars, words, link, stops, nodes, ps, lis, anchors, inputs, heads = below.T
    page_at = base
    page_chars, start = np.maximum(chars[page_at], 1), total[np.arange(n), 0] - total[page_at, 0]
    depth, nth, siblings = gather("depth").astype(float), gather("nth").astype(float), gather("children").astype(float)[parent]
    up_chars = np.maximum(chars[parent], 1)
    blocky = np.flatnonzero(group >= 0)
    # text density of the siblings: of the rest of the parent, and of its larger paragraphs
    rest = np.maximum(chars[parent] - chars, 0)
    rest_link = (link[parent] - link) / np.maximum(rest, 1)
    tokens, above = gather("tokens"), gather("above")
    up = np.where(root[parent], parent, parent[parent])
    columns = [np.log1p(chars), np.log1p(words), link / np.maximum(chars, 1), stops / np.maximum(words, 1),
               chars / np.maximum(words, 1), np.log1p(nodes), chars / nodes, np.log1p(ps), np.log1p(lis),
               anchors / nodes, np.log1p(inputs), heads / nodes, ps / nodes, own[:, 0] / np.maximum(chars, 1),
               depth, nth, siblings, nth / np.maximum(siblings, 1), chars / up_chars, chars / page_chars,
               start / page_chars, rest_link, np.log1p(rest), np.log1p(chars[parent]), link[parent] / up_chars,
               stops[parent] / np.maximum(words[parent], 1), np.log1p(ps[parent]), chars[up] / page_chars,
               group.astype(float), group[parent].astype(float), group[up].astype(float)]
    columns += [(tokens >> k & 1).astype(float) for k in range(N_TOKENS)]
    columns += [(above >> k & 1).astype(float) for k in range(N_TOKENS)]
    # tokens somewhere below: shares of the elements there
    low = np.concatenate([np.zeros((1, N_TOKENS), np.int64), np.cumsum((tokens[:, None] >> np.arange(N_TOKENS)) & 1, axis=0)])
    columns += list(((low[end] - low[np.arange(n) + 1]) / nodes[:, None]).T)
    hood = gather("groups")
    columns += [(hood >> k & 1).astype(float) for k in range(N_GROUPS)]
    columns += [(group == k).astype(float) for k in range(N_GROUPS)]
    return np.column_stack(columns)[blocky].astype(np.float32), blocky


# ---------------------------------------------------------------- boosted trees

@dataclass
class Trees:
    """Complete binary trees of one depth: feature and threshold per inner node, value per leaf."""
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if self.value.size else 0
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 70, depth: int = 5, rate: float = 0.2, bins: int = 32,
          ridge: float = 1.0, least: float = 4.0) -> Trees:
    """Gradient boosting of the logistic loss with histogram splits (second order)."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.int64)
    width = bins + 1
    m, n_features = np.full(len(y), base), x.shape[1]
    inner = (1 << depth) - 1
    features_, thresholds, values = [], [], []
    columns = np.arange(n_features) * width
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            flat = ((at - first)[:, None] * (n_features * width) + columns + binned).ravel()
            size = count * n_features * width
            hist = [np.bincount(flat, np.repeat(w, n_features), size).reshape(count, n_features, width) for w in (g, h)]
            left = [np.cumsum(a, axis=2) for a in hist]
            full = [a[:, :, -1:] for a in left]
            right = [a - b for a, b in zip(full, left)]
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - full[0] ** 2 / (full[1] + ridge)
            gain[(left[1] < least) | (right[1] < least)] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                j, b = divmod(int(best[k]), width)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    f[first + k], t[first + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
        leaf = at - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        v = -rate * gs / (hs + ridge)
        m += v[leaf]
        features_.append(f), thresholds.append(t), values.append(v)
    return Trees(np.array(features_), np.array(thresholds), np.array(values), base)


# ---------------------------------------------------------------- decoding

#: Cost (in nats) of a dropped element under a kept one: main text is more often whole than torn.
TEAR = 0.75


def decode(pages: list[Page], margin: np.ndarray, rows: np.ndarray, tear: float = TEAR) -> list[np.ndarray]:
    """Kept elements of each page: the likeliest choice in which every kept element has a kept parent.

    Elements that are no blocks follow their parent; the body is always kept
    and may be torn at no cost.
    """
    m = np.clip(margin, -6, 6)
    n = sum(len(p.tag) for p in pages)
    keep_cost, drop_cost = np.zeros(n), np.zeros(n)
    keep_cost[rows] = np.logaddexp(0, -m)   # -log p
    drop_cost[rows] = np.logaddexp(0, m)    # -log (1 - p)
    is_block = np.zeros(n, bool)
    is_block[rows] = True
    out, base = [], 0
    for p in pages:
        size = len(p.tag)
        drop_all = np.concatenate(([0.0], np.cumsum(drop_cost[base:base + size])))
        best, choice = keep_cost[base:base + size].tolist(), [True] * size
        parent, end = p.parent, p.end
        block = is_block[base:base + size].tolist()
        for i in range(size - 1, 0, -1):
            drop = drop_all[end[i]] - drop_all[i] + (tear if parent[i] > 1 else 0.0)
            if block[i] and i > 1 and drop < best[i]:
                choice[i] = False
                best[parent[i]] += drop
            else:
                best[parent[i]] += best[i]
        for i in range(1, size):
            choice[i] = choice[i] and choice[parent[i]]
        out.append(np.array(choice))
        base += size
    return out


# ---------------------------------------------------------------- training pages

def _composer(words: list[str], rng: np.random.Generator):
    """Composes labelled pages: an article among page furniture (``data-y`` marks which is which)."""
    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def some(low, high):
        return int(rng.integers(low, high + 1))

    def phrase(low=1, high=5):
        return " ".join(words[int(i)] for i in rng.integers(0, len(words), some(low, high)))

    def sentences(low=1, high=8):
        return " ".join(phrase(3, 18).capitalize() + pick(".", ".", ".", "?", "!", "...") for _ in range(some(low, high)))

    def link(low=1, high=4):
        return f'<a href="/{some(0, 999)}">{phrase(low, high)}</a>'

    def rich():
        return sentences(1, pick(1, 3, 8)) + pick("", "", f" {pick('<b>', '<em>', '<strong>')}{phrase()}. ", f" {link()} {sentences(1, 2)}",
                                                  "<br>" + sentences(1, 2), f" {phrase(1, 1)}{pick('!!', '%%%', '***', ' |')} {phrase(1, 2)}")

    def neutral():
        return pick("", "", f' class="{pick("c", "x", "b", "col", "row", "box", "wrap", "inner", "l", "grid")}-{some(1, 40)}"', f' id="b{some(1, 99)}"')

    def named(*kinds):
        k = pick(*kinds)
        return pick(neutral(), f' class="{k}"', f' id="{k}"', f' class="{pick("site", "page", "m", "js", "the")}-{k}{pick("", "-inner", "-wrap", "-box")}"')

    def paragraph():
        return pick("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p class=\"t{n}\">{}</p>").replace(
            "{n}", str(some(1, 9))).replace("{}", pick(rich, rich, rich, lambda: phrase(1, 3).capitalize() + ".")())

    def article_part():
        kind = rng.random()
        if kind < 0.74:
            return paragraph()
        if kind < 0.82:
            return f"<h{(h := some(2, 4))}>{phrase(1, 7)}</h{h}>"
        if kind < 0.88:
            t = pick("ul", "ol")
            return f"<{t}>" + "".join(f"<li>{pick(phrase(2, 8), rich())}</li>" for _ in range(some(2, 6))) + f"</{t}>"
        if kind < 0.91:
            return f"<blockquote>{pick(rich(), paragraph())}</blockquote>"
        if kind < 0.93:
            return f"<pre>{phrase(4, 30)}</pre>"
        if kind < 0.95:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{phrase(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(some(2, 5))) + "</table>"
        if kind < 0.97:
            return f'<figure><img src="i.png"><figcaption>{phrase(2, 9)}</figcaption></figure>'
        k = pick("ad", "advert", "sponsored", "promo", "related", "share")  # furniture among the text needs a telling name
        return f'<div data-y="0" class="{k}">{pick(sentences(1, 2), link() + " " + link())}</div>'

    def article():
        n = pick(1, 2, 3, 6, 12, 25)
        inner = "".join(article_part() for _ in range(n))
        head = pick("", f"<h1>{phrase(2, 12)}</h1>", f"<h1>{phrase(2, 12)}</h1>", f"<h2>{phrase(2, 10)}</h2>",
                    f"<header><h1>{phrase(2, 12)}</h1></header>")
        tag, attrs = pick(("article", ""), ("article", neutral()), ("main", ""), ("div", named("content", "article", "post", "story", "entry", "main", "body")),
                          ("div", neutral()), ("section", neutral()))
        if rng.random() < 0.2:
            inner = f"<div{pick(neutral(), named('text', 'content', 'body'))}>{inner}</div>"
        return f'<{tag} data-y="1"{attrs}>{head}{inner}</{tag}>'

    def listing(n):
        tag = pick("ul", "ul", "ol", "div")
        return f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(n))}</ul>" if tag != "div" else " | ".join(link() for _ in range(n))

    def furniture(tag, kinds, inner):
        t = pick(tag, tag, "div")
        return f'<{t} data-y="0"{neutral() if t != "div" else named(*kinds)}>{inner}</{t}>'

    def nav():
        return furniture("nav", ("nav", "menu", "navbar", "navigation", "breadcrumbs", "tabs"), listing(some(2, 12)))

    def header():
        return furniture("header", ("header", "masthead", "topbar", "logo"),
                         pick("", f"<a href='/'>{phrase(1, 2)}</a>") + pick("", f"<p>{phrase(2, 8)}</p>", f"<h1>{phrase(1, 3)}</h1>") + pick("", listing(some(2, 6))))

    def footer():
        return furniture("footer", ("footer", "bottom", "colophon", "legal"), pick("", listing(some(2, 8))) + pick(
            f"&copy; {phrase(1, 3)}.example &middot; {sentences(1, 1)}", f"<p>&copy; {some(1990, 2030)} {phrase(1, 4)}. {phrase(2, 6)}.</p>", sentences(1, 2), f"<p>{sentences(1, 3)}</p>"))

    def ad():
        return furniture(pick("div", "div", "aside", "section"), ("ad", "ads", "advert", "sponsored", "promo", "advertisement", "ad-slot", "banner ad"),
                         pick(sentences(1, 3), f"<p>{sentences(1, 3)}</p>", f"<a href='/x'>{sentences(1, 1)}</a>", f"{phrase(2, 6)} {link()}"))

    def side():
        return furniture("aside", ("sidebar", "side", "widget", "related", "trending", "popular", "rail"), "".join(
            pick(f"<h3>{phrase(1, 4)}</h3>{listing(some(2, 8))}", f"<p>{sentences(1, 2)}</p>", f"<div>{link(3, 9)}<p>{phrase(4, 14)}...</p></div>", f"<h4>{phrase(1, 3)}</h4><p>{sentences(1, 3)} {link()}</p>")
            for _ in range(some(1, 4))))

    def notice():
        return furniture(pick("div", "section", "aside", "dialog"), ("cookie", "cookie-notice", "consent", "gdpr-banner", "newsletter", "notice", "alert", "popup", "modal", "subscribe", "paywall"),
                         pick(f"<p>{sentences(1, 3)}</p>", sentences(1, 2)) + pick("", " <button>OK</button>", link()))

    def form():
        return f'<form data-y="0" action="/s"{neutral()}>{pick("", phrase(1, 4), f"<label>{phrase(1, 3)}</label>", f"<p>{sentences(1, 2)}</p>")}<input name="q">{pick("", "<button>Go</button>", "<input type=submit>")}</form>'

    def comments():
        return furniture("section", ("comments", "discussion", "replies", "comment-list", "reader-comments", "disqus"), pick("", f"<h3>{phrase(1, 3)}</h3>") + "".join(
            f"<{(t := pick('div', 'li', 'article'))}{named('comment', 'reply')}>{pick('', f'<b>{phrase(1, 2)}</b> ', f'<span>{phrase(1, 2)}</span>')}<p>{sentences(1, 4)}</p></{t}>" for _ in range(some(1, 6))))

    def share():
        return furniture("div", ("share", "social", "tags", "byline", "meta"), pick(listing(some(2, 5)), phrase(1, 6)))

    def page():
        """A page, and whether what the words of its marks say can be relied on varies from page to page."""
        before = [f() for f in (notice, header, nav, nav, ad, form) if rng.random() < 0.42]
        inner_before = [f() for f in (ad, nav, share) if rng.random() < 0.15]
        inner_after = [f() for f in (share, side, comments, ad, form) if rng.random() < 0.25]
        after = [f() for f in (side, comments, ad, notice, nav, footer, footer) if rng.random() < 0.42]
        core = "".join([*inner_before, article(), *inner_after])
        for _ in range(some(0, 2)):
            core = f"<{(t := pick('div', 'div', 'main', 'section'))}{pick(neutral(), named('page', 'container', 'wrapper', 'main', 'content'))}>{core}</{t}>"
        if rng.random() < 0.1:
            before.append(f"<div{neutral()}>{after.pop() if after else nav()}</div>")
        return f"<html><head><title>{phrase()}</title></head><body>{''.join(before)}{core}{''.join(after)}</body></html>"
    return page


def _training_rows(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of elements with text; 1: main text is somewhere inside."""
    x, rows = features(pages)
    truth = np.array([t for p in pages for t in p.truth])
    end = np.concatenate([np.array(p.end) + b for p, b in zip(pages, np.cumsum([0, *(len(p.tag) for p in pages)]))])
    chars = np.array([s[0] for p in pages for s in p.stats])
    good = np.concatenate(([0], np.cumsum(np.where(truth == 1, chars, 0))))
    total = np.concatenate(([0], np.cumsum(chars)))
    some = total[end[rows]] > total[rows]
    return x[some], (good[end[rows]] > good[rows])[some].astype(float)


def fit(words: list[str], pages: int = 700, seed: int = 29) -> Trees:
    words = words or [a + b for a in ("ba", "ko", "ri", "te", "mu") for b in ("lan", "des", "tor", "nig", "sa")]
    compose = _composer(words, np.random.default_rng(seed))
    x, y = _training_rows([parse(compose()) for _ in range(pages)])
    return boost(x, y)


def train(pages: DataFrame, sample_pages: int = 200, id_col: str = "page_id", html_col: str = "html") -> Trees:
    """Fit on pages composed from the words of the ``sample_pages`` pages with the smallest hash of their id.

    The bound keeps the fit in driver memory; only words are taken from the
    sample (at most 20,000 distinct ones).
    """
    ids = pages.select(F.col(id_col).cast("string").alias("i")).distinct().orderBy(F.xxhash64("i"), "i").limit(sample_pages)
    rows = pages.select(F.col(id_col).cast("string").alias("i"), F.col(html_col).cast("string").alias("h")) \
        .join(F.broadcast(ids), "i").select("h")
    split = F.explode(F.split(F.regexp_replace("h", "<[^>]*>", " "), r"\s+"))
    words = rows.select(split.alias("w")).where(F.col("w").rlike(r"^[^<>&]+$") & (F.length("w") <= 30)) \
        .groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(20_000).collect()
    return fit([r["w"] for r in words])


def extract_pages(sources: list[str | None], model: Trees) -> list[str]:
    parsed = [parse(s) for s in sources]
    if not parsed:
        return []
    x, rows = features(parsed)
    return [blocks(p, kept) for p, kept in zip(parsed, decode(parsed, model.margin(x), rows))]


def _extractor(shared, html_at: int, group: int = 200):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, group):
                part = batch.slice(i, group)
                texts = extract_pages(part.column(html_at).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, model: Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points): the main text of the whole html.

    Blocks are joined by a blank line, white space inside a block is one
    space, character references are decoded.  Null or empty html, and pages
    without main text, give the empty text.  Plain text without markup is
    kept.  Repeated rows and null ids are returned as they come; an empty
    table gives no rows; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # a few thousand numbers
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))
    return d.mapInArrow(_extractor(shared, 2), "page_id long, url string, text string, n_chars long")
