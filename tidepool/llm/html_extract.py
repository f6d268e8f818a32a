"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its element tree. Each element has a hidden state, content or not. Its own features
(tag, words in class, id and role, link density, text length) give its unary potential; each parent-child
pair has a potential that depends on whether the child is a line-level, block or section element. One upward
and one downward sum-product pass over the tree give the exact marginals. All weights are trained by gradient
ascent of the likelihood on labelled pages (`labelled_pages`), whose expected statistics come from the same
two passes. Text whose element is content with probability 0.5 or more is kept.

Text is put into blocks: block elements end a block, line-level elements and <br> do not; white space becomes
one space, blocks are joined by \\n. Elements without text of the page's own (script, style, title, form
controls and the like) have no text. Tags may be unclosed or stray, and pages may end anywhere.

Null and empty pages give ""; a page with a text outside of menus, asides, footers and forms never does: where no
element is content, those most likely to be count. Pages of any length are parsed whole, in time that grows with their
length. An empty table has no rows; ties, repeated rows and null ids need no care. White space is what str.split() takes
for it, no-break spaces too; elements with the attribute hidden have no text. Rows are independent; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_batches, text_steps

# ---- parsing

#: Fixed values of HTML: elements without content, elements whose text isn't shown, line-level elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title head template noscript noembed noframes iframe svg math object canvas audio video select option textarea button input datalist".split())
RAW = frozenset("script style textarea title noscript noembed noframes iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SECTIONS = frozenset("article aside body footer header html main nav section form".split())
#: Which open elements a start tag ends, and where the search for them stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tree:
    """Elements in page order: tag, parent, words of class, id and role; texts as (element, string or None for a block's end)."""

    def __init__(self, page: str):
        self.tags, self.parents, self.names, self.attributes, self.texts = ["#root"], [-1], [frozenset()], [{}], []
        stack, n_open = [0], Counter()

        def end(at: int):
            for node in stack[at:]:
                n_open[self.tags[node]] -= 1
                if self.tags[node] not in INLINE:
                    self.texts.append((node, None))
            del stack[at:]

        def text(raw: str):
            if raw:
                self.texts.append((stack[-1], raw))

        at = 0
        while at < len(page):
            m = TOKEN.search(page, at)
            if m is None:
                text(page[at:])
                break
            text(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                for i in () if not n_open[tag] else range(len(stack) - 1, 0, -1):
                    if self.tags[stack[i]] == tag:
                        end(i)
                        break
                    if tag in INLINE and self.tags[stack[i]] not in INLINE:
                        break  # a stray end tag of a line-level element ends no block
                continue
            if tag in CLOSES:
                close, stop = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1) if any(n_open[c] for c in close) else ():
                    if self.tags[stack[i]] in stop:
                        break
                    if self.tags[stack[i]] in close:
                        end(i)
                        break
            if tag in ENDS_P and n_open["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[i]] == "p":
                        end(i)
                        break
                    if self.tags[stack[i]] in SECTIONS or self.tags[stack[i]] in {"div", "td", "li", "table"}:
                        break
            node = len(self.tags)
            found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[3])} if m[3] else {}
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.attributes.append(found)
            self.names.append(frozenset(p.lower() for key in ("class", "id", "role", "aria-label", "itemprop") for p in NAME_PART.findall(found.get(key, ""))))
            if tag == "br":
                self.texts.append((stack[-1], " "))
            elif tag not in INLINE:
                self.texts.append((node, None))
            if tag in VOID or m[3].endswith("/") and tag not in RAW:
                continue
            stack.append(node)
            n_open[tag] += 1
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                end(len(stack) - 1)


    def path(self, node: int) -> list[str]:
        """Tags from an element up to the root."""
        out = []
        while node > 0:
            out.append(self.tags[node])
            node = self.parents[node]
        return out


#: Elements that are never an article.
APART = frozenset({"nav", "aside", "footer", "form", "button", "script", "style", "head"})


# ---- features

#: Words in class, id and role that speak for or against an element.
AGAINST = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toc pagination pager skip topbar toolbar tabs".split(),
    "frame": "header masthead banner footer foot copyright legal imprint colophon contentinfo logo brand".split(),
    "side": "sidebar side aside widget related recommended popular trending complementary rail tags archive".split(),
    "notice": "cookie cookies consent gdpr notice alert warning popup modal overlay dialog newsletter subscribe signup paywall disclaimer".split(),
    "advert": "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion promoted affiliate dfp".split(),
    "form": "form search login signin register contact input field".split(),
    "comments": "comment comments reply replies respond discussion disqus thread reviews feedback".split(),
    "social": "share sharing social follow tweet facebook twitter meta byline tools print".split(),
}
FOR = "article content main post entry story text body".split()
TAGS = "html body article main section div p h1 h2 h3 h4 ul ol li dl dt dd table tr td th blockquote pre figure figcaption a span b nav header footer aside form label details".split()
GROUPS = [*AGAINST, "for"]
_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_WORD_AT = {w: i for i, g in enumerate(GROUPS) for w in AGAINST.get(g, FOR)}
N_TAGS, N_GROUPS = len(TAGS) + 1, len(GROUPS)
N_FEATURES = N_TAGS + N_GROUPS + 15


def describe(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, parents and kinds (0 line-level, 1 block, 2 section) of a tree's elements."""
    n = len(tree.tags)
    parents = np.array(tree.parents)
    x = np.zeros((n, N_FEATURES), np.float32)
    own, linked = np.zeros(n), np.zeros(n)
    in_link, inside = np.zeros(n, bool), np.zeros(n, bool)
    depth = np.zeros(n, int)
    for i in range(n):
        p = tree.parents[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            in_link[i] = in_link[p] or tree.tags[i] == "a"
            inside[i] = inside[p] or tree.tags[p] in ("article", "main")
        x[i, _TAG_AT.get(tree.tags[i], N_TAGS - 1)] = 1
        for word in tree.names[i]:
            if (g := _WORD_AT.get(word)) is not None:
                x[i, N_TAGS + g] = 1
    for node, raw in tree.texts:
        if raw is not None:
            size = len(raw) - raw.count(" ")
            own[node] += size
            linked[node] += size * in_link[node]
    total, links = own.copy(), linked.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        total[tree.parents[i]] += total[i]
        links[tree.parents[i]] += links[i]
    density = links / np.maximum(total, 1)
    f = N_TAGS + N_GROUPS
    x[:, f] = 1
    x[:, f + 1] = density
    x[:, f + 2] = np.minimum(np.log1p(total) / 8, 1.5)
    x[:, f + 3] = np.minimum(np.log1p(own) / 6, 1.5)
    x[:, f + 4] = (density > 0.5) & (total > 0)
    x[:, f + 5] = own > 80
    x[:, f + 6] = depth <= 2
    x[:, f + 7] = total == 0
    plain = total - links
    x[:, f + 8] = plain / max(plain[0], 1)  # share of the page's text that is not links
    x[:, f + 9] = plain > 0.5 * max(plain[0], 1)
    x[:, f + 11] = inside
    for j, tag in enumerate(("header", "footer", "article")):  # those of an article, not of the page
        x[:, f + 12 + j] = np.array([t == tag for t in tree.tags]) & (inside | (tag == "article"))
    x[:, f + 14] *= density < 0.5
    x[:, f + 10] = (density < 0.2) & (total > 200)
    kinds = np.array([0 if t in INLINE else 2 if t in SECTIONS else 1 for t in tree.tags])
    return x, parents, kinds


# ---- the model


class TreeModel:
    """Unary weights (content against not) and a 2 x 2 potential of (parent, child) for each kind of child."""

    def __init__(self):
        self.unary = np.zeros(N_FEATURES)
        self.pair = np.zeros((3, 2, 2))

    def marginals(self, x, parents, kinds):
        """P(content) per element, and P(parent state, child state) per element with a parent; for a forest, parents first."""
        n = len(parents)
        local = np.zeros((n, 2))
        local[:, 1] = x @ self.unary
        depth = np.zeros(n, int)
        child = np.flatnonzero(parents >= 0)
        for i in child:
            depth[i] = depth[parents[i]] + 1
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1)))
        up, message = local.copy(), np.zeros((n, 2))
        for level in levels[:0:-1]:  # from the leaves: what a subtree says about its parent's state
            message[level] = np.logaddexp(self.pair[kinds[level], :, 0] + up[level, None, 0], self.pair[kinds[level], :, 1] + up[level, None, 1])
            np.add.at(up, parents[level], message[level])
        belief = up.copy()
        for level in levels[1:]:  # from the root: what all the rest says
            rest = belief[parents[level]] - message[level]
            down = np.logaddexp(self.pair[kinds[level], 0, :] + rest[:, 0, None], self.pair[kinds[level], 1, :] + rest[:, 1, None])
            belief[level] = up[level] + down
        p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        joint = self.pair[kinds[child]] + (belief[parents[child]] - message[child])[:, :, None] + up[child][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        return p, child, joint / joint.sum(axis=(1, 2), keepdims=True)

    def train(self, pages, rounds: int = 200, rate: float = 0.5, l2: float = 1e-3) -> TreeModel:
        """Gradient ascent of the labelled trees' likelihood; pages: (features, parents, kinds, states)."""
        x, parents, kinds, states = _forest(pages)
        one_hot = np.eye(2)[states]
        seen_unary, seen_pair = x.T @ states, np.zeros((3, 2, 2))
        child = np.flatnonzero(parents >= 0)
        np.add.at(seen_pair, kinds[child], one_hot[parents[child]][:, :, None] * one_hot[child][:, None, :])
        g_unary, g_pair = np.full(N_FEATURES, 1e-8), np.full((3, 2, 2), 1e-8)
        for _ in range(rounds):
            p, child, joint = self.marginals(x, parents, kinds)
            expected = np.zeros((3, 2, 2))
            np.add.at(expected, kinds[child], joint)
            up = (seen_unary - x.T @ p) / len(p) - l2 * self.unary
            pair = (seen_pair - expected) / len(p) - l2 * self.pair
            g_unary += up * up
            g_pair += pair * pair
            self.unary += rate * up / np.sqrt(g_unary)
            self.pair += rate * pair / np.sqrt(g_pair)
        return self


def _forest(pages):
    """Several trees as one forest."""
    shift = np.cumsum([0, *(len(p[1]) for p in pages)])
    parents = np.concatenate([np.where(p[1] >= 0, p[1] + s, -1) for p, s in zip(pages, shift)])
    return np.concatenate([p[0] for p in pages]), parents, np.concatenate([p[2] for p in pages]), *(np.concatenate([p[k] for p in pages]) for k in range(3, len(pages[0])))


# ---- labelled pages

_LABEL = "data-content"


def _prose(r: random.Random, low: int, high: int) -> str:
    words = ["".join(r.choice(("ta", "lo", "mi", "ren", "sa", "ko", "el", "un", "dra", "pes")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + r.choice((".", ".", "!", "?"))


def labelled_pages(n: int = 300, seed: int = 11) -> list[str]:
    """Pages of many layouts; elements of the article bear the attribute data-content, which features never see."""
    r = random.Random(seed)
    pages = []
    for _ in range(n):
        links = lambda k: "".join(f"<li><a href='/{i}'>{_prose(r, 1, 3)[:-1]}</a></li>" for i in range(k))
        y = f" {_LABEL}"

        def block():
            kind = r.random()
            if kind < 0.6:
                inner = _prose(r, 1, r.choice((1, 3, 12, 40, 90)))
                if r.random() < 0.3:
                    tag = r.choice(("b", "i", "em", "strong", "span", "a", "code"))
                    inner = f"<{tag}{y}>{_prose(r, 1, 6)}</{tag}> {inner}" if r.random() < 0.5 else f"<{tag}{y}>{inner}<br>"
                return f"<p{y}>{inner}" + r.choice(("</p>", "</p>", ""))
            if kind < 0.7:
                return f"<{r.choice(('h2', 'h3'))}{y}>{_prose(r, 2, 7)[:-1]}</h2>"
            if kind < 0.78:
                return f"<ul{y}>" + "".join(f"<li{y}>{_prose(r, 3, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
            if kind < 0.84:
                return f"<blockquote{y}><p{y}>{_prose(r, 8, 40)}</p></blockquote>"
            if kind < 0.9:
                return f"<div{y}>{_prose(r, 10, 60)}</div>"
            if kind < 0.95:
                return f"<table{y}><tr{y}><td{y}>{_prose(r, 1, 5)}</td><td{y}>{_prose(r, 1, 5)}</td></tr></table>"
            return f"<pre{y}>{_prose(r, 5, 30)}</pre>"

        noise = [
            lambda: f"<div class='{r.choice(('ad', 'ads', 'advert', 'sponsored', 'promo-box', 'ad-banner'))}'>{_prose(r, 3, 25)}</div>",
            lambda: f"<aside{r.choice(('', ' class=sidebar'))}><h3>{_prose(r, 1, 3)}</h3><p>{_prose(r, 5, 30)}</p><ul>{links(4)}</ul></aside>",
            lambda: f"<div class='{r.choice(('sidebar', 'widget', 'related', 'related-posts'))}'><h3>{_prose(r, 1, 3)}</h3><ul>{links(4)}</ul><p>{_prose(r, 3, 25)}</p></div>",
            lambda: f"<div {r.choice(('class', 'id'))}='{r.choice(('cookie-banner', 'cookie-notice', 'notice', 'consent', 'newsletter'))}'><p>{_prose(r, 5, 30)}</p><button>{_prose(r, 1, 2)}</button></div>",
            lambda: f"<form action='/x'><label>{_prose(r, 1, 4)}</label><input name=q>{r.choice(('', '<p>' + _prose(r, 3, 14) + '</p>'))}<button>go</button></form>",
            lambda: f"<div class='{r.choice(('share', 'social', 'breadcrumb', 'tags'))}'><a href=/1>{_prose(r, 1, 2)}</a> <a href=/2>{_prose(r, 1, 2)}</a></div>",
            lambda: f"<script>var a = '<p>{_prose(r, 2, 5)}</p>';</script>",
        ]
        comments = lambda: (
            f"<{r.choice(('section', 'div'))} {r.choice(('class', 'id'))}='{r.choice(('comments', 'comment-list', 'reader-comments', 'discussion'))}'><h3>{_prose(r, 1, 3)}</h3>"
            + "".join(f"<div{r.choice(('', ' class=comment'))}><p>{_prose(r, 4, 60)}</p></div>" for _ in range(r.randint(1, 4)))
            + "</section></div>"
        )
        some = lambda k: "".join(r.choice(noise)() for _ in range(r.randint(0, k)))
        title = f"<h1{y}>{_prose(r, 2, 14)[:-1]}</h1>"
        body = "".join(block() + (r.choice(noise)() if r.random() < 0.06 else "") for _ in range(r.choice((1, 3, 6, 10, 25))))
        lead, by = f"<header{y}>{title}{r.choice(('', f'<p{y}>' + _prose(r, 3, 20) + '</p>'))}</header>", r.choice(("", f"<footer>{_prose(r, 1, 4)}</footer>"))
        figure = f"<figure{y}><img src=x><figcaption{y}>{_prose(r, 3, 15)}</figcaption></figure>"
        broken = "<br>".join(_prose(r, 5, 60) + r.choice(("", "<br>")) for _ in range(r.choice((1, 2, 5, 12))))
        article = r.choice(
            (
                f"<article{y}>{lead}{body}{by}</article>",
                f"<article{y}>{title}{figure}{body}</article>",
                f"<div{y}{r.choice(('', ' class=content', ' class=text', ' class=artikel', ' id=texte'))}>{title}{broken}</div>",
                f"<div{y}{r.choice(('', ' class=x1', ' class=contenu', ' class=inhalt'))}>{title}{body}</div>",
                f"{title}{body}",
                f"<table{y}><tr{y}><td{y}>{title}{broken}</td></tr></table>",
                f"<article{y}>{title}{body}</article>",
                f"<main{y}><article{y}>{title}{body}</article></main>",
                f"<main{y}>{title}{body}</main>",
                f"<div{y} class='{r.choice(('content', 'post', 'article-body', 'entry-content', 'story'))}'>{title}{body}</div>",
                f"<div{y} id='{r.choice(('content', 'main', 'article'))}'>{title}<div{y}>{body}</div></div>",
                f"<section{y}>{title}{body}</section>",
            )
        )
        if r.random() < 0.15:
            inside = comments() + some(1)
            cut = article.rfind("</")
            article = article[:cut] + inside + article[cut:]
        top = r.choice((f"<nav><ul>{links(5)}</ul></nav>", f"<header><h2>{_prose(r, 1, 4)}</h2><p>{_prose(r, 2, 10)}</p><nav>{links(4)}</nav></header>", f"<div class='{r.choice(('menu', 'navbar', 'header', 'top-menu'))}'><ul>{links(4)}</ul></div>", f"<header>{_prose(r, 2, 9)}</header>"))
        foot = r.choice((f"<footer>&copy; {_prose(r, 1, 20)}</footer>", f"<div {r.choice(('class', 'id'))}=footer><p>{_prose(r, 2, 25)}</p><ul>{links(3)}</ul></div>", f"<footer><p>{_prose(r, 2, 30)}</p></footer>", ""))
        bare = r.random()
        if bare < 0.08:  # a page that is its text
            pages.append(r.choice((f"{title}{body}", f"<html{y}><body{y}>{broken}</body></html>", article, f"<body{y}>{body}</body>")))
            continue
        wrap = r.choice(("{}", "{}", "<div class=wrapper>{}</div>", "<div id=page><div>{}</div></div>"))
        after = comments() if r.random() < 0.4 else ""
        pages.append(f"<!DOCTYPE html><html><head><title>{_prose(r, 2, 9)}</title><style>p{{}}</style></head><body>" + wrap.format(top + some(2) + article + after + some(2) + foot) + r.choice(("</body></html>", "")))
    return pages


_model: TreeModel | None = None


def trained_model() -> TreeModel:
    """The model of labelled_pages(), trained once per process."""
    global _model
    if _model is None:
        _model = TreeModel().train(_labelled(labelled_pages()))
    return _model


def _labelled(pages: list[str]):
    out = []
    for page in pages:
        tree = Tree(page)
        states = np.array([int(_LABEL in a) for a in tree.attributes])
        out.append((*describe(tree), states))
    return out


# ---- extraction


def collect(tree: Tree, content: np.ndarray) -> str:
    """The text of content elements, in blocks."""
    hidden = np.zeros(len(tree.tags), bool)
    for i, tag in enumerate(tree.tags):
        hidden[i] = tag in HIDDEN or tree.parents[i] >= 0 and hidden[tree.parents[i]] or "hidden" in tree.attributes[i]
    blocks, parts = [], []
    for node, raw in [*tree.texts, (0, None)]:
        if raw is None:
            if parts and (text := " ".join(entities.unescape("".join(parts)).split())):
                blocks.append(text)
            parts = []
        elif content[node] and not hidden[node]:
            parts.append(raw)
    return "\n".join(blocks)


def extract_texts(pages: list[str], model: TreeModel) -> list[str]:
    trees = [Tree(p) for p in pages]
    described = [describe(t) for t in trees]
    x, parents, kinds = _forest(described)
    p, _, _ = model.marginals(x, parents, kinds)
    ends = np.cumsum([len(t.tags) for t in trees])
    return [_text_of(t, p[e - len(t.tags) : e]) for t, e in zip(trees, ends)]


def _text_of(tree: Tree, p: np.ndarray) -> str:
    """The text of content elements; if there is none, of the elements most likely to be content that have any."""
    text = collect(tree, p >= 0.5)
    if text:
        return text
    with_text = sorted({node for node, raw in tree.texts if raw is not None and raw.strip() and not set(tree.path(node)) & APART}, key=lambda node: -p[node])
    for node in with_text:
        if text := collect(tree, p >= p[node]):
            return text
    return ""


def extract_pages(pages: DataFrame, *, model: TreeModel | None = None) -> DataFrame:
    """Per row of pages(page_id, url, html): page_id, url, text, n_chars."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    shared = pages.sparkSession.sparkContext.broadcast(model or trained_model())

    def run(batches):
        for part, _ in text_steps(batches, "html", 1 << 19):
            texts = extract_texts(part.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
