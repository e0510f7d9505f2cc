"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements. Each node that holds text is
described by its subtree's text density and links, its tag, the words in its
and its ancestors' class and id, depth, and its place among its siblings. A
gradient-boosted model gives each its log odds of being main text. Decoding
weighs these by text length and picks the best labelling in which a node that
is left out takes its whole subtree with it, so no choice contradicts one
above or below.

The model is trained on pages of known labels, which are laid out from words
of a bounded sample of the pages (``sample_pages``) in varied templates.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from reelstat.llm.common import smallest_hashes, text_blocks
from reelstat.llm.gbt import BoostedTrees

#: Fixed vocabularies of HTML: elements, and words that authors use in class and id.
RAW = ["script", "style", "noscript", "template", "textarea", "iframe", "svg", "object", "title", "select", "button"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
CLOSES |= {t: {"p"} for t in ("div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "nav", "aside", "footer",
                              "header", "form", "main", "blockquote", "pre", "hr", "dl", "figure")}
OUTSIDE_TAGS = {"nav", "header", "footer", "aside", "form", "head", "menu", "fieldset", "dialog", "figcaption"}
CONTENT_TAGS = {"article", "main", "section", "blockquote", "pre"}
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "td", "li", "pre", "blockquote", "dd", "dt"}
OUTSIDE_WORDS = set("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent contact cookie cookies
copyright dialog disclaimer disqus footer form gdpr header login masthead menu menubar meta modal nav navbar navigation newsletter notice
overlay pager pagination popup promo promoted promotion reader readers recommended related reply replies responses search share sharing
sidebar sidenav signup skip social sponsor sponsored subscribe tags teaser toolbar topbar tracking trending widget widgets alert warning
discussion feedback""".split())
CONTENT_WORDS = set("article articlebody body content entry main maincontent page post postbody prose story text".split())

#: A comment; an element whose content is no text; a tag (a quoted value ends before a blank, ``/`` or ``>`` and holds no
#: ``<``); a tag with stray quotes, up to the first ``>``; a declaration. None reads on past the next ``<`` in vain, so a page takes linear time.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^<>]*+(?<!/)>.*?(?:</\1\s*+>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^\"'<>]|\"[^\"<]*+\"(?=[\s/>])|'[^'<]*+'(?=[\s/>]))*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)>|<[!?][^<>]*+>",
                    re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
N_FEATURES = 22


class Node:
    __slots__ = ("tag", "parent", "words", "own", "linked", "order")

    def __init__(self, tag: str, parent: int, words: frozenset):
        self.tag, self.parent, self.words = tag, parent, words
        self.own, self.linked = 0, 0


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """(nodes, pieces): the block elements, parents first, and the text pieces (node, text) in page order.

    Two pieces without a break between them (None) belong to one block.
    """
    nodes, pieces, stack, links = [Node("html", -1, frozenset())], [], [0], 0
    at, open_tags = 0, Counter()

    def text(until: int):
        if until > at and (t := page[at:until]):
            t = entities.unescape(t) if "&" in t else t
            pieces.append((stack[-1], t))
            size = len(t.strip())
            nodes[stack[-1]].own += size
            nodes[stack[-1]].linked += size * bool(links)

    for m in _TOKEN.finditer(page):
        text(m.start())
        at = m.end()
        closing, tag, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        tag = (tag or "").lower()
        if not tag:
            if m[1]:
                pieces.append((stack[-1], None))
            continue
        if tag in INLINE:
            links = max(links + (-1 if closing else 1), 0) if tag == "a" else links
            continue
        pieces.append((stack[-1], None))
        if closing:
            if open_tags[tag]:
                while nodes[stack[-1]].tag != tag:
                    open_tags[nodes[stack.pop()].tag] -= 1
                open_tags[nodes[stack.pop()].tag] -= 1
                links = 0
        elif tag not in VOID and tag not in RAW and tag not in ("html", "body"):  # of the raw ones only those that close themselves come here
            closes = CLOSES.get(tag, ())
            while len(stack) > 1 and nodes[stack[-1]].tag in closes:
                open_tags[nodes[stack.pop()].tag] -= 1
            found = [x.lower() for name in _NAMES.findall(rest) for x in _WORD.findall(" ".join(name))] if rest else ()
            nodes.append(Node(tag, stack[-1], frozenset(found)))
            if not rest.endswith("/") or tag in CLOSES:
                stack.append(len(nodes) - 1)
                open_tags[tag] += 1
    text(len(page))
    return nodes, pieces


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    n = len(nodes)
    parent = np.array([x.parent for x in nodes])
    own = np.array([x.own for x in nodes], float)
    linked = np.array([x.linked for x in nodes], float)
    total, links, size = own.copy(), linked.copy(), np.ones(n)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        total[p] += total[i]
        links[p] += links[i]
        size[p] += size[i]
    out = np.zeros((n, N_FEATURES))
    children = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n)
    everything = max(total[0], 1)
    position = np.cumsum(own) / everything
    same: dict[tuple, int] = {}
    for x in nodes:
        same[x.parent, x.tag] = same.get((x.parent, x.tag), 0) + 1
    for i, x in enumerate(nodes):
        up = out[x.parent] if i else np.zeros(N_FEATURES)
        bad_tag, good_tag = x.tag in OUTSIDE_TAGS, x.tag in CONTENT_TAGS
        bad_word, good_word = not x.words.isdisjoint(OUTSIDE_WORDS), not x.words.isdisjoint(CONTENT_WORDS)
        p = x.parent
        out[i, :18] = (
            bad_tag, good_tag, bad_word, good_word, x.tag in TEXT_TAGS, x.tag in ("ul", "ol", "li"),
            max(up[0], up[6]), max(up[1], up[7]), max(up[2], up[8]), max(up[3], up[9]),
            up[10] + 1 if i else 0, np.log1p(own[i]), np.log1p(total[i]), total[i] / size[i], links[i] / max(total[i], 1),
            total[i] / max(total[p], 1) if i else 1, children[p] if i else 0, same[x.parent, x.tag])
    out[:, 18] = position
    out[:, 19] = total / everything
    out[:, 20] = links[parent] / np.maximum(total[parent], 1)
    out[:, 21] = np.log1p(total[parent])
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which nodes' own text is main: the best labelling in which a node left out leaves its subtree out."""
    weight = odds * np.array([x.own for x in nodes], float)
    inside, outside = weight.copy(), -weight
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        inside[p] += max(inside[i], outside[i])
        outside[p] += outside[i]
    keep = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        keep[i] = (i == 0 or keep[x.parent]) and inside[i] > outside[i]
    return keep & (odds > 0)


def text_of(pieces: list[tuple[int, str | None]], keep: np.ndarray) -> str:
    """The kept pieces: white space in a block is one space, blocks are joined by one space."""
    return " ".join("".join(" " if t is None else t for node, t in pieces if t is None or keep[node]).split())


#: Where the main text of a template lies: in paragraphs and the like, in one element by lines, in several elements
#: that are no paragraphs, in the body itself, or in a page without markup.
STYLES = ["blocks"] * 12 + ["lines"] * 3 + ["pieces"] * 3 + ["body", "plain"]


def template_page(rng: random.Random, words: list[str]) -> tuple[str, set[str]]:
    """A page and the ids of its blocks of main text; ids carry no meaning and are removed before training."""
    count = [0]
    main: set[str] = set()
    style = rng.choice(STYLES)

    def prose(a, b):
        return " ".join(rng.choices(words, k=rng.randint(a, b)))

    def block(tag, content, is_main=False, names=""):
        count[0] += 1
        key = f"k{count[0]}"
        if is_main:
            main.add(key)
        return f'<{tag} data-k="{key}"{f" class={chr(34)}{names}{chr(34)}" if names else ""}>{content}</{tag}>'

    def links(k, tag="li"):
        items = "".join(block(tag, f'<a href="/x">{prose(1, 3)}</a>') for _ in range(k))
        return f"<ul>{items}</ul>" if tag == "li" else items

    def aside(kind):
        words_for = {"nav": ["menu", "navbar", "nav main-nav", "breadcrumbs"], "header": ["site-header", "masthead", "topbar"],
                     "footer": ["footer", "site-footer", "copyright"], "aside": ["sidebar", "widget", "related", "widget-area"],
                     "ad": ["ad", "ads", "advert", "sponsored", "promo-banner"], "notice": ["cookie-notice", "consent", "gdpr popup", "alert"],
                     "form": ["login", "newsletter subscribe", "search-form"], "comments": ["comments", "comment-list", "reader-comments", "replies"],
                     "share": ["share", "social-links"]}[kind]
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6 else rng.choice(["div", "section", "div"])
        content = (links(rng.randint(2, 8)) if kind in ("nav", "share") else
                   "".join(block("p", prose(3, 40)) for _ in range(rng.randint(1, 4))) if kind == "comments" else
                   rng.choice([block("p", prose(3, 25)), prose(3, 25), links(3) + block("p", prose(2, 12))]))
        return block(tag, content, False, rng.choice(words_for) if tag in ("div", "section") or rng.random() < 0.4 else "")

    def sides(kinds, most):
        return "".join(aside(k) for k in rng.sample(kinds, rng.randint(0, most)))

    def lines():
        return rng.choice(["<br>", "<br><br>", "\n"]).join(prose(15, 90) for _ in range(rng.randint(1, 5)))

    before, after = ["header", "nav", "ad", "notice", "nav", "form"], ["footer", "aside", "comments", "ad", "footer", "form", "notice"]
    if style == "plain":  # no markup at all
        return lines().replace("<br>", "\n"), {"html"}
    if style == "body":
        main.add("html")
        return f"<html><body>{sides(before, 2)}{lines()}{sides(after, 2)}</body></html>", main
    body = [block(rng.choice(["h1", "h1", "h2"]), prose(3, 9), True)] if style == "blocks" or rng.random() < 0.5 else []
    if style == "lines":
        body.append(block(rng.choice(["div", "div", "section", "article", "main", "pre", "blockquote"]), lines(), True, rng.choice(["", "", "content", "text"])))
    if style == "pieces":
        tag = rng.choice(["section", "div", "td", "dd", "blockquote"])
        cells = "".join(block(tag, prose(12, 90), True) for _ in range(rng.randint(1, 6)))
        body.append(f"<table><tr>{cells}</tr></table>" if tag == "td" else f"<dl>{cells}</dl>" if tag == "dd" else cells)
    for _ in range(rng.randint(1, 9) if style == "blocks" else 0):
        body.append(block("p", prose(1, 4) if rng.random() < 0.15 else prose(8, 90), True))
        if rng.random() < 0.15:
            body.append("<ul>" + "".join(block("li", prose(3, 15), True) for _ in range(3)) + "</ul>")
        if rng.random() < 0.1:
            body.append(block(rng.choice(["h2", "h3"]), prose(2, 6), True))
        if rng.random() < 0.12:
            body.append(aside(rng.choice(["ad", "share", "aside"])))
    if rng.random() < 0.3:
        body.append(aside(rng.choice(["comments", "share", "form"])))
    tag, names = rng.choice([("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-body"), ("div", "entry"), ("div", ""), ("section", "")])
    article = "".join(body) if style != "blocks" and rng.random() < 0.4 else block(tag, "".join(body), False, names)
    if rng.random() < 0.3:
        article = f"<div class='wrapper'><div>{article}</div>{aside('aside')}</div>"
    inside = f"{sides(before, 4)}{article}{sides(after, 4)}"
    if rng.random() < 0.35:  # a wrapper of the whole page that only names what else the page has
        inside = block("div", inside, False, rng.choice(["page comments-open", "has-sidebar", "layout no-sidebar", "site header-fixed", "wrap nav-left", "page with-ads",
                                                         "theme-share menu-open", "post related-off"]))
    elif rng.random() < 0.15:
        article = block("div", article, False, rng.choice(["page comments-open", "has-sidebar", "site header-fixed", "wrap nav-left"]))
        inside = f"{sides(before, 4)}{article}{sides(after, 4)}"
    return f"<html><body>{inside}</body></html>", main


@lru_cache(maxsize=2)
def train(words: tuple, pages: int = 700, seed: int = 5) -> BoostedTrees:
    """The model, trained on template pages with these words; the same for the same words."""
    rng, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        page, main = template_page(rng, list(words))
        keys = ["html"] + re.findall(r'<(?!body|/|html|br)\w+(?: data-k="(\w+)")?[^>]*>', re.sub(r"</?a\b[^>]*>", "", page))
        nodes, _ = parse(re.sub(r' data-k="\w+"', "", page))
        held = np.array([x.own > 0 for x in nodes])
        xs.append(features(nodes)[held])
        ys.append(np.array([k in main for k in keys])[held])  # as many keys as nodes
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def sample_words(pages: DataFrame, html: str = "html", sample_pages: int = 40, most: int = 2_000) -> tuple:
    """Words of at most ``sample_pages`` different pages, those whose hashes are smallest; a few fixed ones if there are none."""
    found = sorted({w for page in smallest_hashes(pages, html, sample_pages) for _, t in parse(page)[1] if t for w in t.split()})
    return tuple(found[::max(len(found) // most, 1)][:most]) or ("a", "word", "of", "plain", "text.")


def extract(pages: DataFrame, words: tuple, html: str = "html") -> DataFrame:
    """The rows with ``main_text`` (empty if there is none; null html: empty) in front of all columns.

    Whole pages are read; a page without any markup is one text node. Repeated
    rows repeat; an equally named column is replaced.
    """
    new = StructType.fromDDL("main_text string")
    rest = [c for c in pages.columns if c != "main_text"]

    def run(batches):
        model = train(words)
        for batch in batches:
            out = []
            for _, _, texts in text_blocks(batch, html):
                trees = [parse(t or "") for t in texts]
                odds = model.decision(np.concatenate([features(nodes) for nodes, _ in trees]))
                at = 0
                for nodes, pieces in trees:
                    out.append(text_of(pieces, decode(nodes, odds[at:at + len(nodes)])))
                    at += len(nodes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())] + [batch.column(batch.schema.get_field_index(c)) for c in rest], new.names + rest)

    kept = pages.select(*rest)
    return kept.mapInArrow(run, StructType(new.fields + kept.schema.fields))
