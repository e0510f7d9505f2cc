"""HTML extraction on layouts of known articles, on hostile markup, and on edge rows."""

import random
import time

import numpy as np
import pytest

from reelstat.llm import html_extract as H

WORDS = tuple(f"{a}{b}{c}" for a in ("lo", "mar", "the", "un", "vel") for b in ("ti", "ra", "on", "es") for c in ("", "n", "s.", "t,", "m"))
NAV = "<nav class='menu'><ul>" + "".join(f"<li><a href='/{i}'>Menuitem {i}</a></li>" for i in range(6)) + "</ul></nav>"
FOOT = "<footer>&copy; Imprintword <a href=/>contactlink</a></footer>"


def framed(body):
    return f"<html><head><title>Titleword</title></head><body>{NAV}{body}{FOOT}</body></html>"


LAYOUTS = {
    "div with line breaks": lambda a, b: framed(f"<div>{a}<br>{b}</div>"),
    "text in the body": lambda a, b: framed(f"{a}<br>{b}"),
    "sections": lambda a, b: framed(f"<section>{a}</section><section>{b}</section>"),
    "no markup": lambda a, b: f"{a}\n{b}",
    "wrapper with a misleading class": lambda a, b: f"<html><body><div class=\"page comments-open\">{NAV}<article><p>{a}</p><p>{b}</p></article>{FOOT}</div></body></html>",
    "closed svg": lambda a, b: framed(f"<article><svg class='i'/><p>{a}</p><p>{b}</p></article>"),
    "closed title": lambda a, b: f"<html><head><title/></head><body>{NAV}<article><p>{a}</p><p>{b}</p></article>{FOOT}</body></html>",
    "stray quote": lambda a, b: framed(f"<article><p title=\"it's>{a}</p><p class=\"x\">{b}</p></article>"),
    "quote with >": lambda a, b: framed(f"<article><p title=\"a > b\">{a}</p><p data-x='>'>{b}</p></article>"),
    "table": lambda a, b: framed(f"<table><tr><td>{a}</td><td>{b}</td></tr></table>"),
    "pre": lambda a, b: framed(f"<pre>{a}\n\n{b}</pre>"),
    "blockquote and dd": lambda a, b: framed(f"<article><blockquote>{a}</blockquote><dl><dd>{b}</dd></dl></article>"),
    "nested svg": lambda a, b: framed(f"<article><p>{a}</p><svg><svg><text>x</text></svg></svg><p>{b}</p></article>"),
    "figure": lambda a, b: framed(f"<article><p>{a}</p><figure><img src=x></figure><p>{b}</p></article>"),
    "header in the article": lambda a, b: framed(f"<article><header><h1>Head</h1></header><p>{a}</p><p>{b}</p></article>"),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts_keep_their_article(name):
    rng, model = random.Random(5), H.train(WORDS)
    kept = clean = 0
    for _ in range(30):
        a, b = (" ".join(rng.choices(WORDS, k=rng.randint(30, 90))) for _ in range(2))
        nodes, pieces = H.parse(LAYOUTS[name](a, b))
        found = H.text_of(pieces, H.decode(nodes, model.decision(H.features(nodes))))
        kept += a in found and b in found
        clean += not any(w in found for w in ("Menuitem", "Imprintword", "contactlink", "Titleword"))
    assert kept >= 28 and clean >= 29


@pytest.mark.parametrize("page", ["<a '" * 250_000, '<p title="x' * 90_000, "<div>" * 100_000 + "</x>" * 100_000, "<title " * 140_000, "<svg/>" * 150_000, "&amp" * 200_000,
                                  "<!--" * 200_000, "</title " * 100_000, "<p class='a' " * 80_000, "<div class='" * 80_000])
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    nodes, _ = H.parse(page)
    H.decode(nodes, np.ones(len(nodes)))
    assert time.process_time() - began < 6


def test_closing_tags_and_trees():
    nodes, pieces = H.parse("<div><p>a<p>b</div></p></nothing><section>c<li>d</section>e")
    assert [n.tag for n in nodes] == ["html", "div", "p", "p", "section", "li"]
    assert [nodes[n].tag for n, t in pieces if t] == ["p", "p", "section", "li", "html"]
    assert [t for _, t in H.parse("<script src=x/>never</script><style>x</style>a &lt; b &#233;")[1] if t and t.strip()][-1] == "a < b é"


def test_edge_rows(spark):
    long = " ".join(random.Random(1).choices(WORDS, k=200_000))
    pages = spark.createDataFrame([(1, None, "m", "x"), (2, "", "m", "x"), (3, "<p></p>", "m", "x"), (4, framed(f"<article><p>{long}</p></article>"), "m", "x"),
                                   (5, framed("<article><p>" + "Some words here. " * 9 + "</p></article>"), "m", "x")] + [(6, "plain " * 40, "m", "x")] * 2,
                                  "page_id long, html string, main_text string, tag string")
    rows = {r["page_id"]: r for r in H.extract(pages, WORDS).collect()}
    assert rows[1]["main_text"] == rows[2]["main_text"] == rows[3]["main_text"] == "" and rows[4]["main_text"] == long
    assert rows[5]["main_text"] == ("Some words here. " * 9).strip() and rows[6]["main_text"] == ("plain " * 40).strip() and rows[5]["tag"] == "x"
    assert H.extract(pages, WORDS).count() == 7 and H.extract(pages.where("false"), WORDS).collect() == []
    assert H.sample_words(pages.where("false"))
