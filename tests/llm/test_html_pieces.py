"""Pieces of text inside articles that very many pages of a host share."""

import random
import time

import pytest

from idloom.llm import html

PAGE = "<body><article><h1>Report</h1><p>own text {n}</p><p>Reprinted by kind permission.</p><ul><li>Home<li>Press</ul><table><tr><td>0<td>{n}</table></article></body>"


def test_pieces_of_articles_recur(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.format(n=i)) for i in range(40)]
    rows += [(100 + i, f"https://b.example/{i}", PAGE.format(n=i)) for i in range(8)]
    got = {r.page_id: r.text for r in html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Report\n\nown text 3\n\n0 3"  # the notice and the links have gone; heading and cells stay
    assert got[103] == "Report\n\nown text 3\n\nReprinted by kind permission.\n\nHome\n\nPress\n\n0 3"


FRAMED = "<body><div class='x1'><span>All sections</span><ul><li>Home<li>World</ul></div><div class='x2'><p>own words {n}</p><p>and {m}</p></div><div class='x3'>Printed {k}</div></body>"


def framed():
    rng = random.Random(5)
    return [(i, f"https://a.example/{i}", FRAMED.format(n=i, m=rng.randrange(9), k=rng.randrange(3))) for i in range(60)]


def plain_templates(rows):
    """Recurring subtrees by counting in Python, from the same hashes."""
    pages = {}
    for _, url, page in rows:
        root = html.parse(page)
        pages.setdefault(url.split("/")[2], {})[html._text(root)] = {d for _, d in html.digests(root)}
    out = set()
    for name, own in pages.items():
        for digest in set().union(*own.values()):
            n = sum(digest in d for d in own.values())
            least, share = html.RULES[digest & 3]
            if (n >= least and n >= share * len(own)) or (digest & 3 != html.PIECE and n >= html.FEW and n >= html.NEARLY_ALL * len(own)):
                out.add((name, digest))
    return out


def test_counting_finds_what_nothing_marks(spark):
    rows = framed()
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {(r.host, r.hash) for r in html.site_templates(table).collect()} == plain_templates(rows)
    got = {r.page_id: r.text for r in html.main_texts(table).collect()}
    for i, _, page in rows:
        assert "All sections" in html.extract(page) and "Printed" in html.extract(page)  # without the counts they stay
        assert got[i].startswith(f"own words {i}") and "Printed" not in got[i] and "Home" not in got[i]


def test_templates_of_the_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = {r.hash for r in html.site_templates(pages).collect()}
    named = [node.name for r in pages.collect() for node, digest in html.digests(html.parse(r.html)) if digest in found]
    assert {"nav", "footer", "div"} <= set(named) and "p" not in named and "article" not in named


@pytest.mark.parametrize("salted", [20_000, 7])
def test_dealt_pages_equal_broadcast(spark, monkeypatch, salted):
    rows = framed() + [(100 + i, url, None if i % 2 else f"<body><p>alone {i}</p></body>") for i, url in enumerate([None, "no url", "http://b.example/1", "http://b.example/2"])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = sorted(map(str, html.main_texts(table).collect()))
    monkeypatch.setattr(html, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(html, "SALTED", salted)
    assert sorted(map(str, html.main_texts(table).collect())) == want and len(want) == len(rows)


HOSTILE = {
    "inline": "<b>" * 150_000 + "</i>" * 150_000, "open": "<a " * 300_000, "quotes": '<a x="' * 150_000 + '>"', "odd": "<a x='" * 150_001, "comments": "<!--" * 200_000,
    "items": "<ul>" + "<b>" * 50_000 + "<li></li>" * 80_000, "deep": "<div>" * 200_000, "raw": "<script></script " * 60_000, "cells": "<table>" + "<td><b>" * 120_000,
    "names": "<a" * 400_000 + ">", "spaces": "<a x=" + " " * 500_000 + "=" * 400_000, "ends": "</" * 400_000, "entities": "&" * 900_000, "less": "<" * 900_000,
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_long_hostile_pages_take_seconds(name):
    began = time.perf_counter()
    root = html.parse(HOSTILE[name])
    html.digests(root)
    html.extract(HOSTILE[name], frozenset([1]))
    assert time.perf_counter() - began < 20


def test_markup_is_read_as_browsers_do():
    assert html.extract("<p>a<p title='x>y'>b<p don't>c<br>d</p>e") == "a\n\nb\n\nc d\n\ne"
    assert html.extract("x <a href=\"q>never closed") == "x never closed"
    assert html.extract("1 < 2 <b>and</b> 3 <4") == "1 < 2 and 3 <4"
    assert html.extract("<p>a</p><!-- <p>b</p> --><p>c</p><!doctype x><?php y ?>d</>e") == "a\n\nc\n\nde"
    assert html.extract("<SCRIPT>if (a</b>c) '</scripty>'</Script >t") == "t"
