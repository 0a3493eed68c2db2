"""Main text of pages against planted articles, and templates against full occurrence vectors."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from fixtures import prose
from pyspark.sql import types as T

from tidemark.llm import page_template
from tidemark.llm.page_template import article, broken_classes, spans_of
from tidemark.llm.page_tree import Page

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("host", "text", "tokens", "pages", "salt", "slot", "n_chars", "key")],
    ]
)


def frame(spark, pages, parts=3):
    rows = [(i, url, html, *["x"] * 8) for i, (url, html) in enumerate(pages)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)


def texts_of(result):
    return {r["page_id"]: r["text"] for r in result.collect()}


def plain(html):
    return article(Page(html).blocks, frozenset(), None)


@pytest.mark.parametrize(
    "html, wanted",
    [
        ("", []),
        ("just text &amp; more", ["just text & more"]),
        ("<p>a<p>b <b>c</b><br>d</p>", ["a", "b c d"]),
        ("<article><h1>T&eacute;</h1><p>x\n\t y&nbsp;z</p></article><footer>f</footer>", ["Té", "x y z"]),
        ("<body><nav><a href=/>m</a></nav><main><header><h1>T</h1></header><p>x</p><aside>s</aside></main></body>", ["T", "x"]),
        ('<div class="cookie-bar">c</div><article class="post comments-open"><p>x</p><div id="comments"><p>r</p></div></article>', ["x"]),
        ('<div class="content-with-sidebar"><p>long text here</p></div><div class="sidebar"><p>s</p></div>', ["long text here"]),
        ("<article><script>if (a</p>b) {}</script><p>x<script>y</script>z</p><!-- <p>n</p> --></article>", ["xz"]),
        ("<article><p>a < b and 1<2</p><p>unclosed <a href='x>y</p></article>", None),
        ("<article><ul><li>one<li>two</ul><ul><li><a href=1>m1</a><li><a href=2>m2</a></ul></article>", ["one", "two"]),
        ("<article><form><p>f</p></form><p>x <button>go</button>y</p></article>", ["x y"]),
        ("<article><p>a</p></b></div></p><p>b</p></article>", ["a", "b"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<article><![CDATA[a &amp; b]]></article>", ["a &amp; b"]),
        ("<p>" + "x" * 300_000 + "</p>", ["x" * 300_000]),
    ],
)
def test_single_pages(html, wanted):
    found = plain(html)
    assert found == wanted if wanted is not None else any("a < b" in t for t in found)


def site(draw, host, n, notice, copies=0):
    """Pages whose boxes have names that tell nothing; the article's paragraphs vary in number."""
    pages, wanted = [], []
    shared = [prose(draw, 30) for _ in range(4)]
    for i in range(n):
        paragraphs = shared if i < copies else [prose(draw, draw.randrange(8, 40), 5000) for _ in range(draw.randrange(2, 7))]
        replies = "".join(f"<div class=r{i}><p>{prose(draw, 3, 5000)}</p></div>" for _ in range(draw.randrange(3)))
        html = (
            f"<html><body><div class=x1><a href=/>Start</a><a href=/n>News</a></div><div class=x2><h1>{prose(draw, 4, 5000)}</h1>"
            f"<p>{notice}</p>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div><div class=x3>{replies}</div><div class=x4>About us</div></body></html>"
        )
        pages.append((f"http://{host}/{i}", html))
        wanted.append("\n\n".join([html.split("<h1>")[1].split("</h1>")[0], *paragraphs]))
    return pages, wanted


@pytest.mark.parametrize("broadcast", [page_template.MOST_BROADCAST, 0])
def test_templates_take_away_what_a_host_repeats(spark, broadcast):
    draw = random.Random(4)
    first, wanted = site(draw, "a.example", 40, "We would like to know what you think about this page")
    second, more = site(draw, "B.example", 12, "Another notice of another host")
    # copies of one article on a third of the pages of a host are no template
    third, last = site(draw, "c.example", 15, "Third notice", copies=6)
    result = page_template.main_texts(frame(spark, first + second + third), broadcast, together=10)
    found = texts_of(result)
    assert [found[i] for i in range(67)] == wanted + more + last


def test_a_host_of_copies_keeps_its_article(spark):
    html = "<html><body><div class=a>Menu</div><div class=b><p>" + "</p><p>".join(f"sentence {i} of the one article" for i in range(6)) + "</p></div></body></html>"
    found = texts_of(page_template.main_texts(frame(spark, [(f"http://h.example/{i}", html) for i in range(9)])))
    assert set(found.values()) == {"\n\n".join(f"sentence {i} of the one article" for i in range(6))}


def test_classes_equal_those_of_full_vectors(spark):
    draw = random.Random(9)
    pages, _ = site(draw, "a.example", 30, "notice")
    other, _ = site(draw, "b.example", 4, "too few pages")
    rows = frame(spark, pages + other).select("page_id", "url", page_template.host_of(page_template.F.col("url")).alias("host"), "html")
    made = page_template.classes(rows).collect()
    assert [r["host"] for r in made] == ["a.example"]
    vectors = defaultdict(lambda: [0] * 30)
    for i, (_, html) in enumerate(pages):
        for token, n in Counter(Page(html).tokens).items():
            vectors[token][i] = n
    by_vector = defaultdict(set)
    for token, vector in vectors.items():
        if sum(n > 0 for n in vector) >= 18:
            by_vector[tuple(vector)].add(token)
    wanted = sorted(sorted(c) for c in by_vector.values() if len(c) > 1)
    by_class = defaultdict(list)
    for t in made[0]["tokens"]:
        by_class[t["class"]].append((t["token"], t["text"]))
    assert sorted(sorted(c) for c in by_class.values()) == wanted


def test_order_and_nesting():
    assert spans_of([1, 4, 6, 9], [0, 1, 0, 1]) == [(1, 4), (6, 9)]
    assert spans_of([1, 4, 6], [0, 1, 1]) is None
    member = {(1, False): (7, 0), (2, False): (7, 1), (3, False): (8, 0), (4, False): (8, 1)}
    sequence = lambda *tokens: [(t, False) for t in tokens]
    assert broken_classes(sequence(1, 3, 4, 3, 4, 2), member) == set()
    assert broken_classes(sequence(1, 3, 2, 4, 3, 4), member) == {8}
    assert broken_classes(sequence(2, 1, 3, 4), member) == {7}


def test_odd_rows(spark):
    pages = [(None, None), (None, "<p>x</p>"), ("no host", "<p>y</p>"), ("http:///z", ""), ("http://h.example", "   "), ("http://h.example", "<p>q</p>"), ("http://h.example", "<p>q</p>")]
    rows = page_template.main_texts(frame(spark, pages)).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in rows) == [(i, t, len(t)) for i, t in enumerate(["", "x", "y", "", "", "q", "q"])]
    assert rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}


def test_an_empty_table_has_no_rows(spark):
    assert page_template.main_texts(frame(spark, [])).collect() == []
