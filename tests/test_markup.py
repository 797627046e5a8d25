"""HTML cleaning: handmade cases, properties, and a cross-check with a parser."""

import hashlib
import random
import re
import time
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docquay.functions import markup, naming
from docquay.functions.markup import SPACE_CHARS
from docquay.operators import extraction

CARD = (
    '<li class="each-item"><h2 title="ID-1" class="title big"><b>x</b>Heading &amp; co</h2>'
    '<span class="date"> 11/03/2026 </span><p class="description" title="A v B">..</p>'
    '<span class="refNO">ID-1</span><a href="/x/id-1.html" class="btn btn-primary">View</a></li>'
)


def column(spark, rows, step):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h string")
    return [r.r for r in df.select("i", step(F.col("h")).alias("r")).orderBy("i").collect()]


def cleaned(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, html string")
    return [r.cleaned_html for r in markup.clean_html(df).orderBy("i").collect()]


def test_visible_text(spark):
    cases = {
        "<p> a </p><p>b </p>": "ab",
        "a <!-- x --> b": "ab",
        "a <script>var t='</p>';</script> b": "ab",
        "x &amp;lt; &copy; &#39;&#x1F600; &nbsp;<b> y": "x &lt; © '😀y",
        "cut &ampTo off": "cut &ampTo off",
        "1 < 2 and <3": "1 < 2 and <3",
        '<a title="a > b">t</a>': "t",
        "open <!-- never closed": "open",
        "<style>p{}</style>t<script>never closed": "t",
        "t<template>hidden</template><ruby>k<rt>r</rt></ruby>": "tk",
        "<!DOCTYPE html><?php x ?>t</ >": "t",
        "cut tag <a href='x": "cut tag",
        "&#0;&#xD800;&unknown;&apos;": "��&unknown;'",
    }
    assert column(spark, list(cases), markup.visible_text) == list(cases.values())


def test_container(spark):
    cases = {
        '<div class="main content"><div>in</div>x</div><p>after</p>':
            '<div class="main content"><div>in</div>x</div>',
        '<div class="contents">no</div>': None,
        '<div id="content">no</div>': None,
        '<div data-class="content">no</div>': None,
        "<DIV CLASS=content>up</DIV>": "<DIV CLASS=content>up</DIV>",
        "<div class='a\ncontent'>open<div>x</div>": "<div class='a\ncontent'>open<div>x</div>",
        '<div title="<div" id=a class="content">t</div>z': '<div title="<div" id=a class="content">t</div>',
        '<script>"<div class=content>"</script><p>t</p>': None,
        '<!-- <div class="content">x</div> --><div class="content">y</div>':
            '<div class="content">y</div>',
        '<div class="content">a<br/><div/>b</div>c': '<div class="content">a<br/><div/>b</div>',
        '<section class="content">no</section>': None,
        None: None,
    }
    found = column(spark, list(cases), lambda h: markup.content_container(markup.strip_raw_blocks(h)))
    assert found == list(cases.values())


def test_clean_fallback(spark):
    cases = {
        "<header>h<nav>n</nav></header><nav>a<nav>b</nav>c</nav>T</nav>": "T",
        '<p id="asideNav">1</p><p id=asideNav>2</p>': "<p id=asideNav>2</p>",
        '<div id="globalCookieBar"><div id="asideNav">a</div></div><i id="asideNav">b</i>c': "c",
        '<i class="my-navbar-x">gone<i>x</i></i>stay': "stay",
        '<img class=navbar>z<br class="x navbar">': "z",
        '<span class="firstLetter">F</span><span class="firstLetterX">K</span>':
            '<span class="firstLetterX">K</span>',
        '<b class="Navbar">case</b>': '<b class="Navbar">case</b>',
        "<a href=x>Return to Search</a><a><b>Return to Search</b></a>k": "k",
        "<a><i></i>Return to Search</a>": "<a><i></i>Return to Search</a>",
        "<abbr>Return to Search</abbr>": "<abbr>Return to Search</abbr>",
        "a<noscript>n</noscript>b<!-- c -->": "ab",
        "x<nav>never closed <p>gone": "x",
        None: None,
    }
    assert cleaned(spark, list(cases)) == list(cases.values())


def test_clean_container_keeps_chrome_inside(spark):
    page = (
        '<nav>n</nav><div class="content"><nav>kept</nav><script>x</script>'
        "<p>t<a>Return to Search</a></p></div>"
    )
    assert cleaned(spark, [page]) == ['<div class="content"><nav>kept</nav><p>t</p></div>']


def test_stable_hash(spark):
    page = "<html><body><nav>n</nav>{}<footer>f</footer></body></html>"
    box = '<div class="content"{}><p> one </p>{}<p>two</p></div>'
    rows = [
        page.format(box.format("", "")),
        page.format(box.format(" data-t=1", "<script>s</script><!-- c -->")),
        page.format("<p>one</p><p>two</p>"),
    ]
    plain, noisy, whole = column(spark, rows, naming.stable_html_hash)
    assert plain == noisy == hashlib.sha256(b"onetwo").hexdigest()
    assert whole == hashlib.sha256(b"nonetwof").hexdigest()


def test_bytes_to_text(spark):
    rows = [b"\xef\xbb\xbfa", "é".encode(), b"\x93\xe9\x94", "é😀".encode("utf-16"), b"", None,
            "é😀".encode("utf-16-be"), b"\xfe\xff" + "é😀".encode("utf-16-be"), b"\xff\xfea\x00\x00\xd8", b"\xff\xfea"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, b binary")
    got = df.select("i", markup.html_from_bytes(F.col("b")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == ["a", "é", "“é”", "é😀", "", None,
                                     "\x00éØ=Þ\x00", "é😀", "ÿþa\x00\x00Ø", "ÿþa"]


def test_card_elements_and_fields(spark):
    rows = [
        '<ul><li class="each-item">A<ul><li>n</li></ul></li><li class=each-item>B'
        '<li class="x each-item">C</ul><li>d</li>',
        "<li class='each-items'>no</li>",
    ]
    assert column(spark, rows, lambda h: markup.select_elements(h, "li", "each-item")) == [
        ['<li class="each-item">A<ul><li>n</li></ul></li>', "<li class=each-item>B",
         '<li class="x each-item">C'],
        [],
    ]
    fields = F.array(
        *[f(F.col("h"), *where) for f, where in (
            (markup.attribute_of, ("h2", "title", "title")),
            (markup.own_text_of, ("h2", "title")),
            (markup.own_text_of, ("span", "date")),
            (markup.attribute_of, ("p", "description", "title")),
            (markup.attribute_of, ("a", "btn-primary", "href")),
            (markup.attribute_of, ("a", "none", "href")),
        )]
    )
    assert column(spark, [CARD], lambda h: fields) == [
        ["ID-1", "Heading & co", " 11/03/2026 ", "A v B", "/x/id-1.html", ""]
    ]


def test_large_pages_take_linear_time(spark):
    """Neither many tags nor unlucky text lead to backtracking or deep recursion."""
    many = "".join(f'<p class="a">t{i}</p>' for i in range(30000))
    rows = [
        f'<body>{many}<div class="navbar">q</div></body>',
        "<div class='content'>" + "<div>" * 20000 + "x" + "</div>" * 20001,
        " " * 200000 + "x" + "&nbsp;" * 50000 + "x",
        "<p " + "a='1' " * 50000 + ">x",
        "<li " * 20000 + "navbar",
    ]
    started = time.time()
    lengths = [len(c) for c in cleaned(spark, rows)]
    texts = column(spark, rows, lambda h: F.length(markup.stable_text(h)))
    assert lengths[0] == len(rows[0]) - len('<div class="navbar">q</div>')
    assert lengths[1] == len(rows[1])
    assert texts[1] == 1 and texts[3] == 1
    assert time.time() - started < 60


class Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.raw = [""], None

    def boundary(self, *_):
        self.nodes.append("")

    def handle_starttag(self, tag, attrs):
        self.boundary()
        if tag in markup.RAW_TAGS:
            self.raw = tag

    def handle_endtag(self, tag):
        self.boundary()
        if tag == self.raw:
            self.raw = None

    handle_comment = handle_decl = handle_pi = boundary

    def handle_data(self, data):
        if self.raw is None:
            self.nodes[-1] += data

    def handle_entityref(self, name):
        known = {"amp": "&", "copy": "©", "middot": "·", "quot": '"'}
        self.handle_data(known[name])

    def text(self, html):
        self.feed(html)
        self.close()
        return "".join(n.strip(SPACE_CHARS) for n in self.nodes)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_text_equals_a_parser_on_all_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    rows = pages.select("html", markup.visible_text(F.col("html")).alias("text")).collect()
    assert all(r.text == Text().text(r.html) for r in rows)


fragment = st.lists(
    st.sampled_from([
        "<p>", "</p>", "<div>", "</div>", "<nav>", "</nav>", '<div class="navbar">', "<ul>",
        "<li id=asideNav>", "</li>", "</ul>", "text ", " &amp; ", "<br>", "<!-- c -->",
        "<script>s</script>", '<a href="x">Return to Search</a>', '<b class="lastLetter">L</b>',
        '<div class="content">', "<header>", "</header>",
    ]),
    max_size=25,
).map("".join)
batches = st.lists(fragment, min_size=20, max_size=40)
few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(batches)
def test_cleaning_is_idempotent_and_complete(spark, rows):
    # An id is removed once per pass, so repeated ids need not be gone after one.
    rows = [r.replace("<li id=asideNav>", "<li>", r.count("<li id=asideNav>") - 1) for r in rows]
    once = cleaned(spark, rows)
    assert cleaned(spark, once) == once
    for result in once:
        assert "<script" not in result and "<!--" not in result
        if not result.startswith('<div class="content">'):
            assert not any(m in result for m in ("<nav", "</header", "navbar", "lastLetter", "Return to"))


@few
@given(batches)
def test_noise_does_not_change_the_hash(spark, rows):
    noisy = [
        r.replace("<p>", '<p data-x="1">').replace("</p>", "</p><script>y('<p>')</script><!-- z -->")
        for r in rows
    ]
    assert column(spark, rows, naming.stable_html_hash) == column(spark, noisy, naming.stable_html_hash)


def test_nested_children_boxes_references_charset(spark):
    """Own text behind nested children, all count boxes, references of any length, charsets."""
    rows = [
        ('<h2 class="title"><span><i>x</i></span> Heading</h2>', "Heading"),
        ('<h2 class="title"><input type="hidden"><span><b><i>x</i>y</b></span>Own<b>z</b>rest</h2>', "Own"),
        ('<h2 class="title">Plain</h2>', "Plain"), ('<h2 class="title"><b><i>x</i></b></h2>', ""), ("<p>no</p>", ""),
    ]
    df = spark.createDataFrame(rows, "html string, want string")
    got = df.select("want", F.trim(markup.own_text_of(F.col("html"), "h2", "title")).alias("got"))
    assert all(r.got == r.want for r in got.collect())
    boxes = '<div class="searchhead">Welcome</div><div class="searchhead">1 to 10 of 562 results</div> of 3 results'
    count = spark.createDataFrame([(boxes,)], "html string").select(extraction.result_count(F.col("html")))
    assert count.first()[0] == 562
    text = "&#00000065;&#x0000041;&#99999999999999999999999;&#xFFFFFFFFFFFFFFFFFFFFFF;&#0;"
    got = spark.createDataFrame([(text,)], "t string").select(markup.decode_entities(F.col("t"))).first()[0]
    assert got == "AA���"
    page = '<meta charset="ISO-8859-2"><p>Łódź</p>'
    raw = spark.createDataFrame([(bytearray(page.encode("iso-8859-2")),), (bytearray(page.encode()),)], "c binary")
    assert {r[0] for r in raw.select(markup.html_from_bytes(F.col("c"))).collect()} == {page}


def test_many_hits_take_linear_time(spark):
    def seconds(n):
        page = '<a class="my-navbar-x">t</a>' * n + "<p>end</p>"
        df = spark.createDataFrame([(page,)], "html string")
        started = time.perf_counter()
        assert df.select(markup.strip_class_like(F.col("html"), "navbar")).first()[0] == "<p>end</p>"
        return time.perf_counter() - started

    seconds(100)
    few, many = seconds(10_000), seconds(40_000)
    assert many < 12 * few + 3


def nested_items(page):
    """Items of class c as html parsers close them: by their end, the next item or the end of their list."""
    stack, found = [], []

    def close(entry, end):
        if entry[0] == "hit":
            found.append((entry[1], page[entry[1]:end]))

    for m in re.finditer(r"</?(?:ul|li)[^>]*>", page):
        tag, at, end = m.group(), m.start(), m.end()
        if tag == "<ul>":
            stack.append(("list", at))
        elif tag == "</ul>":
            while stack and stack[-1][0] != "list":
                close(stack.pop(), at)
            if stack:
                stack.pop()
        elif tag == "</li>":
            if stack and stack[-1][0] != "list":
                close(stack.pop(), end)
        else:
            if stack and stack[-1][0] != "list":
                close(stack.pop(), at)
            stack.append(("hit" if "class" in tag else "item", at))
    while stack:
        close(stack.pop(), len(page))
    return [text for _, text in sorted(found)]


def test_items_inside_items(spark):
    draw = random.Random(6)
    parts = ["<ul>", "</ul>", "<li>", '<li class="c">', '<li class="c">', "</li>", "x", "<b>y</b>"]
    pages = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(600)]
    pages += ['<li class="c">' + "<ul><li class=c>" * 300, '<ul><li class="c">1' + '<ul><li class="c">2</ul>' * 3000]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    rows = df.select("i", markup.select_elements(F.col("h"), "li", "c", nested=True).alias("found")).collect()
    for r in rows:
        assert r.found == nested_items(pages[r.i]), pages[r.i]
    # Elements of any other name nest by their own tags.
    page = '<div class="c">1<div>2<div class="c">3</div></div><div class="c">4'
    one = spark.createDataFrame([(page,)], "h string")
    got = one.select(markup.select_elements(F.col("h"), "div", "c", nested=True)).first()[0]
    assert got == [page, '<div class="c">3</div>', '<div class="c">4']


def test_declared_sets_anywhere(spark):
    """A declaration far behind the start counts, one in a comment does not."""
    texts = {
        "iso-8859-2": "<!-- %s --><meta charset=iso-8859-2><p>Łódź</p>" % ("x" * 6000),
        "windows-1251": "<!-- <meta charset=koi8-r> --><meta charset=windows-1251><p>Привет</p>",
        "cp1252": "<!-- <meta charset=koi8-r> --><p>naïve “quote”</p>",
    }
    df = spark.createDataFrame([(k, bytearray(t.encode(k))) for k, t in texts.items()], "k string, c binary")
    assert {r.k: r.t for r in df.select("k", markup.html_from_bytes(F.col("c")).alias("t")).collect()} == texts
