"""How broken markup is read."""

import subprocess
import sys
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vulnloom.operators.html_scan import (
    PIECE_OR_LEAF, LinkRecord, PageRecord, Tokenizer, attributes_of, read_advisory, read_links, read_title,
)


def text_of(html, tag="p"):
    page = PageRecord(html)
    return page.text(page.first(0, tag))


@pytest.mark.parametrize("html, text", [
    ("<p>foo<b>bar</b></p>", "foo bar"),
    ("<p> a \u00a0\u2003\x1c b </p>", "a b"),
    ("<p>a<!-- x -->b</p>", "a b"),
    ("<p>a<?pi x>b</p>", "a b"),
    ("<p>a<![CDATA[ c ]]>b</p>", "a c b"),
    ("<p>a<br>b<br/>c</p>", "a b c"),
    ("<p>a<br></br>b</p>", "a b"),
    ("<p>fo</i>o</p>", "fo o"),                      # a stray end tag still ends a run
    ("<p>a<script>s</script><style>t</style>b</p>", "a b"),
    ("<p>a<template>x<i>y</i></template>b</p>", "a b"),
    ("<p>a<ruby>k<rp>(</rp><rt>r</rt></ruby></p>", "a k"),
    ("<p>&lt;b&gt; &amp;amp; &eacute; &#233; &#xe9;</p>", "<b> &amp; é é é"),
    ("<p>&#147;q&#148; &#129;</p>", "\u201cq\u201d \x81"),
    ("<p>&nosuch; x &nosuch y</p>", "&nosuch x &nosuch y"),
    ("<p>AT&T & x &</p>", "AT&T & x &"),
    ("<p>&#xD800;|&#99999999;|&#0;|</p>", "\ufffd|\ufffd|\x00|"),
    ("<p>a &copy b</p>", "a \u00a9 b"),
    ("<p>one<p>two</p>three</p>", "one two three"),  # nothing is closed implicitly
    ("<p>open <b>bold", "open bold"),
    ("<p>a <x.y> b</p>", "a b"),
    ("<p>1 < 2</p>", "1 < 2"),
    ("<p></p>", ""),
])
def test_text(html, text):
    assert text_of(html) == text


def test_own_text_of_special_elements():
    assert text_of("<script>let a = '<b>';</script>", "script") == "let a = '<b>';"
    assert text_of("<template>x<i>y</i></template>", "template") == "x y"
    page = PageRecord("<template><i>y</i></template>")
    assert page.text(page.first(0, "i")) == ""


def test_solid_text():
    page = PageRecord("<pre> {\n <b> a </b>:\u00a0<i>1</i> <!-- --> } </pre>")
    assert page.solid_text(page.first(0, "pre")) == "{a:1}"


def values_in(html):
    page = PageRecord(html)
    return [(page.text(dt), None if dd is None else page.text(dd)) for dt, dd in page.values(0)]


@pytest.mark.parametrize("html, values", [
    ("<div><dl><dt>A<b><i>x</dt><dd>v</dd></dl></div><dd>out</dd>", [("A x", "v")]),  # closed up to the dt
    ("<div><dt>A</dt></div><dd>v</dd>", [("A", None)]),                                # beside, not anywhere
    ("<dl><dt>A</dt><dd/>text<dd>v</dd></dl>", [("A", "")]),                           # self-closed, empty
    ("<dt>A</dt><p>x</p><dd>v</dd><dt>B</dt><dt>C</dt><dd>w</dd>", [("A", "v"), ("B", "w"), ("C", "w")]),
    ("<dt>A<dd>v", [("A v", None)]),                                                   # nested, so not beside
    ("<dd>v</dd><dt>A</dt><dd>w<dt>B</dt><dd>x", [("A", "w B x"), ("B", "x")]),
])
def test_values(html, values):
    assert values_in(html) == values


@pytest.mark.parametrize("cls, found", [
    ("a", True), ("x a\n y", True), ("A", False), ("ab", False), ("x\u00a0a", True), ("", False),
])
def test_class_is_a_whole_token(cls, found):
    assert (PageRecord(f'<p class="{cls}">').first(0, cls="a") is not None) == found


def test_links():
    html = (
        '<a href="/1">x</a><A HREF=/2><a>n</a><a href>e</a><a href="/3" href="/4">d</a>'
        '<a href="/5?a=1&amp;b=2">q</a><!-- <a href="/no"> --><script>"<a href=/no>"</script>'
    )
    assert read_links(html)["anchors"] == ["/1", "/2", "", "", "/4", "/5?a=1&b=2"]


def test_first_heading():
    assert read_title("<p>x</p><h1 class='t'>b<i>c</i></h1><h1>d</h1>")["title"] == "b c"
    assert read_title("<p>")["title"] == ""


def test_nothing_fetched():
    assert read_advisory(None) == {"has_page": False, "has_details": False}
    assert read_links(None) == {"anchors": []} and read_title(None) == {"title": ""}


def entries(body):
    html = f'<p class="vulnerability-page"><dl class="vulnerability-details">{body}'
    return [(e["label"], e["has_dd"], e["value"], e["anchors"]) for e in read_advisory(html)["details"]]


def test_entries_that_decide_a_lookup_are_kept():
    assert entries(
        "<dt>Other</dt><dd>x</dd><b><dt>Source</dt></b><i><dt>Source</dt></i><dt>SOURCE</dt><dd>a</dd>"
        "<dt>Source</dt><dd>b</dd><dt>Source</dt><dd><a>c</a><a href=/d></a></dd><dt>Source</dt><dd><a>e</a></dd>"
        "<dt>Source of all evil, at length</dt><dd>f</dd><dt></dt><dd>g</dd><dt>Import\n <b>source</b></dt><dd>h</dd>"
    ) == [
        ("source", False, None, []), ("source", True, "a", []), ("source", True, "c", [None, "/d"]),
        ("import source", True, "h", []),
    ]


@pytest.mark.parametrize("piece", [
    "<b>", "<p>x<i></p>", "<br>", "</br></x>", "&amp;", "<dd>", "x<dt>", "<dt>Summary</dt><dd>x", "<dt>Summary<dd>",
    "<dt>Summary</dt>", "<dt>Summary</dt><dd>x</dd>", "<dt>x</dt><dd><a>", "<dt>Source</dt><dd><a>", "<pre class=specific>x</pre>", "<h3>", "<a href=/x>",
])
def test_time_grows_with_the_page(piece):
    def seconds(n):
        html = '<div class="vulnerability-page"><dl class="vulnerability-details">' + piece * n
        start = time.perf_counter()
        read_advisory(html)
        read_links(html)
        return time.perf_counter() - start

    seconds(1000)
    small, large = min(seconds(4000) for _ in range(3)), min(seconds(40000) for _ in range(3))
    assert large < max(small, 0.005) * 40


# -- the fast reading of regular markup against the tokenizer alone

PIECES = [
    "text ", "a<b>", "<b>", "</b>", "<p>", "</p>", "<br>", "<br/>", "<br />", "</br>", "<hr>", "</hr>",
    "<div class=\"a b\">", "</div>", "<DIV CLASS='a'>", "</DIV >", "<dl>", "<dt>", "</dt>", "<dd/>", "<dd>", "</dl>",
    '<a href="/x?a=1&amp;b=2">', "<a href='/y'>", "<a href=/z/>", "<a href>", "<a href=\"\">", "<a href=/q class=k>",
    '<a\thref="/n"\n class="c" >', '<a href="/1" href="/2">', '<a href="/1"class="k">', "<a href = '/s'>",
    '<a href="/?a=1&b=2">', '<a href="/&copy=1">', '<a href="&#x41;&#66;">', "<a/href=/p>", "<a b/>", "<a b=c/>",
    '<a href="<b>">', "<a href='>'>", '<a\x0bhref="/v">', "<a href=/w>", "<a x:y.z-1=2>", "<a =x>", "<a \"q\">",
    "<a x=\"1\" / y=2>", "<a b=`c`>", "<x.y>", "<x:y>", "<1>", "< p>", "</ p>", "</p x>", "</>", "</1>", "<>", "<",
    "&amp;", "&lt;", "&copy", "&copy;", "&nosuch;", "&nosuch ", "&a-b;", "&a.b ", "&", "& ", "&&", "&;", "&#65;",
    "&#65", "&#x41;", "&#xZ;", "&#", "&#;", "&#147;", "&#129;", "&#55296;", "&#0;", "&#1114112;", "&x1y;",
    "<!-- c -->", "<!-- a - b -->", "<!---->", "<!-->", "<!--->", "<!-- a -- b -->", "<!-- x --!>", "<!-- <b> -->",
    "<!-- a --->", "<!--x--", "<!-- open", "<!DOCTYPE html>", '<!doctype html PUBLIC "-//W3C//DTD">', "<!DOCTYPE",
    "<!ELEMENT x>", "<![CDATA[ d ]]>", "<![CDATA[ <b> ]]>", "<!x>", "<?pi x>", "<?xml version='1.0'?>", "<?",
    "<script>", "</script>", "<script>a<b</script>", '<script src="/s">var t="</p>";</script >', "<script/>",
    "<script>a</ script>b</script>", "<SCRIPT>x</Script>", "<script><!-- </script>", "<style>p{}</style>", "<style>",
    "<title>t &amp; u</title>", "<title>a<b>c</title>", "<title>", "<textarea>x</textarea>", "<textarea><b></textarea>",
    "<template>", "</template>", "<rt>", "</rt>", "<iframe><b></iframe>", "<xmp><b></xmp>", "<plaintext>",
    "\x00", "\r\n", " ", "é\U0001f600", "]]>", "-->", "/>", "\"", "'", "=",
]


def contents(page):
    return {k: v for k, v in vars(page).items() if not k.startswith("_")}


def readings(html):
    """(fast, tokenizer alone), each with the links; an exception stands for itself."""
    out = []
    for fast in (True, False):
        try:
            with pytest.MonkeyPatch.context() as m:
                if not fast:
                    m.setattr(PageRecord, "_read_regular", lambda self, html: 0)
                page = PageRecord(html)
                links = [href or "" for href in page.links(0)]
                out.append((contents(page), LinkRecord(html).hrefs if fast else links))
        except AssertionError as e:
            out.append(str(e))
    return out


def test_both_readings_agree_on_pairs():
    for first in PIECES:
        for second in PIECES:
            fast, alone = readings(first + second)
            assert fast == alone, (first, second)


@settings(max_examples=4000, deadline=None, database=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25))
def test_both_readings_agree(pieces):
    html = "".join(pieces)
    fast, alone = readings(html)
    assert fast == alone


@settings(max_examples=2000, deadline=None, database=None)
@given(st.text(st.sampled_from(list("<>/!-?&#;=\"' \nab1x[]")), max_size=30))
def test_both_readings_agree_on_noise(html):
    fast, alone = readings(html)
    assert fast == alone


def test_regular_pages_are_read_fast(monkeypatch):
    from golden import FULL

    def refuse(self, html):
        raise AssertionError(html[:60])

    monkeypatch.setattr("vulnloom.operators.html_scan.Tokenizer.read", refuse)
    assert read_advisory(FULL)["has_page"]
    assert len(read_links("<!DOCTYPE html><title>t</title><style>a{}</style>" + FULL)["anchors"]) == 11


BITS = [
    "<dt>Source</dt>", "<dt>SOURCE", "<dt>Severity</dt>", "<dt>References</dt>", "<dt>x</dt>", "</dt>", "<dd>a</dd>",
    "<dd>", "</dd>", "<a href=/1>l</a>", "<a>", "</a>", "text", "<div>", "</div>", "<dl>", "</dl>",
]


def lookups(entries, label):
    """What the three lookup rules find, as (value, first link, first entry)."""
    mine = [e for e in entries if e[0] == label]
    return (
        next((value for _, has, value, _ in mine if has), ""),
        next((links[0] or "" for _, has, _, links in mine if has and links), ""),
        mine[0] if mine else None,
    )


@settings(max_examples=1500, deadline=None, database=None)
@given(st.lists(st.sampled_from(BITS), max_size=24))
def test_kept_entries_decide_as_all_entries_would(bits):
    body = "".join(bits)
    page = PageRecord(f'<p class="vulnerability-page"><dl class="vulnerability-details">{body}')
    everything = [
        (page.text(dt).lower(), dd is not None, None if dd is None else page.text(dd),
         [] if dd is None else page.links(dd))
        for dt, dd in page.values(page.first(0, "dl"))
    ]
    kept = entries(body)
    for label in ("source", "severity", "references"):
        assert lookups(kept, label) == lookups(everything, label)


def test_elements_of_text_alone_are_read_at_once():
    html = '<dt class="a">x</dt><dd> y </dd><br>n</br><script>s</script><B>z</B><i>p</b></i><u/>q</u>'
    assert [piece[0] for piece in PIECE_OR_LEAF.finditer(html)][:2] == ['<dt class="a">x</dt>', "<dd> y </dd>"]
    whole, page = PageRecord(""), PageRecord(html)
    whole._open, whole.tags, whole.attrs, whole.parents, whole.ends = [0], [""], [{}], [-1], [0]
    whole.text_from, whole.text_to, whole.texts = [0], [0], []
    Tokenizer(whole).read(html)
    whole._end_run()
    while whole._open:
        whole._pop()
    for column in ("tags", "attrs", "parents", "ends", "text_from", "text_to", "texts"):
        assert getattr(page, column) == getattr(whole, column)
    assert attributes_of(' class="a"') is attributes_of(' class="a"')
    long = f' href="{"x" * 200}"'
    assert attributes_of(long) == {"href": "x" * 200} and attributes_of(long) is not attributes_of(long)


def test_the_reader_travels_without_this_package(tmp_path):
    from pyspark import cloudpickle

    from vulnloom.operators import parse

    html = '<div class="vulnerability-page"><dl class="vulnerability-details"><dt>Source</dt><dd>x</dd></dl></div>'
    job = tmp_path / "reader"
    job.write_bytes(cloudpickle.dumps((parse.html_scan.read_advisory, html)))
    code = f"import pickle; read, html = pickle.load(open({str(job)!r}, 'rb')); print(read(html))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == str(read_advisory(html)), out.stderr
