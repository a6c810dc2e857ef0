from html.parser import HTMLParser
from math import e, log

import duckdb
import pytest

from brandbook.llm import html_text as H
from tests import oracle

LONG = "word " * 40


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<br>c&nbsp;d", "a\nb c d"), ("<script>var x='<p>no</p>'", ""), ("<!-- <p>no</p> --><p>yes", "yes"),
        ("a < b <3 & c", "a < b <3 & c"), ("<table><tr><td>one<td>two<tr><td>three</table>", "one\ntwo\nthree"), ("<ul><li>x<li>y</ul>", "x\ny"),
        (f"<nav><p>{LONG}</nav><article><header><h1>T</h1></header><p>{LONG}<p>s</article><aside>{LONG}</aside>", f"T\n{LONG.strip()}\ns"),
        (f"<form id=aspnet><main><p>{LONG}</p><p>b</p></main></form>", f"{LONG.strip()}\nb"), (f"<form><p>{LONG}</p></form><p>left</p>", "left"),
        (f"<div class='post'><p>{LONG}</p><p>{LONG}</p></div><div class='ad-box'>{LONG}</div><div id='userComments'><p>{LONG}</div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<div><p>{LONG}</p><p>{LONG}</p></div><div>" + "<p><a href=x>more links</a></p>" * 12 + "</div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<div role=navigation>{LONG}</div><p hidden>x</p><p style='display: none'>x</p><p>kept</p>", "kept"), ("<p>x</div></p></span>y", "x\ny"), ("<article><p>cut o", "cut o"),
        ("<p title=it's>one</p><p title='a>b' x=\"c>d\">two</p>", "one\ntwo"), ("<p>a</p><a href=\"x>rest <p>of it", "a"), ("<p>a</p>" + "<a b=\"" * 20_001, "a"),
        (f"<article><p>{LONG}</p><div class=promo><p>buy</article><footer>f", LONG.strip()),
    ],
)
def test_pages(html, text):
    assert H.main_text(html) == text


def test_density_by_the_formula():
    root, nodes = H.parse("<div><p>abcdefghij</p><p>xyz<a>lin</a></p></div>")
    H.measure(root, nodes)
    by = {n.tag + str(n.chars): n for n in nodes}
    assert by["p10"].density == pytest.approx(10 * log(10) / log(log(10 / 10 * 1 + 3 / 16 * 10 + e)))
    assert by["p6"].density == pytest.approx(6 / 1 * log(6 / 3) / log(log(6 / 3 * 3 + 3 / 16 * 6 + e)))
    # the div's last run is empty, each p's run is as dense as the p itself but for the link's tag
    assert by["div16"].sum == pytest.approx(by["p10"].density + by["p6"].density)
    assert by["p10"].sum == pytest.approx(by["p10"].density)
    assert root.best is by["div16"]


def test_deep_and_long(spark):
    deep = "<div>" * 20_000 + "core"
    long = "<article>" + "".join(f"<p>p{i} {LONG}</p>" for i in range(3000))
    frame = spark.createDataFrame([(1, "u", deep, "t"), (2, None, long, "t"), (2, None, None, "t")], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text[:4], r.n_chars, len(r.text)) for r in H.extract(frame).collect()]
    assert [g[:2] for g in got] == [(1, "core"), (2, "p0 w"), (2, "")] and all(g[2] == g[3] for g in got)
    assert H.extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "html",
    [
        f'<article class="post hentry category-social tag-search"><p>{LONG}</p></article>', f'<article class="widget social"><p>{LONG}</p></article>',
        f'<div id=page class="layout has-sidebar no-comments"><p>{LONG}</p></div>', f'<div class="search-page"><article><p>{LONG}</p></article></div>', f'<div class="social"><main><p>{LONG}</p></main></div>',
        f'<div class="related-wrapper"><p>{LONG}</p></div>', f'<span class="share-root"><article><p>{LONG}</p></article></span>',
        f'<article><p>{LONG}</p></article><section id=comments><article class="comment-body"><p>{LONG}{LONG}</p></article></section>', f'<article><p>{LONG}</p></article><div class=comments><p>{LONG}{LONG}{LONG}</p></div>',
    ],
)
def test_names_that_hold_the_article(html):
    assert H.main_text(html) == LONG.strip()


MENU = "<div class=q1><ul>" + "".join(f"<li><a href=/{i}>go to {i}</a></li>" for i in range(12)) + "</ul></div>"
PARTS = [f"part {i} {LONG}".strip() for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARTS)


@pytest.mark.parametrize(
    "html",
    [
        f"<div class=content-with-sidebar>{BODY}</div>", f"<div id=page class=no-sidebar><main>{BODY}</main></div>", f"<article class='post comments-open'>{BODY}</article>", f"<div class='post has-share'>{BODY}</div>",
        f"<div class=copyright-law>{BODY}</div>", f"<article><section id=related-work>{BODY}</section></article>", f"<h1>{PARTS[0]}</h1><div class=c>{BODY[BODY.index('</p>') + 4:]}</div>",
        f"<form action=/x>{MENU}<div class=q2>{BODY}</div></form>", f"<div class='layout sidebar-left'><div class=col>{MENU}</div><div class=col2>{BODY}</div></div>", f"<table><tr><td>{MENU}<td>{BODY}</table>",
        f"<span class=share-root><div>{BODY}</div></span>", f"<div>{BODY}</div><div class=q3><a href=x>one</a> | <a href=y>two</a></div>",
    ],
)
def test_articles_are_whole_among_names_and_menus(html):
    assert H.main_text(MENU + html) == "\n".join(PARTS)


def test_density_decides_without_names(monkeypatch):
    page = f"{MENU}<div class=q2>{BODY}</div>{MENU}"
    lines = MENU + "<div>" + "<br><br>".join(PARTS) + "</div>"
    assert H.main_text(page) == "\n".join(PARTS) and H.main_text(lines) == " ".join(PARTS)
    monkeypatch.setattr(H, "select", lambda root, nodes: setattr(root, "taken", True))
    assert "go to 3" in H.main_text(page) and "go to 3" in H.main_text(lines)


class Slow(HTMLParser):
    """The tree of a page without misnesting or names, by the standard library: lists of texts and (tag, children)."""

    def __init__(self, html):
        super().__init__()
        self.open = [("body", [])]
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body", "meta"):
            return
        if tag == "p" or tag in H.BLOCKS:
            while any(t == "p" for t, _ in self.open):
                self.open.pop()
        tag = "aside" if ("class", "ad") in attrs else tag
        self.open[-1][1].append(node := (tag, []))
        if tag != "br":
            self.open.append(node)

    def handle_endtag(self, tag):
        if tag not in ("html", "body") and any(t == tag or t == "aside" and tag == "div" for t, _ in self.open):
            while self.open.pop()[0] not in (tag, "aside" if tag == "div" else tag):
                pass

    def handle_data(self, data):
        self.open[-1][1].append(data)


def brute(html):
    """The same selection with every count taken anew by walking the tree."""
    body = Slow(html).open[0]
    drop, bad = ("script", "style", "head", "title"), ("nav", "aside", "footer")
    block = lambda n: n[0] in H.BLOCKS or n[0] == "body"

    def walk(node, link=False, tags=0):
        """(text, within a link) and None for each tag below."""
        for x in node[1]:
            if isinstance(x, str):
                yield x, link
            elif x[0] not in drop:
                yield None, link or x[0] in ("a", *bad), x[0]
                yield from walk(x, link or x[0] in ("a", *bad))

    def counts(node):
        size = lambda s: len(" ".join(s.split()))
        if node[0] in bad:
            return 0, 0, 0, 0
        seen = [*walk(node)]
        texts, tags = [x for x in seen if x[0] is not None], [x for x in seen if x[0] is None]
        return sum(size(t) for t, _ in texts), len(tags), sum(size(t) for t, link in texts if link), sum(link for _, link, _ in tags)

    c, _, lc, _ = counts(body)
    share = lc / max(1, c)
    dense = lambda node: H.density(*counts(node), share)

    def runs(node):
        run = ("run", [])
        for x in node[1]:
            if not isinstance(x, str) and (x[0] in drop or block(x)):
                if x[0] not in drop:
                    yield run
                    run = ("run", [])
                continue
            run[1].append(x)
            inner = [] if isinstance(x, str) else [x, *(n for n in x[1] if not isinstance(n, str))]
            if any(n[0] == "br" for n in inner):
                yield run
                run = ("run", [])
        yield run

    def inner_blocks(node):
        """Block children, those within inline elements too."""
        for x in node[1]:
            if not isinstance(x, str) and x[0] not in drop:
                yield from [x] if block(x) else inner_blocks(x)

    every, up = [], {}

    def collect(node):
        every.append(node)
        for x in inner_blocks(node):
            if x[0] not in bad:
                up[id(x)] = node
                collect(x)

    collect(body)
    total = {id(n): sum(map(dense, (x for x in inner_blocks(n) if x[0] not in bad))) + sum(map(dense, runs(n))) for n in every}
    core = max(every, key=lambda n: total[id(n)])
    article = next((n for n in every if n[0] == "article"), None)
    return core, article


def text_of(node):
    out, run = [], []

    def end():
        if words := " ".join("".join(run).split()):
            out.append(words)
        run.clear()

    def go(n):
        for x in n[1]:
            if isinstance(x, str):
                run.append(x)
            elif x[0] == "br":
                run.append(" ")
            elif x[0] in H.BLOCKS:
                end()
                go(x)
                end()
            else:
                go(x)

    go(node)
    end()
    return "\n".join(out)


@pytest.mark.skipif(not oracle.DATA.exists(), reason="the driver's tables aren't here")
def test_the_driver_pages_against_a_slow_extractor():
    rows = duckdb.sql(f"SELECT html FROM '{oracle.DATA / 'pages.parquet'}'").fetchall()
    agree = [H.main_text(h) == text_of(brute(h)[1]) for (h,) in rows if h]
    inside = sum(brute(h)[0] is brute(h)[1] or text_of(brute(h)[0]) in text_of(brute(h)[1]) for (h,) in rows if h)
    assert all(agree) and len(agree) > 10 and inside == len(agree)
