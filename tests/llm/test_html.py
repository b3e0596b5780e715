"""Main text of pages."""

import re

import pyarrow as pa
import pytest

from oddrow.llm import html_extract as h

WEIGHTS = {"word": 0.8, "linked": -2.0, "<a>": -2.0, "<p>": -0.25}
SCHEMA = "page_id long, url string, html string, text string"


def page(body, head="<title>T t</title><style>p{a:b}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>A title here</h1><p>First <b>bold<br>line &amp; more.<p>Second\n\n one.</article>"
TEXT = "A title here\n\nFirst bold line & more.\n\nSecond one."
NAV = '<nav><ul><li><a href="/x">The menu</a></li></ul></nav>'


@pytest.mark.parametrize(
    "around",
    [
        NAV + "{}",
        '<div class="ad">Buy a great many things here today now.</div>{}',
        "<header><p>Site name and slogan</p></header>{}<footer>&copy; all rights of us</footer>",
        '{}<aside>Sidebar with a lot of words in it</aside><div class="comments"><p>I disagree.</div>',
        "<script>var t='</p><article>no</article>';</script>{}<form>Name <input> words</form>",
        '<div id="cookie-notice">We use cookies as you know</div>{}<!-- <p>gone</p> -->',
        '<div role="navigation">A B C D E F</div>{}<p hidden>not seen at all</p>',
    ],
)
def test_the_article_is_found(around):
    assert h.extract(page(around.format(ARTICLE)), WEIGHTS) == TEXT


def test_parts_inside_the_article_are_left_out():
    inside = ARTICLE.replace(
        "<p>Second", '<div class="advert">Buy this now</div><section id="comments">Bad!</section><p>Second'
    )
    assert h.extract(page(inside), WEIGHTS) == TEXT


def test_pages_without_a_marked_article():
    body = (
        NAV + '<div class="post has-sidebar"><h2>A title</h2><p>Some words are here.<p>And more of '
        'them follow.</p></div><div class="widget">Other words</div><p><a href=1>One</a> <a href=2>Two</a>'
    )
    assert h.extract(page(body), WEIGHTS) == "A title\n\nSome words are here.\n\nAnd more of them follow."


def test_blocks_of_lists_tables_and_entities():
    body = "<main><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>x&nbsp;y &#233;&lt;p&gt;</main>"
    assert h.extract(page(body), WEIGHTS) == "one\n\ntwo\n\na\n\nb\n\nx y é<p>"


@pytest.mark.parametrize(
    "source", [None, "", "   ", "<html></html>", "<script>only code", page(NAV), "<!-- open", "< <"]
)
def test_pages_without_text(source):
    assert h.extract(source, WEIGHTS) in ("", "< <")


def test_plain_text_and_very_long_pages():
    assert h.extract("just words & <no tag", WEIGHTS).startswith("just words")
    body = "<article>" + "<p>some words of text" * 20_000 + "</article>"
    assert h.extract(page(body), WEIGHTS).count("\n\n") == 19_999
    assert h.extract("<div>" * 3_000 + "deep words" + "</div>" * 3_000, WEIGHTS) == "deep words"


def test_best_run_is_the_maximum():
    assert h.best_run([-1, 2, -1, 3, -5, 1]) == (1, 4)
    assert h.best_run([-1, -2]) == (0, 0) == h.best_run([])
    assert h.best_run([1, -1, 1]) == (0, 1)


def test_weights_from_labelled_pages(spark):
    rows = [(i, "u", page(NAV + ARTICLE + "<footer>x</footer>"), "clash") for i in range(20)]
    rows += [(None, None, page("<p>no label"), None), (21, "u", None, "x"), (3, "u", rows[3][2], "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    weights = h.train(pages)
    assert weights["word"] > 0 and weights["linked"] < 0 and weights["<p>"] < 0
    got = h.main_text(pages, weights).collect()
    assert sorted(r["text"] for r in got) == sorted([TEXT] * 21 + ["no label", ""])
    empty = pages.filter("false")
    assert h.main_text(empty, h.train(empty)).collect() == []


INLINE_OUT = [
    '<span class="share">x</span>', "<span hidden>x</span>", '<span aria-hidden="true">x</span>',
    '<a class="social" href="/s">x</a>', "<b style='display:none'>x <i>y</i></b>",
]


@pytest.mark.parametrize("out", INLINE_OUT)
def test_text_around_a_left_out_inline_element_stays(out):
    for body, text in [
        (f"<p>{out} Hello big world</p>", "Hello big world"),
        (f"<p>Hello {out} big world</p>", "Hello big world"),
        (f"<p>Hello big world {out}</p>", "Hello big world"),
        (f"<p>First words here.</p><p>Closing words of it {out}</p>", "First words here.\n\nClosing words of it"),
    ]:
        assert h.extract(page(body), WEIGHTS) == text
        assert h.extract(page(f"<article>{body}</article>"), WEIGHTS) == text


LINKS = '<ul class="zz"><li><a href="/1">One other story</a><li><a href="/2">Two more of them</a></ul>'
THREAD = "".join(
    f'<div class="zz"><a href="/u{i}">User number {i}</a> so <a href="/r">Answer to this</a></div>'
    for i in range(3)
)


@pytest.mark.parametrize("clutter", [LINKS, THREAD])
@pytest.mark.parametrize("wrapper", ["article", "main", 'div id="page"', "section"])
def test_unmarked_clutter_in_the_wrapper_of_the_text_is_cut(wrapper, clutter):
    first, last = "Some words of the text that stand before", "and some more of them that follow it to its end here."
    text = f"<h2>A title here</h2><p>{first} <a href=3>one</a> link</p><p>{last}</p>"
    expected = f"A title here\n\n{first} one link\n\n{last}"
    for body in (clutter + text, text + clutter, clutter + text + clutter):
        made = page(f"<{wrapper}>{body}</{wrapper.split()[0]}>")
        assert h.extract(made, WEIGHTS) == expected


def test_the_weights_decide_the_text():
    body = page("<article><p>Some words of it.</p><table><tr><td>x<td>y</table></article>")
    assert h.extract(body, {"word": 1.0}) == "Some words of it.\n\nx\n\ny"
    assert h.extract(body, {"word": 1.0, "<td>": -3.0}) == "Some words of it."


@pytest.mark.parametrize(
    "kept",
    [
        '<h2 id="related-work">{}</h2>', '<section id="discussion">{}</section>', '<h3 id="menu-options">{}</h3>',
        '<h2 id="cookies">{}</h2>', '<section id="social-sciences">{}</section>', '<h2 class="search">{}</h2>',
    ],
)
@pytest.mark.parametrize("wrapper", ["article", "div"])
def test_names_of_chapters_cut_no_text(wrapper, kept):
    rest = "<p>Some words are here and more of them follow here.</p>"
    body = f"<{wrapper}>{rest}{kept.format('Words of a chapter')}{rest}</{wrapper}>"
    assert "Words of a chapter" in h.extract(page(body), WEIGHTS).split("\n\n")


@pytest.mark.parametrize(
    "wrapper",
    ['form action="/x" id="aspnetForm"', 'div class="sidebar-right"', 'div id="layout-sidebar-left"', 'div role="form"'],
)
def test_wrappers_of_the_whole_page_are_kept(wrapper):
    name = wrapper.split()[0]
    for body, text in [(ARTICLE, TEXT), ("<p>Some words are here.</p>", "Some words are here.")]:
        body = f'<{wrapper}>{body}<div class="ad">Buy</div><form>Name</form></{name}>'
        assert h.extract(page(NAV + body), WEIGHTS) == text


def test_parts_that_outweigh_a_marked_text_are_no_wrappers():
    long = "<p>" + "other words " * 30 + "</p>"
    for part in (f'<div class="sidebar">{long}</div>', f'<div class="post-comments">{long}</div>'):
        assert h.extract(page(f"<main>{ARTICLE}{part}</main>"), WEIGHTS) == TEXT


def test_quotes_open_a_value_only_after_an_equals_sign():
    assert h.extract("<p title=Bob's>First text that's here.</p><p>More</p>", WEIGHTS).startswith("First text")
    assert h.extract("<p title='a > b' alt=\"it's > c\" hidden>gone</p><p it's>Text</p>", WEIGHTS) == "Text"


LONG = "some words of a longer text " * 12


def test_marks_and_names_do_not_limit_the_text():
    assert h.extract(page("<main><h2>x</h2></main><p>long text of many words</p>"), WEIGHTS).endswith(
        "long text of many words"
    )


def test_formulas_and_icons_stay_in_their_paragraph():
    body = "<p>We have <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <svg><text>no</text></svg>so on.</p>"
    assert h.extract(page(body), WEIGHTS) == "We have x=2 and so on."


@pytest.mark.parametrize("names", ["user-feedback", "reader-comments", "customer_reviews list"])
def test_reader_comments_are_left_out(names):
    thread = f'<div class="{names}"><p>I do not agree with this at all, my friend.</p></div>'
    assert h.extract(page(f"<article><p>{LONG}</p></article>{thread}"), WEIGHTS) == LONG.strip()


def labelled(i):
    """A page of plain words, with an advert beside its article."""
    nav = "".join(f'<li><a href="/{k}">entry{k}</a></li>' for k in range(6))
    paragraphs = "".join(f"<p>{LONG}{i} {k}.</p>" for k in range(1 + i % 4))
    return page(
        f'<nav><ul>{nav}</ul></nav><div class="ad">Buy these eight good things here now {i}.</div>'
        f"<article><h1>Title {i}</h1>{paragraphs}</article><footer>&copy; owner of page</footer>"
    )


def bare(source):
    """The same page without marks and names."""
    source = re.sub(r'\s(class|id|role)="[^"]*"', "", source)
    return re.sub(r"<(/?)(article|main|nav|aside|footer|header)\b[^>]*>", r"<\1div>", source)


def test_learned_weights_find_the_text_without_marks_and_names():
    sources = [labelled(i) for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(sources)], names=["html"])
    counts = {
        r["kind"]: (r["inside"], r["outside"]) for b in h._label_counts([batch]) for r in b.to_pylist()
    }
    weights = h.weights_from(counts)
    assert len({w for k, w in weights.items() if w < -0.05}) > 3  # not one limit for all
    for i, source in enumerate(sources):
        expected = [f"Title {i}", *(f"{LONG}{i} {k}." for k in range(1 + i % 4))]
        assert h.extract(source, weights).split("\n\n") == expected
        assert h.extract(bare(source), weights).split("\n\n") == expected


def test_the_scan_cuts_unmarked_clutter_of_marked_parts():
    """What the scan keeps is less than all blocks of the marked part."""
    inside = f"<article><p>{LONG}</p><div>Buy these good things</div></article>"
    weights = {"word": 0.4, "<div>": -2.9}
    assert h.extract(page(inside), weights) == LONG.strip()
    assert h.extract(page(inside), {"word": 0.4}) == f"{LONG.strip()}\n\nBuy these good things"


def test_names_with_positive_weights_are_text():
    body = f'<div class="sidebar"><p>Words in it</p></div><p>{LONG}</p>'
    assert h.extract(page(body), WEIGHTS) == LONG.strip()
    assert h.extract(page(body), WEIGHTS | {"word@part": 0.5}).startswith("Words in it")
