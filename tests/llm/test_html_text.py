import html
import re
import time

import pytest

from tests.llm.helpers import SF_DIR
from tickloom.llm.html_text import extract, main_text

ARTICLE = "<h1>A title &amp; more</h1><p>First  paragraph\nwith <b>bold</b> and <a href=x>a link</a> in it.</p><p>Second, as long as the first one is.</p>"
LINES = "A title & more\nFirst paragraph with bold and a link in it.\nSecond, as long as the first one is."


@pytest.mark.parametrize(
    "around",
    [
        "<html><head><title>t</title><style>p{}</style></head><body>%s</body></html>",
        "<body><nav><ul><li><a href=1>one</a><li><a href=2>two</a></ul></nav><main>%s</main><footer>(c)</footer></body>",
        "<body><div class='ad top'>Buy this very good thing now, it is really cheap today</div><article>%s</article></body>",
        "<div id=sidebar><p>Some words beside the article that go on.</p></div><div class=post>%s</div>",
        "<header><h2>Site name</h2></header><article>%s<form><input><button>Send it</button></form></article>",
        "<article>%s</article><section id='comments'><p>I think that this is a comment of a reader.</p></section>",
        "<article>%s<aside>Read this too</aside><script>var x='</p>';</script><!-- <p>no</p> --></article>",
        "<div class='cookie-notice'>We use cookies, as everyone does these days.</div><div>%s</div>",
        "<body><ul class='menu'><li>a<li>b</ul><div><div>%s</div></div><iframe src=x>frame</iframe></body>",
    ],
)
def test_only_the_article_is_left(around):
    assert main_text(around % ARTICLE) == LINES


def test_missing_end_tags():
    page = "<article><h1>Title</h1><p><b>Bold start.<br><p>One paragraph.<p>Another one.</article><footer>no</footer>"
    assert main_text(page) == "Title\nBold start.\nOne paragraph.\nAnother one."


def test_an_article_in_parts_is_kept_whole():
    part = "<section><h2>Part</h2><p>%s</p><p>%s</p></section>" % ("words of it " * 20, "more of it " * 20)
    text = main_text(f"<body><article>{part * 3}</article></body>")
    assert text.count("Part") == 3 and len(text.split("\n")) == 9


def test_links_lower_the_density():
    links = "<div>" + "".join(f"<p><a href={i}>A long enough title of another article {i}</a></p>" for i in range(9)) + "</div>"
    body = "<div>" + "<p>A plain sentence of the article without any link in it at all.</p>" * 4 + "</div>"
    assert "another article" not in main_text(f"<body>{links}{body}</body>")


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""), ("plain &lt;text&gt;\n here", "plain <text> here"), ("<p>", ""), ("<" * 40, "<" * 40),
        ("</div></p>x", "x"), ("<div>" * 30_000 + "deep", "deep"), ("<script>only</script>", ""),
        ("<p>&#233;&eacute;&nbsp;&#x1F600;</p>", "éé 😀"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_all_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = extract(pages).collect()
    assert len(rows) == pages.count()
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        article = re.search(r"<article>(.*)</article>", raw[r.page_id], re.S)[1]
        blocks = re.split(r"<[^>]*>", re.sub(r"</?b>", "", article))
        want = "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert r.text == want and r.n_chars == len(want)


def test_null_repeated_and_no_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract(pages).collect()), key=str)
    assert got == [(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1)]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "around",
    [
        "<div class='layout has-sidebar'><article>%s</article></div>",
        "<div class='no-comments ad-free'>%s</div>",
        "<div class=elementor-widget-container>%s</div>",
        "<div id=search-result>%s</div>",
        "<div class=search>%s</div>",
        "<article></article><div class=sidebar><div><div>%s</div></div></div>",
        "<div class=widget><main>%s</main></div>",
        "<div class=sidebar><div>%s</div></div><p>x</p>",
        "<span class=share><div>%s</div></span>",
        "<div title='the hidden cost'>%s</div>",
        "<div class='wide hidden md:block'>%s</div>",
        "<div data-id=ad data-style='display:none'>%s</div>",
    ],
)
def test_a_wrapper_with_a_name_keeps_the_article(around):
    assert main_text(around % ARTICLE) == LINES


@pytest.mark.parametrize("attributes", ["hidden", "aria-hidden='true'", "style='color:red; display : none'", "HIDDEN=''"])
def test_hidden_elements_go(attributes):
    assert main_text(f"<article>{ARTICLE}<div {attributes}><p>Not to be seen.</p></div></article>") == LINES


def test_a_marked_part_of_a_line_goes_and_the_line_stays_one():
    assert main_text("<p>A line of text with<span class='ad box'> buy</span> words after it.</p>") == "A line of text with words after it."
    most = "<p>Before <a class=share>nearly all of the characters of this page</a> after.</p>"
    assert main_text(most) == "Before nearly all of the characters of this page after."


P = "A plain sentence of the article, long enough to be one of its paragraphs, and then a little longer. " * 3


@pytest.mark.parametrize(
    "page, lines",
    [
        (f"<article><div><h1>Title</h1></div><div><p>{P}<p>{P}</div></article>", ["Title", P, P]),
        (f"<body><h1>Title</h1><div><p>{P}<p>{P}</div></body>", ["Title", P, P]),
        (
            f"<article><section><h2>A</h2><p>{P}<p>{P}</section><section><h2>B</h2><p>Short end.</p></section></article>",
            ["A", P, P, "B", "Short end."],
        ),
        (f"<form><article><h1>T</h1><p>{P}<p>{P}</article></form>", ["T", P, P]),
        (f"<dialog open><div><p>{P}<p>{P}</div></dialog><p>x</p>", [P, P]),
        (f"<article><p>{P}<p>{P}<div class='reader-comments'><p>I say so.</p></div></article>", [P, P]),
        (f"<div class='has-comments'><p>{P}<p>{P}</div>", [P, P]),
        (
            f"<article><div><p>{P}<p>{P}</div><div><ul><li><a href=1>One more</a><li><a href=2>Two more</a></ul></div></article>",
            [P, P],
        ),
        (f"<div id=logo><h1>Site</h1></div><article><h1>T</h1><div><p>{P}<p>{P}</div></article>", ["T", P, P]),
        (f"<form><input><button>Send</button></form><div><p>{P}<p>{P}</div>", [P, P]),
    ],
)
def test_the_article_is_kept_whole(page, lines):
    assert main_text(page) == "\n".join(x.strip() for x in lines)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title='a > b'>x", "x"), ("<p title='a > b>x", "b>x"), ('<p a="\'>y</p>\'">z', "z"), ("x <a y", "x <a y"),
        ("<p title=\"it's\">x</p>", "x"),
    ],
)
def test_where_tags_end(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("part", ["<a x", "<p title='", '<p title="', "<p title='>", "<!x", "</a", "<a '\""])
@pytest.mark.parametrize("last", ["", ">", "'>"])
def test_unclosed_tags_take_time_in_proportion(part, last):
    start = time.perf_counter()
    main_text(part * 100_000 + last)
    assert time.perf_counter() - start < 5
