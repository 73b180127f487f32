import re
from html import unescape

import pytest

from yearling.llm.pages import Page, main_text

BODY = "<p>The first paragraph of the story, long enough to be the text.</p>"


def text_of(spark, *htmls, url="https://www.example.com/a/{}"):
    rows = [(i, url.format(i), h) for i, h in enumerate(htmls)]
    found = main_text(spark.createDataFrame(rows, "page_id int, url string, html string"))
    return [r.text for r in found.orderBy("page_id").collect()]


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<h1>T &amp; U</h1><p>a <b>b</b>c<br>d\n\n e<p>f", "T & U a bc d e f"),
        ("<p>a</p><nav>m</nav><aside>s</aside><form>f<input></form><p>b", "a b"),
        ("<p>a</p><script>var x='<p>no</p>'</script><style>p{}</style><!-- c --><p>b", "a b"),
        ("<p>a</p><div class='ad-box'>buy</div><div id=cookie-notice>ok</div><p>b", "a b"),
        ("<p>a</p><section class=comments><p>first</p></section><p>b", "a b"),
        ("<p>a</p><ul><li><a>1</a><li><a>2</a><li><a>3</a></ul><p>b", "a 1 2 3 b"),
        ("<p>a</p><div class='form-factor'>f</div><section class=related-work>r</section>", "a f r"),
        ("<p>a <math><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></math> b", "a x2 b"),
        ("<p>a</p><svg><title>no</title><path d='M'/><text>axis</text></svg><p>b", "a axis b"),
        ("<p>a</p><div class='related-posts x1'>r</div><div class=user-comments>c</div><p>b", "a b"),
        ("<ul><li>one<li>two</ul><table><tr><td>x<td>y</table>", "one two x y"),
        ("<p>a</p><div role=navigation>m</div><div hidden>h</div><p style='display: none'>n<p>b", "a b"),
        ("<p>1 &lt; 2 &#233; &nbsp; x</p>a < b", "1 < 2 é x a < b"),
        ("<header><h1>Title</h1></header><p>a", "Title a"),
        ("<p>a</p></div></span><p>b</i>c", "a bc"),
    ],
)
def test_article(spark, inside, text):
    page = (
        f"<html><head><title>no</title></head><body><header>Site</header><nav>menu</nav>"
        f"<article>{inside}</article><aside>more</aside><footer>foot</footer></body></html>"
    )
    assert text_of(spark, page) == [text]


def test_the_host_decides(spark):
    """A page whose sidebar is longer than its text follows the other pages of its host."""
    frame = "<body><div class=menu>m</div><div class='col main-{0}'>{1}</div><div class=right>{2}</div>"
    pages = [frame.format(i, BODY * 3, "<p>x</p>") for i in range(6)]
    pages.append(frame.format(9, "<p>Short.</p>", "<p>" + "A long list of other things. " * 9))
    found = text_of(spark, *pages)
    assert found[-1] == "Short."
    assert "A long list" in text_of(spark, pages[-1])[0]


def test_hosts_do_not_mix(spark):
    rows = [(i, f"http://h{i % 2}.x/", f"<div class=k{'ab'[i % 2]}>{BODY}</div>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    assert {r.text for r in main_text(df).collect()} == {
        "The first paragraph of the story, long enough to be the text."
    }


def test_generated_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in main_text(pages).collect():
        inside = re.search(r"(?s)<article>(.*?)(</article>|$)", html[r.page_id]).group(1)
        inside = re.sub(r"</?b>", "", inside)
        assert r.text == " ".join(unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "html", ["<", "<a", "<a b='", "</", "<!--", "<script>", "<p" * 50, "<div>" * 3000, "&#x;", "<p>a</p" ]
)
def test_broken_pages(html):
    page = Page(html)
    page.best(page.scores())


def test_a_host_may_have_many_templates(spark):
    """The sixth template and later ones have votes too."""
    frame = "<body><div class=menu>m</div><div class='main-{0}'>{1}</div><div class=right>{2}</div>"
    names = "abcdefgh"
    pages = [
        frame.format(k, BODY * 3, "<p>x</p>") for n, k in enumerate(names) for _ in range(20 - n)
    ]
    pages += [frame.format(k, "<p>Short.</p>", "<p>" + "A long list. " * 20) for k in names]
    assert text_of(spark, *pages)[-len(names) :] == ["Short."] * len(names)


def test_classes_outside_an_article(spark):
    """A word in a longer name does not remove most of a page; whole names always count."""
    page = f"<body><div class=form-factor>{BODY * 3}</div><div class=promo-xy>buy</div></body>"
    talk = f"<body><div class=story>{BODY}</div><div class=comments>{'<p>I think so.</p>' * 90}</div>"
    menu = f"<body><div class=k>{BODY}<ul><li><a>1</a><li><a>2</a><li><a>3</a></ul></div>"
    one = "The first paragraph of the story, long enough to be the text."
    assert text_of(spark, page) == [f"{one} {one} {one}"]
    assert text_of(spark, talk) == [one]
    assert text_of(spark, menu) == [one]


def test_repeated_rows_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>w{i} and more words</p>" for i in range(40_000)) + "</article>"
    rows = [(1, "http://a.x/", long), (1, "http://a.x/", long), (2, None, None), (None, "", "<p>t</p>")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    found = sorted(main_text(df).collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert [r.page_id for r in found] == [1, 1, 2, None]
    assert found[0].text == found[1].text == " ".join(f"w{i} and more words" for i in range(40_000))
    assert (found[2].text, found[2].n_chars, found[3].text) == ("", 0, "t")
