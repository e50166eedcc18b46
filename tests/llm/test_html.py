from __future__ import annotations

import html
import re
import time

import pytest

from lakeward.llm import html as pages
from lakeward.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR

TEXT = "This is the text of the page, and it has more than a few words in it."


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n of a page", "plain text of a page"),
        (f"<nav><a>x</a></nav><p>{TEXT}</p><footer>c</footer>", TEXT),
        (f"<article><h1>Title</h1><p>{TEXT}<p>Ti.</article><aside>{TEXT}</aside>", f"Title\n{TEXT}\nTi."),
        (f"<header>Site</header><main><header><h1>T</h1></header>{TEXT}</main>", f"T\n{TEXT}"),
        (f"<div class='ad'>{TEXT}<article><p>{TEXT}</article>", TEXT),
        (f"<article><p>{TEXT}</p><div id='reader-comments'><p>{TEXT}</p></div></article>", TEXT),
        (f"<article><p>{TEXT}</p></article><div class=comments><article class='comment'>{TEXT}</article></div>", TEXT),
        ("<p>a &lt;b&gt; &amp;amp; &#233;&nbsp;&#x41; &copy; 1 < 2", "a <b> &amp; é A © 1 < 2"),
        ("<p>one<br>two</p><p>three<br><br>four", "one two\nthree\nfour"),
        ("<p>a<b>b</b>c <i>d</i><script>var a='</p>';</script><!-- x --><style>p{}</style> e", "abc d e"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>cut <a href=\"x", "cut"),
        ("<p>cut &am", "cut &am"),
        (f"<body class='has-sidebar'><div class='cookie-notice'>We use</div><form><label>Mail</label></form><div>{TEXT}</div>", TEXT),
        (f"<div>{TEXT}</div><p style='display: none'>gone</p><p hidden>gone</p><div role=navigation>gone</div>", TEXT),
        (f"<p>{TEXT}</p><ul><li><a href=1>More of this</a></li><li>x</li><li><a href=2>And that</a></li></ul>", TEXT),
    ],
)
def test_pages(source, want):
    assert pages.main_text(source) == want


def test_short_heading_follows_what_comes_after():
    source = f"<p><a href=1>Home</a></p><h2>Head</h2><p>{TEXT}</p><h2>Other</h2><p><a href=2>Next page</a></p>"
    assert pages.main_text(source) == f"Head\n{TEXT}"


def expected(source):
    """The article of a generated page, taken apart by its known form."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", source, re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", body[1].replace("<br>", " ") if body else "")
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", p)).split()) for p in parts)
    return "\n".join(line for line in lines if line)


def test_whole_table(spark):
    got = {r["page_id"]: r for r in QUERIES["op1_main_text"](spark, SF_DIR).collect()}
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(got) == len(table)
    for page in table:
        row = got[page["page_id"]]
        assert row["text"] == expected(page["html"])
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x"), (2, None, ""), (2, None, ""), (3, "v", f"<p>{TEXT}</p>" * 20_000), (4, "w", "<" * 50_000), (5, "w", "<div>" * 5_000 + "deep")]
    table = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = pages.extract(table).collect()
    assert [r["n_chars"] for r in sorted(got, key=lambda r: r["page_id"] or 0)] == [1, 0, 0, 0, 20_000 * (len(TEXT) + 1) - 1, 50_000, 4]
    assert pages.extract(table.where("false")).collect() == []


POLISH = "Wczoraj rano mieszkańcy małego miasteczka zobaczyli nad rzeką wielkie stado białych żurawi lecących powoli wzdłuż brzegu."
CHINESE = "昨天早上镇上的居民在河边看到一大群白鹤沿着河岸慢慢飞过天空非常壮观令人难忘。"
LINKS = "<ul><li><a href=1>Inne wiadomości</a></li><li><a href=2>Pogoda</a></li></ul>"


@pytest.mark.parametrize("text", [POLISH, CHINESE])
def test_page_of_another_language_with_a_link_list(text):
    want = f"{text}\n{text}\n{text}"
    assert pages.main_text(f"<article><p>{text}</p><p>{text}</p>{LINKS}<p>{text}</p></article>") == want
    assert pages.main_text(f"<div><p>{text}</p>{LINKS}<p>{text}</p><p>{text}</p></div>") == want


def test_long_block_without_stop_words_after_the_last_links():
    numbers = " ".join(map(str, range(40)))
    assert pages.main_text(f"<article><p>{TEXT}</p>{LINKS}<pre>{numbers}</pre></article>") == f"{TEXT}\n{numbers}"
    # Outside an article it follows its neighbours where the stop words fit the page.
    assert pages.main_text(f"<p>{TEXT * 5}</p>{LINKS}<p>{numbers}</p>") == TEXT * 5


@pytest.mark.parametrize(
    "source",
    [
        f"<div class='layout has-sidebar'><p>{TEXT}</p></div>",
        f"<div id='page-with-comments'><p>{TEXT}</p><div class='comments'><p>{TEXT}</p><p>{TEXT}</p></div></div>",
        f"<form id='aspnetForm'><p>{TEXT}</p></form>",
        f"<form id='aspnetForm'><div class='sidebar'>{TEXT}</div><article><p>{TEXT}</p></article></form>",
        f"<article><section class='social-history'><p>{TEXT}</p></section></article>",
        f"<div id=content><p>{TEXT}</p></div><article class='card'>Short card text here</article>",
        f"<article><p>{TEXT}</p><div class='user-discussion'><p>{TEXT}</p></div></article>",
        f"<div class='share-buttons'>Share this on the sites that you are on</div><p>{TEXT}</p>",
    ],
)
def test_names_of_wrappers_and_of_what_stands_beside(source):
    assert pages.main_text(source) == TEXT


def test_a_plain_cookie_notice_goes():
    notice = "We use cookies on this site and by going on you accept that they are set by us and by our partners."
    assert pages.main_text(f"<p>{notice}</p><p>{TEXT * 5}</p>") == TEXT * 5


def test_a_text_about_cookies_stays():
    about = "A cookie is a small file that a site sets, and by law a reader has to accept or to refuse it in the browser."
    assert pages.main_text(f"<p>{about}</p><p>{TEXT}</p>") == f"{about}\n{TEXT}"


@pytest.mark.parametrize("unit", ["<b>{}</i>", "<b>{}<td></td>", "<b>{}<li>", "<div class=sidebar-page>{}</div>", "<b>{}<article>", "<p>{}</p>"])
def test_unclosed_tags_take_linear_time(unit):
    opened, closed = unit.split("{}")
    begin = time.process_time()
    pages.main_text(opened * 100_000 + TEXT + closed * 100_000)
    assert time.process_time() - begin < 8
