import pytest

from turnlens.llm.html import extract_main_text, main_text, smoothed

ARTICLE = "A first paragraph that is long enough to look like the text of an article, with a few words more."
SIDES = {
    "menu": '<div class="main-menu"><a href=/>Home</a> <a href=/b>Other</a></div>',
    "nav": "<nav><ul><li><a>One</a><li><a>Two</a></ul></nav>",
    "header": "<header><h1>Site name</h1></header>",
    "footer": "<footer><p>Some footer text that could be long, too, and is not part of it.</p></footer>",
    "aside": "<aside><p>Read also the other articles of this week in our paper.</p></aside>",
    "notice": '<div id="cookie-notice"><p>We use cookies to make this site better for all of you.</p></div>',
    "form": "<form><p>Write to us</p><input name=q><button>Send</button></form>",
    "script": '<script>var t="</p>";</script><style>p{margin:0}</style>',
    "comments": '<section class="comments"><p>What a nice article, I did like it very much, thank you.</p></section>',
}


@pytest.mark.parametrize("side", SIDES)
def test_leaves_out(side):
    page = f"<html><body>{SIDES[side]}<article><h1>Title</h1><p>{ARTICLE}</p><p>Short.</p></article>{SIDES[side]}</body></html>"
    assert main_text(page) == f"Title\n{ARTICLE}\nShort."


@pytest.mark.parametrize("side", SIDES)
def test_leaves_out_without_an_article_element(side):
    page = f"<body>{SIDES[side]}<div><h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></div>{SIDES[side]}"
    assert main_text(page) == f"Title\n{ARTICLE}\n{ARTICLE}"


@pytest.mark.parametrize("name", ["with-sidebar", "no-sidebar", "has-comments", "widget-area content"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrapper_named_after_a_side_part(name, inner):
    page = f'<body><div class="{name}"><{inner}><h1>Title</h1><p>{ARTICLE}</p></{inner}></div>{SIDES["footer"]}</body>'
    assert main_text(page) == f"Title\n{ARTICLE}"
    if inner != "div":
        assert main_text(f"<body><p>Home</p>{page[6:]}") == f"Title\n{ARTICLE}"


def test_comments_that_are_articles_stay_out():
    comment = f'<div id="comments"><ol><li><article class="comment-body"><p>{ARTICLE} {ARTICLE}</p></article></ol></div>'
    plain = comment.replace(' class="comment-body"', "")
    assert main_text(f"<body><div><p>{ARTICLE}</p></div>{comment}") == ARTICLE
    assert main_text(f"<body><article><p>{ARTICLE}</p></article>{plain}") == ARTICLE


@pytest.mark.parametrize("start", ["<body>", "<div>", "<p>", ""])
def test_head_without_end_tag(start):
    assert main_text(f"<html><head><meta charset=utf-8><title>T</title><script>x()</script>{start}{ARTICLE}") == ARTICLE
    assert main_text(f"<head><noscript><p>Please turn scripts on</p></noscript><body><p>{ARTICLE}</p>") == ARTICLE


def test_text_rules():
    page = "<article><p>a &amp;\n b&nbsp;&#233;<br>c <b>d</b>e<p>  <p>two<ul><li>x<li>y</ul>"
    assert main_text(page) == "a & b é c de\ntwo\nx\ny"


@pytest.mark.parametrize("page", [None, "", " \n", "<html></html>", "<!-- a -->", "<p></p>", "<nav>x</nav>"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_broken_and_long_pages():
    assert main_text("<p>open <b>bold <p>next</div></x><") .startswith("open bold\nnext")
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert main_text(deep) == "deep text"
    long = "<article>" + "".join(f"<p>paragraph {i} with some text</p>" for i in range(5000)) + "</article>"
    assert main_text(long).count("\n") == 4999


def test_smoothing_keeps_a_constant():
    assert smoothed([2.0] * 9, 1.0) == pytest.approx([2.0] * 9)


def test_table(spark):
    rows = [(1, "u", "<article><p>caf&eacute;</p></article>", "x"), (1, "u", "<article><p>caf&eacute;</p></article>", "x"), (None, None, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(repr, (tuple(r) for r in extract_main_text(pages).collect())))
    assert got == sorted(map(repr, [(1, "u", "café", 4), (1, "u", "café", 4), (None, None, "", 0)]))
    assert extract_main_text(pages.limit(0)).collect() == []
