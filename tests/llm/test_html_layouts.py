"""Pages whose markup looks like boilerplate around the article, and deep nesting."""

import time

import pytest

from tidemart.llm.html_text import main_text

P = "<p>" + "The tide came in over the flats before the boats were ready, and nobody had seen it so early. " * 2 + "</p>"
WANT = "The tide came in over the flats before the boats were ready, and nobody had seen it so early."
MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
FOOT = "<footer>All rights reserved by the harbour office</footer>"

LAYOUTS = [
    '<article class="post category-social">{}</article>', '<article class="post tag-comments">{}</article>',
    '<main class="content ad-free">{}</main>', '<div class="main-content has-related">{}</div>', '<div class="comment-free story">{}</div>',
    '<div class="elementor-widget elementor-widget-text-editor">{}</div>', "<form>{}</form>", "<form><article>{}</article></form>",
    '<form method=post><div class="page"><main>{}</main></div></form>', '<div class="widget">{}</div>', '<div id="widget-area"><article>{}</article></div>',
    "<article>{}</article>", "<main>{}</main>", "<div>{}</div>", '<div class="no-sidebar">{}</div>', '<div class="has-sidebar">{}</div>',
    '<section class="without-ads">{}</section>', '<div class="content-with-sidebar">{}</div>', '<div class="tag-cookie">{}</div>',
    '<div class="category-advertising">{}</div>', '<article class="not-sponsored">{}</article>', '<div class="social"><article>{}</article></div>',
    '<aside><article>{}</article></aside>', '<div role="dialog"><main>{}</main></div>', '<section class="promo"><div>{}</div></section>',
    '<div class="newsletter"><article>{}</article></div>', "<fieldset>{}</fieldset>", '<table><tr><td>{}</td></tr></table>',
    '<div class="popup"><section>{}</section></div>', '<div class="banner-wrap">{}</div>', "<center>{}</center>", '<div class="entry-content">{}</div>',
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_article_is_found(layout):
    for page in (layout.format(P), f"<html><body>{MENU}{layout.format(P)}{FOOT}</body></html>"):
        text = main_text(page)
        assert WANT in text, page
        assert "Home" not in text and "rights reserved" not in text


def test_an_element_of_page_text_beside_a_short_unmarked_line():
    text = main_text(f'<div class="widget">{P * 4}</div><div>Set in type by hand</div>')
    assert text.count(WANT) == 8


def test_comments_adverts_and_hidden_text_stay_out():
    long = "<p>" + "I do not agree with any of this and I will say so at length. " * 30 + "</p>"
    text = main_text(f'<article>{P}</article><div id="comments"><article class="comment">{long}</article></div>')
    assert WANT in text and "agree" not in text
    text = main_text(f'<div>{P}</div><div class="comments">{long}</div>')
    assert WANT in text and "agree" not in text
    assert main_text(f'<article style="display:none">{P}</article>') == ""
    assert main_text(f'<div>{P}</div><footer>{"Terms apply to all. " * 3}</footer><aside class="sidebar">{"See also. " * 20}</aside>') == " ".join(
        P[3:-4].split())


def test_form_controls_are_not_text():
    text = main_text(f'<form>{P}<select><option>One</option></select><button>Send</button><textarea>draft</textarea></form>')
    assert WANT in text and not any(x in text for x in ("One", "Send", "draft"))


def test_unclosed_cdata_keeps_its_text():
    assert main_text("<article><p>Before <![CDATA[and inside]]> it</p></article>") == "Before and inside it"
    assert main_text("<article><p>Before <![CDATA[and the end") == "Before and the end"


@pytest.mark.parametrize("tag", ["div", "span", "b", "table", "article"])
def test_deep_nesting_takes_linear_time(tag):
    begun = time.time()
    text = main_text(f"<{tag}>x " * 100_000 + "</i>" * 50_000)
    assert time.time() - begun < 20 and text.count("x") == 100_000
