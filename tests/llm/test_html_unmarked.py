"""Pages without an article or main element keep the short parts of their text."""

import pytest

from tidemart.llm import html_text

LONG = "A sentence of the article that is long enough to be a surge on its own, with more words than the others have."
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(6)) + "</ul>"
AD = "<div class='related'><ul>" + "<li>Other story</li>" * 6 + "</ul></div>"


@pytest.mark.parametrize("page, want", [
    (f"<div><h1>Title</h1></div><div><p>{LONG}</p></div>", f"Title\n{LONG}"),
    (f"<div><p>{LONG}</p></div><div><p>Short one.</p></div><div><p>{LONG}</p></div><div><p>The end.</p></div>",
     f"{LONG}\nShort one.\n{LONG}\nThe end."),
    (f"<table><tbody><tr><td>{LONG}</td></tr><tr><td>a</td></tr><tr><td></td></tr><tr><td></td></tr><tr><td></td></tr>"
     "<tr><td>b</td></tr></tbody></table>", f"{LONG}\na\nb"),
    (f"<div><h2>Head</h2><p>{LONG}</p>{AD}<p>Closing line.</p></div>", f"Head\n{LONG}\nClosing line."),
    (f"<div>{MENU}</div><div><div><h1>Title</h1></div><section><p>{LONG}</p></section></div><footer>Foot</footer>",
     f"Title\n{LONG}"),
])
def test_short_parts_beside_a_surge_stay(page, want):
    assert html_text.main_text(page) == want


def test_stray_text_across_a_gap_goes():
    page = f"<div><span>Stray</span></div>{MENU}<div><p>{LONG}</p></div>{AD}<div><p>Stray, too</p></div>"
    assert html_text.main_text(page) == LONG
