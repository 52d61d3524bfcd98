import pytest

from lexitrend.llm import op10_html_extract as web

LONG = "A long first paragraph with a number of words, that is fine and goes on for some more words here."
ARTICLE = f'<article><h1>Title</h1><p>{LONG}</p><p>Short one.</p></article>'
WANT = f"Title\n{LONG}\nShort one."


@pytest.mark.parametrize("page", [
    '<body class="single right-sidebar">{}</body>', '<html class="has-footer"><body class="no-header">{}</body></html>',
    '<body><div id="content-sidebar-wrap">{}</div></body>', '<body><div class="no-sidebar"><div>{}</div></div></body>',
    '<body class="right-sidebar"><div class="no-sidebar">{}<div class="sidebar"><p>' + LONG + '</p></div></div></body>',
    '<body><div class="no-sidebar">{}</div><div class="related"><article><p>Teaser of it.</p></article></div></body>',
    '<body><div class="no-sidebar">{}</div><div class="comments"><article class="comment"><p>' + LONG * 9 + '</p></article></div></body>',
])
def test_boilerplate_words_of_wrappers_do_not_count(page):
    assert web.main_text(page.format(ARTICLE)) == WANT
    main = ARTICLE.replace("article", "main")
    assert web.main_text(page.format(main)) == WANT


def test_formulas_stay_in_their_paragraph():
    page = f"<article><p>{LONG} As <math><mi>a</mi><mo>=</mo><mi>b</mi></math> holds.</p><p>{LONG}</p></article>"
    assert web.main_text(page) == f"{LONG} As a=b holds.\n{LONG}"
