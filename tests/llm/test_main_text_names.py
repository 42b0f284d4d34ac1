"""Names of wrappers and parts of an article that sound like boilerplate."""

import pytest

from ledgerloom.llm.extract import main_text

PROSE = "The river rises in the hills and flows through three towns before it meets the sea."


@pytest.mark.parametrize("name", ["layout has-sidebar", "content-sidebar-wrap", "page-with-comments", "no-sidebar", "widget", "promo banner"])
def test_article_below_a_named_wrapper_stays(name):
    page = f"<body><div class='{name}'><article><h1>Rivers</h1><p>{PROSE}</p></article><aside>Other pages</aside></div></body>"
    assert main_text(page) == f"Rivers {PROSE}"


@pytest.mark.parametrize("name", ["layout has-sidebar", "content-sidebar-wrap", "page-with-comments", "no-sidebar"])
def test_prose_below_a_layout_stays(name):
    assert main_text(f"<div class='{name}'><p>{PROSE}</p><p>{PROSE}</p></div>") == f"{PROSE} {PROSE}"


def test_parts_of_an_article_stay():
    page = (
        f"<article><h1>Rivers</h1><p>{PROSE}</p><section id='discussion'><p>{PROSE}</p></section><h2 id='popular-culture'>Popular culture</h2>"
        f"<p class='notice'>{PROSE}</p><p data-role='banner'>{PROSE}</p><p data-x='hidden'>{PROSE}</p><p title='class=ad hidden'>{PROSE}</p>"
        "<div class='share'>Share this</div></article>"
    )
    assert main_text(page) == " ".join(["Rivers", PROSE, PROSE, "Popular culture", *[PROSE] * 4])


def test_comments_and_side_elements_still_go():
    page = (
        f"<article><p>{PROSE}</p></article><section id='comments'><article><p>A reader's comment, long enough to be prose.</p></article></section>"
        f"<div class='sidebar'><p>{PROSE}</p></div><div hidden><article>{PROSE}</article></div>"
    )
    assert main_text(page) == PROSE
    assert main_text(f"<p>{PROSE}</p><div class='sidebar'><div class='content'><p>Side text of a few words.</p></div></div>") == PROSE
