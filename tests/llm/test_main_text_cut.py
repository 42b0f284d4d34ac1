"""Blocks that the minimum cut decides, the learned classifier, deep and long pages."""

import tracemalloc

import numpy as np
import pytest

from ledgerloom.llm import extract
from ledgerloom.llm.common import prepared

PROSE = "The river rises in the hills, flows through three towns and meets the sea behind a long bank of sand."
MENU = "<ul><li><a>Home</a></li><li><a>Towns</a></li><li>Learn about the river.</li><li><a>Maps</a></li><li><a>Contact</a></li></ul>"


def alone(page):
    """Text of the blocks whose own costs speak for content, without any edge."""
    blocks = extract.blocks_of(page)[0]
    return " ".join(b.text for b in blocks if extract.leaning(b, extract.marks_main(blocks)) > 0)


@pytest.mark.parametrize(
    "page, want, without",
    [
        # a sentence in a menu goes with the links around it
        (f"<div>{MENU}</div><div><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE} {PROSE}", f"Learn about the river. {PROSE} {PROSE}"),
        # a short line between paragraphs stays with them
        (f"<div><p>{PROSE}</p><li>Second part</li><p>{PROSE}</p></div>", f"{PROSE} Second part {PROSE}", f"{PROSE} {PROSE}"),
        # so does a line that is half a link; a line that is all link is outweighed by neither
        (f"<div><p>{PROSE}</p><p>See also <a>the long way</a></p><p>{PROSE}</p></div>", f"{PROSE} See also the long way {PROSE}", f"{PROSE} {PROSE}"),
        (f"<div><p>{PROSE}</p><p><a>All the long ways</a></p><p>{PROSE}</p></div>", f"{PROSE} {PROSE}", f"{PROSE} {PROSE}"),
        # a section of the article in spite of its name; short named parts go
        (f"<article><p>{PROSE}</p><section id='discussion'><p>{PROSE}</p></section><p>{PROSE}</p></article>", " ".join([PROSE] * 3), f"{PROSE} {PROSE}"),
        (f"<article><p>{PROSE}</p><div class='share'>Share this</div><p>{PROSE}</p></article>", f"{PROSE} {PROSE}", f"{PROSE} {PROSE}"),
        (f"<article><p>{PROSE}</p><div class='ad'>Buy new boats.</div><p>{PROSE}</p></article>", f"{PROSE} {PROSE}", f"{PROSE} {PROSE}"),
        # no number of neighbours makes an aside or a form content
        (f"<article><p>{PROSE}</p><aside>{PROSE}</aside><p>{PROSE}</p><form>{PROSE}</form><p>{PROSE}</p></article>", " ".join([PROSE] * 3), " ".join([PROSE] * 3)),
    ],
)
def test_neighbours_decide_open_blocks(page, want, without):
    assert extract.main_text(page) == want and alone(page) == without


def test_edges_weaken_with_the_steps_between():
    blocks, parents, depths = extract.blocks_of("<div><p>a</p><p>b</p></div><div><div><p>c</p></div></div><p>d")
    weights = {(a, b): w for a, b, w in extract.edges_of(blocks, parents, depths)}
    assert weights == {(0, 1): extract.NEXT / 3, (1, 2): extract.NEXT / 6, (2, 3): extract.NEXT / 5}


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<p>A few words.</p>" * 20_000, "<span>" * 20_000 + "<p>x</p>y" * 5_000, "<div>" * 20_000 + "</span>" * 20_000])
def test_memory_is_linear_in_deep_and_long_pages(page):
    tracemalloc.start()
    extract.main_text(page)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 << 20


def test_learned_weights_are_the_greatest_posterior():
    draw = np.random.default_rng(4)
    rows = np.column_stack([np.ones(3000), draw.random((3000, 7))])
    truth = np.array([0.5, -4, 3, 1, 2, -1, 0, -2])
    content = (draw.random(3000) < 1 / (1 + np.exp(-rows @ truth))).astype(float)

    def loss(w):
        odds = rows @ w
        return (np.logaddexp(0, odds) - content * odds).sum() + extract.TRUST / 8 * ((w - np.array(extract.START)) ** 2).sum()

    found = np.array(extract.learned(rows, content))
    assert all(loss(found) < loss(found + 0.01 * sign * axis) for axis in np.eye(8) for sign in (-1, 1))


def test_weights_come_from_pages_that_mark_their_content(spark):
    prepared(spark)
    kind = "page_id long, html string, `a``b` string, tags map<string, string>, text string"
    good = f"<nav><a>Home</a> <a>Towns</a></nav><article><h1>Rivers</h1><p>{PROSE}</p></article><div>Made with care.</div>"
    rows = [(k, good.replace("Rivers", f"Rivers {k}"), "x", {"a": "b"}, "clash") for k in range(40)]
    pages = spark.createDataFrame(rows, kind)
    weights = extract.fitted(pages)
    assert weights != extract.START and weights[1] < -1 < 0.5 < weights[4]
    # repeated rows count once, unmarked and empty pages not at all
    more = spark.createDataFrame(rows + rows[:1] * 200 + [(90, None, None, None, None), (None, "", "", None, "y"), (91, f"<p>{PROSE}</p>", "", None, "")], kind)
    assert extract.fitted(more) == weights
    assert extract.fitted(pages.where("false")) == extract.fitted(more.where("page_id = 91")) == extract.START
    assert len(extract.fitted(pages, sample=10)) == len(extract.START)
    found = extract.extracted(more).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in found)[0] == (0, "") and len(found) == 243
    assert {r["text"] for r in found if r["page_id"] == 7} == {f"Rivers 7 {PROSE}"}
