"""Marks of elements that hold the page's text, and lenient reading of heads and embedded content."""

import pytest

from voxelark.llm import html

LONG = " ".join(f"word{i}" for i in range(80))
SHORT = "Some closing words of the author that belong to the text as well."


@pytest.mark.parametrize(
    "wrapper",
    ['<div class="layout with-sidebar">', '<div class="no-sidebar">', '<div class="has-banner">', '<div class="widget-area content">',
     "<form action=x>", '<div class="sidebar">'],
)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_wrappers_of_the_text(wrapper, inner):
    text = inner.format(f"<h1>Title</h1><p>{LONG}<p>{LONG}<p>{SHORT}")
    page = f"<body><nav><a href=1>Home</a></nav>{wrapper}{text}</{wrapper[1:].split()[0].split('>')[0]}><footer>foot</footer>"
    assert html.main_text(page) == f"Title\n\n{LONG}\n\n{LONG}\n\n{SHORT}"


def test_slugs_in_an_article_and_real_comments():
    page = (
        f'<article><h2 id="social-effects">Effects</h2><p>{LONG}</p><section id="related-work"><h2>Work</h2><p>{SHORT}</p></section></article>'
        f'<section class="comments"><article class="comment">{LONG} reply</article></section><div class="sidebar"><p>{SHORT} side</p></div>'
    )
    assert html.main_text(page) == f"Effects\n\n{LONG}\n\nWork\n\n{SHORT}"


def test_open_heads_and_embedded_content():
    assert html.main_text(f"<html><head><title>T</title><meta charset=x><p>{LONG}") == LONG
    assert html.main_text(f"<html><head><title>T</title><style>p{{}}</style></head><body><p>{LONG}") == LONG
    assert html.main_text(f"<p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=t>x=2</annotation></math> end") == f"{LONG} x=2 end"
    for start in ("<object data=x>", "<svg width=1>", "<svg/>", "<svg><text>no</text></svg>"):
        assert html.main_text(f"<p>One {start}</p><p>{LONG}") == f"One\n\n{LONG}"


def test_a_teaser_article_does_not_outvote_the_text():
    page = f"<div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><article><p>Read this too</p></article>"
    assert html.main_text(page).startswith(f"{LONG}\n\n{LONG}\n\n{LONG}")
