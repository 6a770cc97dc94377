"""Pages whose wrappers, leads or broken elements used to cost text."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lathe.llm import htmltext  # noqa: E402

TEXT = "One long paragraph of text, with some words, for sure. " * 8
LINES = "\n".join([TEXT.strip()] * 5)
BODY = f"<p>{TEXT}</p>" * 5


@pytest.mark.parametrize("name", ["layout has-sidebar", "site no-sidebar", "content-area with-sidebar", "page comment-open", "content side-by-side", "sidebar"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_a_wrapper_is_not_beside(name, tag):
    assert htmltext.main_text(f"<body><div class='{name}'><{tag}>{BODY}</{tag}></div><nav>x</nav>") == LINES


def test_comments_stay_out():
    page = f"<body><article>{BODY}</article><div id=comments><article class=comment><p>I, for one, disagree.</p></article></div>"
    assert htmltext.main_text(page) == LINES


def test_lead_outside_the_largest_container():
    lead = "A lead of eighty characters, more or less, that says what the article is about."
    assert htmltext.main_text(f"<body><div class=lead><p>{lead}</p></div><div class=body>{BODY}</div>") == lead + "\n" + LINES


@pytest.mark.parametrize("part", ["<svg class=i />", "<p>Mark <svg/> here.</p>", "<div><object data=x></div>", "<div><select><option>no</div>", "<div><canvas></div>", "<div><noscript><p>no</div>", "<noscript><div><p>no</noscript>", "<svg><title>no</title><text>no</text></svg>"])
def test_hidden_elements_end(part):
    want = LINES if "Mark" not in part else "Mark here.\n" + LINES
    assert htmltext.main_text(f"<body><article>{part}{BODY}</article>") == want


def page(body):
    return f"<html><body>{body}</body></html>"


STORY = "".join(f"<p>Part {i} of the story tells, in some detail, what happened next; and why it mattered.</p>" for i in range(6))
TOLD = "\n".join(f"Part {i} of the story tells, in some detail, what happened next; and why it mattered." for i in range(6))


@pytest.mark.parametrize("wrap", ["form", "fieldset", "label"])
@pytest.mark.parametrize("inner", [f"<article>{STORY}</article>", f"<div class='body'>{STORY}</div>"])
def test_a_page_in_a_form_keeps_its_story(wrap, inner):
    menu = "<nav><a href=/>Home</a></nav><div class='sidebar'><p>More of this here.</p></div>"
    assert htmltext.main_text(page(f"<{wrap}>{menu}{inner}</{wrap}>")) == TOLD


def test_a_form_beside_the_story_goes():
    assert htmltext.main_text(page(f"<div>{STORY}</div><form><label>Your name</label><p>Send us a letter.</p></form>")) == TOLD


@pytest.mark.parametrize(
    "name",
    "related-posts newsletter-signup ad-slot adsbygoogle comment-thread reader-comments sidebar-left share-buttons footer-widgets recommended-articles popular-posts alert privacy-notice".split(),
)
def test_what_stands_in_an_article_but_is_not_of_it(name):
    assert htmltext.main_text(page(f"<article>{STORY}<div class='{name}'><p>Read something else, here and now.</p></div></article>")) == TOLD


@pytest.mark.parametrize("name", ["top-stories-body", "popular", "latest", "alerting", "left"])
def test_other_names_stay(name):
    assert htmltext.main_text(page(f"<article><div class='{name}'>{STORY}</div></article>")) == TOLD
