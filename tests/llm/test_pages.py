"""Ordinary pages whose markup names things like what it is not."""

import time

import pytest

from tidemark.llm.extraction import main_text

LONG = "This sentence is a part of the article and goes on for a while so that it counts as text."
BODY = "".join(f"<p>{LONG} {i}</p>" for i in range(8))
WANT = "\n\n".join(f"{LONG} {i}" for i in range(8))
AROUND = ("<header>Site name</header><nav><a href='/'>Home</a> <a href='/b'>Other</a></nav>{}<div class='sidebar'><a href='/x'>Most read</a> something else</div>"
          "<footer>All rights reserved</footer>")


def page(inner, body=""):
    return f"<html><head><title>t</title></head><body {body}>{AROUND.format(inner)}</body></html>"


@pytest.mark.parametrize("inner, body", [
    (f"<article>{BODY}</article>", "class='single comments-open'"),
    (f"<article class='post has-comments'>{BODY}</article>", ""),
    (f"<div class='post comment-status-open'>{BODY}</div>", ""),
    (f"<div class='no-sidebar'>{BODY}</div>", ""),
    (f"<div class='content with-banner'><div id='main'>{BODY}</div></div>", ""),
    (f"<article><svg viewBox='0 0 1 1'/>{BODY}</article>", ""),
    (f"<article><iframe src=x>{BODY}</article>", ""),
    (f"<aside class='x'><main>{BODY}</main></aside>", ""),
])
def test_wrappers_and_states_are_not_other_things(inner, body):
    assert main_text(page(inner, body)) == WANT


def test_a_page_within_one_form():
    assert main_text(f"<html><body><form method=post action='x.aspx'>{AROUND.format('<div>' + BODY + '</div>')}<input name=a></form></body></html>") == WANT


@pytest.mark.parametrize("part", ["<div class='share-price'><p>The share rose by a tenth to its highest price of the year today.</p></div>",
                                  "<section id='related-work'><p>Others have written about this before, and at some length too, it has to be said.</p></section>",
                                  "<p class='social'>Social housing was built here in the years after the war, and much of it still stands today.</p>"])
def test_parts_of_an_article_with_words_of_other_things(part):
    text = " ".join(part.replace("<", " <").replace(">", "> ").split())
    inner = main_text(f"<p>{text}</p>")
    got = main_text(page(f"<article>{BODY}{part}<p>{LONG}</p></article>"))
    assert got == f"{WANT}\n\n{inner}\n\n{LONG}" and len(inner) > 30


def test_what_is_named_as_other_things_goes():
    other = ("<div class='comments'>" + "<div class='comment'><p>I think this is wrong in many ways, said a reader at length, and then some more.</p></div>" * 30 + "</div>"
             "<ol id='comment-list'><li><article class='comment'><p>Another reader writes a long comment about the article that was above.</p></article></li></ol>"
             "<div class='cookie-notice'>We use cookies</div><div class='ad-slot'>Buy this</div><div class='social-share'><a href=x>Share</a></div>"
             "<div class='related-posts'><a href=y>Another story</a></div><section class='newsletter signup'>Write your address</section><form><p>Search</p></form>")
    assert main_text(page(f"<article>{BODY}{other}</article>")) == WANT
    assert main_text(page(f"<div class='post'>{BODY}</div>{other}")) == WANT


def test_a_list_keeps_its_heading_and_a_page_loses_its_copyright_line():
    items = "".join(f"<li>{LONG} {i}</li>" for i in range(6))
    got = main_text(f"<html><body><h1>Six things</h1><ul>{items}</ul><div>© 2024 The Company. All rights reserved.</div></body></html>")
    assert got == "Six things\n\n" + "\n\n".join(f"{LONG} {i}" for i in range(6))


def test_time_grows_with_the_page_not_with_its_square():
    took = []
    for n in (4_000, 32_000):
        start = time.process_time()
        assert main_text("<div><b>" * n + LONG + "</i>" * n) == LONG
        took.append(time.process_time() - start)
    assert took[1] < 30 * took[0] + 0.2


@pytest.mark.parametrize("html, want", [(None, ""), ("", ""), ("<p>", ""), ("a < b", "a < b"), ("<p>a<p>b", "a\n\nb"), ("<script>x", ""), ("<p>x</p><style>p{", "x"), ("&amp;&#65;", "&A")])
def test_odd_pages(html, want):
    assert main_text(html) == want
