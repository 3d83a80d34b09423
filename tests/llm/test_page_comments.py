"""Reader comments, heads of articles, class names in one word, and broken markup."""

import time

import pytest

from gaugewise.llm.html_text import TAG, blocks, main_text, tags

TEXT = "The long story goes on here, with many words, and it has commas. It ends well, they say, after all."
COMMENTS = [
    '<section class="comments"><h2>Replies</h2><article class="comment"><p>Great post, thanks, really.</p></article></section>',
    '<div id="comments"><article class="comment-body"><p>I do not agree, not at all, sorry.</p></article></div>',
    '<div class="commentList"><article class="comment"><p>First, as always, friends.</p></article></div>',
    '<section class="related"><article class="teaser related"><p>Ten more things, read on, now.</p></article></section>',
]


@pytest.mark.parametrize("extra", COMMENTS)
def test_comments_go_inside_and_beside_the_article(extra):
    inside = f"<html><body><main><article><h1>Head</h1><p>{TEXT}</p>{extra}</article></main></body></html>"
    beside = f"<html><body><article><h1>Head</h1><p>{TEXT}</p></article>{extra}</body></html>"
    for page in (inside, beside):
        assert main_text(page) == f"Head\n\n{TEXT}"


def test_unclassed_comment_articles_inside_the_article():
    page = f'<body><article><h1>Head</h1><p>{TEXT}</p><section class="comments"><article><p>Me too, yes.</p></article></section></article></body>'
    assert main_text(page) == f"Head\n\n{TEXT}"


def test_head_of_the_article_stays_and_the_page_header_goes():
    page = f"<body><header><h1>Site name</h1></header><article><header><h1>Headline</h1></header><p>{TEXT}</p><footer>Filed under x</footer></article></body>"
    assert main_text(page) == f"Headline\n\n{TEXT}"


@pytest.mark.parametrize("name", ["cookieBanner", "siteFooter", "navMenu"])
def test_class_names_in_one_word(name):
    page = f'<body><div class="{name}"><p>Something else, and more of it, here.</p></div><div><p>{TEXT}</p><p>{TEXT}</p></div></body>'
    assert main_text(page) == f"{TEXT}\n\n{TEXT}"


def test_tags_of_sound_markup_are_unchanged():
    page = "<!doctype html><p class='a>b'>x<br/><!-- c > --><![CDATA[ d ]]></p><a href=\"?a<b\">y</a> 1 < 2 <3 <"
    assert [t.span() for t in tags(page)] == [t.span() for t in TAG.finditer(page)]


def test_an_open_quote_leaves_no_markup():
    page = f'<body><article><p title="open>{TEXT}</p><p>{TEXT}</p></article></body>'
    assert "<" not in main_text(page)


@pytest.mark.parametrize("piece", ["<a b='", "<a b='>", "<", "<!", "<a ", "</", "<!-", "<a \"x", "'<p>\"", "<![CDATA["])
def test_hostile_markup_ends(piece):
    page = "<p>" + piece * (1_000_000 // len(piece))
    for text in (page, page + ">"):
        begin = time.perf_counter()
        for _ in blocks(text):
            pass
        assert time.perf_counter() - begin < 20
