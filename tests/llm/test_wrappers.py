"""Names of wrappers, comments and hostile pages in the extraction of main texts."""

import time

import pytest

from leadflow.llm import wrapper

STORY = "<p>" + "real words of the story here " * 20 + "</p>"
WRAPPERS = "has-sidebar with-footer no-comments comments-open page-nav-wrapper form-wrapper search-results content-sidebar-wrap widget-area post-with-ad banner-on single-header promo-layout".split()
text = lambda html: "\n".join(wrapper.blocks(wrapper.parse(html)))


@pytest.mark.parametrize("name", WRAPPERS)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main><article>{}</article></main>", "<div>{}</div>", "<div class='{n}'><article>{}</article></div>"])
def test_a_wrapper_named_after_what_stands_beside_keeps_its_article(name, inner):
    replies = "".join(f"<li class='comment'><article class='comment-body'>{'nice post ' * 10}</article></li>" for _ in range(4))
    page = f"<html><body><div class='menu'>home about</div><div class='{name}'>{inner.format(STORY, n=name)}<div class='sidebar'>side text</div></div><div id='comments' class='comments-area'><ol>{replies}</ol></div><div class='ad'>buy this</div></body></html>"
    assert text(page) == " ".join(("real words of the story here " * 20).split())


def test_a_large_part_beside_a_short_article_goes():
    assert text(f"<body><div class='ad'>{STORY}</div><article><p>short</p></article><div class='comments'>{STORY}</div></body>") == "short"
    assert text(f"<body><div><p>one two three</p></div><div class='comments'>{'word ' * 4}</div></body>") == "one two three"


def test_unmatched_tags_take_linear_time():
    start = time.time()
    for page in ("<b>" * 100_000 + "</i>" * 100_000, "<b>" * 30_000 + "<p>x</p>" * 30_000, "<ul>" + "<b>" * 30_000 + "</li>" * 30_000, "</div>" * 100_000):
        wrapper.parse(page)
    assert time.time() - start < 20


def test_query_over_wrapped_pages(spark):
    page = "<html><head><title>t{i}</title></head><body><div class='has-sidebar'><article><h1>Title {i}</h1><p>{w} {i}</p></article><div class='sidebar'>s</div></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i=i, w="words of a story " * 15)) for i in range(5)]
    got = {r.page_id: r.text for r in wrapper.op2_query(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"Title {i}\n{'words of a story ' * 15}{i}" for i in range(5)}
