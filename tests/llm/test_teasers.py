"""Small article elements beside a long unmarked story are teasers."""

import pytest

from cratecast.llm.html import extracted

PAGES = "page_id long, url string, html string"
STORY = " ".join(f"Sentence number {i} of the long story." for i in range(30))


def texts(frame, *sources, host="a.example"):
    rows = [(i, f"http://{host}/{i}", s) for i, s in enumerate(sources)]
    return {r["page_id"]: r["text"] for r in extracted(frame(rows, PAGES)).collect()}


def test_a_teaser_does_not_hide_the_story(frame):
    page = f"<body><nav>Menu</nav><article><h2>Teaser</h2></article><div id=content><p>{STORY}</p></div><div class=footer>Foot</div></body>"
    assert texts(frame, page)[0] == f"Teaser {STORY}"


@pytest.mark.parametrize("own", ["<main><p>Short.</p></main>", "<div itemprop=articleBody>Short.</div>", "<main><article>Short.</article></main>"])
def test_main_and_article_body_count_however_small(frame, own):
    assert texts(frame, f"<body>{own}<div><p>{STORY}</p></div></body>")[0] == "Short."


def test_an_article_of_a_fair_part_stands_alone_and_an_empty_one_is_empty(frame):
    article = STORY[: len(STORY) // 5]
    got = texts(frame, f"<article>{article}</article><div>{STORY}</div>", f"<article> </article><div>{STORY}</div>")
    assert got == {0: article.strip(), 1: ""}


def test_templates_are_no_story(frame):
    # the long block is on every page of the host, so the short articles stay the main text
    pages = [f"<body><article><p>News {i}</p></article><div><div>{STORY}</div><p>more {i}</p></div></body>" for i in range(8)]
    assert texts(frame, *pages) == {i: f"News {i}" for i in range(8)}
