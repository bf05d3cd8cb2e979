"""What a page hides is no text, and words in quoted values hide nothing."""

import pytest

from cratecast.llm.html import extracted

STORY = "The long story of the page goes on and on. " * 6


@pytest.mark.parametrize(
    "html",
    [
        f"<body><article title='A hidden place'><p>{STORY}</p></article></body>",
        f"<body><article class='mt-4 hidden md:block'><p>{STORY}</p></article></body>",
        f"<body><div title='the hidden valley'><p>{STORY}</p></div></body>",
        f"<body><div data-x=\"a hidden=''\"><p>{STORY}</p></div></body>",
        f"<body><div hidden=''><p>secret {STORY}</p></div><p>{STORY}</p></body>",
        f"<body><div HIDDEN><p>secret {STORY}</p></div><p>{STORY}</p></body>",
        f"<body><div class=a hidden=\"hidden\" id=b><p>secret</p></div><p>{STORY}</p></body>",
        f"<body><div style=\"color:red; display : none\"><p>secret</p></div><p>{STORY}</p></body>",
        f"<body><span aria-hidden=true>secret</span><p>{STORY}</p></body>",
        f"<body><!--><p>{STORY}</p><!-- secret --></body>",
        f"<body><!---><p>{STORY}</p><!-- secret --!></body>",
    ],
)
def test_hidden_text(frame, html):
    assert extracted(frame([(1, "http://h/1", html)], "page_id long, url string, html string")).first()["text"] == STORY.strip()
