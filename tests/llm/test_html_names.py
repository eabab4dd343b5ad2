"""Names of elements that hold the main text, or comments."""

import pytest

from entiva.llm.html_text import main_text

TEXT = "The river rose in the night, and by morning the lower fields, as so often, were wet. " * 3
ARTICLE = f"<article><h1>Flood</h1><p>{TEXT}</p><p>{TEXT}</p></article>"
WHOLE = " ".join(f"Flood {TEXT}{TEXT}".split())


@pytest.mark.parametrize(
    "name", ["layout has-sidebar", "wrapper no-sidebar", "container sticky-header", "site legal"]
)
@pytest.mark.parametrize("inner", [ARTICLE, f"<div><h1>Flood</h1><p>{TEXT}</p><p>{TEXT}</p></div>"])
def test_wrappers_stay(name, inner):
    page = (
        f"<body><div class='{name}'><div class='sidebar'><p>Other news of the day, in short</p>"
        f"</div>{inner}</div></body>"
    )
    assert main_text(page) == WHOLE


@pytest.mark.parametrize("name", ["post-comments", "article-comments", "comment-content"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_comments_go(name, tag):
    said = "<p>I saw it too, and it was, by all means, the worst in years for everyone here.</p>" * 3
    for page in (
        f"<body>{ARTICLE}<{tag} class='{name}'>{said}</{tag}></body>",
        ARTICLE.replace("</article>", f"<{tag} class='{name}'>{said}</{tag}></article>"),
        f"<div class='post'><h1>Flood</h1><p>{TEXT}</p><p>{TEXT}</p>"
        f"<{tag} class='{name}'><article class='comment-body'>{said}</article></{tag}></div>",
    ):
        assert main_text(page) == WHOLE


def test_what_is_named_so_goes_still():
    for name in ("sidebar", "related", "legal"):
        page = (
            f"<body>{ARTICLE}<div class='{name}'><article><p>Another piece, of a few words only,"
            " that nobody asked for here.</p></article></div></body>"
        )
        assert main_text(page) == WHOLE
