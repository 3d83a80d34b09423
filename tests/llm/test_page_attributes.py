"""Attributes and class words that must not cost a page its text."""

import pytest

from gaugewise.llm.html_text import main_text

TEXT = "A long text, with marks. And more of it here, so that it counts."
LONG = "\n\n".join([TEXT] * 3)
PARTS = f"<p>{TEXT}</p>" * 3


@pytest.mark.parametrize(
    "attributes",
    ['style="overflow:hidden"', 'aria-hidden="false"', 'data-class="ad"', 'title="class=sidebar hidden"', 'class="layout has-sidebar"', "class=no-sidebar"]
    + ['class="page with-header"', 'id="search-layout"', 'class="content sidebar-left"'],
)
@pytest.mark.parametrize("element", ["div", "article", "section"])
def test_wrappers_stay(element, attributes):
    page = f"<body><nav>Menu</nav><{element} {attributes}>{PARTS}<div class=sidebar><p>Beside.</p></div></{element}><footer>Us</footer></body>"
    assert main_text(page) == LONG


def test_furniture_goes():
    rest = "<div class='comments'><p>I like it, really, all of it, and this is why I do.</p></div>"
    for furniture in (f"<div hidden>{PARTS}</div>", f"<div aria-hidden='true'>{PARTS}</div>", rest, f"<div role=banner>{PARTS}</div>"):
        assert main_text(f"<body><div>{PARTS}</div>{furniture}</body>") == LONG
        assert main_text(f"<body><article>{PARTS}{furniture}</article></body>") == LONG
    assert main_text(f"<body><div>{PARTS}</div>" + rest * 20 + "</body>") == LONG


def test_text_beside_marked_teasers():
    assert LONG in main_text(f"<body><div>{PARTS}</div><aside-list><article><p>Read this.</p></article></aside-list></body>")
    assert main_text(f"<body><article>{PARTS}<p>Short.</p></article><p>Not part of it.</p></body>") == LONG + "\n\nShort."
    assert LONG in main_text(f"<body><div class=sidebar><div class='main-area'><article>{PARTS}</article></div></div></body>")
