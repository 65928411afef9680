"""Pages lose nothing beyond the kinds of markup that the extraction names."""

import pytest

from loomline.llm import html_extract


@pytest.mark.parametrize(
    ("inside", "kept"),
    [
        ("<p>A</p><svg viewBox='0 0 9 9'/><p>B</p>", "A\n\nB"),
        ("<p>A</p><svg/><p>B</p><svg><text>icon</text></svg><p>C</p>", "A\n\nB\n\nC"),
        ("<p>A</p><object data='x'/><p>B</p>", "A\n\nB"),
        ("<p>A <object data='x'>fallback</object> B</p>", "A fallback B"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><math/><p>B</p>", "so x=1 holds\n\nB"),
        ("<p>A</p><xmp><b>&amp;</xmp><p>B</p>", "A\n\n<b>&amp;\n\nB"),
        ("<p>A</p><noscript><p>B</p>", "A\n\nB"),
        ("<p>A</p><script>x</script><p>B</p><style>never ends <p>C</p>", "A\n\nB"),
    ],
)
def test_icons_formulas_and_objects(inside, kept):
    assert html_extract.main_text(f"<article>{inside}</article>", html_extract.trained()) == kept


LONG = " ".join(["Plain words of a long and link-poor paragraph that make the page."] * 6)


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        (f"<div class='content has-sidebar'><p>{LONG}</p><p>{LONG}</p></div><div class='sidebar'><p>Side words.</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<div id='page' class='no-sidebar'><article><p>{LONG}</p><div class='ad'>Buy</div></article></div>", LONG),
        (f"<div class='elementor-widget'><article><p>{LONG}</p></article></div><div class='widget'><p>{LONG}</p></div>", LONG),
        (f"<div class='elementor-widget elementor-widget-text-editor'><p>{LONG}</p></div><div class='comments'><p>Nice post.</p></div>", LONG),
        (f"<article><p>Short.</p></article><div class='comments'><p>{LONG}</p><article>A comment.</article></div>", "Short."),
    ],
)
def test_names_of_wrappers_are_no_verdict(page, kept):
    assert html_extract.main_text(f"<html><body>{page}</body></html>", html_extract.trained()) == kept


WORDS = "Some words of a paragraph that tells a little more of the matter."

#: Hand-labelled pages that the tree hasn't seen: html and main text.
HELD_OUT = [
    (f"<title>Leak</title><article><h1>Head</h1><p>{LONG}</p></article>", f"Head\n\n{LONG}"),
    (f"<article><div class='social-policy-report'><p>{LONG}</p><p>Yes.</p></div><p>{WORDS}</p></article>", f"{LONG}\n\nYes.\n\n{WORDS}"),
    (f"<article><p>{LONG}</p><section id='related-work'><h2>Related work</h2><p>{WORDS}</p></section></article>", f"{LONG}\n\nRelated work\n\n{WORDS}"),
    (f"<article><ul class='x'><li><a href=1>Home</a></li><li><a href=2>World</a></li><li><a href=3>Sport today</a></li></ul><p>{WORDS}</p><p>{LONG}</p></article>", f"{WORDS}\n\n{LONG}"),
    (f"<article><p>{WORDS}</p><p><a href=1>The whole report</a></p><p>{LONG}</p></article>", f"{WORDS}\n\nThe whole report\n\n{LONG}"),
    (f"<article><p>{LONG}</p><div><a href=1>One</a></div><div><a href=2>Two more</a></div><div><a href=3>Three</a></div></article>", LONG),
    (f"<article><p>{WORDS} <a href=1>with a link of some words</a></p><p>No.</p></article>", f"{WORDS} with a link of some words\n\nNo."),
    (f"<article><p>{WORDS}</p><nav><p>Unclosed <article><p>{WORDS}</p></article>", WORDS),
    (f"<article><p>{WORDS}</p><footer><div><footer>In</footer>{WORDS}</div></footer><p>After.</p></article>", f"{WORDS}\n\nAfter."),
    (f"<body><nav><a>A</a></nav><main><p>{WORDS}</p><p>{WORDS}</p></main><div><p>{LONG}</p></div></body>", f"{WORDS}\n\n{WORDS}"),
    (f"<div class='top-menu'><a>A</a> <a>B</a></div><div class='story'><h1>Head words</h1><p>{LONG}</p><p>{WORDS}</p></div><div class='footer-links'><a>About us</a></div>", f"Head words\n\n{LONG}\n\n{WORDS}"),
    (f"<article><p>{LONG}</p><aside>{LONG}</aside><form><p>{LONG}</p></form><div class='cookie-consent-banner'>{WORDS}</div><p>End.</p></article><section id='comments'><p>{LONG}</p></section>", f"{LONG}\n\nEnd."),
    (f"<article><table><tr><td>Year</td><td>1999</td></tr></table><blockquote>{WORDS}</blockquote><pre>a  b\n c</pre></article>", f"Year\n\n1999\n\n{WORDS}\n\na b c"),
    (f"<article><h2><a href=1>A linked heading</a></h2><p>{WORDS}</p></article>", f"A linked heading\n\n{WORDS}"),
]


@pytest.mark.parametrize(("page", "kept"), HELD_OUT)
def test_held_out_pages(page, kept):
    assert html_extract.main_text(page, html_extract.trained()) == kept
