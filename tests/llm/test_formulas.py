"""Formulas are text of their sentence; an svg or formula that is not closed ends at the next block."""

import pytest

from payfeed.llm import pagetext


def leaves(page):
    return [t for t in pagetext.parse(page).text if t]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>Let <math><mi>x</mi></math> be</p>", ["Let x be"]),
        ("<p>So <math display='block'><mrow><mi>a</mi><mo>+</mo><mspace/><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow></math>.</p><p>On</p>", ["So a+12.", "On"]),
        ("<p>A <math><semantics><mi>x</mi><annotation encoding='t'>\\x</annotation></semantics></math> b</p>", ["A x b"]),
        ("<p>A <math><semantics><mi>x</mi><annotation>\\x</semantics></math> b</p><p>c</p>", ["A x b", "c"]),
        ("<p>A <math><mi>x</mi> b</p><p>c</p>", ["A x b", "c"]),
        ("<p>A <svg><path d='1'></p><p>c</p><div>d</div>", ["A", "c", "d"]),
        ("<div><svg><g></div><p>c</p><svg><text>no</text></svg><p>d</p>", ["c", "d"]),
        ("<p>A <svg><svg/><svg><text>no</text></svg><text>no</text></svg> b</p>", ["A b"]),
        ("<p>A <svg><title>no</title><foreignObject><p>no</p></foreignObject></svg> b</p>", ["A b"]),
        ("<p>A <svg><foreignObject><p>c</p><p>d</p>", ["A", "c", "d"]),
        ("<p>A <svg/> b</p>", ["A b"]),
    ],
)
def test_formulas_and_drawings(page, want):
    assert leaves(page) == want
