"""Tags that HTML lets a page omit, and elements that a slash closes."""

from __future__ import annotations

import pytest

from findlake.llm.html_blocks import main_text

LONG = "This is the text of the article and it has to be long enough for the rules to decide on it."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<html><head><title>T</title><meta charset=utf-8><body><p>{LONG}</p></body></html>", LONG),
        (f"<head><script>var a;</script><article><p>{LONG}</article>", LONG),
        (f"<head><link rel=x><img src=a><p>{LONG}", LONG),
        (f"<head><title>T</title>{LONG}", LONG),
        (f"<head><template><div>{LONG}</div></template><noscript><p>{LONG}</noscript><title>{LONG}</title></head><body><p>{LONG}", LONG),
        (f"<article><p>Icon <svg width=1 />{LONG}</p></article>", f"Icon {LONG}"),
        (f"<article><p><math/>{LONG}</p><svg><svg/><text>no</text></svg><p>Short.</article>", f"{LONG} Short."),
        (f"<article><p><svg><path d=a /><text>no</text></svg>{LONG}</p></article>", LONG),
    ],
)
def test_as_browsers_read_it(page, text):
    assert main_text(page) == text
