"""Pages whose skipped elements do not end."""

import pytest

from almanack.llm.html_extract import main_text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a<svg-icon></svg-icon><p>rest", "a\nrest"),
        ("<button-bar>b</button-bar><p>rest", "b\nrest"),
        ("<p>a<svg/><p>rest", "a\nrest"),
        ("<p>a<svg class='x' /><p>rest", "a\nrest"),
        ("<div>a<select><option>o<div>in</div></div><p>rest", "a\nrest"),
        ("<div>a <b><button>x</b> c</div><p>rest", "a c\nrest"),
        ("<p>a<svg><svg><g></g></svg>x</svg>b</p>", "ab"),
        ("<p>a<button>x<button>y</button>b</p>", "ab"),
        ("<p>a<script src='x'/><p>rest", "a\nrest"),
        ("<p>a<script/><p>rest", "a\nrest"),
        ("<p>a<script src=/x/>code</script>b</p>", "ab"),
        ("<p>a<script>if (a<b) '</p>' / 2 > 1</script>b<style>p", "ab"),
    ],
)
def test_only_raw_elements_run_to_the_end(page, text):
    assert main_text(page, None) == text
