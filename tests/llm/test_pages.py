"""Pages that once failed or took time with the square of their depth."""

import time

import pytest

from panelwright.llm import html

PROSE = "The article itself goes on for a good while, with sentences, commas and full stops. " * 6


@pytest.mark.parametrize("value", ["Price", "", "1", "0", "-1", "1e3", "é"])
def test_attributes_of_real_pages_are_no_labels(spark, value):
    page = f'<html><body><article><p>{PROSE}</p><table><tr><td data-label="{value}">4.50 in all</td></tr></table></article></body></html>'
    rows = spark.createDataFrame([(1, page), (2, page.replace(f"data-label=\"{value}\"", "")), (3, None)], "page_id long, html string")
    found = {r.page_id: r.text for r in html.extract(rows).collect()}
    assert found[1] == found[2] and PROSE.strip() in found[1] and found[3] == ""
    assert set(html.parse(page).label) == {-1} and 1 in html.parse(html.LabelledPage('<div data-label="1"><p>x</p></div>')).label


def test_deep_and_unmatched_markup_in_linear_time():
    trees = html.train(layouts=40)
    took = []
    for n in (12_500, 50_000):
        page = "<div>" * n + f"<p>{PROSE}</p>" + "</span></section></li>" * n + "</div>" * n
        start = time.perf_counter()
        (text,) = html.main_texts([page], trees)
        took.append(time.perf_counter() - start)
        assert text in ("", PROSE.strip())
    assert took[1] < 12 * took[0] + 1  # four times the blocks


def test_an_end_closes_what_is_open_inside():
    dom = html.parse("<section><div><ul><li>one<li>two</section><p>three</div>four")
    assert [t for _, t, _ in dom.runs] == ["one", "two", "three", "four"]
    assert dom.parent == [0, 0, 1, 2, 3, 3, 0]
