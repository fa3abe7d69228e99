"""Parts that are hidden, names that only look so, and pages that a host's path covers in part."""

import pytest

from stockweave.llm import html_text

SHOWN = [
    'class="overflow-hidden"', 'class="not-hidden wide"', 'style="overflow:hidden"', 'style="overflow: hidden; width:1px"', 'data-hidden="true"',
    ':hidden="no"', 'x_hidden=1', 'aria-hidden="false"', 'title="hidden"', 'title="display:none"', 'data-aria-hidden="true"',
    'style="display:none;display:block"', 'style="backface-visibility:hidden"', 'hidden="until-found"',
]
UNSEEN = [
    "hidden", 'class="a" hidden', 'hidden=""', "HIDDEN=hidden", 'aria-hidden="true"', "aria-hidden = TRUE", 'style="color:red; Display : None"',
    "style='display:none !important'", 'style="visibility:hidden"',
]


@pytest.mark.parametrize("attribute", SHOWN + UNSEEN)
def test_only_hidden_parts_are_left_out(attribute):
    text = html_text.read_page(f"<body><p>Head of it</p><div {attribute}><p>the whole article</p></div></body>").extract([])
    assert text == ("Head of it the whole article" if attribute in SHOWN else "Head of it")


def test_a_host_path_with_half_of_a_page_does_not_cut_it(spark):
    usual = '<body><div class="lead"><p>%s</p></div></body>' % ("one part only " * 20)
    split = '<body><div class="lead"><p>%s</p></div><div class="rest"><p>%s</p></div></body>' % ("lead " * 60, "rest " * 40)
    rows = [(k, "http://h/", usual) for k in range(20)] + [(20, "http://h/", split)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert text[0] == ("one part only " * 20).strip() and text[20] == ("lead " * 60 + "rest " * 40).strip()
