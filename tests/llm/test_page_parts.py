"""What belongs to the article, on pages whose parts are named or nested in unusual ways."""

import random

import pytest

from stockweave.llm import html_text

BODY = "body text of the article " * 20
PAGES = {
    "lead in a sibling": ('<div><div class="lead"><p>Lead.</p></div><div class="b"><p>%s</p></div></div>', "Lead. %s"),
    "closing in a sibling": ('<div><div class="b"><p>%s</p></div><div class="end"><p>The end.</p></div></div>', "%s The end."),
    "heading in a sibling": ('<div><div class="t"><h1>Title</h1></div><div class="b"><p>%s</p></div></div>', "Title %s"),
    "heading before the article": ('<div class="t"><h1>Title</h1></div><article><p>%s</p></article>', "Title %s"),
    "wrapper with a listed part of a name": ('<div class="wrapper fixed-header"><article><p>%s</p></article></div>', "%s"),
    "the same around a plain container": (
        '<div class="site-header">Brand</div><div class="fixed-header"><div><p>%s</p></div></div><div class="comments"><p>long comment %s</p></div>',
        "%s",
    ),
    "wrapper with a listed name": ('<div class="sidebar-layout"><p>%s</p></div><div class="footer"><p>About us.</p></div>', "%s"),
    "section of the article": ('<article><p>%s</p><section id="related-work"><p>Others did it too.</p></section></article>', "%s Others did it too."),
    "list of links in it": ('<article><p>%s</p><div class="related-posts"><a href="/x">Another one</a></div></article>', "%s"),
    "header of the article": ('<article><header><h1>Title</h1></header><p>%s</p></article>', "Title %s"),
    "advert in it": ('<article><p>%s</p><div class="ad-slot"><p>Buy this!</p></div></article>', "%s"),
    "comments as articles": ('<div><p>%s</p></div><section id="comments"><article class="comment"><p>Nice %s</p></article></section>', "%s"),
    "page in a form": ('<form><nav><a href="/">Home</a></nav><div><p>%s</p><select><option>a</select></div></form>', "%s"),
    "cookie notice": ('<div class="cookie-notice"><p>We use cookies on this site, for all that they are good for, and more.</p></div><p>%s</p>', "%s"),
}


@pytest.mark.parametrize("name", PAGES)
def test_article_is_whole_and_alone(name):
    html, expected = (x.replace("%s", BODY) for x in PAGES[name])
    found = html_text.read_page(f"<html><body>{html}</body></html>").extract([])
    assert found == " ".join(expected.split())


def test_every_block_of_a_random_article_is_kept_in_order():
    """Against brute force: a tree of containers with paragraphs, asides strewn in."""
    rng = random.Random(4)

    def tree(depth, blocks):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.randrange(5)
            if kind == 0 and depth < 5:
                tag = rng.choice(["div", 'div class="c%d"' % rng.randrange(9), "section", 'div class="has-sidebar"'])
                out.append(f"<{tag}>{tree(depth + 1, blocks)}</{tag.split()[0]}>")
            elif kind == 1:
                out.append(rng.choice(['<div class="ad">Buy</div>', "<nav><a href=x>Go</a></nav>", "<script>x='<p>'</script>", '<p hidden></p>']))
            else:
                blocks.append(f"Paragraph number {len(blocks)} &amp; more.")
                out.append(f"<p>{blocks[-1]}</p>")
        return "".join(out)

    for _ in range(200):
        blocks = []
        html = tree(0, blocks)
        found = html_text.read_page(f"<body><div id=top-nav><a href=x>Menu</a></div><div id=page>{html}</div><footer>(c)</footer></body>").extract([])
        assert found == " ".join(blocks).replace("&amp;", "&") or not blocks


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "<p>at the bottom</p>" + "</div>" * 49_000
    assert html_text.read_page(deep).extract([]) == "at the bottom"
    long = "<body><div>" + "<p>word</p><div class=x>%s</div>" % BODY * 20_000 + "</div></body>"
    assert html_text.read_page(long).extract([]) == " ".join(["word " + BODY.strip()] * 20_000)


def test_a_host_path_must_hold_the_running_text():
    usual = html_text.read_page(f'<div class="all"><div class="x"><p>{BODY}</p></div></div>')
    path = usual.elements[usual.best()].path
    assert path.endswith("div.x")
    other = html_text.read_page(f'<div class="all"><div class="x"><p>{BODY}</p></div><div class="y"><p>And an end.</p></div></div>')
    assert other.extract([path]).endswith("And an end.")
    wider = html_text.read_page(f'<div class="all"><div class="k">News</div><div class="x"><p>{BODY}</p></div></div>')
    assert wider.extract(["/div.all"]).startswith("News") and not wider.extract([path]).startswith("News")
