from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest

from clearplate.llm.main_text import IN_CHROME_NAME, IN_CHROME_TAG, NEIGHBOUR, SIBLING, UNFITTED, Block, Flow, blocks_of, costs, extract, features, fit, fit_margin, label, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><!-- <p>hidden</p> -->
<header><p>Site name, the best of all sites in the world.</p></header>
<div class="ad">Buy now, a long advert with many words in it, so that density alone would keep it. Really.</div>
<div class="cookie-banner"><p>We use cookies to make this site better for you and for others.</p></div>
<article><header><h1>A &amp; B&nbsp;news</h1></header><p>First   paragraph
of the <b>story</b>, with a <a href="/x">link</a>.<br><p>Second &lt;one&gt; &#233;.</p><p>Ok.</p>
<form><label>Your mail address</label><input name="q"></form>
<div class="comments"><p>Great article, I liked it very much, thanks for sharing.</p></div></article>
<aside><p>Related: ten other stories that you may like to read today.</p></aside>
<footer>&copy; 2024 All rights reserved by the site.</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == "A & B news\nFirst paragraph of the story, with a link.\nSecond <one> é.\nOk."


def test_without_article_tags():
    menu = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(8))
    body = "".join(f"<p>{'Some sentence with enough words in it. ' * 4}</p>" for _ in range(4))
    got = main_text(f"<body><ul>{menu}</ul><div>{body}<p>Short.</p>{body}</div><ul>{menu}</ul></body>")
    assert "Item" not in got and got.count("\n") == 8 and "Short." in got


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<!-- open", "<script>x", "a<b>c", "</p></p>", "&amp;&#0;&bogus;", "<p>" * 500 + "deep"])
def test_broken_pages(page):
    main_text(page)


# Pages and, by hand, their main text.
HAND = [
    ("<body><nav><a href=/>Home</a></nav><article><p data-x=it's>One whole paragraph of the article.</p><p title=\"5\" tall\">Second one.</p><p title=Bob's>Third.</p></article>", "One whole paragraph of the article.\nSecond one.\nThird."),
    ("<article><p>Before.</p><!-- x --!><p>After the comment.</p><!--><p>And more.</p><!---><p>End.</p></article>", "Before.\nAfter the comment.\nAnd more.\nEnd."),
    ("<article><p>Text <![CDATA[ a > b ]]>goes on here.</p><?php echo 1 ?><p>Last &lt;line&gt;.</p></article>", "Text goes on here.\nLast <line>."),
    ("<article><p>First one.</p><p class='share'>A paragraph whose class has a word of the list.</p></article>", "First one.\nA paragraph whose class has a word of the list."),
    ("<main id='search-results'><p>All the results of a long search, told in one sentence.</p><p>Short.</p></main><footer>Foot</footer>", "All the results of a long search, told in one sentence.\nShort."),
    ("<div class='header-content'><p>Some sentence with enough words in it to be kept as content of this page.</p><p>Short.</p><p>Another sentence with enough words in it to be kept as content.</p></div>", "Some sentence with enough words in it to be kept as content of this page.\nShort.\nAnother sentence with enough words in it to be kept as content."),
    ("<article><p>Body text of the article, all of it.</p><noscript><p>A picture, told in words.</p></noscript><div id='discussion'><p>Nice one, I liked it a lot, thank you all for it.</p></div></article><noscript>Please turn scripts on.</noscript>", "Body text of the article, all of it.\nA picture, told in words."),
    ("<article><ul><li>One point of the list.<li>Two points of it.</ul><table><tr><td>A cell of text<td>And one more</table></article>", "One point of the list.\nTwo points of it.\nA cell of text\nAnd one more"),
    ("<article><p>One <b>bold <i>both</b> text</i> here.</p></div></section><p>Stray ends above.</p></article>", "One bold both text here.\nStray ends above."),
]


@pytest.mark.parametrize(("page", "text"), HAND)
def test_pages_by_hand(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<p>a" + "<b c='" * 170_000, "<b>" * 170_000 + "</i>" * 170_000, "<b>" * 100_000 + "<div>x</div>" * 30_000, "<" * 1_000_000, "<![CDATA[" * 100_000, "<a " * 300_000, "<div>" * 100_000 + "</p>" * 100_000, "<!--" * 200_000])
def test_time_grows_with_the_page(page):
    start = time.process_time()
    blocks_of(page)
    assert time.process_time() - start < 3


def some_blocks(rng, n):
    return [Block("w" * rng.randrange(1, 400) + rng.choice(". "), rng.randrange(3), rng.choice([0.0, 0.0, IN_CHROME_NAME, IN_CHROME_TAG]), rng.random() < 0.4, rng.random() < 0.2, rng.random(), rng.randrange(6)) for _ in range(n)]


def test_cut_is_least_of_all_labellings():
    rng = random.Random(3)
    for _ in range(60):
        blocks = some_blocks(rng, rng.randrange(1, 8))
        n, paid = len(blocks), costs(blocks)

        def cost(keep):
            total = sum(c[0] if not k else c[1] for c, k in zip(paid, keep))
            last = {}
            for i, b in enumerate(blocks):
                if i and keep[i] != keep[i - 1]:
                    total += NEIGHBOUR if b.chrome == blocks[i - 1].chrome else NEIGHBOUR / 4
                if b.parent in last and keep[i] != keep[last[b.parent]]:
                    total += SIBLING
                last[b.parent] = i
            return total

        assert cost(label(blocks)) == pytest.approx(min(cost(k) for k in itertools.product([False, True], repeat=n)))


def test_cut_mends_single_blocks():
    """A short line between long paragraphs counts as boilerplate alone, a long one in a menu as content; the cut knows better."""
    long = "Some sentence with enough words in it to be told from a menu by its length alone. " * 2
    menu = [f"<li><a href='/{k}'>Item number {k}</a></li>" for k in range(6)]
    menu[3] = "<li>This week: an offer with a good many words in it, without any link at all, for you.</li>"
    page = f"<body><ul>{''.join(menu)}</ul><div><p>{long}</p><p>Well</p><p>{long}</p><p>{long}</p></div>"
    blocks = blocks_of(page)
    alone = [drop > keep for drop, keep in costs(blocks)]
    texts = [b.text for b in blocks]
    assert not alone[texts.index("Well")] and alone[3]
    assert main_text(page) == "\n".join([long.strip(), "Well", long.strip(), long.strip()])


def test_fit_tells_words_of_articles_from_those_of_menus(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = fit(pages)
    assert weights.tolist() == fit(pages.repartition(7)).tolist() and weights.tolist() != UNFITTED.tolist()
    told = right = 0
    for r in pages.collect():
        blocks = blocks_of(r["html"])
        margin = features(blocks) @ weights
        for b, m in zip(blocks, margin):
            if b.heading or b.body == bool(b.chrome):
                continue
            told += 1
            right += (m > 0) == b.body
    assert right > 0.9 * told > 100
    assert fit(pages.limit(0)).tolist() == UNFITTED.tolist()


def test_fit_is_the_optimum():
    """Against gradient descent on the weighted loss."""
    rng = np.random.default_rng(4)
    x = np.hstack([np.ones((80, 1)), rng.normal(size=(80, 7))])
    y = (x[:, 1] + 0.5 * rng.normal(size=80) > 0.4).astype(float)
    weigh = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * 80
    w = UNFITTED.copy()
    for _ in range(20_000):
        w -= 0.01 * (x.T @ (weigh * (1 / (1 + np.exp(-x @ w)) - y)) + (w - UNFITTED))
    assert fit_margin(x, y) == pytest.approx(w, abs=1e-5)


def test_flow_value():
    f = Flow(4)
    for a, b, c in ((0, 1, 3), (0, 2, 2), (1, 2, 1), (1, 3, 2), (2, 3, 3)):
        f.edge(a, b, c)
    f.run(0, 3)
    assert sum(f.left[e ^ 1] for e in f.out[0]) == 5


def test_tables_and_edge_rows(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = extract(pages).collect()
    assert len(got) == pages.count() and all(r["n_chars"] == len(r["text"]) > 0 for r in got)
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<article>" + "<p>word one two.</p>" * 3000 + "</article>", "x")]
    odd = {(r["page_id"], r["n_chars"]) for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert odd == {(1, 0), (None, 0), (2, 3000 * 13 + 2999)}
    assert extract(pages.limit(0)).count() == 0
    assert blocks_of("<p>a<p>b")[1].text == "b"
