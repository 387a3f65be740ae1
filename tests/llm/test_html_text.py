import html
import math
import random
import re
import time

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import html_text
from tidemark.llm.html_text import main_text
from tidemark.llm.queries import op8_main_text

LONG = "This is a paragraph with quite a few words in it, as articles have them. " * 3


def test_query_equals_slicing_the_article_out(spark, sf_dir):
    pages = pd.read_parquet(f"{sf_dir}/pages.parquet")
    want = {}
    for p, h in zip(pages.page_id, pages.html):
        body = h[h.index("<article>") + 9 : h.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", body)]
        want[p] = "\n\n".join(b for b in blocks if b)
    got = op8_main_text(spark, sf_dir).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got) and len(got) == len(pages)


def test_what_is_no_article_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav><div class="cookie-notice">We use cookies. {LONG}</div>
    <article><h1>Head &amp; line</h1><p>{LONG}</p><p>Short.</p><aside>See also {LONG}</aside><div class="ad">Buy {LONG}</div>
    <ul><li>one<li>two &nbsp; three</ul><script>var x = "<p>no</p>";</script><form><label>Mail</label><input></form>
    <p>A<br>B <a href=x>link</a> &eacute;&#233;&lt;</p><section class="comments"><p>{LONG}</p></section></article>
    <div id="sidebar">{LONG}</div><footer>&copy; nobody</footer></body></html>"""
    text = " ".join(LONG.split())
    assert main_text(page) == f"Head & line\n\n{text}\n\nShort.\n\none\n\ntwo three\n\nA B link éé<"


def test_without_an_article_tag_clusters_choose_the_region():
    links = "".join(f"<div><a href=/{i}>Link {i}</a> <a href=/x{i}>more</a></div>" for i in range(12))
    page = f"<body><div class=top>{links}</div><div class=content><h2>Title</h2><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div>© us</div></body>"
    text = " ".join(LONG.split())
    assert main_text(page) == f"Title\n\n{text}\n\nYes.\n\n{text}"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("just text", "just text"), ("<p>a<p>b", "a\n\nb"), ("</p></div>x", "x"), ("<nav>menu</nav>", ""),
    ("<article><p><b>a<br><p>b</article>tail", "a\n\nb"), ("<nav><ul><li>m<article><p>a</p></article>", "a"), ("<article>a<!-- c --><p></p>", "a"),
    ("<article><p>a&#x1F600;&unknown; &amp;amp;</p></article>", "a😀&unknown; &amp;"), ("<article><p>x</p></article><article><p>y</p></article>", "x\n\ny"),
    ("<article><p hidden>h</p><p style='display: none'>h</p><p>x</p></article>", "x"),
    ("<article><table><tr><td>a<td>b</table><p>c</article>", "a\n\nb\n\nc"),
])
def test_edges(page, want):
    assert main_text(page) == want


def test_smoothing_and_threshold():
    assert np.allclose(html_text.smooth(np.ones(7)), 1) and len(html_text.smooth(np.array([5.0]))) == 1
    peak = html_text.smooth(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert peak.argmax() == 3 and peak[2] > peak[1] > 0
    cut = html_text.threshold(np.array([1, 2, 1, 30, 31.0]))
    assert 2 < cut < 30 and html_text.threshold(np.array([4.0, 4.0])) <= 4


def test_nulls_repeats_long_pages_and_extra_columns(spark):
    big = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    rows = [(1, None, "k"), (2, "<p>x</p>", "k"), (2, "<p>x</p>", "k"), (None, big, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), len(r.text)) for r in got) == [("1", 0), ("2", 1), ("2", 1), ("None", 20_000 * (len(LONG) - 1) + 2 * 19_999)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_clusters_decide_where_articles_are_teasers_only():
    cards = "".join(f"<article><h3><a href=/{i}>Title {i}</a></h3><p>Short teaser {i}</p></article>" for i in range(8))
    text = " ".join(LONG.split())
    assert main_text(f"<body><div class=content><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div class=more>{cards}</div></body>") == f"{text}\n\nYes.\n\n{text}"
    assert main_text(f"<body><div class=content><p>{LONG}</p></div><article><p>{LONG}</p><p>Yes.</p></article></body>") == f"{text}\n\nYes."


@pytest.mark.parametrize("wrapped", [
    "<div class='content has-sidebar'>{}</div>", "<main class='with-sidebar'>{}</main>", "<article class='post comments-open'>{}</article>",
    "<div id='page' class='no-banner'><article>{}</article></div>", "<section class='social-policy'>{}</section>", "<div class='no-banner'><main class='has-menu'>{}</main></div>",
])
def test_words_do_not_drop_the_main_text(wrapped):
    text = " ".join(LONG.split())
    body = f"<p>{LONG}</p><p>Yes.</p><p>{LONG}</p>"
    other = f"<div class=sidebar><p>{LONG}</p></div><div class=related><a href=/x>{LONG * 9}</a></div>"
    assert main_text(f"<body>{wrapped.format(body)}{other}</body>") == f"{text}\n\nYes.\n\n{text}"
    if "<article" not in wrapped and "<main" not in wrapped:
        return
    comments = f"<section class=comments><article class=comment><p>{LONG}</p></article></section>"
    assert main_text(f"<body>{wrapped.format(body)}{comments}</body>") == f"{text}\n\nYes.\n\n{text}"


def test_a_teaser_is_no_article_and_a_short_article_is_one():
    body = "This body is a sentence of about sixty-four characters, it is."
    teaser = "<div><article><a href=/x>Teaser</a></article></div>"
    assert main_text(f"<div class=c><p>{body}</p></div>{teaser}") == body
    assert main_text(f"<div class=c><p>{body[:30]}</p></div>{teaser}") == body[:30]
    assert main_text(f"<div class=ad>{body}</div><article><h1>Short.</h1><p>Yes.</article>") == "Short.\n\nYes."


def test_time_is_linear_in_unclosed_elements():
    for piece in ("<b><p>x</p>", "<b></i><p>x", "<ul><li><p>x</b>", "<p><b></u>"):
        began = time.process_time()
        main_text(piece * 100_000)
        assert time.process_time() - began < 8, piece


def slow_content(lines):
    """The method again, one line at a time: ratio, Gaussian weights, the best of all two-part splits by means, regions."""
    ratio = [(len(x.text) - min(x.linked, len(x.text))) / x.tags for x in lines]
    weight = [math.exp(-0.5 * k * k) for k in range(4)]
    smoothed = []
    for i in range(len(lines)):
        near = [(weight[abs(i - j)], ratio[j]) for j in range(max(0, i - 3), min(len(lines), i + 4))]
        smoothed.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    cut = (min(smoothed) + max(smoothed)) / 2
    for _ in range(100):
        low, high = [s for s in smoothed if s < cut], [s for s in smoothed if s >= cut]
        cut = ((sum(low) / len(low) if low else min(smoothed)) + sum(high) / len(high)) / 2
    high = [i for i in range(len(lines)) if smoothed[i] >= cut - 1e-12 and ratio[i] >= cut - 1e-12] or [ratio.index(max(ratio))]
    letters = lambda x: len(re.sub(r"\s", "", x.text))
    marked = [x for x in lines if x.article]
    own = sum(max(0, letters(x) - x.linked) for x in marked)
    outside = sum(max(0, letters(lines[i]) - lines[i].linked) for i in high if not lines[i].article and not lines[i].mark)
    if marked and sum(x.linked for x in marked) <= own and outside <= 2 * own:
        return marked
    regions = {lines[i].region for i in high}
    of = {r: [x for x in lines if x.region == r] for r in {x.region for x in lines}}
    linked = {r for r, xs in of.items() if 2 * sum(x.linked for x in xs) > sum(map(letters, xs))}
    return [x for i, x in enumerate(lines) if (x.region in regions or high[0] < i < high[-1]) and x.region not in linked]


@pytest.mark.parametrize("seed", range(40))
def test_content_equals_a_plain_second_version(seed):
    rng = random.Random(seed)
    lines = []
    for i in range(rng.randint(1, 30)):
        text = " ".join("word" * rng.randint(1, 2) for _ in range(rng.choice([1, 2, 5, 40])))
        lines.append(html_text.Line(text, rng.randint(1, 6), rng.choice([0, 0, len(text) // 2, len(text)]), rng.randint(1, 4), rng.random() < seed % 3 / 4, rng.choice([0, 0, 1])))
    assert [id(x) for x in html_text.content(lines)] == [id(x) for x in slow_content(lines)]


def test_columns_of_the_output_names_are_replaced(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>", "old", "k")], "page_id long, html string, Text string, url string")
    assert [tuple(r) for r in html_text.extract(pages).collect()] == [(1, "<p>a</p>", "k", "a")]
