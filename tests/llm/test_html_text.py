"""Main text of pages whose article stands in oddly named boxes, where the cut decides, and of broken markup."""

import time

import pytest

from campaign_spark.llm import html_text as h

PARAS = ["First paragraph, long enough to be read by people who care for such things.", "Short.",
         "The last one; it ends the text, with some more words in it."]
BODY = "<h1>Title here</h1>" + "".join(f"<p>{p}</p>" for p in PARAS)
TEXT = "\n".join(["Title here", *PARAS])
ARTICLE = f"<article>{BODY}</article>"
MENU = "<nav><a href=/>Home</a></nav>"


@pytest.mark.parametrize("page", [
    f'<div class="page has-sidebar">{ARTICLE}</div>',
    f'<div class="article-with-comments">{ARTICLE}</div>',
    f'<div class="no-header"><main>{BODY}</main></div>',
    f"<form>{MENU}<main>{BODY}</main></form>",
    f'<form id="aspnetForm">{MENU}<div id="content">{BODY}</div><input></form>',
    f'<div class="ad">Buy it now!{ARTICLE}<footer>Foot.</footer>',
    f'<div class="legal">{ARTICLE}</div>',
    f'<div class="sidebar"><main>{BODY}</main></div>',
    f'{MENU}{ARTICLE}<div id="comments"><article><p>{PARAS[0] * 3}</p></article></div>',
    f'{MENU}{ARTICLE}<article class="comment"><p>{PARAS[0] * 3}</p></article>',
    f'{ARTICLE}<div class="x7">And this is told beside the article, in a box of no name.</div>',
    f'<form action=x>Name <input><p>{PARAS[0]}</p></form>{ARTICLE}',
    ARTICLE.replace("<p>Short", "<div data-ad-slot=3>Cheap shoes here.</div><p>Short"),
    ARTICLE.replace("</article>", '<div class="xq7"><a href=z>Buy the best shoes now</a></div></article>'),
    ARTICLE.replace("</article>", "<ul>" + "".join(f"<li><a href=x>Story {k}</a></li>" for k in range(9)) + "</ul></article>"),
    f'{MENU}<div hidden>{ARTICLE}</div><main>{BODY}</main>',
])
def test_article_alone(page):
    assert h.main_text(page) == TEXT


def decided(page):
    found = h.blocks(page)
    score = h.unary(found)
    kept = h.content(score, h._edges([b[1] for b in found]))
    return [(b[0], s > 0, k) for b, s, k in zip(found, score, kept)]


def test_cut_decides_by_the_neighbours():
    linked = "<p><a href=x>See the whole of the report here.</a></p>"
    inside = decided(f"<article>{BODY}{linked}{BODY}</article>")
    assert [x[1:] for x in inside if x[0].startswith("See")] == [(False, True)]
    among = decided("<article>" + BODY + linked * 6 + "</article>")
    assert [x[1:] for x in among if x[0].startswith("See")] == [(False, False)] * 6
    between = decided(f"<body><h1>Head</h1><p>{PARAS[0]}</p><div>Between</div><p>{PARAS[2]}</p></body>")
    assert [x[1:] for x in between if x[0] == "Between"] == [(False, True)]
    alone = decided("<body><div>Between</div></body>")
    assert [x[1:] for x in alone] == [(False, False)]


@pytest.mark.parametrize("piece", ['<a "', "<a '", '<a ">" ', "<script ", "<!-", "</", "<div></b>", "<p '\" "])
def test_broken_markup_takes_linear_time(piece):
    def took(n):
        start = time.perf_counter()
        h.main_text(piece * n)
        return time.perf_counter() - start

    took(1_000)
    assert took(80_000) < 3.0  # quadratic: minutes


def test_unmatched_ends_in_deep_nesting_and_open_tags():
    start = time.perf_counter()
    assert h.main_text("<div>" * 50_000 + "</q1>" * 50_000 + f"<article><p>{PARAS[0]}") == PARAS[0]
    assert time.perf_counter() - start < 5.0
    assert h.main_text(f'<article><p>{PARAS[0]}</p><p title="x>{PARAS[1]}</p></article>') == TEXT.split("\n")[1] + "\n" + PARAS[1]
    assert h.main_text(f"<article><p>{PARAS[0]}</p><b never closed") == PARAS[0]


def test_very_long_page_and_odd_rows(spark):
    long = "<article>" + f"<p>{PARAS[0]}</p>" * 20_000 + "</article>"
    rows = [(1, "u", long, "a"), (None, None, ARTICLE, "b"), (2, "v", None, None), (2, "v", ARTICLE, "c"), (2, "v", ARTICLE, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in h.extract(pages).collect()), key=str)
    want = [(1, "u", "\n".join([PARAS[0]] * 20_000)), (0, None, TEXT), (2, "v", ""), (2, "v", TEXT), (2, "v", TEXT)]
    assert got == sorted(((*x, len(x[2])) for x in want), key=str)
