import html as entities
import re

import numpy as np
import pytest

from refinery.llm import html_density
from refinery.llm.html_density import extract, main_text, smoothed

LONG = "This is a paragraph of running text that goes on for a while, as articles do."
CASES = {
    "": "",
    "plain &amp; text": "plain & text",
    "<p>one<p>two": "one two",
    f"<nav><a>x</a></nav><article><h1>T</h1><p>{LONG}<p>Ti.</article><footer>f</footer>": f"T {LONG} Ti.",
    f"<body><header><h1>Site</h1></header><div id=content><h1>T</h1><p>{LONG}</p></div><aside>{LONG}</aside>": f"T {LONG}",
    f"<article><header><h1>T</h1></header><p>{LONG}</p><div class='ad'>{LONG}</div></article>": f"T {LONG}",
    f"<div class=post><p>{LONG}</p></div><section id=comments><p>{LONG}</p><p>{LONG}</p></section>": LONG,
    f"<main><p>{LONG}</p><form><p>Name</p><input></form><p hidden>no</p><p style='display: none'>no</p></main>": LONG,
    f"<div class='cookie-notice'>{LONG}</div><article><p>a<br>b <b>c</b>d &lt;x&gt;&nbsp;e</article>": "a b cd <x> e",
    f"<article><script>if (a < b) {{ '</p>' }}</script><style>p</style><p>{LONG}</article>": LONG,
    f"<article><p>{LONG}<ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>": f"{LONG} one two x y",
    "<div hidden>no</div><!-- no --><!DOCTYPE html>": "",
    "<p>broken <b>bold <i>it</p><p>next</i> end": "broken bold it next end",
    "<<<>&&#x41;&bogus;": "<<<>&A&bogus;",
}


@pytest.mark.parametrize("html", list(CASES))
def test_known_pages(html):
    assert main_text(html) == CASES[html]


def test_smoothing_keeps_a_constant():
    assert np.allclose(smoothed(np.full(9, 3.0)), 3.0) and np.allclose(smoothed(np.ones(1)), 1.0)


def test_articles_of_the_pages_equal_a_pattern(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in extract(rows).collect()}
    for row in rows.collect():
        inside = re.search("(?s)<article>(.*?)</article>", row.html)[1]
        blocks = re.split("</?(?:p|h1)>", inside.replace("<br>", " "))
        texts = (" ".join(entities.unescape(re.sub("</?b>", "", b)).split()) for b in blocks)
        assert found[row.page_id].text == " ".join(t for t in texts if t)
        assert found[row.page_id].n_chars == len(found[row.page_id].text)


def test_edge_rows(spark):
    rows = [(1, None), (1, None), (None, "<p>x"), (2, "<div>" * 3000 + "deep"), (3, f"<article>{'<p>' + LONG + '</p>'}" * 2000), (4, "")]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id bigint, html string, text string, url string")
    found = extract(frame).collect()
    assert len(found) == 6 and all(r.url == "b" for r in found)
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == "" == texts[4] and texts[None] == "x" and texts[2] == "deep" and texts[3].count(LONG) == 2000
    assert extract(frame.limit(0)).count() == 0


NINE = "".join(f"<p>{i} {LONG}</p>" for i in range(9))
NINE_TEXT = " ".join(f"{i} {LONG}" for i in range(9))


@pytest.mark.parametrize("around", ["body", "main", "div"])
def test_a_last_paragraph_in_a_section_of_its_own_stays(around):
    assert main_text(f"<{around}><div>{NINE}</div><div><p>{LONG}</p></div></{around}>") == f"{NINE_TEXT} {LONG}"


def test_a_teaser_article_does_not_replace_the_body():
    for article in ("<article><h2>More</h2><p>A short teaser.</p></article>", f"<article><p>{LONG}</p></article>"):
        for page in (f"<body>{article}<div id=content>{NINE}</div></body>", f"<body><div id=content>{NINE}</div>{article}</body>"):
            assert NINE_TEXT in main_text(page)


def test_text_outside_an_article_is_judged_by_its_ratio():
    links = "<div><a href=/a>Other</a> <a href=/b>pages</a></div>"
    assert main_text(f"<body>{links}<article>{NINE}</article><div><p>{LONG}</p></div>{links}<div>(c) x</div></body>") == f"{NINE_TEXT} {LONG}"


NAMED = ["section id=discussion", "section id=related-work", "div class=social-history", "p class=notice", "div id=search-algorithms"]


@pytest.mark.parametrize("named", NAMED)
def test_a_name_alone_takes_no_text_from_an_article(named):
    tag = named.split()[0]
    inside = LONG if tag == "p" else f"<p>{LONG}</p><p>{LONG}</p>"
    text = LONG if tag == "p" else f"{LONG} {LONG}"
    assert main_text(f"<article>{NINE}<{named}>{inside}</{tag}><p>{LONG}</p></article>") == f"{NINE_TEXT} {text} {LONG}"


def test_names_and_ratios_together_take_boilerplate_from_an_article():
    links = "".join(f"<li><a href=/{i}>Another article of this site</a></li>" for i in range(5))
    for part in ("<div class=share-this>Share <b>it</b></div>", f"<ul class=related>{links}</ul>", f"<div id=comments>{NINE}</div>",
                 f"<div class='site-ad ad-slot2'>{LONG}</div>", f"<div class=relatedPosts><h4>More</h4><ul>{links}</ul></div>"):
        assert main_text(f"<article>{NINE}{part}<p>{LONG}</p></article>") == f"{NINE_TEXT} {LONG}"


def test_a_page_in_one_form_has_its_text():
    side = "<div class=sidebar><p>Short.</p></div><form class=search-form><label>Find</label><input></form>"
    page = f"<body><form action=/x><input type=hidden><nav>no</nav><div id=content>{NINE}</div>{side}</form></body>"
    assert main_text(page) == NINE_TEXT


def test_a_wrapper_named_like_a_part_keeps_the_page():
    assert main_text(f"<body><div id=top><div>{NINE}</div></div><div>(c) x</div></body>") == NINE_TEXT


@pytest.mark.parametrize("named", ["div id=comments", "noscript", "div class=comment-list", "div class=ad-container"])
def test_a_page_whose_text_stands_in_a_named_element_has_it(named):
    nav, foot = "<nav><a href=/>Home</a></nav>", "<div>(c) x</div>"
    page = main_text(f"<body>{nav}<{named}>{NINE}</{named.split()[0]}>{foot}</body>")
    assert page == NINE_TEXT
    # Beside other text, whatever its length, the same element is left out.
    for other in (f"<p>{LONG}</p><p>{LONG}</p>", f"<article><p>{LONG}</p></article>", "<main><p>Short.</p></main>"):
        assert NINE_TEXT not in main_text(f"<body>{nav}{other}<{named}>{NINE}</{named.split()[0]}>{foot}</body>")


def test_inline_elements_set_aside_leave_the_line_whole():
    for inside in ("<span class=ad>Buy <b>this</b></span>", "<noscript>Turn it on<br>now</noscript>", "<span class=comments><a href=/>9</a></span>"):
        assert main_text(f"<article>{NINE}<p>Half a wo{inside}rd, {LONG}{inside}</p></article>") == f"{NINE_TEXT} Half a word, {LONG}"
        assert main_text(f"<article><p>One{inside}<p>Two {LONG}</article>") == f"One Two {LONG}"


@pytest.mark.parametrize("named", ["section id=consent", "section id=cookies", "div class=sponsors"])
def test_a_section_of_an_article_on_such_a_topic_stays(named):
    tag = named.split()[0]
    assert main_text(f"<article>{NINE}<{named}><p>{LONG}</p><p>{LONG}</p></{tag}><p>{LONG}</p></article>") == f"{NINE_TEXT} {LONG} {LONG} {LONG}"
    links = "".join(f"<a href=/{i}>Partner {i}</a> " for i in range(9))
    assert main_text(f"<article>{NINE}<{named}>{links}</{tag}><p>{LONG}</p></article>") == f"{NINE_TEXT} {LONG}"


def test_cookie_banners_stay_out():
    for banner in ("div class=cookie-consent", "div id=cookies", "div class=gdpr", "div id=cookie-banner"):
        assert main_text(f"<body><{banner}><p>{LONG}</p><button>OK</button></div><div>{NINE}</div></body>") == NINE_TEXT


def items(n):
    """Entries of a list without a name that tells, and without links: many tags, little text in each."""
    return "".join(f"<div><span><i></i><b>Entry {i}</b><em></em></span><span></span><small>{i} pieces</small></div>" for i in range(n))


PAGES = {
    f"<body><div>{items(60)}</div><div>{NINE}</div><div>{items(40)}</div></body>": NINE_TEXT,
    f"<body><div><div>{items(90)}</div></div><div><div>{NINE[:len(NINE) // 3 * 2 + 40]}</div></div></body>": None,
    f"<body><article><h2>Teaser</h2><p>A few words.</p></article><article>{items(80)}</article><div>{NINE}</div></body>": NINE_TEXT,
    f"<table><tr><td>{items(70)}</td><td>{NINE}</td></tr></table>": NINE_TEXT,
}


def overlap(found, text):
    a, b = found.split(), text.split()
    common = sum(min(a.count(w), b.count(w)) for w in set(a))
    return 2 * common / max(len(a) + len(b), 1)


@pytest.mark.parametrize("without", ["lengths", "ones", "random"])
def test_the_ratios_decide_pages_without_a_single_article(monkeypatch, without):
    pages = {page: text or re.sub("<[^>]*>", " ", page[page.index("<p>0 ") :]) for page, text in PAGES.items()}
    right = {page: overlap(main_text(page), text) for page, text in pages.items()}
    assert all(score >= 0.95 for score in right.values())
    draw = np.random.default_rng(0)
    off = {
        "lengths": lambda lines: np.array([len(x.text) - x.linked for x in lines], float),
        "ones": lambda lines: np.ones(len(lines)),
        "random": lambda lines: draw.random(len(lines)),
    }
    monkeypatch.setattr(html_density, "_clusters", off[without])
    wrong = {page: overlap(main_text(page), text) for page, text in pages.items()}
    assert sum(wrong[page] < right[page] - 0.2 for page in pages) >= 3
