"""Min-cut extraction: cuts against brute force, pages with known text."""

import itertools
import random

from lendscope.llm.html_mincut import blocks, extract, log_odds, main_text, min_cut, ties

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";go(1<2)</script></head>
<body class="has-sidebar"><header class="site-header"><a href="/">Home</a><p>The best site of all, read every day.</p></header>
<nav><ul><li><a href="/a">One</a><li><a href='/b>c'>Two</a></ul></nav><div class="cookie-notice">We use cookies to make this
site better for every reader of it. <button>Accept</button></div><!-- <p>comment</p> -->
<article><header><h1>A  title &amp; more</h1></header><p><b>First para&shy;graph with <i>inline</i> words,<br>and a second line.
<p>Short.<div class="ad">Buy the new thing now, it is better than the old thing.</div><p>Third &lt;one&gt; caf&eacute; &#8364;5 &copy
end.<ul><li>item one of the list</li><li>item two</li></ul><blockquote>Quoted words here.</blockquote>
<section id="comments"><h2>Comments</h2><p>I liked this article a lot, thank you for it.</p></section></article>
<aside><p>Some other long text that stands beside the article and is not part of it.</p></aside>
<form><label>Mail</label><input name=x><select><option>a<option>b</select></form>
<footer>&copy; example &middot; All rights reserved.</footer></body></html>"""
WANT = ["A title & more", "First para\xadgraph with inline words, and a second line.", "Short.",
        "Third <one> café €5 © end.", "item one of the list", "item two", "Quoted words here."]


def test_known_page():
    assert main_text(PAGE).split("\n\n") == WANT
    assert main_text(PAGE.upper().replace("&AMP;", "&amp;").replace("&SHY;", "").replace("&EACUTE;", "E"))[:14] == "A TITLE & MORE"


def test_pages_without_article_and_cut_off():
    long = "This is a long paragraph of plain text that says many things about the subject of the page. " * 2
    page = f"<div id=wrap><div class=menu><a href=1>x</a></div><div><p>{long}<p>Yes.<p>{long}</div><div class='sidebar'>{long}</div>"
    assert main_text(page).split("\n\n") == [long.strip(), "Yes.", long.strip()]
    assert main_text(page + "<a href='cut") .count("\n\n") == 2
    assert main_text("") == main_text("<p>") == main_text("<script>x") == main_text("<!-- <p>a") == ""
    assert "a < b" in main_text(f"<article><p>a < b and {long}")


def test_min_cut_equals_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 8)
        score = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            c = sum(-s if not x else 0 for s, x in zip(score, label) if s < 0) * 0
            for s, x in zip(score, label):
                c += max(s, 0) if not x else max(-s, 0)
            return c + sum(w for i, j, w in edges if label[i] != label[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(min_cut(score, edges)) - best < 0.05


def test_large_pages_take_linear_time():
    page = "<div>" * 20_000 + "<p>word <a href=x>" * 20_000 + "<li>" * 20_000 + "</b>" * 20_000
    assert isinstance(main_text(page), str)
    assert len(main_text("<article>" + "<p>Some words that end here." * 20_000)) > 400_000


def test_query_rows(spark):
    rows = [(1, "u", PAGE, "t", 1), (None, None, None, None, None), (2, "u", "", "t", 1), (1, "u", PAGE, "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = extract(pages).collect()
    want = "\n\n".join(WANT)
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [
        (1, "u", want, len(want)), (1, "u", want, len(want)), (2, "u", "", 0), (None, None, "", 0)]))
    assert extract(spark.createDataFrame([], pages.schema)).count() == 0


def test_wrappers_with_boilerplate_names():
    long = "This is a long paragraph of plain text that says many things about the subject of the page. " * 2
    story, want = f"<h1>A title</h1><p>{long}<p>{long}", ["A title", long.strip(), long.strip()]
    rest = f"<div class='sidebar'><p>{long}</div><ul id=comments><li class=comment>{long}<li class=comment>{long}</ul>"
    for tag, inner in [("form action=x", f"<article>{story}</article>"), ("div class='content-sidebar-wrap'", f"<div>{story}</div>"),
                       ("div class='no-sidebar'", f"<main>{story}</main>"), ("div id=page class='has-comments'", f"<article>{story}</article>")]:
        end = tag.split()[0]
        page = f"<body><nav><a href=1>One</a></nav><{tag}>{inner}{rest}</{end}><footer>All rights reserved.</footer></body>"
        assert main_text(page).split("\n\n") == want, tag
        assert main_text(f"<form>{page}</form>").split("\n\n") == want, tag
    # the same words on what is not a wrapper
    assert main_text(f"<article>{story}</article>{rest}<form><p>{long}</form>").split("\n\n") == want
    assert main_text(f"<div hidden><main>{story}</main></div>") == main_text(f"<aside>{story}</aside>") == ""
    assert isinstance(main_text("<form class=ad>" * 20_000 + story + "<main><p>x" * 20_000), str)


def test_names_that_ordinary_text_has_too():
    page = ("<article><h1>Markets</h1><p>The index rose again on Monday after a week of quiet trading.</p>"
            "<p class='share-price'>The closing price was 41.20.</p></article>")
    assert main_text(page) == ("Markets\n\nThe index rose again on Monday after a week of quiet trading.\n\n"
                               "The closing price was 41.20.")
    short = "<body><nav><a href='/'>Home</a></nav><div class='related-work'><p>Two earlier papers treat the same case.</p></div></body>"
    assert main_text(short) == "Two earlier papers treat the same case."
    links = ("<body><main><p>" + "Plain words of the article go on here. " * 5 + "</p></main><div class='related'>"
             + "".join(f"<p><a href='/{i}'>Another story to read</a></p>" for i in range(4)) + "</div></body>")
    assert "Another" not in main_text(links) and main_text(links).startswith("Plain words")
    advert = "<article><p>" + "Plain words of the article go on here. " * 5 + "</p><div class='ad'>Buy two, get one. Now in all shops.</div></article>"
    assert "Buy" not in main_text(advert)


def test_the_cut_overrules_the_sign_of_a_block():
    long = "The council met on Tuesday evening and spoke for two hours about the new bridge over the river."
    page = f"<body><div><p>{long}</p><p>Why now?</p><p>{long}</p><p>No</p><p>{long}</p></div></body>"
    found = blocks(page)
    texts = [" ".join("".join(b.parts).split()) for b in found]
    prices = [log_odds(b, t) for b, t in zip(found, texts)]
    assert prices[3] < 0 < prices[0]                                 # the sign alone would drop the short line
    assert min_cut(prices, ties(found)) == [True] * 5
    assert main_text(page) == "\n\n".join(texts)
    teaser = "<p><a href='/a'>" + "One more story that you may like to read today" + "</a></p>"
    bar = f"<body><div><p>{long}</p><p>{long}</p></div><div>{teaser * 3}<p>More stories of the week, every day for you</p>{teaser * 3}</div></body>"
    found = blocks(bar)
    texts = [" ".join("".join(b.parts).split()) for b in found]
    prices = [log_odds(b, t) for b, t in zip(found, texts)]
    assert prices[5] > 0                                             # text between teasers looks like content
    assert main_text(bar) == f"{long}\n\n{long}"
