import html
import re

from convlens.llm.html_text import extract, main_text


def expected(page):
    """The article of the generator's pages by a plain reading."""
    a = page[page.index("<article>") + 9:]
    a = a[:a.index("</article>")] if "</article>" in a else a
    blocks = re.split(r"</?(?:p|h1)>", a)
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if x)


def test_pages_against_plain_reading(spark, sf):
    from convlens.llm.queries import op1_html_text
    got = {r.page_id: r for r in op1_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == expected(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_clutter_without_article_element():
    page = ("<body><header>Site name</header><ul class='menu'><li><a href=a>Home</a><li><a href=b>News</a></ul><h1>Title</h1>"
            "<p>A long first paragraph with enough text in it to surge.<p>Yes.<div id=side-bar>Popular stories</div>"
            "<form>Search <input></form><div class='comments'><p>Nice post, a long comment by a reader of the page</div></body>")
    assert main_text(page) == "Title\nA long first paragraph with enough text in it to surge.\nYes."


def test_clutter_inside_article_leaves_no_gap():
    page = ("<article><header><h1>T</h1></header><p>One long paragraph of the text.</p><aside>Also read this</aside>"
            "<div class='ad'>Buy</div><p>End.</p><section class=comments><p>First!</p></section></article><p>Outside, long, unmarked text follows here")
    assert main_text(page) == "T\nOne long paragraph of the text.\nEnd."


def test_markup_details():
    assert main_text("a < b &lt; c &#x41;&nbsp;d") == "a < b < c A d"
    assert main_text("<p title='a>b'>ok</p><!-- open comment") == "ok"
    assert main_text("<p>x<script>var t='</p>';</script>y<style>p{}</style>") == "xy"
    assert main_text("<p>x<p class=ad>buy<p>y") == "x\ny"
    assert main_text("<p>a<br>b\n\t c</p>") == "a b c"


def test_edge_cases(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, None), (2, ""), (3, "<nav>only menu</nav>"), (4, long), (4, long), (None, "<p>t</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "1 AS Window", "'z' AS line")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in extract(df).collect()))
    assert [g[1] for g in got[:4]] == ["t", "", "", ""]
    assert [g[2] for g in got[4:]] == [5 * 200_000 - 1] * 2
    assert extract(df.limit(0)).collect() == []


def test_attribute_words_that_name_no_clutter():
    for a in ('style="overflow:hidden"', 'data-hidden="false"', 'title="the hidden cost"', 'class="overflow-hidden"', 'class="no-sidebar"',
              'class="has-sidebar main"', 'data-x=a-hidden'):
        assert main_text(f"<body><div {a}><p>All of the article's text.</p></div></body>") == "All of the article's text.", a
    for a in ("hidden", 'HIDDEN=""', 'class="hidden"', 'class="x ad-slot"', "id=side-bar", 'class="siteFooter"', 'id="comments"', "aria-hidden=true"):
        assert main_text(f"<body><p>The whole article is here.</p><div {a}>Clutter, clutter, clutter and more of it.</div></body>") == "The whole article is here.", a
    page = ('<article id="discussion"><h1 id="warning">Title</h1><section id="related"><p>One.</p></section><div id="related-work"><p>Two.</p></div>'
            '<h2 id="warning-signs">Signs</h2><p>Three.</p><div class="ad">Buy</div></article>')
    assert main_text(page) == "Title\nOne.\nTwo.\nSigns\nThree."


def test_short_paragraphs_beside_clutter():
    text = "A paragraph that is long enough to be a surge of its own in the page's line lengths. " * 3
    text = text.strip()
    assert main_text(f"<body><div><p>Hi.</p><div class=ad>Buy</div><p>{text}</p><aside>See also</aside><p>Bye.</p></div></body>") == f"Hi.\n{text}\nBye."
    page = f"<body><div><p>{text}</p></div><nav>x</nav><div><p>{text * 100}</p></div><nav>x</nav><div><p>{text}</p></div></body>"
    assert main_text(page) == f"{text}\n{text * 100}\n{text}"


def test_teaser_card_does_not_hide_the_page():
    text = "The main text of the page, in an element that is no article. " * 5
    page = f"<body><div><p>{text}</p><p>{text}</p></div><article><h3>Teaser</h3><p>Read this one as well.</p></article></body>"
    assert main_text(page).startswith("\n".join([text.strip()] * 2))


P = "A paragraph with enough words in it to be the text of a page."


def test_closing_paragraph_beside_an_advert_between_containers():
    assert main_text(f"<body><div><p>{P * 4}</p><p>{P * 4}</p></div><div class=ad>Buy</div><div><p>The end.</p></div></body>") == f"{P * 4}\n{P * 4}\nThe end."


def test_links_that_are_text():
    page = f"<body><div><h1><a href=x>A headline that links to itself</a></h1><p>{P}</p><p><a href=y>A paragraph that is a link</a></p><p>{P}</p></div></body>"
    assert main_text(page) == f"A headline that links to itself\n{P}\nA paragraph that is a link\n{P}"
    assert main_text(f"<body><p><a href=a>Home</a></p><p><a href=b>News</a></p><div><p>{P}</p></div></body>") == P


def test_elements_that_hold_the_page():
    for before, after in (("<form action=x>", "</form>"), ("<div class='widget-area'>", "</div>"), ("<nav><a href=a>Home</a>", ""), ("<aside>", "")):
        page = f"<body><div>Site</div>{before}<div><p>{P}</p><div class=ad><p>Buy</p></div><p>{P}</p></div>{after}</body>"
        assert main_text(page).endswith(f"{P}\n{P}") and "Buy" not in main_text(page) and "Home" not in main_text(page), before
    comments = "<div class=comments>" + f"<p>{P * 9}</p>" * 9 + "</div>"
    assert main_text(f"<body><div><p>{P}</p></div>{comments}</body>") == P


def test_deep_nesting_is_linear():
    import time
    start = time.time()
    assert main_text("<div>" * 40_000 + f"<p>{P}</p>" + "</div>" * 40_000) == P
    assert main_text("<div>" * 20_000 + f"<p>{P}</p>" + "</span></section>" * 20_000) == P
    assert time.time() - start < 10
