"""Main text of pages against rules restated here and hand-made pages."""

import html as entities
import re

from tapewright.llm import html, queries

SF = "/root/testdata/sf0.001"


def slow_text(page):
    """Blocks of the article of the given pages, which have one article each and no furniture inside it."""
    article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    parts = re.split(r"</?(?:p|h1|div)\b[^>]*>", re.sub(r"</?b>|<br>", " ", article))
    lines = [re.sub(r"\s+", " ", entities.unescape(p)).strip() for p in parts]
    return "\n".join(line for line in lines if line)


def test_query_equals_brute_force(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op1_html(spark, SF).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row.text == slow_text(pages[row.page_id].html)
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


LONG = "This is the text of a paragraph that has a number of the words that any language needs, and it is long."


def test_furniture_goes():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <div id="cookieNotice"><p>{LONG} cookies</p></div><div class="nav-menu"><a href=x>Home</a></div><form>{LONG}</form>
    <article class="post"><h1>Head &amp; line</h1><p>{LONG}</p><p>Short &lt;one&gt;.</p><script>if (a<b) x="</article><p>no</p>"</script>
    <div class="ad-box">{LONG} advert</div><aside>{LONG} aside</aside><!-- <p>{LONG} gone</p> --><p>Two   \n words<br>more</p>
    <section id="comments"><article class="comment"><p>{LONG} comment</p></article></section></article>
    <div class="sidebar"><p>{LONG} side</p></div><footer>{LONG} foot</footer></body></html>"""
    assert html.main_text(page) == f"Head & line\n{LONG}\nShort <one>.\nTwo words more"


def test_rules_without_an_article():
    links = "<a href=x>one of the links</a> <a href=y>and another of the links that are here for you to see on the page</a>"
    page = f"<div>Menu</div><div>{links}</div><p>Intro.</p><p>{LONG}</p><p>End.</p><p>{LONG}</p><div>Low</div><div>{links}</div><div>Imprint</div>"
    # Short blocks take the label of the nearest decided block; between two as near, main text decides.
    assert html.main_text(page) == f"Intro.\n{LONG}\nEnd.\n{LONG}\nLow"


def test_malformed_and_odd_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x") == ""
    assert html.main_text("plain words only") == "plain words only"
    assert html.main_text(f"<div class='ad'><article><p>{LONG}</div>") == LONG
    assert html.main_text(f'<p title="a > b">{LONG}<p>{LONG} <b>x') == f"{LONG}\n{LONG} x"
    assert html.main_text("<article><p>1 < 2 &#65;&nbsp;&eacute;&unknown; </p></article>") == "1 < 2 A é&unknown;"


def test_very_long_page_takes_linear_time():
    page = "<article>" + f'<p class="x>{LONG}</p>' * 200 + f"<p>{LONG}</p>" * 20_000
    assert html.main_text(page).count(LONG) >= 20_000


def test_rows_and_columns_stay(spark):
    rows = [(1, None, "u"), (1, None, "u"), (None, f"<p>{LONG}</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = html.extract(pages)
    assert found.columns == ["page_id", "html", "text"]
    assert sorted(r.text for r in found.collect()) == ["", "", LONG]
    assert html.extract(pages.limit(0)).collect() == []


def test_headings_of_an_article_header_stay():
    page = f"<article><header><h1>Head</h1><p>By Bob</p></header><div class='entry-header'><h2>Sub</h2><span>1 May</span></div><p>{LONG}</p></article>"
    assert html.main_text(page) == f"Head\nSub\n{LONG}"


def test_quoted_values_of_any_length_are_no_text():
    inner = "<p class='ad'>" + LONG + "</p> {\"a\" > 1} "
    for quote, value in (("'", inner.replace("'", "")), ('"', inner.replace('"', ""))):
        for times in (1, 100):
            held = f"data-x={quote}{value * times}{quote}"
            assert html.main_text(f"<div {held}><p {held}>{LONG}</p></div>") == LONG
            assert html.main_text(f"<p>{LONG}</p><div {held} class=sidebar><p>{LONG}</p></div><div role=x {held} role = 'menu'>{LONG}</div>") == LONG


def test_quotes_that_open_no_value():
    assert html.main_text(f"<p title=5\" 6'>{LONG}</p><p>{LONG} \"it's\"</p>") == f"{LONG}\n{LONG} \"it's\""
    page = f'<p class="x>{LONG}</p>' + f"<p>{LONG}</p><p id='a>b'>" * 20_000  # the first quote never ends
    assert html.main_text(page).count(LONG) == 20_001


POLISH = "W tym roku w naszym mieście otwarto nową szkołę, do której chodzi już ponad stu uczniów z całej okolicy i nie tylko."
ITEMS = "Tuesday menu: tomato soup, grilled fish, green salad, fresh bread, apple cake, coffee, tea, water, juice, milk"


def test_languages_without_listed_stop_words():
    page = f"<div>Strona</div><p>{POLISH}</p><p>Krótko.</p><p>{POLISH} A to i owo do domu.</p><div><a href=x>{POLISH}</a></div>"
    assert html.main_text(page) == f"Strona\n{POLISH}\nKrótko.\n{POLISH} A to i owo do domu."
    # Blocks without stop words are other text on a page of a known language, and its stop words are those of one language.
    assert html.main_text(f"<p>{LONG}</p><p>{ITEMS}</p>") == LONG
    german = "Die Schule in der Stadt ist neu und sie hat mehr als hundert Schüler, die aus dem ganzen Land zu ihr kommen."
    assert html.main_text(f"<p>{LONG}</p><p>{german}</p>") == f"{LONG}\n{german}"


def test_text_beside_an_article_competes():
    card = "<article class=card><h3>Card</h3><p>More.</p></article>"
    assert html.main_text(f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>{card}").startswith(f"Head\n{LONG}\n{LONG}")
    assert html.main_text(f"<p>{ITEMS}</p><article><p>{LONG}</p></article><div>Imprint</div><div>{ITEMS}</div>") == LONG


def test_drawings_end_where_the_standard_ends_them():
    for drawing in ('<svg class="i"/>', "<svg/>", "<svg><path d='M0 0'/><text>no</text></svg>", "<svg><svg><text>no</text></svg><text>no</text></svg>", "<math/>"):
        assert html.main_text(f"<article><p>{LONG}</p>{drawing}<p>{LONG} more</p></article>") == f"{LONG}\n{LONG} more", drawing
    assert html.main_text(f"<article><p>{LONG}<svg><text>no</text></p><p>{LONG}</p><div><svg><g><p>{LONG}</p></article>") == "\n".join([LONG] * 3)
    held = f"<svg><foreignObject><div>{LONG}</div></foreignObject></svg>"
    assert html.main_text(f"<article>{held}<p>{LONG} after</p></article>") == f"{LONG} after"


def test_formulas_stay_in_their_sentence():
    formula = "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>no</annotation></math>"
    assert html.main_text(f"<article><p>{LONG} Let {formula} be.</p></article>") == f"{LONG} Let x=2 be."


def test_names_that_only_begin_like_furniture():
    for name in ("share-price-table", "notice-board-history", "social-history", "related-work-section", "search-theory", "nav_history_of"):
        assert html.main_text(f"<article><p>{LONG}</p><section class='{name}'><p>{LONG} in it</p></section></article>") == f"{LONG}\n{LONG} in it", name
    for name in ("share-buttons", "related-posts", "sidebar-left", "ad-slot-1", "newsletter-box", "social-links", "header-logo", "promoTeaser"):
        assert html.main_text(f"<article><p>{LONG}</p></article><section class='{name}'><p>{LONG} in it</p></section>") == LONG, name


LINKS = "".join(f"<li><a href=/{w}>{w} page</a></li>" for w in "home news sport about".split())


def test_the_rules_decide_menus():
    """Menus come through as blocks, and link density tells them; prose in one is told by its words."""
    for menu in (f"<nav><ul>{LINKS}</ul></nav>", f"<div class='main-menu'><ul>{LINKS}<li>More</li></ul></div>", f"<ul class=breadcrumb>{LINKS}</ul>"):
        page = f"{menu}<article><h1>Head</h1><p>{LONG}</p></article>{menu}"
        found = html.blocks(page)
        labels = html.decide(found)
        assert [b[4] for b in found].count("links") >= 8
        assert all(x is False for x, b in zip(labels, found) if b[4] == "links" and b[3])
        assert html.main_text(page) == f"Head\n{LONG}"
    assert html.main_text(f"<nav>{LINKS}</nav>") == "" and html.main_text("<nav><p>Menu</p></nav>") == ""


def test_the_rules_decide_the_menus_of_the_given_pages(spark):
    kinds = {"links": 0, "prose": 0, "inherited": 0}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        found = html.blocks(r.html)
        for (*_, region, _), label in zip(found, html.decide(found)):
            kinds["inherited" if label is None else "prose" if label else "links"] += 1
            assert label is not True or region == "article"
    assert min(kinds.values()) > 0
