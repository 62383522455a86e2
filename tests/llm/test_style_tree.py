import pytest
from tidewatch.llm.style_tree import extract_text, main_text, node_importance

#: Names that tell of a layout or a state, and the page's forms: the article inside has to be found.
WRAPPERS = ["page has-sidebar", "no-ads", "search-enabled", "comment-open", "with-banner", "sidebar", "widget"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_stay(name):
    article = "<article><h1>T</h1><p>text</p></article><div class='ad'>buy</div>"
    assert main_text(f"<div class='{name}'>{article}</div>") == "T\n\ntext"
    assert main_text(f"<form id='all'><div id='{name}'>{article}</div></form>") == "T\n\ntext"
    plain = "<p>a long text without any article around it</p><div class='share-buttons'>no</div>"
    assert main_text(f"<div class='{name}'>{plain}</div><p>end</p>").startswith("a long text")


def test_comments_go_although_they_are_articles():
    page = "<div><h1>T</h1><p>a text that is longer</p></div><div id='comments'><article>x</article></div>"
    assert main_text(page) == "T\n\na text that is longer"
    page = "<article><p>a</p></article><div id='comments'><article>a longer comment</article></div>"
    assert main_text(page) == "a"


SCHEMA = "page_id long, url string, html string, text string, n_chars int"


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("just text", "just text"),
    ("<p>one<p>two <b>bold<br>line</p> three", "one\n\ntwo bold line\n\nthree"),
    ("<nav>menu</nav><article><h1>T &amp; t</h1><p>a\n\n b&#8364;&nbsp;c</p></article><footer>f</footer>",
     "T & t\n\na b€ c"),
    ('<header><h1>Site</h1></header><main><header><h1>Title</h1></header>Body<aside>x</aside></main>',
     "Title\n\nBody"),
    ('<article><p>keep</p><div class="share-buttons">no</div><section id="comments"><p>reader</p>'
     "</section><form>f<input></form></article>", "keep"),
    ('<div class="ad">buy</div><script>var t="</p><article>no";</script><style>p{}</style><p>yes</p>', "yes"),
    ("<!-- <p>no</p> --><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\n\nb\n\n1 2\n\n3"),
    ('<p title="a > b">x</p><p hidden>no</p><p style="display: none">no</p><br/>y < z', "x\n\ny < z"),
    ("<article><p>open <i>end", "open end"),
    ("<article></article><p>outside</p>", "outside"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<" * 5000, "<" * 5000),
    ("<a " + "\"'" * 4000, None),
])
def test_main_text(page, text):
    got = main_text(page)
    assert text is None or got == text


def site(spark):
    """Pages of one host with a repeated block that no name gives away, other hosts, awkward rows."""
    rows = []
    for k in range(40):
        body = f"<div class='box'><p>Call us now</p><p>Rates</p></div><div class='story'><p>story {k} goes on</p></div>"
        rows.append((k, f"http://h.org/{k}", f"<html><body>{body}</body></html>"))
    rows += [(100 + k, f"http://h.org/c{k}", rows[0][2]) for k in range(5)]
    rows += [(200, "http://small.org/", rows[0][2]), (201, None, None), (202, "odd", ""), (203, "http://h.org", "<p>")]
    rows += [(300 + k, "http://copies.org/", "<article><h1>Same</h1><p>same text</p></article>") for k in range(30)]
    return spark.createDataFrame([(*r, "old", 1) for r in rows], SCHEMA).repartition(3)


def test_repeated_branches_go(spark):
    pages = site(spark)
    got = {r.page_id: r for r in extract_text(pages).collect()}
    assert len(got) == pages.count()
    for k in range(40):
        assert got[k].text == f"story {k} goes on" and got[k].n_chars == len(got[k].text)
    assert got[200].text == "Call us now\n\nRates\n\nstory 0 goes on"  # too few pages to tell
    assert got[201].text == got[202].text == got[203].text == "" and got[201].n_chars == 0
    assert got[310].text == "Same\n\nsame text"  # an article's text is never judged
    salted = {r.page_id: r.text for r in extract_text(pages, broadcast_bytes=0).collect()}
    assert salted == {k: r.text for k, r in got.items()}
    assert extract_text(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_importance_follows_the_entropies(spark):
    rows = node_importance(site(spark)).where("host = 'h.org'").collect()
    by = {r.path: r for r in rows}
    box, story = by[">html>body>div.box"], by[">html>body>div.story"]
    assert box.content < 0.01 < 0.7 < story.content and box.importance < 0.2 < story.importance


def test_the_tree_decides_within_articles(spark):
    story = "<p>a story of its own, number {0} of many</p><p>it has <b>Note:</b> a second part {0}<br>and {0}</p>"
    more = "<p>Subscribe now</p><ul><li>Notice to readers</li></ul>"
    html = "<article><h1>T {0}</h1>" + story + " <span class='tip'>Tip!</span>" + more + "</article>"
    rows = [(k, "http://h.org/", html.format(k)) for k in range(40)]
    near = "<article><h1>Same</h1><p>a long paragraph that all of them share with each other</p><p>{0}</p></article>"
    rows += [(100 + k, "http://h.org/", near.format(k)) for k in range(40)]
    pages = spark.createDataFrame([(*r, "old", 1) for r in rows], SCHEMA)
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for k in range(40):
        own = f"T {k}\n\na story of its own, number {k} of many\n\nit has Note: a second part {k} and {k}"
        assert got[k] == own
        assert main_text(rows[k][2]) == own + "\n\nTip!\n\nSubscribe now\n\nNotice to readers"  # an empty tree
        assert got[100 + k] == main_text(near.format(k))  # near copies keep their text


def test_empty_table(spark):
    assert extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("quote", ["'", '"'])
def test_attributes_of_any_length(quote):
    value = "a>b " * 20000
    assert main_text(f"<p data-x={quote}{value}{quote}>Real</p>") == "Real"
    assert main_text(f"<p data-x={quote}never closed>Real</p>") == "Real"
