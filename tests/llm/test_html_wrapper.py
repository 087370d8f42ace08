"""Wrappers of small sites, and the main text of pages of many makes."""

import pytest
from matchmill.llm import html_wrapper as H
from matchmill.llm.queries import QUERIES, table
from tests.conftest import SF_DIR


def page(*paragraphs, nav=2, extra=""):
    links = "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(nav))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<html><head><title>T</title><script>var x = '<p>no</p>';</script></head><body><nav><ul>{links}</ul></nav><article><h1>Head</h1>{body}{extra}</article><footer>&copy; us</footer></body></html>"


def wrapper(*pages):
    found = H.wrapper_of(H.parse(pages[0]))
    for p in pages[1:]:
        found = H.align(found, H.wrapper_of(H.parse(p)))
    return found


def test_expression_has_slots_options_and_repeats():
    found = H.expression(wrapper("<div><h1>a</h1><p>x</p></div>", "<div><h1>b</h1><p>x</p><p>y</p><ul><li>1</li></ul></div>"))
    assert found == "<div><h1>#</>(<p>#</>)+(<ul><li>=</></>)?</>"
    mixed = H.expression(wrapper("<div><p>a</p><h2>b</h2><p>c</p></div>"))
    assert mixed == "<div>((<p>#</>)?(<h2>=</>)?)+</>"
    reordered = wrapper("<div><p>a</p><h2>b</h2></div>", "<div><h2>b</h2><p>a</p></div>")
    assert reordered["children"]["div"][2]["group"]


def test_wrappers_align_in_any_grouping():
    pages = [page("a"), page("b", "c"), page("d", nav=1, extra="<blockquote>q</blockquote>"), page("e", "f", "g", nav=4)]
    whole = wrapper(*pages)
    halves = H.align(wrapper(*pages[:2]), wrapper(*pages[2:]))
    assert H.expression(whole) == H.expression(halves) and whole == halves


@pytest.mark.parametrize(
    "html, text",
    [
        (page("one &amp; two", " three\n  four "), "Head\n\none & two\n\nthree four"),
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("plain text", "plain text"),
        ("<article><p><b>open<br><p>next</article>after", "open\n\nnext"),
        ("<article>a<div class='ad'>buy</div>b<aside>c</aside><form><input>send<button>x</button></form></article>", "a\n\nb"),
        ("<article><p>x</p><section id='comments'><p>me too</p></section><div class='cookie-notice'>ok?</div></article>", "x"),
        ("<article><p>x</p><article class='comment'><p>first!</p></article></article>", "x"),
        ("<header>site</header><main><header><h1>h</h1></header><p>x</p></main>", "h\n\nx"),
        ("<main><p hidden>no</p><p style='display: none'>no</p><p>x &lt;b&gt; &eacute;&nbsp;y</p><!-- no --></main>", "x <b> é y"),
        ("<article><table><tr><td>a<td>b</table><ul><li>c<li>d</ul><pre>e\n f</pre></article>", "a\n\nb\n\nc\n\nd\n\ne f"),
        ("<article><div class='has-sidebar'><p>kept</p></div><style>p{}</style><script>x</article></script>", "kept"),
        ("<article><p>a<a href='x>y'>b</a> c</p></article>", "ab c"),
    ],
)
def test_pages(html, text):
    assert H.main_text(html, None) == text


def test_pages_without_an_article_element(spark):
    def site(i):
        body = "".join(f"<p>Paragraph {j} of page {i} has a number of words to read.</p>" for j in range(6))
        links = "".join(f"<a href='/{k}'>Section {k}</a> " for k in range(9))
        return f"<html><body><div class='top'>{links}</div><div class='content'><h2>Title {i}</h2>{body}<p>Subscribe to read more of this.</p></div><div class='end'>All rights reserved by the site</div></body></html>"

    rows = [(i, f"https://site.example.com/{i}", site(i)) for i in range(8)] + [(100, None, None), (101, "x", ""), (102, "https://other.net/", page("p"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS wrapper").repartition(4)
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i].startswith(f"Title {i}\n\nParagraph 0 of page {i} has")
        assert "Section" not in got[i] and "rights" not in got[i]
    assert got[100] == "" and got[101] == "" and got[102] == "Head\n\np"
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [4, 5, 50])
def test_copies_of_a_page_are_one_page(spark, copies):
    """A page's own text is not the host's, however many copies there are; a heading only copies have stays."""
    only = "<html><body><div class=content>The whole text of a page</div></body></html>"
    mixed = [f"<html><body><div class=content><p>Page {i} has its own words.</p></div><div class=end>All rights</div></body></html>" for i in range(6)]
    copied = "<html><body><div class=content><h2>A heading of its own</h2><p>The words of a copied page.</p></div><div class=end>All rights</div></body></html>"
    rows = [(i, "https://one.example/a", only) for i in range(copies)]
    rows += [(100 + i, "https://two.example/a", h) for i, h in enumerate([*mixed, *[copied] * copies])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(got[i] == "The whole text of a page" for i in range(copies))
    assert all(got[100 + i] == f"Page {i} has its own words." for i in range(6))
    assert all(got[106 + i] == "A heading of its own\n\nThe words of a copied page." for i in range(copies))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><h2 id='how-to-search-the-index'>h</h2><p id='share'>x</p></article>", "h\n\nx"),
        ("<article><section id='discussion'><p>of results</p></section><div class='related-work'>y</div></article>", "of results\n\ny"),
        ("<article id='how-to-share-files'><p>x</p></article>", "x"),
        ("<article><p>x</p><div class='share'><a href=1>one</a> <a href=2>two</a></div><div class='ad-container'>buy</div></article>", "x"),
    ],
)
def test_names_of_a_texts_own_parts(html, text):
    assert H.main_text(html, None) == text


def test_the_host_confirms_an_unsure_name(spark):
    rows = [(i, f"https://a.example/{i}", f"<article><p>Text {i}</p><div class='notice'>Read our terms</div><section id='discussion'>Of {i}</section></article>") for i in range(6)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Text {i}\n\nOf {i}" for i in range(6)}


@pytest.mark.parametrize("pages", [4, 5, 12])
def test_what_articles_share_stays(spark, pages):
    """A step or a quotation that is the same in all articles of a host, however many they are."""
    html = "<body><nav>menu</nav><article><h1>Recipe {i}</h1><div class=step>Preheat the oven to 200 degrees.</div><blockquote>Eat well.</blockquote><p>Bake {i}.</p></article></body>"
    rows = [(i, f"https://a.example/{i}", html.format(i=i)) for i in range(pages)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Recipe {i}\n\nPreheat the oven to 200 degrees.\n\nEat well.\n\nBake {i}." for i in range(pages)}


@pytest.mark.parametrize(
    "html, text",
    [
        ("<body><form id='aspnetForm'><input><article><p>x</p><form>search<input></form></article></form></body>", "x"),
        ("<body><form id='aspnetForm'><div class=text><p>The whole text of the page is in here.</p></div></form><div>end</div></body>", "The whole text of the page is in here."),
        ("<article><div class='content-widget'><p>x</p></div><section id='history-of-the-ad'><p>y</p></section></article>", "x\n\ny"),
        ("<article><p>Press <button>Save</button> and <label>wait</label>.</p><button>Share</button><form><label>Mail</label></form></article>", "Press Save and wait."),
        ("<article><div class='one two three four five'>a</div><div class='one two three four six'>b</div></article>", "a\n\nb"),
    ],
)
def test_forms_widgets_and_words(html, text):
    assert H.main_text(html, None) == text


def test_wrappers_are_bounded():
    """Names that each page has for itself: ids tell nothing, classes of their own are folded, and pages are read all the same."""
    import json
    import time

    def site(i, name):
        parts = "".join(f"<h2 {name}='about-{i}-{j}x{i}'>h {i} {j}</h2><div {name}='k{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + j)}'><p>t {i} {j}</p></div>" for j in range(6))
        return f"<body><div class='u{chr(97 + i % 26)}{chr(97 + i // 26)}'><nav>menu</nav><article {name}='how-to-{chr(97 + i % 26)}-share'>{parts}</article></div></body>"

    for name in ("id", "class"):
        found, sizes, took = None, [], []
        for i in range(400):
            start = time.thread_time()
            own = H.wrapper_of(H.parse(site(i, name)), i)
            found = H.align(found, own) if found else own
            took.append(time.thread_time() - start)
            sizes.append(len(json.dumps(found)))
        assert H._size(found) <= H.ELEMENTS and max(sizes) < 250 * H.ELEMENTS and max(sizes[200:]) < 1.3 * max(sizes[:200])
        assert sum(took[300:]) < 3 * sum(took[100:200]) + 1
        rules = json.dumps(H.rules_of(found))
        assert len(rules) < 50_000
        for i in (0, 7, 399, 600):
            want = "\n\n".join(f"h {i} {j}\n\nt {i} {j}" for j in range(6))
            assert H.main_text(site(i, name), rules) == want


@pytest.mark.parametrize("held, parts", [(1, 1), (2, 32), (2_000, 3)])
def test_how_much_is_held_changes_nothing(monkeypatch, held, parts):
    """Hosts passed on early and aligned later give the wrappers of one fold."""
    import pyarrow as pa

    pages = [(f"h{i % 5}", page(f"a{i}", *["b"] * (i % 3), nav=i % 4)) for i in range(40)]
    batch = lambda rows: pa.RecordBatch.from_pylist([{"host": h, "html": t} for h, t in rows])
    whole = {r["host"]: r["wrapper"] for b in H._folded(iter([batch(pages)])) for r in b.to_pylist()}
    monkeypatch.setattr(H, "HOSTS_HELD", held)
    rows = [r for b in H._folded(batch(pages[i : i + 7]) for i in range(0, 40, 7)) for r in b.to_pylist()]
    cut = [sorted(rows[k::parts], key=lambda r: (r["host"], r["wrapper"])) for k in range(parts)]
    some = [r for c in cut if c for b in H._merged(iter([pa.RecordBatch.from_pylist(c)])) for r in b.to_pylist()]
    merged = {r["host"]: r["wrapper"] for b in H._merged(iter([pa.RecordBatch.from_pylist(sorted(some, key=lambda r: (r["host"], r["wrapper"])))])) for r in b.to_pylist()}
    import json

    assert {h: H.rules_of(json.loads(w)) for h, w in merged.items()} == {h: H.rules_of(json.loads(w)) for h, w in whole.items()}


def test_text_after_a_deep_nest():
    nest = "<div>" * 200 + "<p>in</p><nav>menu</nav>" + "</div>" * 200
    html = f"<body><div><article><p>before</p>{nest}<p>after</p></article></div><p>outside</p></body>"
    assert H.main_text(html, None) == "before\n\nin\n\nafter"


def test_marked_pages_are_read_by_the_wrapper(spark):
    """All articles are read, whole: what they say on all pages and lists of links too; an unsure name is confirmed."""
    links = "<ul><li><a href=1>first source</a></li></ul>"
    html = [f"<main><article class=a><h2>Summary</h2><p>Text {i}</p><div>Subscribe to read more</div><div class=notice>The same notice</div>{links.replace('first', str(i))}</article><article class=b>Part two of {i}</article></main>" for i in range(6)]
    rows = [(i, f"https://a.example/{i}", h) for i, h in enumerate(html)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Summary\n\nText {i}\n\nSubscribe to read more\n\n{i} source\n\nPart two of {i}" for i in range(6)}


def test_deep_and_long_pages():
    assert "x" in H.main_text("<article>" + "<div>" * 5000 + "x" + "</div>" * 5000 + "</article>", None)
    long = "word " * 200_000
    assert H.main_text(f"<article><p>{long}</p></article>", None) == long.strip()
    assert H.main_text("<article>" + "<p>y</p>" * 20_000 + "</article>", None).count("y") == 20_000


def test_test_pages(spark):
    """The test pages mark their article; all of its paragraphs come, and nothing else."""
    import html
    import re

    got = {r.page_id: r for r in QUERIES["op7_html"].run(spark, SF_DIR).collect()}
    for r in table(spark, SF_DIR, "pages").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
