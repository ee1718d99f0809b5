import pytest
from rankfold.llm import html_wrapper
from rankfold.llm.html_wrapper import main_text, matching, merge, parse, template_of

ARTICLE = "<article><h1>T {i}</h1><p>First <b>bold</b>{i} text &amp; more.<br>line two</p><p>Unclosed {i}<p>Third  &eacute;\n x</article>"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"),
    ("<p>a<p>b<div>c", "a b c"), ("<p>a<br>b</p>", "a b"), ("<p>a<b>b</b>c</p>", "abc"),
    ("<nav>menu</nav><p>x</p><footer>f</footer>", "x"),
    ("<div class='ad'>buy</div><div id=sidebar>s</div><p>x</p>", "x"),
    ("<script>var a='</p><p>no';</script><style>p{}</style><p>x</p>", "x"),
    ("<p>x</p><script>unclosed <p>no", "x"), ("<p>x</p><!-- gone <p>no</p> --><p>y</p>", "x y"), ("<p>x<!-- open", "x"),
    ("<p title='a>b'>x</p>", "x"), ("<p>1 < 2 &lt; 3 &#65;&#x42;</p>", "1 < 2 < 3 AB"), ("<p>x</p><div clas", "x"),
    ("<header>site</header><main><header><h2>Head</h2><p>by me</p></header><p>x</p><aside>s</aside></main>", "Head x"),
    ("<article><p>x</p><section class='comments'><article>reader</article></section></article><p>outside</p>", "x"),
    ("<article><form><p>in form</p><input></form><p>x</p><div role=alert>a</div><p hidden>h</p></article>", "x"),
    ("<ul><li><a href=1>one</a><li><a href=2>two</a></ul><p>x <a href=3>link</a></p>", "x link"),
    ("<P>Upper</P><UL><LI>a<LI>b</UL>", "Upper a b"), ("</p></div>x</b>", "x"), ("<p>a&nbsp;b</p>", "a b"),
])
def test_page(page, text):
    assert main_text(page, set()) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000, set()) == "x"
    assert main_text("<p>" + "word " * 50_000, set()) == ("word " * 50_000).strip()
    assert main_text('<a "' * 20_000, set()) is not None


def test_simple_tree_matching():
    a, b = (template_of(parse(p)[0]) for p in ("<div><h1>a</h1><p>b</p><p>c</p></div>", "<div><p>b</p><ul><li>x</ul></div><p>z"))
    assert matching(a, a) == 4 and matching(a, b) == matching(b, a) == 3
    merge(a, b)
    assert [c[0] for c in a[3]] == ["div", "p"] and [c[0] for c in a[3][0][3]] == ["h1", "p", "ul"]
    assert a[1] == 2 and a[3][0][3][1][1] == 2


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_constant_nodes_are_the_wrapper(spark):
    rows = [(i, f"https://a.example/{i}", f"<body><div class=top>Welcome to A</div><p>Story {i} told once.</p><p>Sign off line</p></body>", "x")
            for i in range(12)]
    rows += [(100 + i, f"https://b.example/{i}", "<p>The same copy</p>", "x") for i in range(9)]
    rows += [(200 + i, f"https://c.example/{i}", f"<p>Only {i}</p><p>twice</p>", "x") for i in range(2)]
    df = pages_of(spark, rows).repartition(3)
    got = {r.page_id: r.text for r in html_wrapper.page_text(df).collect()}
    assert all(got[i] == f"Story {i} told once." for i in range(12))
    assert all(got[100 + i] == "The same copy" for i in range(9))  # copies are no template
    assert all(got[200 + i] == f"Only {i} twice" for i in range(2))


def test_query_matches_plain_extraction_of_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = html_wrapper.page_text(pages).collect()
    assert len(rows) == pages.count()
    html = {r.page_id: r.html for r in pages.collect()}
    import html as h
    import re
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", html[r.page_id], re.S)[1]
        want = " ".join(h.unescape(re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert r.text == want and r.n_chars == len(r.text)


def test_odd_rows(spark, monkeypatch):
    rows = [(1, None, None, "h"), (None, "no scheme", "<p>x</p>", "h"), (2, "http://a.b/1", "", "h"), (2, "http://a.b/1", "", "h")]
    got = html_wrapper.page_text(pages_of(spark, rows)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "x", 1), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert html_wrapper.page_text(pages_of(spark, [])).count() == 0
    monkeypatch.setattr(html_wrapper, "BROADCAST_HOSTS", 0)
    assert html_wrapper.page_text(pages_of(spark, rows)).count() == 4


@pytest.mark.parametrize("n, paragraphs", [(8, 40), (30, 25), (200, 60)])
def test_constant_texts_among_many_varying_ones(spark, n, paragraphs):
    rows = [(i, f"https://a.example/{i}", "<article>" + "".join(f"<p>Line {k} of {i}.</p>" for k in range(paragraphs)) + "<p>Read on tomorrow</p></article>", "x")
            for i in range(n)]
    got = {r.page_id: r.text for r in html_wrapper.page_text(pages_of(spark, rows + rows[:3]).repartition(5)).collect()}
    assert got == {i: " ".join(f"Line {k} of {i}." for k in range(paragraphs)) for i in range(n)}


def test_copies_in_other_tasks_do_not_count(spark):
    rows = [(i, "https://a.example/x", f"<p>Told {i % 2}</p><p>Same on both</p>", "x") for i in range(70)]
    got = html_wrapper.page_text(pages_of(spark, rows).repartition(9)).collect()  # two different pages
    assert sorted(r.text for r in got) == sorted(f"Told {i % 2} Same on both" for i in range(70))


@pytest.mark.parametrize("n", [3, 4, 7])
def test_hosts_of_few_pages_have_a_wrapper(spark, n):
    rows = [(i, f"https://a.example/{i}", f"<div class=top>Welcome to A</div><p>Story {i} told once.</p><p>Sign off line</p>", "x") for i in range(n)]
    rows += [(100 + i, f"https://b.example/{i}", f"<nav>Menu {i}</nav><p>The same copy</p><footer>At {i}</footer>", "x") for i in range(n)]
    got = {r.page_id: r.text for r in html_wrapper.page_text(pages_of(spark, rows).repartition(3)).collect()}
    assert got == {i: f"Story {i} told once." for i in range(n)} | {100 + i: "The same copy" for i in range(n)}


@pytest.mark.parametrize("page, text", [
    ("<article class='post has-sidebar'><h1>H</h1><p>x</p></article>", "H x"),
    ("<div class='content no-sidebar'><p>x</p></div>", "x"),
    ("<article class='hentry category-legal'><p>x</p></article>", "x"), ("<article class='post legal'><p>x</p></article>", "x"),
    ("<div class='search-page'><div id=form><main><p>x</p></main></div></div>", "x"),
    ("<article><h2 id='related-work'>Related work</h2><p>x</p><section id='search-engines'><p>y</p></section></article>", "Related work x y"),
    ("<article><p>x</p><section class='related'><p>r</p></section><div class='share-buttons'>s</div></article>", "x"),
    ("<div class=sidebar><article>teaser</article></div><article><p>x</p></article>", "x"),
    ("<article><p>x</p></article><ol class=commentlist><li><article class=comment>reader</article></ol>", "x"),
    ("<article><ul><li><a href=1>source one</a><li><a href=2>source two</a></ul></article>", "source one source two"),
])
def test_marks_leave_the_article(page, text):
    assert main_text(page, set()) == text


def test_constant_texts_of_deep_elements(spark):
    deep = "<div>" * 50
    rows = [(i, f"https://a.example/{i}", f"{deep}<p>Story {i}</p><div><p>Sign off line</p></div>", "x") for i in range(9)]
    got = {r.page_id: r.text for r in html_wrapper.page_text(pages_of(spark, rows).repartition(3)).collect()}
    assert got == {i: f"Story {i}" for i in range(9)}


def extracted(spark, pages, parts=3):
    rows = [(i, f"https://{h}.example/{i}", page, "x") for i, (h, page) in enumerate(pages)]
    return {r.page_id: r.text for r in html_wrapper.page_text(pages_of(spark, rows).repartition(parts)).collect()}


@pytest.mark.parametrize("n", [3, 12])
def test_near_copies_and_recurring_headings_keep_their_text(spark, n):
    def storm(i):
        return f"<article><h1>Storm reaches the coast</h1><p>A storm reached the coast on Monday night and cut the power in four towns.</p><p>Ferries stayed in port. Updated {i}</p></article>"

    def recipe(i):
        return f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><p>{i} onions</p><h2>Method</h2><p>Fry them for {i} minutes</p></article>"

    got = extracted(spark, [("a", storm(i)) for i in range(n)] + [("b", recipe(i)) for i in range(n)])
    for i in range(n):
        assert got[i] == f"Storm reaches the coast A storm reached the coast on Monday night and cut the power in four towns. Ferries stayed in port. Updated {i}"
        assert got[n + i] == f"Dish {i} Ingredients {i} onions Method Fry them for {i} minutes"


def quoting(i):
    """Three pages quote the sign-off; the site's own stands at the end of its block."""
    quote = "<p>Read on tomorrow</p>" if i < 3 else ""
    return f"<article><p>Opening number {i} of the paper</p>{quote}<p>Closing number {i}</p><p>Read on tomorrow</p></article>"


def test_only_the_aligned_place_of_a_wrapper_text_goes(spark):
    got = extracted(spark, [("a", quoting(i)) for i in range(12)])
    assert got == {i: f"Opening number {i} of the paper {'Read on tomorrow ' if i < 3 else ''}Closing number {i}" for i in range(12)}


def test_the_matching_decides(spark, monkeypatch):
    monkeypatch.setattr(html_wrapper, "joined", lambda xs, ys: [(x, None) for x in xs] + [(None, y) for y in ys])
    got = extracted(spark, [("a", quoting(i)) for i in range(12)])
    assert all(text.endswith("Read on tomorrow") for text in got.values())


def test_of_texts_that_change_places_one_stays(spark):
    def page(i):
        ends = ["<p>Alpha line here</p>", "<p>Beta line here</p>"][:: 1 if i % 2 else -1]
        return f"{ends[0]}<p>Story number {i} of the long day in town</p>{ends[1]}"

    got = extracted(spark, [("a", page(i)) for i in range(12)])
    assert all(f"Story number {i} of the long day in town" in t and ("Alpha" in t or "Beta" in t) for i, t in got.items())


def test_random_wrappers_against_the_pages_they_were_made_of(spark):
    import random
    rng = random.Random(5)
    pages, want = [], []
    for h in range(6):
        before = [f"Station {h} top {k} of the site" for k in range(rng.randint(0, 3))]
        after = [f"Station {h} foot {k} line" for k in range(rng.randint(0, 3))]
        box = f"<div class=k{h}><p>Letter {h}</p><p>Every morning at {h}</p></div>" if h % 2 else ""
        for i in range(rng.randint(5, 20)):
            paragraphs = [" ".join(rng.choice("tin oak rye fig elm ash fir yew bay may".split()) for _ in range(rng.randint(6, 30))) + f" {i}."
                          for _ in range(rng.randint(3, 9))]
            middle = rng.randint(1, len(paragraphs) - 1)
            body = "".join(f"<p>{p}</p>" for p in paragraphs[:middle]) + box + "".join(f"<p>{p}</p>" for p in paragraphs[middle:])
            edge = "article" if h < 3 else "div"
            pages.append((f"h{h}", f"<{edge}>" + "".join(f"<div>{b}</div>" for b in before) + body
                          + "".join(f"<p>{a}</p>" for a in after) + f"</{edge}>"))
            want.append(" ".join(paragraphs))
    assert extracted(spark, pages, 5) == dict(enumerate(want))


@pytest.mark.parametrize("make", [lambda n: "<b>" * n + "<p>x</p>" * n, lambda n: "<div>" * n + "</p></span></q>" * n, lambda n: "<p><body>" + "<foo>" * n + "<p>x</p>" * n,
                                  lambda n: "<foo>" * n + "<li>a" * n, lambda n: "<header>" * n + "<p>x" * n])
def test_parser_is_linear(make):
    import time
    page = make(1 + 1_000_000 // len(make(1)))
    start = time.process_time()
    parse(page)
    assert time.process_time() - start < 6  # about one second; hours when quadratic
