import re

from flowloom.llm import common, page_text, url_filter


def judged(spark, urls, **kw):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in url_filter.judge_urls(df, **kw).collect()}


def test_parts_and_rules(spark):
    got = judged(spark, [
        "http://A.Example.ORG/es/1?x", "http://x.org/en/1", "https://example.org/en/17#a", "http://b.com/fr/", "http://b.com/fr", "HTTP://B.com/de/9",
        None, "no scheme", "http://org", "://h/p", "http://a://b/c", "http://notexample.org/es/", "x://ex.net?q=/de/", "http://h.com:80/de/1",
    ])
    part = [(got[i].host, got[i].path, got[i].rule) for i in range(14)]
    assert part == [
        ("a.example.org", "/es/1", "example.org/es/"), ("x.org", "/en/1", "org/"), ("example.org", "/en/17", "example.org/en/1"), ("b.com", "/fr/", "com/fr/"),
        ("b.com", "/fr", None), ("b.com", "/de/9", "com/de/"), ("", "", None), ("", "", None), ("org", "", None), ("h", "/p", None), ("a:", "//b/c", None),
        ("notexample.org", "/es/", "org/"), ("ex.net", "", None), ("h.com:80", "/de/1", None),
    ]
    assert got[0].verdict == "block" and got[1].verdict == "allow" and all(r.verdict in ("allow", "block") for r in got.values())


def test_templates_generalise_merge_and_reject(spark):
    urls = [f"http://a.com/{lang}/{i}" for lang in ("de", "fr", "en") for i in range(30)] + [f"http://b.com/de/{w}-x.html" for w in map(chr, range(97, 117))] * 3
    urls += ["http://b.com/shop", "http://b.com/about", "http://c.net/a/b/c/d/e/f"]
    got = judged(spark, urls)
    template = {u: got[i].template for i, u in enumerate(urls)}
    assert template["http://a.com/de/3"] == "/de/*" and template["http://a.com/en/4"] == "/en/*"
    assert template["http://b.com/de/c-x.html"] == "/de/*.html" and template["http://c.net/a/b/c/d/e/f"] == "/a/b/c/d/e/f"
    assert template["http://b.com/shop"] == template["http://b.com/about"] == "/about|shop"
    verdict = {u: got[i].verdict for i, u in enumerate(urls)}
    assert verdict["http://b.com/shop"] == "block"  # its host is blocked throughout
    assert got[len(urls) - 1].block_share < 0.8
    assert judged(spark, []) == {} and len(judged(spark, ["http://q.net/x"] * 5)) == 5


def test_blocks_of_a_page():
    page = """<html><head><title>T &amp; t</title><style>p{}</style></head><body><header>Top</header><nav><li>m</nav>
    <div class="cookie-notice">c</div><article><h1>A &lt;b&gt; &am</h1><p>One <b>bold</b>\n\n two<br>three&nbsp;x<p>Next<script>var a="</p>";</script>
    <aside>side</aside><div class='advert'>ad<div>deep</div></div><section><p>Last</section><ul id=comments><li>no</ul></article><footer>f</footer>"""
    assert [t for z, t in page_text.blocks(page) if z == page_text.CONTENT] == ["A <b> &am", "One bold two three x", "Next", "Last"]


def test_shared_lines_are_a_longest_common_subsequence():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    import random
    rng = random.Random(3)
    for _ in range(60):
        a, b = [[rng.randrange(4) for _ in range(rng.randrange(12))] for _ in "ab"]
        got = sorted(page_text.shared_lines(a, b))
        assert len(got) == length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_differencing_and_edge_cases(spark):
    plain = lambda *lines: "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"
    rows = [
        (1, "http://h.x/a/1", plain("Menu", "First story", "Contact")), (2, "http://h.x/a/2", plain("Menu", "Second story", "Contact")),
        (3, "http://h.x/a/3", plain("Menu", "Third", "story", "Contact")), (4, "http://alone.x/", plain("Menu", "Text")), (5, None, None), (6, "http://h.x/a/9", ""),
        (7, "http://h.x/a/1", plain("Menu", "First story", "Contact")), (7, "http://h.x/a/1", plain("Menu", "First story", "Contact")), (8, "http://h.x/b", "<article>Menu<p>x"),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, lines string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in page_text.extract_text(df).collect())
    want = ["First story", "Second story", "Third\nstory", "Menu\nText", "", "", "First story", "First story", "Menu\nx"]
    assert [t for _, t, _ in got] == want and [n for *_, n in got] == [len(t) for t in want]
    assert page_text.extract_text(df.limit(0)).count() == 0


def test_articles_of_the_table(spark, sf):
    import html

    pages = common.table(spark, sf, "pages")
    got = {r.page_id: r.text for r in page_text.extract_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(x for x in lines if x)


def test_articles_are_not_lost_to_names():
    def kept(page):
        return [t for z, t in page_text.blocks(page) if z == page_text.CONTENT]

    assert kept("""<article class="post comments-open"><h2 id="search-algorithms">Search</h2><p>a<h2 id="search">S</h2><h3 id='related-work'>Related</h3>
    <section id=sharing-data data-id="menu"><p>b</section><div class="site-header nav-menu">m</div></article>""") == ["Search", "a", "S", "Related", "b"]
    assert kept('<div class="layout has-sidebar"><div class="sidebar left">s<main class="widget"><p>x</main>t</div></div>') == ["x"]
    assert kept("<form><header>h</header><article>y</article></form><div id=comments><article class=comment>z</article></div>") == ["y"]
    assert kept('<article>a <svg width="1" /> b<svg/> c<iframe src="u"/> d<svg width=1/>e</svg><svg>f</svg>g</article>') == ["a b c dg"]
    assert page_text.blocks('<div class="comments-open">c</div><div class="comments">d</div>') == [(page_text.OPEN, "c"), (page_text.CHROME, "d")]


def test_references_are_the_nearest_pages(spark):
    from pyspark.sql import functions as F

    plain = lambda *lines: "".join(f"<div>{x}</div>" for x in lines)
    rows = [(f"http://big.x/d/{i:03}", plain(f"Menu {i // 20}", f"Story {i}", "Foot")) for i in range(200)]  # templates of 20 pages
    rows += [(f"http://deep.x/{'ab'[i]}/1/2/3/4/5", plain("Top", f"Deep {i}")) for i in range(2)]
    rows += [(f"http://same.x/{i}", plain("Same", "page")) for i in range(30)] + [("http://same.x/a/b", plain("Same", "other"))]
    rows = [(i, u, h) for i, (u, h) in enumerate(rows)]
    df = spark.createDataFrame(rows + rows[5:8], "page_id long, url string, html string")
    got = page_text.extract_text(df).collect()
    assert len(got) == len(rows) + 3
    text = {r.page_id: r.text for r in got}
    assert [text[i] for i in range(200)] == [f"Story {i}" for i in range(200)]
    assert (text[200], text[201]) == ("Deep 0", "Deep 1") and {text[i] for i in range(202, 232)} == {"page"} and text[232] == "other"
    parsed = spark.range(500).select(F.lit("h").alias("host"), F.format_string("/%04d", "id").alias("path"), F.array(F.expr("id div 3")).alias("keys"))
    near = page_text.nearest_references(parsed.withColumn("h", F.xxhash64("keys")).repartition(7))
    assert {r.path: r.near for r in near.collect()} == {
        f"/{i:04}": [[i // 3 - 1] if i >= 3 else None, [i // 3 + 1] if i // 3 < 499 // 3 else None] for i in range(500)}


def test_pages_with_an_article_are_differenced(spark, sf):
    page = lambda i, *more: f"<nav><li>Home</li><li>Topic {i}</li></nav><article><p>Story {i}<p>Said by all</article>{''.join(more)}<footer>Foot</footer>"
    rows = [(i, f"http://h.x/a/{i}", page(i)) for i in range(6)] + [(6, "http://h.x/a/6", "<div>Home</div><div>Story 5</div><div>Said by all</div><div>Foot</div>")]
    rows += [(7, "http://alone.x/", page(7)), (8, "http://h.x/a/9", None), (9, "http://h.x/a/3", page(3))]
    got = {r.page_id: (r.text, r.n_chars, r.n_shared) for r in page_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    article = lambda i: f"Story {i}\nSaid by all"
    # lines outside the article go by differencing and the others by structure; an article's own stay, also those that others share
    assert {i: got[i] for i in (*range(6), 9)} == {i: (article(3 if i == 9 else i), len(article(3)), 2) for i in (*range(6), 9)}
    assert got[6] == (article(5), len(article(5)), 2)  # a line stays open if only articles share it
    assert got[7] == (article(7), len(article(7)), 0) and got[8] == ("", 0, 0)
    assert page_text.extract_text(common.table(spark, sf.replace("sf0.001", "sf0.01"), "pages")).filter("n_shared > 0").count() > 9


def test_lines_of_articles_are_aligned_one_by_one(spark):
    rows = [
        (1, "http://h.x/a/1", "<nav><li>Home</nav><article><h1>One<p>Said by two<p>Said by both<p>End</article><footer>Foot</footer>"),
        (2, "http://h.x/a/2", "<nav><li>Home</nav><footer>Foot</footer><article><h1>Two<p>Said by two<p>New<p>Said by both</article>"),
        (3, "http://h.x/b/3", "<article>Said by both<div class=ad>Said by two</div><p>Home</article>"), (4, "http://alone.x/", "<article>Said by two<p>End</article>"),
        (5, "http://h.x/c/5", "<div>Said by both</div><div>Home</div><div>Open</div>"),
    ]
    got = {r.page_id: (r.text, r.n_shared, r.n_restored) for r in page_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # two shared lines of the articles, after one menu line, are longer than the footer that stands on their other side
    assert got[1] == ("One\nSaid by two\nSaid by both\nEnd", 1, 2)
    assert got[2] == ("Two\nSaid by two\nNew\nSaid by both", 1, 2)
    assert got[3] == ("Said by both\nHome", 0, 1)  # an advert or an open line shares nothing with an article's
    assert got[4] == ("Said by two\nEnd", 0, 0) and got[5] == ("Said by both\nHome\nOpen", 0, 0)


def test_many_repeated_lines_are_aligned():
    import random
    rng = random.Random(5)
    for _ in range(60):
        a, b = [[rng.randrange(4) for _ in range(rng.randrange(140))] for _ in "ab"]
        want = len(page_text.shared_lines(a, b))
        for bits in (1 << 28, 90):  # whole and in halves
            got = sorted(page_text._shared_by_bits(a, b, most_bits=bits))
            rest = iter(b)
            assert len(got) == want and all(a[i] in rest for i in got)
        assert len(page_text.shared_lines(a + [9], [8] + b, most_matches=0)) == want
    assert len(page_text.shared_lines([1] * 12_000 + [2, 3], [3] + [1] * 15_000 + [2])) == 12_001
