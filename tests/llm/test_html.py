import random

from cadenza.llm import htmltext


def length(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_alignment():
    rng = random.Random(1)
    for _ in range(1500):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = htmltext.lcs(a, b)
        assert len(pairs) == length(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    a, b = ([rng.randint(0, 40) for _ in range(2300)] for _ in range(2))        # halved alignment
    assert len(htmltext.lcs(a, b)) == length(a, b)


def test_markup():
    page = """<html><head><title>no</title><style>p{}</style></head><body><nav>menu</nav><!-- c <p>x</p> -->
    <div class="top-ad">buy</div><article><header><h1>Caf&eacute;&nbsp;&amp; <i>b</i>ar</h1></header><p>one<p>two <b>th</b>ree
    <script>if (a < b) "</p>"</script><div id="comments"><p>reader</p></div><form>f</form><p>fi<!-- -->ve < six</article>
    <aside>side</aside><footer>foot</footer></body>"""
    assert htmltext.main_lines(htmltext.text_lines(page), set()) == ["Café & bar", "one", "two three", "five < six"]
    assert htmltext.main_lines(htmltext.text_lines('<div class="cookie-notice">c</div><p>body<br>x'), set()) == ["body", "x"]
    assert htmltext.main_lines(htmltext.text_lines('<p a="'), set()) == []


def test_url_key():
    assert htmltext.url_key("HTTP://A.example/en/7.html?x#y") == ("a.example", "/en/000000000007")
    assert htmltext.url_key("a/b") == (None, None) == htmltext.url_key(None)


def site(i):
    return (i, f"http://h.example/en/{i}", f"<div>Site name</div><p>Welcome back</p><p>own text of page {i} and more of it, number {i * i}</p>"
            "<div>All rights are ours</div>")


def test_shared_lines_go(spark, monkeypatch):
    monkeypatch.setattr(htmltext, "RANGE_ROWS", 3)      # neighbours across many ranges
    rows = [site(i) for i in range(20)]
    rows += [(100, "http://h.example/en/3?page=2", rows[3][2]), (101, "http://other.example/", rows[4][2])]
    rows += [(200 + i, f"http://copies.example/{i}", "<p>a page and its copy are the same</p><p>second line here</p>") for i in range(3)]
    rows += [(300 + i, f"http://art.example/{i}", f"<article><p>the motto of all our articles</p><p>text {i} {'w ' * i}</p></article>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in htmltext.main_text(pages).collect()}
    for i in range(20):
        assert got[i] == f"own text of page {i} and more of it, number {i * i}"
    assert got[100] == got[3] and got[101].startswith("Site name Welcome back own text of page 4")
    assert {got[200 + i] for i in range(3)} == {"a page and its copy are the same second line here"}
    assert got[301] == "the motto of all our articles text 1 w"


def test_articles_of_the_test_pages(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in htmltext.main_text(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        plain = re.sub(r"<!--.*?-->|<[^>]+>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", article), flags=re.S)
        assert r["text"] == " ".join(html.unescape(plain).split()) and r["n_chars"] == len(r["text"])


def test_containers_around_the_text_are_main_text():
    def main(page):
        return htmltext.main_lines(htmltext.text_lines(page), set())

    for name in ("site has-sidebar", "no-sidebar", "content with-comments", "wrap sticky-footer", "container nav-open",
                 "search-results", "social-policy", "search"):
        assert main(f'<div class="{name}"><p>own text</p><p>of the page</p></div>') == ["own text", "of the page"], name
        assert main(f'<p>menu</p><div class="{name}"><article><p>own text</p></article><div class="related"><article>'
                    '<p>more</p></article></div></div>') == ["own text"], name
    assert main('<form action="/"><div><p>own text</p><div class="user-comments">a reader wrote this</div></div></form>') == ["own text"]
    assert main('<form><nav>menu</nav><article><p>own text</p></article></form>') == ["own text"]
    assert main('<p>own text</p><form>a form that is much longer than the text</form><article><p>x</p></article>') == ["x"]
    assert main('<p>own text of the page</p><div class="related"><article>more</article></div><div class="ad-slot">buy</div>') == ["own text of the page"]
    deep = '<div class="ad">' * 20_000 + "x"
    assert main(deep) == ["x"]


def test_templates_longer_than_the_text(spark, monkeypatch):
    monkeypatch.setattr(htmltext, "RANGE_ROWS", 2)
    menu = "".join(f"<p>menu entry {i} of a long template</p>" for i in range(9))
    stub = 3
    rows = [(i, f"http://long.example/{i}", menu + (f"<p>own {i}</p>" if i != stub else "")) for i in range(8)]
    rows += [(100 + i, f"http://query.example/index.php?id={i}", f"<p>Site name</p><p>own text of page number {i}</p>") for i in range(8)]
    notice = "<p>share this</p>"
    rows += [(200 + i, f"http://art.example/{i}", f"<article><h1>title {i}</h1>{notice}<p>the text of article {i}</p></article>") for i in range(8)]
    same = "<p>a long passage that near copies have</p>"
    rows += [(300 + i, f"http://near.example/{i}", f"{same}<p>date {i}</p>") for i in range(2)]
    rows += [(400 + i, f"http://quotes.example/{i}", f"<article>{same}<p>date {i}</p></article>") for i in range(8)]
    # a copy beside each page: the next path takes its place
    rows += [(500 + i, f"http://beside.example/{i}", f"<p>Site</p><p>the own text of page {i // 2}</p>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in htmltext.main_text(pages).collect()}
    assert all(got[i] == f"own {i}" for i in range(8) if i != stub)
    assert all(got[100 + i] == f"own text of page number {i}" for i in range(8))
    assert all(got[200 + i] == f"title {i} the text of article {i}" for i in range(8))
    assert all(got[300 + i] == f"a long passage that near copies have date {i}" for i in range(2))
    assert all(got[400 + i] == f"a long passage that near copies have date {i}" for i in range(8))
    assert all(got[500 + i] == f"the own text of page {i // 2}" for i in range(6))
