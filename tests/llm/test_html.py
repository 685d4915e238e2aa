import html
import re

import pytest

from trailmark.llm.html_extract import Page, extract


def text(source):
    return Page(source).text([], frozenset())


@pytest.mark.parametrize(
    "source,want",
    [
        ("", ""),
        ("plain  text &amp; more", "plain text & more"),
        ("<body><nav>Menu</nav><header>Site</header><article><header><h1>T</h1></header><p>a<b>b</b>c<p>d<br>e</article><footer>F</footer>", "T abc d e"),
        ("<article><p>Main &eacute;&#233;&#x1F389; x</p><aside>side</aside><div class='comments'>bad <p>reader</p></div><form>f</form><script>a<b</script><style>p{}</style></article>", "Main éé🎉 x"),
        ("<main>kept <div class='ad-box'>buy</div><div id=cookieNotice>ok?</div>too</main><div>not</div>", "kept too"),
        ("<div><p>one</p><div role=navigation>n</div><p hidden>h</p><p style='display: none'>h</p><p>two</p></div>", "one two"),
        ("<p>a<!-- x <p> y -->b</p><!-- open", "ab"),
        ("a < b and <3 c", "a < b and <3 c"),
        ("<p title='a>b'>x</p><p title=\"broken>y</p>z", "x y z"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<title>no</title><p>&am &amp &nbsp;x", "&am & x"),
        ("<article>one</article><article class=comment>two</article>", "one"),
        ("<p>" * 3000 + "deep", "deep"),
        ("<div class='page sidebar-right'><article><p>kept</p></article></div><div class=sidebar>side</div>", "kept"),
        ("<div class='main has-sidebar'><p>kept</p><div class=sidebar>side</div></div>", "kept"),
        ("<div id=comments><article><p>reader</p></article></div><p>story</p>", "story"),
        ("<nav><article>teaser</article></nav><div class=widget><div class=ad><article>bought</article></div></div><p>story</p>", "story"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_page(source, want):
    assert text(source) == want


def test_tables_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r["html"], re.S)[1])
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", body)]
        assert got[r["page_id"]]["text"] == " ".join(x for x in parts if x)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_template_tells_fixed_text_from_slots(spark):
    """No element names help here: what is on every page of the host goes, what varies in the deepest common slot stays."""
    rows = []
    for k in range(8):
        body = " ".join(f"story{k} sentence {j}." for j in range(12))
        rows.append((k, f"http://h.example/{k}", f"<body><div class=top>Welcome to our site</div><div class=wrap><div class=box><p>{body}</p><p>Printed on recycled pixels</p></div></div><div class=low>All rights kept</div></body>"))
    rows += [(50, "http://other.example/", "<p>alone</p>"), (51, None, None), (52, "nonsense", ""), (3, "http://h.example/3", rows[3][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as slots", "3 as text")
    got = extract(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(repr, extract(df, broadcast=0).collect())) == sorted(map(repr, got))
    by = {r["page_id"]: r["text"] for r in got}
    for k in range(8):
        assert by[k] == " ".join(f"story{k} sentence {j}." for j in range(12))
    assert by[50] == "alone" and by[51] == by[52] == ""
    assert extract(df.limit(0)).collect() == []


def test_pages_of_a_host_that_are_copies_keep_their_article(spark):
    page = "<body><nav>m</nav><article><p>the same story</p></article></body>"
    df = spark.createDataFrame([(k, "http://h.example/", page) for k in range(6)], "page_id long, url string, html string")
    assert {r["text"] for r in extract(df).collect()} == {"the same story"}


def test_fixed_text_inside_articles_goes(spark):
    """What stands in every article of the host is no article's own, whatever its class; an article of fixed texts only stays."""
    rows = [(k, f"http://h.example/{k}", f"<body><article class=a><p>story {k} begins</p><p class=x>Share this story</p><p>and {k} ends</p></article></body>") for k in range(5)]
    rows += [(9, "http://h.example/9", "<body><article class=a><p class=x>Share this story</p></article></body>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert got == {k: f"story {k} begins and {k} ends" for k in range(5)} | {9: "Share this story"}


def test_copies_without_article_markup_keep_their_text(spark):
    """Copies tell nothing about a template, be they rows, pages or pages that differ in tags and scripts only."""
    page = "<body><div id=p{0}><script>n={1}</script><p>The whole story {0}</p><p>and its end {0}</p></div></body>"
    rows = [(k, f"http://copies.example/{k}", page.format(0, 0)) for k in range(4)] + [(10, "http://rows.example/", page.format(1, 1))] * 3
    rows += [(20 + k, f"http://nonce.example/{k}", page.format(2, k)) for k in range(4)]
    rows += [(30 + k, f"http://mixed.example/{k}", page.format(max(3, k), 3)) for k in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r["page_id"], r["text"]) for r in extract(df).collect()]
    want = [0] * 4 + [1] * 3 + [2] * 4 + [max(3, k) for k in range(8)]
    assert sorted(got) == sorted((r[0], f"The whole story {n} and its end {n}") for r, n in zip(rows, want))


def bare(source):
    """A page without what the lists go by: semantic elements become div, classes, ids and roles go."""
    return re.sub(r' (class|id|role)="[^"]*"', "", re.sub(r"(</?)(nav|footer|article|header|aside|main|section)\b", r"\1div", source))


def test_template_alone_finds_the_articles_of_the_tables(spark):
    """On hosts of SUPPORT pages or more, whichever way the template reaches the pages."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    host = {r["page_id"]: re.sub(r"\w+://([^/?#:]*).*", r"\1", r["url"], flags=re.S).lower() for r in pages}
    df = spark.createDataFrame([(r["page_id"], r["url"], bare(r["html"])) for r in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert got == {r["page_id"]: r["text"] for r in extract(df, broadcast=0).collect()}
    many = [r for r in pages if sum(h == host[r["page_id"]] for h in host.values()) >= 3]
    right = 0
    for r in many:
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r["html"], re.S)[1])
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", body)]
        right += got[r["page_id"]] == " ".join(x for x in parts if x)
    assert len(many) == 222 and right == 222


def test_slot_without_marks(spark):
    """Headings just before the slot belong to it; pages that lack the slot are searched for their own."""
    rows = []
    for k in range(9):
        body = "".join(f"<p>story{k} sentence {j} goes on and on.</p>" for j in range(8))
        notice = "<div>We use many small files to remember you, as everyone does these days.</div>" if k % 3 else ""
        rows.append((k, f"http://h.example/{k}", f"<body><div><a href=x>Home</a></div>{notice}<div><h1>Title {k}</h1><div>{body}</div></div><div>Contact us</div></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert got == {k: f"Title {k} " + " ".join(f"story{k} sentence {j} goes on and on." for j in range(8)) for k in range(9)}


def test_deep_pages_take_linear_time():
    import time

    began = time.time()
    assert text("<div>" * 100_000 + "deep") == "deep"
    assert text("<p>" + "<x>" * 50_000 + "<hr>a" * 50_000).count("a") == 50_000
    assert text("<ul><li>" + "<b>" * 50_000 + "<li>b" * 50_000).count("b") == 50_000
    assert text("<div><p>c<x><b>" * 30_000).count("c") == 30_000
    assert time.time() - began < 20
