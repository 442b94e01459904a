import html
import re
import time

from headway.llm import html_text as X
from headway.llm.common import table
from headway.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(page):
    """Text between the article tags, cut at block tags: right for the fixture's pages."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = re.split(r"</?(?:p|h1|h2|ul|ol|li|div|section|blockquote|table|tr|td|pre)\b[^>]*>", inner)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m.group().startswith("<br") else "", p)).split())
             for p in parts]
    return "\n\n".join(t for t in texts if t)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="home"><header><h1>Site</h1></header>
<nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<main class="c12"><article><header><h2>Head&amp;line</h2></header><p>One <b>bold</b> &eacute;<br>two<p>Three
  four&nbsp;five<ul><li>item one<li>item two</ul><form><p>Your mail <input></form><div class="ad">Buy</div>
<script>var t="</p><p>not text";</script><!-- nor <p>this --><section id="comments"><p>First!</section></article></main>
<aside>Links</aside><footer>&copy; us</footer>"""


def test_blocks_of_a_page():
    assert X.extract(PAGE, ">html>body.home>main.c>article") == \
        "Head&line\n\nOne bold é two\n\nThree four five\n\nitem one\n\nitem two"


def test_own_best_path_is_used_without_the_hosts_path():
    assert X.extract(PAGE, ">html>body>div.post") == X.extract(PAGE, None) == X.extract(PAGE, ">html>body.home>main.c>article")


def test_link_lists_score_nothing():
    page = "<body><div class=a><p>" + "words " * 40 + "</div><div class=b>" + "<p><a href=x>" + "words " * 90 + "</a></div>"
    assert X.best_path(X.Page(page))[0] == ">body>div.a"


def test_layout_classes_leave_no_article_out():
    body, menu = "<h1>Title</h1><p>" + "true text " * 30 + "</p>", "<div class='sidebar'><p>menu text</p></div>"
    want = "Title\n\n" + ("true text " * 30).strip()
    talk = "<div id=comments class=comments-area><ol><li class=comment><article class=comment-body>" + "<p>" + "reader " * 200
    for page in (f"<main class='with-sidebar'>{body}</main>", f"<article class='post no-comments'>{body}</article>",
                 f"<div class='layout has-sidebar'><article>{body}</article>{menu}</div>",
                 f"<div class='layout sidebar-right'><main>{body}</main>{menu}</div>", f"<main class=sidebar-main>{body}{menu}</main>",
                 f"<article class='post sidebar'>{body}{menu}</article>", f"<div id=content-sidebar>{body}{menu}</div>",
                 f"<article class=post>{body}</article>{talk}", f"<main><article>{body}{talk}", f"<div class=post>{body}</div>{talk}",
                 f"<article>{body}</article><section class=related><article><p>teaser</article></section>"):
        assert X.extract("<body>" + page, None) == want, page
    assert X.extract("<article><p>one <span class=ad>Buy</span> two", None) == "one two"


def test_winning_path_is_widened_to_the_article():
    text = ("words of it " * 40).strip()
    inner = f"<h1>Title</h1><p>Lead</p><div class=body1><p>{text}</p></div><div class=more2><p>Second</p></div>"
    links = "<div class=tags><p><a href=x>One</a> <a href=y>Two</a></div>"
    want = f"Title\n\nLead\n\n{text}\n\nSecond"
    for page, path in ((f"<article>{inner}</article>{links}", ">body>article>div.body"),
                       (f"<main><section>{inner}</section></main>{links}", ">body>main>section>div.body"),
                       (f"<main><article class=post>{inner}</article>{links}</main>", ">body>main>article.post>div.body"),
                       (f"<div class=wrap><div class=post>{inner}</div>{links}</div>", ">body>div.wrap>div.post>div.body")):
        page = "<body>" + page
        assert X.best_path(X.Page(page))[0] == path
        assert X.extract(page, path) == X.extract(page, None) == want


def test_host_votes_decide(spark):
    def page(main, other):
        return f"<html><body><div class=main1><p>{main}</div><div class=extra><p>{other}</div></body></html>"

    rows = [(i, f"https://h.example/{i}", page("long text " * 20, "short")) for i in range(5)]
    rows += [(9, "http://h.example/9", page("true text", "a much longer block of something else " * 5)),
             (10, "http://other.example:80/9", page("true text", "a much longer block of something else " * 5)),
             (11, None, "<p>no body"), (12, "nothing", None), (13, "https://h.example/13", ""), (None, None, "plain"),
             (9, "http://h.example/9", page("true text", "a much longer block of something else " * 5)),
             (14, "https://h.example/14", "<div class=x>" + "<p>very " * 30_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")
    got = {(r.page_id, r.url): r.text for r in X.main_text(pages).collect()}
    assert X.main_text(pages).count() == len(rows)
    assert got[9, "http://h.example/9"] == "true text"
    assert got[10, "http://other.example:80/9"].startswith("a much longer")
    assert got[11, None] == "no body" and got[12, "nothing"] == "" and got[13, "https://h.example/13"] == ""
    assert got[None, None] == "plain" and got[14, "https://h.example/14"].count("very") == 30_000
    assert X.main_text(pages.limit(0)).collect() == []


def test_registered_query(spark):
    pages = table(spark, SF, "pages").collect()
    got = {r.page_id: r for r in QUERIES["op5_host_path_text"](spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == plain(p.html) and got[p.page_id].n_chars == len(plain(p.html))
        assert got[p.page_id].url == p.url


def test_names_within_an_article_count_whole():
    page = ("<body><article><h1>T</h1><h2 id=related-work>Related work</h2><p>One</p><section class='notice-of-appeal'><p>Two</p>"
            "</section><p class='social-proof'>Three</p><div class='related-posts'><p>teaser</p></div><div id=ad-slot-3>Buy</div>"
            "<div class='share-buttons'>Share</div><div class='comment-list'><p>First!</div><aside>x</aside></article>")
    assert X.extract(page, None) == "T\n\nRelated work\n\nOne\n\nTwo\n\nThree"


def test_drawings_that_end_at_once():
    assert X.extract("<article><p>a<svg/>b <svg class=x><path d=1 /><text>no</text></svg>c<math/>d</p><p>e</article>", None) == \
        "ab cd\n\ne"


def test_deep_unclosed_and_stray_tags_take_linear_time():
    def seconds(page):
        t = time.process_time()
        X.extract(page, ">html>body>div.c")
        return time.process_time() - t

    shapes = [lambda n: "<div class=c><p>word" * n, lambda n: "<div>" * n, lambda n: "<span class=ad>" * n + "x",
              lambda n: "<b>" * n + "<p>x</p>" * n, lambda n: "<div>" * n + "</x></p></li>" * n,
              lambda n: "<ul><li>" * n + "x</ul>" * n, lambda n: "<div class=sidebar><p>t" * n, lambda n: "<table><tr><td>x" * n,
              lambda n: "".join(f"<div class=c{'x' * (i % 7)}><p>w" for i in range(n)), lambda n: "<section class=related><article>x" * n]
    for shape in shapes:
        assert seconds(shape(20_000)) < 4, shape(2)
    assert X.extract("<div class=c><p>word" * 3000, None).count("word") == 3000


def test_paths_too_large_to_broadcast_are_joined(spark, monkeypatch):
    rows = [(i, f"https://h{i % 3}.example/{i}", f"<body><div class=main><p>text {i} " + "x " * 30) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(tuple, X.main_text(pages).collect()))
    monkeypatch.setattr(X, "PATHS_BYTES", 0)
    monkeypatch.setattr(X, "PAGES_A_PART", 4)
    assert sorted(map(tuple, X.main_text(pages).collect())) == want and len(want) == 60
