import html as codec
import re

import duckdb

from barforge.llm import queries, template

MENU = "<div class='x1'><a href=/a>Home</a> <a href=/b>About us</a></div>"


def texts(spark, pages, **options):
    df = spark.createDataFrame([(*p, "clash", "t") for p in pages], "page_id long, url string, html string, host string, text string")
    return {(r.id, r.url): r.text for r in template.main_texts(df, **options).collect()}


def test_article_with_everything_around_it(spark):
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
      <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
      <div id="cookie-notice"><p>We use cookies</p></div><!-- <p>hidden</p> --><div class="ad">Buy</div>
      <article class=post><header><h1>Big&nbsp;  news &lt;today&gt;</h1></header><p>One <b>two.<br><p>Three&#33; <a href="/x">four</a>
      five</b> six &amp not &am<div class="share-buttons">Tweet</div><ul><li>first<li>second</ul>
      <table><tr><td>a<td>b<tr><td>c</table><aside>More</aside><form>Name <input></form>
      <section id="comments"><article><p>First!</p></article></section></article>
      <div class="sidebar"><p>Popular</p></div><footer>&copy; 2024</footer></body></html>"""
    got = texts(spark, [(1, "http://a.example/1", page)])
    assert got[1, "http://a.example/1"] == "Big news <today>\nOne two.\nThree! four five six & not &am\nfirst\nsecond\na b\nc"


def test_recurring_subtrees_go_and_articles_stay(spark):
    body = lambda i: f"<title>Page {i}</title><body>{MENU}<div><p>Text of page {i} &eacute;</p><p>Quoted line</p></div><div>All rights kept</div>"
    pages = [(i, f"https://User@Site.example:80/{i}", body(i)) for i in range(8)]
    pages += [(20 + i, f"http://two.example/{i}", body(i)) for i in range(3)]  # too few pages
    pages += [(30, None, body(30)), (31, "not a url", body(31))]
    copy = "<title>Same</title><body><section><p>Copied article</p></section>"
    pages += [(40 + i, f"http://copy.example/{i}", copy) for i in range(20)]  # copies are one page
    got = {i: t for (i, _), t in texts(spark, pages, prose_share=1.1).items()}
    assert all(got[i] == f"Text of page {i} é\nQuoted line" for i in range(8))
    assert got[20] == "Text of page 0 é\nQuoted line\nAll rights kept"  # the menu is all links
    assert got[30] == "Text of page 30 é\nQuoted line\nAll rights kept" and got[31].startswith("Text of page 31")
    assert all(got[40 + i] == "Copied article" for i in range(20))
    got = {i: t for (i, _), t in texts(spark, pages, prose_share=0.3).items()}
    assert got[3] == "Text of page 3 é"


def test_paragraphs_of_marked_articles_are_not_template(spark):
    body = lambda i: f"<title>{i}</title><article><p>Own {i}</p><p>Shared by all</p><div><p>Follow us</p></div></article>"
    got = texts(spark, [(i, f"http://s.example/{i}", body(i)) for i in range(9)])
    assert all(text == f"Own {i}\nShared by all" for (i, _), text in got.items())


def test_joined_by_salt_beyond_the_broadcast(spark, monkeypatch):
    pages = [(i, f"http://s.example/{i}", f"<title>{i}</title>{MENU}<p>Own {i}</p><div>Foot</div>") for i in range(40)]
    want = texts(spark, pages)
    monkeypatch.setattr(template, "BROADCAST_HASHES", 0)
    assert texts(spark, pages) == want and want[7, "http://s.example/7"] == "Own 7"


def test_odd_pages(spark):
    odd = {1: None, 2: "", 3: "plain   text\n here", 4: "<p>cut <a href='x", 5: "<" * 50_000, 6: "<div>" * 30_000 + "deep",
           7: "<script>never closed <p>x", 8: "a < b & c &lt; d", 9: "</p></div>text</body></html>after", 10: "<article></article>outside",
           11: "<p>" + "word " * 200_000 + "</p>", 12: "<!-- open", 13: "<p title=\"a>b\">c</p>", 14: "<p hidden>no</p><p>yes</p>"}
    got = {i: t for (i, _), t in texts(spark, [(i, "http://o.example/", h) for i, h in odd.items()] + [(None, None, "<p>no id</p>")]).items()}
    assert (got[1], got[2], got[3], got[4], got[6]) == ("", "", "plain text here", "cut", "deep")
    assert got[5].startswith("<<<") and got[7] == "" and got[8] == "a < b & c < d" and got[9] == "textafter"
    assert got[10] == "outside" and len(got[11]) == 999_999 and got[12] == "" and got[13] == "c" and got[14] == "yes" and got[None] == "no id"


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://r.example/", "<p>a</p>")] * 7, "page_id long, url string, html string")
    assert [r.text for r in template.main_texts(df).collect()] == ["a"] * 7
    assert template.main_texts(df.where("false")).count() == 0


def test_query_against_the_articles_of_the_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in queries.op11_template(spark, sf).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM read_parquet('{sf}/pages.parquet')").fetchall()
    assert len(got) == len(pages)
    for page_id, url, html in pages:
        article = re.search("<article>(.*)</article>", html, re.S).group(1)
        blocks = (" ".join(codec.unescape(re.sub("<br>|</?b>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, want, len(want))
