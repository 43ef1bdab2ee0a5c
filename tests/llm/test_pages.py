import html
import re
import time
from collections import Counter

import pytest

from tidewatch.llm import pages, queries

PAGE = """<html><head><title>T</title><script>var a = "</p>";</script></head><body><header><h2>Site name</h2></header>
<div class="cookie-notice">We use cookies</div><nav><a href=x>Home</a></nav><{0}><h1>Head &amp; line</h1>
<p>One &lt;two&gt;\n three <b>bold</b>.</p><div class="ad">Buy now</div><p>Second para a<br>b.<form>Sign <input> up</form>
<ul><li>item one<li>item two</ul></{0}><aside>side bar</aside><div id="comments"><p>A reader's comment, quite long.</p></div>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Head & line\n\nOne <two> three bold.\n\nSecond para a b.\n\nitem one\n\nitem two"


def article(page):
    """The article by its own markup, which the sample pages all have."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts)
    return "\n\n".join(x for x in texts if x)


def test_pages(spark, small):
    rows = queries.op5_main_text(spark, small).collect()
    source = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (source[r.page_id].url, article(source[r.page_id].html), len(r.text))


def test_furniture_is_left_out():
    for tag in ("article", "main", "div"):
        assert pages.main_text(PAGE.format(tag), {}) == TEXT


def test_odd_pages(spark):
    odd = ["", None, "<", "<p", "<!-- x", "<script>a", "plain words", "<p>a < b & c</p>", "<nav><a>only a menu</a></nav>",
           "<p>" + "word " * 100_000]
    frame = spark.createDataFrame([(k, None, h, "x") for k, h in enumerate(odd)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in pages.extract_pages(frame).collect()}
    assert [got[k] for k in range(9)] == ["", "", "<", "", "", "", "plain words", "a < b & c", ""]
    assert len(got[9]) == 499_999
    assert pages.extract_pages(frame.limit(0)).count() == 0


def test_weights_follow_labels():
    counts = {("w:p", True): 100, ("w:li", False): 90, ("t:p", True): 9, ("t:nav", False): 9}
    weight = pages.weights(counts)
    assert weight["w:p"] > 0 > weight["w:li"] and weight["t:nav"] < weight["t:p"] < 0


def wrapped(names, heading):
    body = ("<h1>Head</h1>" if heading else "") + "".join(f"<p>Paragraph {k} {'of an article about things ' * 6}</p>" for k in range(30))
    page = f"""<html><body><header><a href=/>Site</a></header><nav><a href=/a>Home</a><a>News</a></nav><div class="{names}">{body}
        <div class="ad">Buy this now</div></div><div id="comments"><p>{"I liked it a lot. " * 20}</p></div><footer>foot line</footer></body></html>"""
    want = [" ".join(x.split()) for x in re.findall(r"<(?:p|h1)>(.*?)</", body)]
    return page, "\n\n".join(want)


@pytest.mark.parametrize("names", [
    "content has-sidebar", "layout no-sidebar", "post social", "entry related-posts-enabled", "wp-block share-enabled", "social", "sidebar"])
def test_names_never_remove_the_article(spark, small, names):
    learned = pages.learn(spark.read.parquet(f"{small}/pages.parquet"))
    for heading in (False, True):
        page, want = wrapped(names, heading)
        assert pages.main_text(page, {}) == pages.main_text(page, learned) == want


def test_names_of_furniture():
    for names, want in (("ad", 2), ("cookie-notice", 2), ("cookieNotice", 2), ("comment-12", 2), ("related posts", 2), ("has-sidebar", 1),
                        ("post comment", 1), ("content has-sidebar", 0), ("story", 0), ("adage", 0), ("shared-values", 0)):
        assert pages.suspicion(names, {}) == want, names
    assert pages.suspicion("rail", {"n:rail": -3.0}) == 1 and pages.suspicion("social", {"n:social": 2.0}) == 1


def test_pages_without_names_and_labels(spark):
    """Only weights of settings are left: all of the article is found, and nine of ten words are its own."""
    web = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    learned = pages.learn(web)
    own = found = both = 0
    for r in web.collect():
        bare = re.sub(r'\s(?:class|id|role)="[^"]*"', "", re.sub(r"<(/?)(?:article|nav|aside|header|footer)\b", r"<\1div", r.html or ""))
        want, got = Counter(article(r.html or "").split()), Counter(pages.main_text(bare, learned).split())
        own, found, both = own + want.total(), found + got.total(), both + (want & got).total()
    assert both >= 0.99 * own and both >= 0.88 * found


@pytest.mark.parametrize("part", ["<b>x", "</b><i>", "<div><b>", "<p><b>x", "<li>x", "</x><article>", "<a class='ad b'>y"])
def test_open_tags_take_linear_time(part):
    def seconds(size):
        start = time.process_time()
        pages.main_text(part * (size // len(part)), {})
        return time.process_time() - start

    assert seconds(800_000) < 8 * seconds(200_000) + 0.5


def test_repeated_pages_stay(spark):
    web = spark.createDataFrame([(1, "u", PAGE.format("main"))] * 3 + [(None, None, None)] * 2, "page_id long, url string, html string")
    rows = sorted(pages.extract_pages(web).collect(), key=lambda r: r.n_chars)
    assert [tuple(r) for r in rows] == [(None, None, "", 0)] * 2 + [(1, "u", TEXT, len(TEXT))] * 3
