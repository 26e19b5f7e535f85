"""Operator 5: main text of web pages."""

import re
from html import unescape

from trackmart.llm import html

SCHEMA = "page_id long, url string, html string"


def texts(spark, *pages):
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], SCHEMA)
    found = html.extract_texts(df.selectExpr("*", "'x' as text", "1 as n_chars")).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_articles_of_the_given_pages(spark):
    pages = given_pages(spark)
    assert texts(spark, *pages) == articles(pages)


def test_what_is_not_the_article_goes(spark):
    words = "The story goes on with many plain words here. " * 8
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>
    <header class="site">Site name and slogan</header>
    <nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this site to do things.</div>
    <main><article><h1>A&nbsp;title &amp; more</h1><!-- <p>hidden</p> --><p>{words}</p>
    <aside class="related"><a href="#">Read this as well</a></aside>
    <p>Second   <b>part</b>ed<br>line</p><form><input><label>Mail</label><button>Send</button></form>
    <div class="ad-slot">Buy now</div><p>Tail.</p>
    <section id="comments"><p>{words} said a reader</p></section></article></main>
    <div class="sidebar"><p>Sidebar text of some length, not wanted.</p></div>
    <script>var a = "<p>no</p>";</script><footer>Copyright &copy; 2020</footer></body></html>"""
    assert texts(spark, page) == [
        "A title & more\n" + words.strip() + "\nSecond parted line\nTail."]


def test_awkward_pages(spark):
    found = texts(spark, None, "", "<p>", "plain words only", "<<< 1 < 2 <p", "<p>a" * 500,
                  "<div>" * 3000 + "deep words", "&lt;b&gt; &#65;&#x42; &am &unknown;",
                  "<script>never closed <p>x</p>", "<a href='x>y'>link</a> text of a page <p>one two")
    assert found[:4] == ["", "", "", "plain words only"]
    assert found[4] == "<<< 1 < 2 <p"
    assert found[5] == "\n".join(["a"] * 500)
    assert found[6] == "deep words" and found[7] == "<b> AB &am &unknown;" and found[8] == ""
    assert found[9].endswith("one two")
    assert html.extract_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_of_wrappers_do_not_empty_a_page(spark):
    words = "plain words of a story " * 5
    assert texts(
        spark, f"<div class='page has-sidebar'><nav>menu</nav><p>{words}</p></div>",
        f"<main><header class='article-header'><h1>Title</h1></header><p>{words}</p></main>",
    ) == [words.strip(), "Title\n" + words.strip()]


def test_the_best_run_is_the_one_with_the_largest_sum():
    model = html.RegionModel({})
    for page in ["<p>a b c</p><ul><li>x</li><li>y</li></ul><p>d e f g h</p>", "a", "",
                 "<div><div><div>a</div></div></div><table><tr><td>b c</td></tr></table>",
                 "<nav>a b <a>c</a></nav><h1>t</h1><div class=ad>x y z</div><p>d e</p><form>f</form>"]:
        scores = model.scores(html.pieces(page))
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)),
                   default=0)
        first, last = model.region(scores)
        assert abs(sum(scores[first:last]) - max(best, 0)) < 1e-9


def given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    return [row["html"] for row in rows]


def articles(pages):
    return [html_text(re.search(r"<article>(.*?)</article>", page, re.S).group(1)) for page in pages]


def html_text(body):
    blocks = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split())
              for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_articles_without_any_names(spark):
    """Classes, ids and roles are taken out: the weights of elements are learned."""
    pages = given_pages(spark)
    bare = [re.sub(r' (?:class|id|role)="[^"]*"', "", page) for page in pages]
    assert bare != pages and texts(spark, *bare) == articles(pages)


def test_names_are_learned_from_marked_pages(spark):
    """Names that nobody guessed, in both directions; the last page marks nothing."""
    words = [f"word{i} of a story that goes on and on" for i in range(12)]
    box = "<div class='zebra'>{}</div>"
    good = "<div class='sidebar'><p>{}</p></div>"
    pages = [f"<body>{box.format('x y z w ' * 12)}<article>{good.format(' '.join(words))}</article>"
             f"{box.format('q r s ' * 15)}</body>" for _ in range(40)]
    pages.append(f"<body>{box.format('x y z')}{good.format(words[0])}{box.format('q r')}</body>")
    found = texts(spark, *pages)
    assert found == [" ".join(words)] * 40 + [words[0]]


def test_the_scan_decides_what_is_kept(spark, monkeypatch):
    pages = given_pages(spark)[:40]
    model = html.Extractor({"words": (100, 10)})
    with_scan = [model.extract(page) for page in pages]
    monkeypatch.setattr(html.RegionModel, "region", lambda self, scores: (0, len(scores)))
    without = [model.extract(page) for page in pages]
    assert all(a != b and a in b for a, b in zip(with_scan, without))


def test_broken_pages_take_linear_time():
    import time

    model = html.Extractor({})
    for unit in ("x <b y ", "<span><div></div>", "<a ", '<a "', "<p", "</x>", "<!--", "<script>",
                 "<div class='a b", "<li><b>", "<a '\">", "<i></b>", "&#x", "<?", "<td><table>",
                 "<div class='c{}'>x"):
        count = 250_000 // len(unit)
        page = "".join(unit.format(i) for i in range(count)) if "{" in unit else unit * count
        for ending in ("", ">", "'>\""):
            start = time.process_time()
            model.extract(page + ending)
            assert time.process_time() - start < 5, (unit, ending)
