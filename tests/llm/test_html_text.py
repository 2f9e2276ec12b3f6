import html
import itertools
import random
import re

from vigia.llm import html_text
from vigia.llm.queries import op4_html

from .conftest import SMALL


def test_query_equals_the_article_of_the_template(spark):
    want = {}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    got = op4_html(spark, SMALL).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_menus_notices_adverts_forms_and_comments_go():
    page = """<html><head><title>x</title></head><body class="has-sidebar"><header><h1>Site</h1><a href=/>home</a>
    </header><div id="cookie-notice">We use cookies. Please accept our cookies now, thanks.</div>
    <div class="page-wrapper"><div class="post-content"><h2>Story</h2><p>First para &amp; &lt;b&gt; text.<p>Second   para
    <a href=x>link</a> here.<ul><li>one item<li>two items</ul><div class="ad">Buy now!</div><p>Third.</p></div>
    <div class="comments"><p>I like this article a lot, it is very well written indeed.</p></div>
    <aside><p>Related: something else entirely to read here.</p></aside></div>
    <form><label>Name</label><input><button>Go</button></form><footer>(c) 2020</footer><script>if(a<b){"</div>"}"""
    assert html_text.main_text(page).split("\n") == [
        "Story", "First para & <b> text.", "Second para link here.", "one item", "two items", "Third."]


def test_pages_without_telling_elements_and_odd_pages():
    page = ("<div><p>Long paragraph number one has many words and it ends with a stop.</p><p>Short one.</p><p>Another "
            "long paragraph with many words that ends properly too.</p></div><ul><li><a href=a>Home</a></li></ul>")
    assert html_text.main_text(page).count("\n") == 2 and "Home" not in html_text.main_text(page)
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("<article><p>a < b <!-- open").startswith("a < b")
    assert html_text.main_text("<article>" + "<div>" * 5000 + "deep down in here") == "deep down in here"
    assert len(html_text.main_text("<article>" + "<p>some words</p>" * 20_000).split("\n")) == 20_000


def test_min_cut_is_minimal():
    random.seed(3)
    for _ in range(60):
        n = random.randint(1, 7)
        terminal = [random.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, random.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if random.random() < 0.5]

        def cost(side, terminal=terminal, edges=edges):
            return (sum(t if not k else 0 for t, k in zip(terminal, side, strict=True) if t > 0)
                    - sum(t if k else 0 for t, k in zip(terminal, side, strict=True) if t < 0)
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        best = min(cost(s) for s in itertools.product((False, True), repeat=n))
        assert abs(cost(html_text.min_cut(terminal, edges)) - best) < 1e-6


def test_rows_pass_through(spark):
    rows = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (2, "u", "<p>A sentence of several words.</p>", 2)],
                                 "page_id long, url string, html string, tag int")
    assert sorted((r.page_id, r.n_chars) for r in html_text.main_texts(rows).collect()) == [(1, 0), (1, 0), (2, 28)]
    assert html_text.main_texts(rows.limit(0)).count() == 0
    assert html_text.extract(rows).columns == ["page_id", "url", "html", "tag", "text"]


def test_end_tags_may_be_left_out():
    assert html_text.main_text("<html><head><title>x</title><script>a='<p>b'</script><body><article><p>The article."
                               "</article>") == "The article."
    for tag in ("button", "select", "svg", "object"):
        page = f"<article><div><{tag}>Go <b>there</b></div><p>The article.</p></article>"
        assert html_text.main_text(page) == "The article.", tag
    assert html_text.main_text("<article><svg><g><text>a</text></g><svg></svg>b</svg><p>It is.</p></article>") == "It is."


def _article(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split())
              for b in re.split(r"</?(?:p|h1)>", article)]
    return article, [b for b in blocks if b]


def _neutral(page):
    page = re.sub(r"(</?)(?:article|nav|footer|header|aside|main|form)\b", r"\1div", page)
    return re.sub(r'\s(?:class|id|role)="[^"]*"', "", page)


def _bare(page):
    """Paragraphs, heading and menu are plain divisions too."""
    article, _ = _article(page)
    parts = [re.sub("</?b>", "", p) for p in re.split(r"</?(?:p|h1)>", article)]
    parts = "".join(f"<div>{p}</div>" for p in parts if re.sub("<br>", "", p).strip())
    page = page.replace(f"<article>{article}</article>", f"<div>{parts}</div>")
    return re.sub(r"(</?)(?:ul|li)>", r"\1div>", _neutral(page))


def test_pages_without_names_and_the_cut_beats_the_sign(spark):
    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    for change in (_neutral, _bare):
        cut = sign = 0
        for page in pages:
            want = _article(page)[1]
            blocks = html_text.Blocks(change(page)).out
            score = html_text.scores(blocks)
            cut += [b[0] for b, k in zip(blocks, html_text.labels(blocks, score), strict=True) if k] == want
            sign += [b[0] for b, s in zip(blocks, score, strict=True) if s > 0] == want
        assert cut >= 0.9 * len(pages) and cut >= sign
        assert change is _neutral or cut > sign


def test_long_boilerplate_goes_and_short_lines_of_the_article_stay():
    long = "This sentence is long and has a good many words in it, as a real paragraph has. " * 20
    page = f"""<body><article><h1>Story</h1><p>{long}</p><p>Yes.</p><div class="notice"><p>{long}</p></div><p>{long}</p>
    <ul>{'<li><a href=x>a source</a></li>' * 30}</ul><div style="display:none"><p>{long}</p></div><p>No.</p></article>
    <div class="comments">{f'<p>{long}</p>' * 40}</div><aside><p>{long}</p></aside><footer><p>{long}</p></footer></body>"""
    long = " ".join(long.split())
    assert html_text.main_text(page).split("\n") == ["Story", long, "Yes.", long] + ["a source"] * 30 + ["No."]


def test_a_short_line_without_a_positive_score_is_kept_by_the_cut():
    blocks = html_text.Blocks("<div><p>Long paragraph number one has many words and it ends with a stop.</p><div>1</div><p>"
                              "Another long paragraph with many words that ends properly too.</p></div>"
                              "<ul><li><a href=a>Home</a></li></ul>").out
    score = html_text.scores(blocks)
    assert score[1] < 0 and html_text.labels(blocks, score) == [True, True, True, False]
