from __future__ import annotations

import collections
import random

from presspulse.llm.html_text import LEAST_PAGES, extracted_text, main_text

PAGES = "page_id long, url string, html string, host string, template string, token long, text string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1, "t") for i, u, h in rows], PAGES)


CASES = {
    "": "",
    "<p>a<p>b</p>c": "a b c",
    "<p>a <b>b</b>c&amp;&nbsp;d\n\te</p>": "a bc& d e",
    "<script>var t='</p>';</script>x<style>p{": "x",
    "<!-- a <p> b -->x<!-- open": "x",
    "<nav>n</nav><article><header><h1>T</h1></header><p>x</p><div id='comments'>c</div><form>f</form></article><p>o": "T x",
    "<header>h</header><div class='sidebar left'>s</div><div class=content>x<aside>a</aside></div><footer>f": "x",
    "<div class='cookie-notice'>c</div><p title='a>b'>x</p></div></span>y": "x y",
    "a < b <c and d": "a < b <c and d",
    "x<br/>y<img src=z>z": "x yz",
    "<title>t</title><body>b": "b",
    "<div class='ad'><div>a</div>b</div>x": "x",
}


def test_structure():
    for page, text in CASES.items():
        assert main_text(page) == text, page
    assert main_text(None) == ""


WHOLE = {
    "<aside><article>teaser</article></aside><div>story</div>": "story",
    "<div class=content>story</div><div class=comments><article>reply</article></div>": "story",
    "<article></article><p>story": "story",
    "<p>menu</p><main><article>story</article></main>": "story",
    "<div style='overflow:hidden'>story</div>": "story",
    "<div class=\"overflow-hidden\">story</div>": "story",
    "<div data-note='is hidden here'>story</div>": "story",
    "<div hidden>n</div>story": "story",
    "<div class=x HIDDEN=hidden>n</div>story": "story",
    "<html class='nav'><body class='has-sidebar search'><p>story": "story",
    "<article class='post comment'>story</article>": "story",
    "<main class=social>story</main>": "story",
    "<div class='with-sidebar no-ads'>story</div>": "story",
    "<div class='left sidebar'>n</div><div id=share-widget>n</div>story": "story",
}


def test_marks_beside_the_article_drop_no_article():
    for page, text in WHOLE.items():
        assert main_text(page) == text, page


def test_long_and_deep_pages():
    assert main_text("<p>word</p>" * 20_000) == " ".join(["word"] * 20_000)
    assert main_text("<div>" * 3000 + "x") == "x"


def test_template_of_a_host(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, want = [], {}
    for i in range(3 * LEAST_PAGES):  # the class names say nothing; only repetition does
        text = [" ".join(word() for _ in range(12)) for _ in range(3)]
        body = "".join(f"<p>{t}</p>" for t in text)
        rows.append((i, f"https://one.example.org/{i}", f"<div class=q1>Our great portal</div><div class=q2>{body}</div><div class=q3>Made with care</div>"))
        want[i] = " ".join(text)
    few = "<div class=q1>Our great portal</div><p>kept text</p>"
    rows += [(100 + i, "https://two.example.org/x", few) for i in range(3)]
    got = {r.page_id: r.text for r in extracted_text(pages(spark, rows)).collect()}
    assert {i: got[i] for i in want} == want
    assert got[100] == "Our great portal kept text"


def test_copies_on_one_host_keep_their_text_where_others_differ(spark):
    rows = [(i, "https://one.example.org/", f"<article><p>{'same article' if i % 2 else f'own article {i}'}</p></article>") for i in range(30)]
    got = {r.page_id: r.text for r in extracted_text(pages(spark, rows)).collect()}
    assert got[1] == "same article" and got[2] == "own article 2"


def test_copies_are_one_page_in_template_deduction(spark):
    story = "".join(f"<p>part {k} of one story</p>" for k in range(4))
    rows = [(i, f"https://all.example.org/{i}", story) for i in range(20)]
    rows += [(100 + i, f"https://most.example.org/{i}", story if i < 12 else f"<p>own text {i}</p>") for i in range(20)]
    got = {r.page_id: r.text for r in extracted_text(pages(spark, rows)).collect()}
    whole = " ".join(f"part {k} of one story" for k in range(4))
    assert {got[i] for i in range(20)} | {got[100 + i] for i in range(12)} == {whole}
    assert got[115] == "own text 15"


def test_template_never_takes_all_text_of_a_page(spark):
    frame = "<div class=q1>Our great portal</div>{}<div class=q3>Made with care</div>"
    rows = [(i, "https://one.example.org/", frame.format(f"<p>text {i}</p>" if i else "")) for i in range(20)]
    got = {r.page_id: r.text for r in extracted_text(pages(spark, rows)).collect()}
    assert got[0] == "Our great portal Made with care" and got[7] == "text 7"


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "no host", ""), (None, "https://h/", "<p>x"), (3, None, "<p>y"), (3, None, "<p>y"), (4, "https://h/", "😀 &#x1F600; é")]
    got = extracted_text(pages(spark, rows)).collect()
    assert collections.Counter((r.page_id, r.url, r.text, r.n_chars) for r in got) == collections.Counter(
        [(1, None, "", 0), (2, "no host", "", 0), (None, "https://h/", "x", 1), (3, None, "y", 1), (3, None, "y", 1), (4, "https://h/", "😀 😀 é", 5)]
    )
    assert extracted_text(pages(spark, [])).count() == 0
