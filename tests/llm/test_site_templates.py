import re
from html import unescape

import pytest

from viewtide.llm.site_templates import extract, host_of, read_page


def text(html):
    return " ".join(read_page(html)[0])


@pytest.mark.parametrize("html, expected", [
    ("", ""), ("  \n ", ""), ("plain &amp; text", "plain & text"),
    ("<p>a<b>b</b>c<br>d\n\t e<p>f", "abc d e f"),
    ("<title>t</title><script>var p='</p><p>x';</script><style>p{}</style><p>a</p><!-- c --><noscript>n</noscript>", "a"),
    ("<nav><ul><li>m</ul></nav><header>h</header><article><header><h1>T</h1></header><p>a</p></article><footer>f</footer>", "T a"),
    ("<article><p>a<aside>s</aside><p>b<form><p>q</p></form><div class='ad-box'>x</div>c</article>", "a b c"),
    ("<article><p>a</p><div class='comments'><article><p>r</p></article></div></article><div id=related><article>s", "a"),
    ("<form id=all><article><p>a</p><div id='readerComments'>r</div></article><input><p>z</p></form>", "a"),
    ("<main><div role=alert>x</div><p>a</main><p>b", "a"),
    ("<div class=sidebar>s</div><div><p>a</p></div><div class='has-sidebar'><article><p>b", "b"),
    ("<article><p>&lt;b&gt; &#233;&eacute;&#x1F600; &copy &nosuch; a&nbsp;b</p></article>", "<b> éé\U0001f600 © &nosuch; a b"),
    ("<article><p><b>one<br><p>two</b><div>three</div></p>four</article>five", "one two three four"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><th>e</table><dl><dt>f<dd>g", "a b c d e f g"),
    ("<svg><text>x</text></svg><p>a</p><button>go</button><select><option>1</select>", "a"),
    ("<p>a<span class=ad>x</span>b</p></div></nav>c", "a b c"),
    ("<article class='comment-open'><p>a</article><article class=comment>b</article>", "a"),
    ("<article><section><p>a</section></article><article><p>b</article>", "a b"),
])
def test_pages(html, expected):
    assert text(html) == expected


def test_depth_and_length():
    assert text("<div>" * 50_000 + "<p>a" + "</div>" * 50_000 + "b") == "a b"
    assert text("<article>" + "<p>word</p>" * 100_000 + "</article>") == " ".join(["word"] * 100_000)


@pytest.mark.parametrize("url, host", [
    ("http://A.example.org/x", "a.example.org"), ("//b.c:80?x", "b.c"), ("https://u:p@h.i./#f", "h.i"), ("x/y", None),
    (None, None), ("", None), ("mailto:a@b", None),
])
def test_hosts(url, host):
    assert host_of(url) == host


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "h", "b", 1) for r in rows], "page_id long, url string, html string, host string, blocks string, row int"
    )


def site(n, host="s.org", first=0, box="<div class=x9>join us</div>"):
    return [(first + k, f"http://{host}/{k}", f"<article><div>{box}<p>same words</p><p>text {k}</p></div></article>") for k in range(n)]


def test_what_a_site_repeats_goes(spark):
    rows = site(5) + site(4, "t.org", 100) + site(3, None, 200)
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert got == {
        **{k: f"same words text {k}" for k in range(5)},
        **{100 + k: f"join us same words text {k}" for k in range(4)},
        **{200 + k: f"join us same words text {k}" for k in range(3)},
    }


def test_copies_of_an_article_are_no_template(spark):
    one = "<article><div class=c><div>first part</div><p>second</p></div></article>"
    rows = [(k, f"http://s.org/{k}", f"<nav>{k}</nav>{one}") for k in range(50)]
    assert {r.text for r in extract(pages(spark, rows)).collect()} == {"first part second"}


def test_cases(spark):
    rows = [(1, None, None), (None, "http://s.org", "<p>a"), (1, "http://s.org", "<p>a"), (1, "http://s.org", "<p>a")]
    got = extract(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, None, "", 0), (None, "http://s.org", "a", 1), *[(1, "http://s.org", "a", 1)] * 2], key=repr)
    assert extract(pages(spark, [])).collect() == []
    long = "<article>" + "".join(f"<p>word {k} é\U0001f600</p>" for k in range(50_000)) + "</article>"
    row = extract(pages(spark, [(1, "http://s.org", long)])).first()
    assert row.n_chars == len(row.text) and row.text.startswith("word 0 é") and row.text.endswith("word 49999 é\U0001f600")


def test_on_the_table(spark, sf):
    """The pages of the table have all their text in one article of headings and paragraphs."""
    table = spark.read.parquet(f"{sf}/pages.parquet")

    def plain(html):
        inside = re.search(r"<article>(.*)</article>", html, re.S)[1]
        return " ".join(unescape(re.sub(r"</?b>", "", part)).strip() for part in re.split(r"</?(?:p|h1|br)>", inside) if part.strip("\n "))

    expected = {r.page_id: " ".join(plain(r.html).split()) for r in table.collect()}
    assert {r.page_id: r.text for r in extract(table).collect()} == expected
