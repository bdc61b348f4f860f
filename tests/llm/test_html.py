"""Main texts of pages: known articles in made layouts, a plain reading of the given pages, odd markup."""

import html
import os
import random
import re

import pytest

from lonja.llm import html_template

SF_DIR = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))


def article(rng):
    return [words(rng, 4), *[words(rng, rng.randint(12, 40)) + " & more <x>" for _ in range(rng.randint(2, 6))]]


def marked(rng, parts):
    head, *rest = [html.escape(p) for p in parts]
    body = f"<h1>{head}</h1>" + "".join(f"<p>{p}" + rng.choice(["</p>", "<br>", "\n"]) for p in rest)
    return (
        f'<!DOCTYPE html><html><head><title>{head}</title><script>var t="</p>";</script></head><body class="has-sidebar">'
        f"<header><a href='/'>Site</a> {words(rng, 3)}</header><nav><ul><li><a>{words(rng, 1)}</a><li><a>{words(rng, 1)}</a></ul></nav>"
        f'<div class="cookie-notice">We use cookies {words(rng, 5)}</div><article>{body}<p>Read our other pages too.</p>'
        f"<section id='comments'><article class='comment'><p>{words(rng, 20)}</p></article></section></article>"
        f"<aside>{words(rng, 9)}</aside><form><p>{words(rng, 5)}</p><input></form><footer>&copy; {words(rng, 5)}</footer></body></html>"
    )


def unmarked(rng, parts):
    head, *rest = [html.escape(p) for p in parts]
    links = "".join(f"<li><a href='/{i}'>{words(rng, 3)}</a></li>" for i in range(9))
    return (
        f"<html><body><div id=top><p>Daily paper, the one you know</p></div><div id=left><ul>{links}</ul></div>"
        f"<div id=middle><h2>{head}</h2>" + "".join(f"<p>{p}</p>" for p in rest) + f"</div><div id=low><p>{words(rng, 2)}</p></div></body></html>"
    )


@pytest.mark.parametrize("layout", [marked, unmarked])
def test_known_articles(spark, stage, written, layout):
    rng = random.Random(2)
    truth = {i: article(rng) for i in range(30)}
    rows = [(i, f"http://www.paper{i % 2}.org/{i}", layout(rng, parts)) for i, parts in truth.items()]
    found = html_template.main_texts(written(spark.createDataFrame(rows, "page_id long, url string, html string")), stage)
    assert {r.page_id: r.text for r in found.collect()} == {i: "\n\n".join(parts) for i, parts in truth.items()}


def test_copies_and_versions_of_one_text_keep_their_text(spark, stage, written):
    rng = random.Random(4)
    one, other = article(rng), article(rng)
    versions = [[*one[:-1], one[-1] + f" {i}"] for i in range(20)]
    truth = dict(enumerate([*versions, *[other] * 20, *[one] * 3]))
    host = lambda i: "versions.org" if i < 20 else "copies.org" if i < 40 else "few.org"
    page = lambda parts: "<html><body><article>" + "".join(f"<p>{html.escape(p)}</p>" for p in parts) + "</article></body></html>"
    rows = [(i, f"http://{host(i)}/", page(parts)) for i, parts in truth.items()]
    found = html_template.main_texts(written(spark.createDataFrame(rows, "page_id long, url string, html string")), stage)
    assert {r.page_id: r.text for r in found.collect()} == {i: "\n\n".join(parts) for i, parts in truth.items()}


def test_tags_out_of_order_are_no_template(spark, stage, written):
    rng = random.Random(6)

    def page(i):
        a, b = f"<div id=a><p>{words(rng, 30)}</p></div>", f"<div id=b><p>{words(rng, 30)}</p></div>"
        return "<html><body>" + (a + b if i % 2 else b + a) + "</body></html>"

    rows = written(spark.createDataFrame([(7, page(i)) for i in range(12)], "host long, html string"))
    template = html_template.templates(rows, stage).collect()[0]
    seen = [token for token, _ in html_template.read(page(1)).tags]
    assert set(seen[:2]) <= set(template.tags) and len(template.tags) == 3


@data
def test_given_pages_as_read_plainly(spark):
    """In these pages the article element is closed, holds no other containers, and its blocks are h1 and p."""
    found = {r.page_id: r for r in html_template.op12_template_extraction(spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        inside = re.search("<article>(.*)</article>", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", inside)
        parts = [" ".join(html.unescape(re.sub(r"</?b\b[^>]*>", "", p).replace("<br>", " ")).split()) for p in parts]
        want = "\n\n".join(p for p in parts if p)
        assert found[page.page_id].text == want
        assert found[page.page_id].n_chars == len(want) and found[page.page_id].url == page.url


@pytest.mark.parametrize(
    "markup, text",
    [
        (None, []),
        ("", []),
        ("plain &lt;text&gt;  of\n no&nbsp;block", ["plain <text> of no block"]),
        ("<p>one<p>two <b>three</p>four", ["one", "two three", "four"]),
        ("<!-- a -- > b --><p>a<!-- x --> b</p><!-- open", ["a b"]),
        ("<p title='>'>quoted</p><p class=\"x>left", ["quoted", "left"]),
        ("<p>1 < 2 and 2 > 1</p>", ["1 < 2 and 2 > 1"]),
        ("<SCRIPT>if (a<b) x='</p>';</SCRIPT ><p>after</p><style>p{}", ["after"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
        ("<div><p>in</div></div></div>out", ["in", "out"]),
        ("<article><header><h1>Head</h1></header><p>x</p><footer>y</footer></article><p>z</p>", ["Head", "x"]),
        ("<main><p>x</p></main><p>z</p>", ["x"]),
        ("<div class='content-with-sidebar'><p>x</p></div><div class='left sidebar'>y</div>", ["x"]),
        ("a<br>b<br/>c", ["a b c"]),
        ("<p>caf&eacute; &#233;&#x e9;&amp;amp; &bogus; &copy 2</p>", ["café é&#x e9;&amp; &bogus; © 2"]),
        ("<p>" + "long " * 200_000 + "</p>", [("long " * 200_000).strip()]),
    ],
)
def test_odd_markup(markup, text):
    assert html_template.extract(markup, None, None, None) == text


def test_odd_rows(spark, tmp_path):
    page = "<body><p>same text</p></body>"
    rows = [(1, None, page, 5), (1, None, page, 5), (None, "http://a.org", None, 6), (3, "no host", "", 7), (4, "http://a.org/x", page, 8)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    docs.write.parquet(f"{tmp_path}/pages.parquet")
    docs.where("false").write.parquet(f"{tmp_path}/none/pages.parquet")
    found = html_template.op12_template_extraction(spark, str(tmp_path))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted([tuple(r) for r in found.collect()], key=repr)
    want = [(1, None, "same text", 9), (1, None, "same text", 9), (3, "no host", "", 0), (4, "http://a.org/x", "same text", 9)]
    assert got == sorted([*want, (None, "http://a.org", "", 0)], key=repr)
    assert html_template.op12_template_extraction(spark, f"{tmp_path}/none").count() == 0
