import html
import re

import pytest
from llm.samples import prose
from pyspark.sql import functions as F

from vellum.llm import wrappers
from vellum.llm.common import read_table
from vellum.llm.dom import articles, content, parse


def text_of(page: str) -> str:
    return content(articles(parse(page)), set())


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><p>a<p>b<b>c</b>d<br>e</article>", "a bcd e"),
        ("<article><p><b>open<br><p>next</p></article>x", "open next"),
        ("<body><nav>menu</nav><p>a</p><div class='ad'>buy</div><footer>f</footer>", "a"),
        ("<article><h1>t</h1><aside>s</aside><form>f</form><p>a &lt;b&gt; &#233;&nbsp;x</p></article><p>out</p>", "t a <b> é x"),
        ("<article>a<script>var t='</p><p>no';</script><style>p{}</style>b<!-- <p>c</p> -->d</article>", "abd"),
        ("<article>a<div class=ad>x</div>b<span class=ad>y</span>c</article>", "a bc"),
        ("<article><p>a</p><section id='comments'><article class='comment'><p>no</p></article></section></article>", "a"),
        ("<div role='navigation'>n</div><div hidden>h</div><div style='display: none'>s</div><main><p>a</main><p>b", "a"),
        ("<article><header><h1>title</h1></header><p>a</article>", "title a"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<a href=\"x>y\" title='<p>'>link</a>", "link"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
        ("<article><p>cut <b>of", "cut of"),
        ("<script>never closed <p>a", ""),
        ("<b>a</b> <i>b</i>", "a b"),
        ("<P CLASS=Ad>x</P><P>y</P>", "y"),
    ],
)
def test_text_of_pages(page, expected):
    assert text_of(page) == expected


def plain_score(a, b) -> int:
    """Simple tree matching without shortcuts."""
    if a.label != b.label:
        return 0
    rows = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + plain_score(x, y))
    return rows[-1][-1] + 1


def test_matching_equals_plain_dynamic_programming():
    import random

    rng = random.Random(3)

    def grown(depth):
        tag = rng.choice(["div", "span", "em"])
        inner = "".join(grown(depth - 1) for _ in range(rng.randint(0, 4))) if depth else "t"
        return f"<{tag}>{inner}</{tag}>"

    matcher = wrappers.Matcher()
    for _ in range(60):
        a, b = parse(grown(3)), parse(grown(3))
        leaves = matcher.measured(a), matcher.measured(b)
        assert matcher.score(a, b) == plain_score(a, b)
        pairs = sorted(matcher.aligned(a, b))
        assert all(i < len(leaves[0]) and j < len(leaves[1]) for i, j in pairs)
        assert [j for _, j in pairs] == sorted({j for _, j in pairs})


def layout(i: int, host: str, body: str) -> tuple:
    page = (
        f"<html><head><title>t{i}</title></head><body><div class=top>Site name</div><div class=x1><p>Welcome to our pages</p></div>"
        f"<div class=body>{body}</div><div class=x2><p>All rights reserved</p></div></body></html>"
    )
    return i, f"https://{host}/p/{i}", page


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, host string, text string").repartition(3)


def bodies(i: int) -> list[str]:
    return [prose(100 * i + k, 12) for k in range(1 + i % 5)]


@pytest.mark.parametrize("sent", [32 << 20, 0])
def test_constant_slots_are_template(spark, sent):
    rows = [layout(i, "Site.example.com:80", "".join(f"<p>{b}</p>" for b in bodies(i))) for i in range(40)]
    copy = "".join(f"<p>{b}</p>" for b in bodies(4))
    rows += [layout(100 + i, "copies.example.com", copy) for i in range(10)]  # equal pages tell nothing about a template
    rows += [layout(200, "single.example.com", "<p>alone</p>"), (300, None, "<p>no host</p>"), (301, "https://site.example.com/x", None), (302, "x", ""), (303, None, None)]
    rows += [rows[0]]
    found = wrappers.main_texts(pages(spark, rows), wrappers.WrapperConfig(sent=sent)).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    for i in range(40):
        assert texts[i] == " ".join(bodies(i))
    around = "Site name Welcome to our pages {} All rights reserved"
    assert all(texts[100 + i] == around.format(" ".join(bodies(4))) for i in range(10))
    assert texts[200] == around.format("alone") and texts[300] == "no host" and texts[301] == texts[302] == texts[303] == ""
    assert all(r.n_chars == len(r.text) for r in found)


def four_layouts():
    """One host whose pages have four layouts with neutral names and a constant block of their own in each."""
    rows = []
    for kind in range(4):
        for i in range(40):
            n = 40 * kind + i
            body = "".join(f"<p>{b}</p>" for b in bodies(n))
            strip = f"<div class=k{kind}a><p>Constant strip of layout {kind}</p></div>"
            deep = "<div class=w><div class=q>" * kind
            page = f"<html><body><div class=k{kind}>{strip}{deep}<div class=k{kind}b>{body}</div>{'</div></div>' * kind}</div><div class=z>Same everywhere</div></body></html>"
            rows.append((n, f"https://many.example.org/{n}", page))
    return rows


@pytest.mark.parametrize("sent", [32 << 20, 0])
def test_each_layout_of_a_host_has_its_template(spark, sent):
    rows = four_layouts()
    found = {r.page_id: r.text for r in wrappers.main_texts(pages(spark, rows), wrappers.WrapperConfig(sent=sent)).collect()}
    assert found == {n: " ".join(bodies(n)) for n in range(160)}


def test_the_wrapper_decides(spark):
    """Without enough pages to induce a template the same pages keep their constant blocks."""
    found = {r.page_id: r.text for r in wrappers.main_texts(pages(spark, four_layouts()), wrappers.WrapperConfig(pages=10_000)).collect()}
    assert all("Constant strip of layout" in t and t.endswith("Same everywhere") for t in found.values())


def test_given_pages(spark):
    table = read_table(spark, "/root/testdata/sf0.01", "pages")
    found = {r.page_id: r.text for r in wrappers.main_texts(table).collect()}
    for row in table.collect():
        body = re.search(r"<article>(.*?)</article>", row.html, re.S)
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|br|h1)[^>]*>", " ", body[1]))
        assert found[row.page_id] == " ".join(html.unescape(plain).split())


def test_long_page(spark):
    long = "".join(f"<p>{prose(i, 8)}</p>" + ("<p><b>x</b></p>" if i % 7 == 0 else "") for i in range(4000))
    rows = [layout(0, "a.example", long)] + [layout(i, "a.example", f"<p>{prose(i, 9)}</p><p><b>y</b></p>") for i in range(1, 9)]
    found = {r.page_id: r.n_chars for r in wrappers.main_texts(pages(spark, rows)).collect()}
    assert found[0] > 100_000


def test_no_pages(spark):
    assert wrappers.main_texts(pages(spark, [])).collect() == []
    assert wrappers.main_texts(pages(spark, [(None, None, None)])).select("text", F.col("n_chars")).collect() == [("", 0)]
