from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.functions.html import html_text
from geoingest.sources.html_tree import _nodes, html_nodes


def outline(page: str) -> list[str]:
    """Text nodes behind the path of their elements."""
    path, found = {}, []
    for pos, parent, _, tag, text in _nodes(page):
        above = path.get(parent, "")
        if text is None:
            path[pos] = f"{above}/{tag}"
        else:
            found.append(f"{above} {text.strip()}")
    return found


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<div><p>a<p>b</div>c", ["/div/p a", "/div/p b", " c"]),
        ("<p>a<div>b</div>c", ["/p a", "/div b", " c"]),
        ("<ul><li>a<li>b<ul><li>c<li>d</ul>e</ul>f", ["/ul/li a", "/ul/li b", "/ul/li/ul/li c", "/ul/li/ul/li d", "/ul/li e", " f"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", ["/dl/dt a", "/dl/dd b", "/dl/dt c"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["/table/tr/td a", "/table/tr/td b", "/table/tr/th c", " d"]),
        ("<table><thead><tr><td>a<tbody><tr><td>b<table><tr><td>c</table>d", [
            "/table/thead/tr/td a", "/table/tbody/tr/td b", "/table/tbody/tr/td/table/tr/td c", "/table/tbody/tr/td d"]),
        ("<table><tr><td><p>a</div>b</table>", ["/table/tr/td/p a", "/table/tr/td/p b"]),
        ("<div><table><tr><td>a</div>b</table>c</div>d", ["/div/table/tr/td a", "/div/table/tr/td b", "/div c", " d"]),
        ("<select><optgroup><option>a<option>b<optgroup><option>c</select>d", [
            "/select/optgroup/option a", "/select/optgroup/option b", "/select/optgroup/option c", " d"]),
        ("a</b></div></p>b", [" a", " b"]),
        ("<b><i>a</b>b</i>c", ["/b/i a", "/i b", " c"]),
        ("<p><b>a</p><p>b</b>c</p>", ["/p/b a", "/p/b b", "/p c"]),
        ("<table><tr><td><b>a</td><td>b</table>c", ["/table/tr/td/b a", "/table/tr/td b", " c"]),
        ("<p><b>a<p><b>b</b>c<p>d", ["/p/b a", "/p/b/b b", "/p/b c", "/p/b d"]),
        ("<p><b>a<p><b>b<p><b>c<p><b>d<p>e", ["/p/b a", "/p/b/b b", "/p/b/b/b c", "/p/b/b/b/b d", "/p/b/b/b e"]),
        ("<b><p><b>a</p>b", ["/b/p/b a", "/b/b b"]),
        ("<span><div>a</span>b</div>c", ["/span/div a", "/span/div b", "/span c"]),
        ("<a>a<a>b</a>c", ["/a a", "/a b", " c"]),
        ("<h1>a<h2>b</h2>c", ["/h1 a", "/h2 b", " c"]),
        ("<section><h1>a</h1><p>b</section>c", ["/section/h1 a", "/section/p b", " c"]),
        ('<a title="open>one</a> two', ["/a one", " two"]),
        ("<a title='1>2'>x</a><img src=a.png>y<br/>z", ["/a x", " y", " z"]),
        ("<script>if (a<b) '<p>no</p>'</script>a<style>never <p>ends", [" a"]),
        ("<title>a <b>b", ["/title a <b>b"]),
        ("a<!-- b <p>c", [" a"]),
        ("a<p>b<p class=", [" a", "/p b"]),
        ("<svg><g><path/>a</g></svg>b", ["/svg/g a", " b"]),
        ("<div/>a</div>b", ["/div a", " b"]),
        ("<ruby>a<rp>(</rp><rt>b</rt></ruby>", ["/ruby a"]),
        ("1 < 2 <> 3", [" 1 < 2 <> 3"]),
        ("<P>a<LI>b</p>c", ["/p a", "/li b", "/li c"]),
        ("", []),
    ],
)
def test_repair(page, texts):
    assert outline(page) == texts


_inline = st.recursive(
    st.sampled_from(["x", "y z"]),
    lambda inner: st.tuples(st.sampled_from(["span", "b", "em", "q"]), st.lists(inner, min_size=1, max_size=2)),
    max_leaves=4,
)
_block = st.recursive(
    st.tuples(st.just("p"), st.lists(_inline, min_size=1, max_size=2)),
    lambda inner: st.one_of(
        st.tuples(st.sampled_from(["div", "section", "blockquote"]), st.lists(inner, max_size=3)),
        st.tuples(st.sampled_from(["ul", "ol"]), st.lists(st.tuples(st.just("li"), st.lists(inner, max_size=2)), max_size=3)),
        st.tuples(st.just("table"), st.lists(st.tuples(st.just("tr"), st.lists(
            st.tuples(st.sampled_from(["td", "th"]), st.lists(inner, max_size=2)), max_size=3)), max_size=2)),
    ),
    max_leaves=12,
)


def _written(node, path, left_out, whole, found):
    if isinstance(node, str):
        found.append(f"{path} {node}")
        return f"{node}<!-- -->"
    name, children = node
    inner = "".join(_written(c, f"{path}/{name}", left_out, whole, found) for c in children)
    return f"<{name}>{inner}" + ("" if name in left_out and not whole else f"</{name}>")


@settings(max_examples=300, deadline=None)
@given(st.lists(_block, max_size=4), st.sets(st.sampled_from(["p", "li", "tr", "td", "th"])))
def test_end_tags_that_may_be_left_out(blocks, left_out):
    texts, again = [], []
    whole = "".join(_written(b, "", left_out, True, texts) for b in blocks)
    # A paragraph ends at its parent's end or at the next block, so that no text follows it directly.
    short = "".join(_written(b, "", left_out, False, again) for b in blocks)
    assert outline(whole) == outline(short) == texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<b>", "</b>", "<i x='", "<table>", "<td>", "</td>", "</table>", "<li>", "a", " ", '"', "=", "<", ">", "<!--", "-->", "<script>", "</script>"]
), max_size=40))
def test_any_markup_gives_a_tree(tokens):
    nodes = list(_nodes("".join(tokens)))
    assert [n[0] for n in nodes] == list(range(len(nodes)))
    depth = {None: -1} | {n[0]: n[2] for n in nodes if n[4] is None}
    assert all(depth[n[1]] == n[2] - 1 for n in nodes)


def test_long_and_deep_pages_take_linear_time():
    for page in ("<div>" * 200_000 + "a", "<p><b>" * 100_000 + "a", "<a <a " * 100_000, "<a ='>' " * 100_000, "</p>" * 200_000, "<b><i></b>" * 50_000):
        assert sum(1 for _ in _nodes(page)) <= 500_002


def test_rows_of_pages(spark):
    rows = [(1, "<p>a &amp; b<p> <b>c"), (2, None), (3, ""), (4, "<p>" + "<i>x</i>" * 20_000), (1, "<p>again")]
    pages = spark.createDataFrame(rows, "tag_id int, body string")
    nodes = html_nodes(pages, "tag_id")
    assert [tuple(r) for r in nodes.where("tag_id = 1 AND text IS NOT NULL").orderBy("text").collect()] == [
        (1, 1, 0, 1, "p", "a & b"), (1, 1, 0, 1, "p", "again"), (1, 4, 3, 2, "b", "c"),
    ]
    assert nodes.where("tag_id = 4").count() == 40_001 and nodes.where("tag_id IN (2, 3)").isEmpty()
    assert html_nodes(pages.limit(0), "tag_id").isEmpty()
    with pytest.raises(ValueError):
        html_nodes(pages.withColumnRenamed("tag_id", "tag"), "tag")


def test_bytes_and_text_of_whole_pages(spark):
    page = "<html><body><h1>é</h1><p>a<br>b &lt;c&gt;</p><script>no</script></body></html>"
    pages = spark.createDataFrame([(1, page)], "id int, body string")
    texts = html_nodes(pages.withColumn("body", F.encode("body", "UTF-8")), "id").where("text IS NOT NULL").orderBy("node_pos")
    assert "\n".join(r["text"] for r in texts.collect()) == pages.select(html_text(F.col("body"))).first()[0]
