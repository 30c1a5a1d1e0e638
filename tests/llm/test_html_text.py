from __future__ import annotations

import random
import re
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.llm import html_text as op
from llm_helpers import prose

MENU = '<nav><ul><li><a href="/a">Home</a></li><li>News</li></ul></nav>'
FOOT = "<footer>&copy; site &middot; imprint</footer>"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_shared_is_a_longest_common_subsequence(a, b):
    @cache
    def length(i, j):
        if i == len(a) or j == len(b):
            return 0
        return length(i + 1, j + 1) + 1 if a[i] == b[j] else max(length(i + 1, j), length(i, j + 1))

    found = op.shared(a, b)
    assert len(found) == length(0, 0) and found == sorted(set(found))
    at = 0
    for i in found:
        at = b.index(a[i], at) + 1


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>a\n  b&nbsp;c</p><p> d </p>", "a b c d"),
    (f"<html><head><title>t</title><style>p{{}}</style></head><body>{MENU}<article><h1>T</h1><p>one<br>two<b>bold</b></p></article>{FOOT}", "T one twobold"),
    ('<article><p>x<script>var t="</p><p>no"</script>y</p><!-- c <p> --></article>', "xy"),
    ('<div class="post-content"><p>body</p></div><div class="sidebar">side</div>', "body"),
    ('<article>a<aside>b</aside>c<form><p>d</p></form><div class="ad">e</div></article>', "a c"),
    ('<article>a</article><section id="comments"><article>no</article></section>', "a"),
    ('<article><header><h1>head</h1></header><p>a</p><div class="comments">no</div></article><header>no</header>', "head a"),
    ('<div class="cookie-notice">no</div><p>a</p><div hidden>no</div><div style="display: none">no</div>', "a"),
    ("<p>unclosed <b>bold <p>next &lt;tag&gt; &#233; &euro;", "unclosed bold next <tag> é €"),
    ("<article>a < b and c > d</article>", "a < b and c > d"), ('<p title="a>b">x</p>', "x"), ("<script>never ends", ""),
    ("<table><tr><td>a</td><td>b</td></tr></table>", "a b"), ("<p>x</p><!-- open", "x"), ('<p title="odd>x</p>', "x"),
    ('<body class="has-menu"><p>a</p></body>', "a"), ("<textarea>no</textarea><p>a</p>", "a"), ("</p></div>a</article>", "a"),
])
def test_regions_and_text(html, text):
    texts, ranks, _ = op.lines_of(html)
    best = max([op.PLAIN, *ranks])
    assert " ".join(t for t, r in zip(texts, ranks) if r >= best) == text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def text_of(df):
    return {r["page_id"]: r["text"] for r in op.extract(df).collect()}


def test_shared_lines_go_and_copies_stay(spark):
    def page(body):
        return f"<div>Site name</div><div>Welcome</div><p>{body}</p><p>second {body}</p><div>All rights reserved</div>"

    bodies = [prose(i, 30) for i in range(4)]
    rows = [(i, f"http://h.org/en/{i}", page(b)) for i, b in enumerate(bodies)]
    rows += [(10, "http://copy.org/a", page("same words here")), (11, "http://copy.org/b", page("same words here"))]
    rows += [(20, "http://alone.org/x", page("lonely")), (21, None, page("no url")), (22, "", None)]
    got = text_of(pages(spark, rows))
    for i, b in enumerate(bodies):
        assert got[i] == f"{b} second {b}"
    for i in (10, 11, 20, 21):
        assert got[i].startswith("Site name Welcome") and got[i].endswith("All rights reserved")
    assert got[22] == ""


def test_declared_articles_lose_frames_only(spark):
    """A line that all pages of a host show goes; what two pages share stays, and so do titles and first headings."""
    rows = [(i, f"http://h.org/en/{i}", f"{MENU}<article><p>shared line</p><p>own {i}</p></article>{FOOT}") for i in range(3)]
    rows += [(10 + i, f"http://two.org/{i}", f"{MENU}<article><p>shared line</p><p>own {i}</p></article>{FOOT}") for i in range(2)]
    rows += [(20 + i, f"http://head.org/{i}", f"<title>The title</title><article><h2>Head</h2><p>The title</p><h2>Share</h2><p>own {i}</p></article>") for i in range(4)]
    rows += [(30 + i, f"http://same.org/{i}", "<article><p>all pages show this alone</p></article>") for i in range(4)]
    expected = {i: f"own {i}" for i in range(3)} | {10 + i: f"shared line own {i}" for i in range(2)}
    expected |= {20 + i: f"Head The title own {i}" for i in range(4)} | {30 + i: "all pages show this alone" for i in range(4)}
    assert text_of(pages(spark, rows)) == expected


def test_neighbours_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(i, "hot.org" if i % 3 else f"h{i % 4}.org", f"/{rng.choice('ab')}{rng.randrange(60)}/x") for i in range(300)]
    df = spark.createDataFrame(rows, "place long, host string, path string")

    def agree(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    ordered, expected = sorted(rows, key=lambda r: (r[1], r[2], r[0])), {}
    for k, row in enumerate(ordered):
        beside = [ordered[j] for j in (k - 1, k + 1) if 0 <= j < len(ordered) and ordered[j][1] == row[1]]
        if beside:
            expected[row[0]] = max(beside, key=lambda r: agree(r[2], row[2]))[0]
    for n in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            assert {r["place"]: r["near"] for r in op.nearest(df).collect()} == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_empty_long_repeated_and_clashing(spark):
    assert op.extract(pages(spark, [])).count() == 0
    long_ = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    rows = [(1, "http://a.org/1", long_)] * 2 + [(2, "http://a.org/2", "<p>" + "x" * 300_000 + "</p>"), (None, None, None)]
    df = pages(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("row", "place", "host", "cut", "text", "lines", "best")])
    got = op.extract(df)
    assert sorted(len(r["text"]) for r in got.collect()) == [0, 199_999, 199_999, 300_000] or got.count() == 4
    assert {"row", "cut", "best"} <= set(got.columns) and dict(got.dtypes)["text"] == "string"


def test_shared_lines_in_declared_articles_go(spark):
    """Notices and share lines within articles repeat on the host; versions of one article stay whole."""
    def page(*own):
        lines = ["Read our terms before use", *own, "Share this with friends"]
        return f"{MENU}<article>{''.join(f'<p>{x}</p>' for x in lines)}</article>{FOOT}"

    one = [f"first text number {i} " + " ".join(f"w{i}x{j}" for j in range(20)) for i in range(3)]
    rows = [(i, f"http://h.org/en/{i}", page(one[i])) for i in range(3)]
    # Of a short article the larger part is shared.
    rows += [(10, "http://s.org/a", page("gone fishing")), (11, "http://s.org/b", page("snow tonight")), (12, "http://s.org/c", page("no school"))]
    story = [f"line {j} of a story that two urls show" for j in range(5)]
    rows += [(20, "http://c.org/a", page(*story, "seen 17 times today")), (21, "http://c.org/b", page(*story, "seen 18 times today"))]
    got = text_of(pages(spark, rows))
    assert [got[i] for i in range(3)] == one
    assert (got[10], got[11]) == ("gone fishing", "snow tonight")
    assert got[20] == " ".join(["Read our terms before use", *story, "seen 17 times today", "Share this with friends"])


LONG = "a text that is much longer than what stands beside it"


@pytest.mark.parametrize("html,text", [
    (f"<main><p>{LONG}</p><article class=teaser>more</article></main>", f"{LONG} more"),
    (f"<main><h1>head</h1><article>{LONG}</article></main>", f"head {LONG}"),
    (f"<div>{LONG}</div><div class=post>teaser</div>", f"{LONG} teaser"),
    (f"<div>{LONG}</div><article>teaser</article>", f"{LONG} teaser"),
    (f"<div>beside</div><div class=content>{LONG}<article>teaser</article></div>", f"{LONG} teaser"),
    (f"<div>beside</div><article>{LONG}</article>", LONG),
    (f"<div>beside</div><main></main><div class=post>{LONG}</div>", LONG),
])
def test_a_small_declared_region_takes_nothing_away(html, text):
    test_regions_and_text(html, text)


def test_short_texts_under_long_menus(spark):
    """Pages of which a small part is their own lose what all pages of the host show, copies among them as well as others."""
    menu = "".join(f"<div>entry {i} of a long menu</div>" for i in range(40))
    rows = [(0, "http://h.org/a", f"{menu}<p>gone fishing</p>"), (1, "http://h.org/b", f"{menu}<p>snow tonight</p>")]
    rows += [(k, f"http://c.org/{k}", f"{menu}<p>seen {k // 2} times today</p>") for k in range(2, 6)]
    got = text_of(pages(spark, rows))
    assert (got[0], got[1]) == ("gone fishing", "snow tonight")
    # Two equal pages are half of this host: what would lose all of its text keeps it.
    assert got == slow_extract(rows) and got[4] == "seen 2 times today" and got[3].startswith("entry 0 of")


def slow_extract(rows):
    """The whole extraction by plain loops: neighbours, longest common subsequences, counts per host."""
    parts = {}
    for place, (page_id, url, html) in enumerate(rows):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0].lower()
            path = re.split("[?#]", rest[len(host) :])[0]
        parts[place] = (host, path, *op.lines_of(html))

    def agree(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    def subsequence(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        i, j, out = len(a), len(b), set()
        while i and j:
            if best[i][j] == best[i][j - 1]:
                j -= 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                i, j = i - 1, j - 1
                out.add(i)
        return out

    ordered, out = sorted(parts, key=lambda p: (*parts[p][:2], p)), {}
    for k, place in enumerate(ordered):
        host, path, texts, ranks, firm = parts[place]
        best = max([op.PLAIN, *ranks])
        beside = [ordered[j] for j in (k - 1, k + 1) if 0 <= j < len(ordered) and parts[ordered[j]][0] == host] if host else []
        gone = set()
        if beside:
            near = max(beside, key=lambda p: agree(parts[p][1], path))
            of_host = [p for p in parts if parts[p][0] == host]
            for at in subsequence(texts, parts[near][2]):
                n = sum(texts[at] in parts[p][2] for p in of_host)
                if n >= max(0.5 * len(of_host), 3 if best > op.PLAIN else 2) and at not in firm:
                    gone.add(at)
        kept = [t for at, (t, r) in enumerate(zip(texts, ranks)) if r >= best and at not in gone]
        out[rows[place][0]] = " ".join(kept or [t for t, r in zip(texts, ranks) if r >= best])
    return out


@pytest.mark.parametrize("at_once", [1 << 22, 4])
def test_whole_extraction(spark, monkeypatch, at_once):
    """Lines are distinct within a page, so the common subsequence taken does not matter."""
    monkeypatch.setattr(op, "ALIGNED_AT_ONCE", at_once)
    rng, rows = random.Random(8), []
    for i in range(120):
        host = rng.choice(["a.org", "a.org", "a.org", "b.org", "c.org", f"d{i % 7}.org"])
        frame = [f"<div>{host} frame {k}</div>" for k in range(8) if rng.random() < 0.8]
        body = [f"<p>{prose(rng.randrange(60), 6)}</p>" for _ in range(rng.randrange(6))]
        body = list(dict.fromkeys(body))
        inner = frame[:4] + [f"<h1>page {i % 9}</h1>"] * (i % 2) + body + frame[4:]
        html = f"<title>page {i % 9}</title>{MENU}" + ("<article>{}</article>" if rng.random() < 0.5 else "{}").format("".join(inner)) + FOOT
        rows.append((i, f"http://{host}/{rng.choice('xy')}/{rng.randrange(40)}", html))
    assert text_of(pages(spark, rows)) == slow_extract(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=30))
def test_split_alignments_are_as_long(a, b):
    whole = op.shared(a, b)
    kept, op.ALIGNED_AT_ONCE = op.ALIGNED_AT_ONCE, 6
    try:
        assert len(op.shared(a, b)) == len(whole)
    finally:
        op.ALIGNED_AT_ONCE = kept


def test_long_lists_of_lines():
    a = [random.Random(1).randrange(30_000) for _ in range(20_000)]
    assert op.shared(a, a) == list(range(20_000))
    assert len(op.shared(a, a[5_000:])) == 15_000


def test_no_article_of_the_given_pages_loses_text(spark):
    got = op.op9_html_text(spark, "/root/testdata/sf0.1").select("page_id", "text")
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").join(got, "page_id")
    for r in df.collect():
        texts, ranks, _ = op.lines_of(r["html"])
        best = max([op.PLAIN, *ranks])
        assert r["text"] == " ".join(t for t, k in zip(texts, ranks) if k >= best)
