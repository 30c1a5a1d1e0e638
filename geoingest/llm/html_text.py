"""Main text of pages by differencing each page with its nearest by URL.

A page becomes text lines, one per block, each with the rank of the region it lies in: noise (menus, headers,
footers, sidebars, notices, adverts, forms, comments), plain, or the declared article: all that main and article
elements hold, or else, if that is less than half of the page's text without noise, also containers named as content;
if that is less than half too, as for a teaser beside the text, nothing counts as declared. Noise goes, and where a page
declares an article, what lies outside it.

Pages of one host are ordered by path; each is paired with the neighbour whose path agrees with its own for longer, and
the two are aligned line by line by their longest common subsequence. A shared line is deleted if its host shows that
it belongs to the pages' frame: it stands on ``SHARE`` of the host's pages, and on ``LEAST_PAGES`` of them where it lies in a declared
article. Copies of an article share their lines with each other, not with their host, so they keep them. The page's
title and its first heading stay in any case, and so does the text of a page that would lose all of it.

The order by path is made by range partitions whose edges are exchanged, so no host is gathered in one
task. Alignment sees hashes of lines only and splits long lists, so its memory does not grow with their square; a host's
pages are counted for the shared lines alone, by partial sums.

Defined results: null or empty html gives the empty text; a page alone on its host, or of a null url, is cut by
its regions only; repeated rows give repeated results; an empty table gives an empty result. Input columns
stay, a result column replaces one of its name.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.llm.common import broadcast_within, staged
from geoingest.llm.registry import query, table
from geoingest.llm.url_filter import host_of, path_of

#: Ranks of lines; while a page is read, marks of the declared containers that hold a line, together.
NOISE, PLAIN, CONTENT, MAIN, ARTICLE = -1, 0, 1, 2, 4
#: A declared region holds this share of the text that is not noise, or the page counts as undeclared.
HALF = 0.5
#: A line of a host's frame stands on this share of its pages, and on so many within declared articles.
SHARE, LEAST_PAGES = 0.5, 3
#: Lists of lines with a larger product of lengths are split before they are aligned.
ALIGNED_AT_ONCE = 1 << 22

# Fixed values of the HTML format: elements that break a line, and those whose content is not markup.
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math object canvas".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that carry a region; others open and close without effect on it.
_CONTAINERS = frozenset(
    "html head body article main section div nav header footer aside form menu dialog fieldset ul ol dl table figure "
    "details center button select label span td p".split()
)
_NOISE_TAGS = frozenset("head nav footer aside form menu dialog button select".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class and id that name what is not the article.
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox sponsor sponsored sponsors promo promoted promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription "
    "signup sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar "
    "comment comments commentlist respond reply replies disqus share sharing social related recommended recommendations "
    "widget widgets pagination pager login search copyright disclaimer banner skip".split()
)
_COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus related recommended recommendations".split())
_CONTENT_WORDS = frozenset("article post entry story content maincontent articlebody".split())

_TAG = re.compile(
    r"""<(?:!--(?:.*?--!?>|.*\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z0-9]+")


def _region(tag: str, attributes: str, outer: int, forced: bool) -> tuple[int, bool]:
    """Rank inside an element, and whether it is noise whatever it holds."""
    found = {}
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), value.strip("\"'").lower())
    role = found.get("role", "")
    words = set(_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}"))
    if forced:
        return NOISE, True
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    if tag in _NOISE_TAGS or role in _NOISE_ROLES or hidden:
        return NOISE, True
    if words & _COMMENT_WORDS and tag not in ("html", "body"):
        return NOISE, True
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articlebody":
        rank = MAIN if tag == "main" or role == "main" else ARTICLE
        return (max(outer, PLAIN) | rank, False)
    if outer == NOISE:
        return NOISE, False
    if tag == "header":
        return (outer, False) if outer > PLAIN else (NOISE, True)
    noise = words & _NOISE_WORDS
    if noise and tag not in ("html", "body"):
        # The head of an article is part of it.
        if not (noise <= {"header", "banner"} and (outer > PLAIN or words & _CONTENT_WORDS)):
            return NOISE, False
    if tag in ("div", "section", "td") and words & _CONTENT_WORDS:
        return outer | CONTENT, False
    return outer, False


def declared(sizes: list[int], marks: list[int]) -> list[int]:
    """Ranks of lines from the marks of the containers that hold them: noise, plain or content."""
    least = HALF * sum(n for n, m in zip(sizes, marks) if m >= PLAIN)
    for region in (MAIN | ARTICLE, MAIN | ARTICLE | CONTENT):
        ranks = [min(m, PLAIN) if m <= PLAIN or not m & region else CONTENT for m in marks]
        if sum(n for n, r in zip(sizes, ranks) if r == CONTENT) >= least:
            return ranks
    return [min(m, PLAIN) for m in marks]


def spaced(held: list[str]) -> str:
    """Pieces of markup as one text: character references decoded, white space made single spaces."""
    return " ".join(unescape("".join(held)).split())


def lines_of(html: str | None) -> tuple[list[str], list[int], list[int]]:
    """Text lines of a page in order, the rank of each, and the places of its title and of its first heading."""
    texts: list[str] = []
    ranks: list[int] = []
    if not html:
        return texts, ranks, []
    stack: list[tuple[str, int, bool]] = [("", PLAIN, False)]
    held: list[str] = []
    heading, headings, title = "", [], None

    def flush() -> None:
        if held:
            text = spaced(held)
            held.clear()
            if text:
                if heading:
                    headings.append(len(texts))
                texts.append(text)
                ranks.append(stack[-1][1])

    at = 0
    size = len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            held.append(html[at:])
            break
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        closing, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if name in _BLOCKS:
            flush()
        if name in _HEADINGS:
            heading = "" if closing else name
        if closing:
            if name in _CONTAINERS:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        if stack[depth][1] != stack[depth - 1][1]:
                            flush()
                        del stack[depth:]
                        break
        elif name in _RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(html, at)
                if name == "title" and title is None:
                    title = spaced([html[at : end.start() if end else size]])
                at = end.end() if end else size
        elif name in _CONTAINERS and name not in _VOID and not (attributes.endswith("/") and name != "p"):
            if name == "p" and stack[-1][0] == "p":
                stack.pop()
            rank, forced = _region(name, attributes, stack[-1][1], stack[-1][2])
            if rank != stack[-1][1]:
                flush()
            stack.append((name, rank, forced))
    flush()
    ranks = declared([len(t) for t in texts], ranks)
    best = max([PLAIN, *ranks])
    first = [k for k in headings if ranks[k] == best][:1]
    return texts, ranks, sorted({*first, *(k for k, t in enumerate(texts) if t == title)})


def _masks(b: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    return masks


def _next(v: int, mask: int, full: int) -> int:
    """One row of the alignment: a bit is off where the common subsequence grows."""
    u = v & mask
    return ((v + u) | (v - u)) & full


def _reach(a: list[int], b: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` and each start of ``b``, the empty one first."""
    masks, full = _masks(b), (1 << len(b)) - 1
    v = full
    for x in a:
        v = _next(v, masks.get(x, 0), full)
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    both = set(a) & set(b)
    places, out = [i for i, x in enumerate(a) if x in both], []
    # Parts of both lists that are aligned with each other; a large one is split at the middle of the first.
    parts = [(places, [x for x in b if x in both])]
    while parts:
        rows, others = parts.pop()
        if not rows or not others:
            continue
        if len(rows) > 1 and len(rows) * len(others) > ALIGNED_AT_ONCE:
            half = len(rows) // 2
            before = _reach([a[i] for i in rows[:half]], others)
            after = _reach([a[i] for i in rows[half:][::-1]], others[::-1])[::-1]
            cut = int((before + after).argmax())
            parts += [(rows[half:], others[cut:]), (rows[:half], others[:cut])]
            continue
        masks, full = _masks(others), (1 << len(others)) - 1
        steps = [full]
        for i in rows:
            steps.append(_next(steps[-1], masks.get(a[i], 0), full))
        i, j, found = len(rows), len(others), []
        while i and j:
            if steps[i] >> (j - 1) & 1:
                j -= 1
            elif not steps[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.append(rows[i])
        out += found[::-1]
    return out


_LINES = T.StructType([
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("ranks", T.ArrayType(T.IntegerType())),
    T.StructField("hashes", T.ArrayType(T.LongType())),
    T.StructField("firm", T.ArrayType(T.IntegerType())),
])


@F.arrow_udf(_LINES)
def _lines(html: pa.Array) -> pa.Array:
    found = [lines_of(h.as_py()) for h in html]
    hashes = [[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in texts] for texts, _, _ in found]
    return pa.StructArray.from_arrays(
        [
            pa.array([[t.encode("utf-8", "replace").decode() for t in texts] for texts, _, _ in found], pa.list_(pa.string())),
            pa.array([ranks for _, ranks, _ in found], pa.list_(pa.int32())),
            pa.array(hashes, pa.list_(pa.int64())),
            pa.array([firm for _, _, firm in found], pa.list_(pa.int32())),
        ],
        ["texts", "ranks", "hashes", "firm"],
    )


_SHARED = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("line", T.LongType())])


@F.arrow_udf(T.ArrayType(_SHARED))
def _shared(ranks: pa.Array, firm: pa.Array, hashes: pa.Array, near_hashes: pa.Array) -> pa.Array:
    """The lines of the best rank that the nearest page shares, but for title and heading: their places and hashes."""
    out = []
    for row in zip(ranks, firm, hashes, near_hashes):
        rank, stays, own, near = (c.as_py() for c in row)
        best = max([PLAIN, *rank])
        out.append([{"at": k, "line": own[k]} for k in shared(own, near) if rank[k] == best and k not in stays])
    return pa.array(out, pa.list_(pa.struct([("at", pa.int32()), ("line", pa.int64())])))


def _frames(pages: DataFrame, shared_lines: DataFrame) -> DataFrame:
    """Of ``place, at, line, host, declared`` those on lines that stand on enough pages of the host."""
    asked = shared_lines.select("host", "line").distinct()
    held = pages.select("host", F.explode(F.array_distinct("hashes")).alias("line"))
    seen = held.join(broadcast_within(staged(asked, "asked-lines"), F.length("host") * 4 + 24), ["host", "line"], "left_semi")
    seen = staged(seen.groupBy("host", "line").agg(F.count("*").alias("n")), "lines-of-hosts")
    hosts = staged(pages.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    least = F.greatest(F.col("pages") * SHARE, F.when(F.col("declared"), F.lit(LEAST_PAGES)).otherwise(F.lit(2)))
    counted = shared_lines.join(broadcast_within(seen, F.length("host") * 4 + 24), ["host", "line"])
    counted = counted.join(broadcast_within(hosts, F.length("host") * 4 + 16), "host")
    return counted.where(F.col("n") >= least).select("place", "at")


def nearest(pages: DataFrame) -> DataFrame:
    """From unique ``place`` with ``host, path``: ``place, near``, the neighbour on the host whose path agrees longer."""
    order = ["host", "path", "place"]
    sorted_ = pages.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = staged(sorted_.withColumn("part", F.spark_partition_id()), "pages-by-url")
    ends = sorted_.groupBy("part").agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"))
    # One row per partition: the edges that neighbouring partitions see of each other.
    across = W.orderBy("part")
    ends = ends.select("part", F.lag("last").over(across).alias("edge_before"), F.lead("first").over(across).alias("edge_after"))
    w = W.partitionBy("part").orderBy(*order)
    own = F.struct(*order)
    beside = sorted_.withColumn("before", F.lag(own).over(w)).withColumn("after", F.lead(own).over(w)).join(F.broadcast(ends), "part")
    beside = beside.withColumn("before", F.coalesce("before", "edge_before")).withColumn("after", F.coalesce("after", "edge_after"))

    def agreement(other: str):
        # Characters of the path up to the first that differs.
        n = F.least(F.length("path"), F.length(f"{other}.path"))
        differs = F.filter(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: F.substring(F.col("path"), i, F.lit(1)) != F.substring(F.col(f"{other}.path"), i, F.lit(1)),
        )
        length = F.coalesce(F.get(differs, F.lit(0)) - 1, n)
        return F.when(F.col(f"{other}.host") == F.col("host"), length)

    a, b = agreement("before"), agreement("after")
    near = F.when(a.isNotNull() & (b.isNull() | (a >= b)), F.col("before.place")).when(b.isNotNull(), F.col("after.place"))
    return beside.select("place", near.alias("near")).where("near is not null")


def extract(df: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The columns of ``df`` but the html, with ``text``."""
    columns = [c for c in df.columns if c not in (html_col, "text")]
    url = F.col(f"`{url_col}`")
    pages = df.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        _lines(F.col(f"`{html_col}`")).alias("lines"),
    ).select("row", "host", "path", "lines.*", F.monotonically_increasing_id().alias("place"))
    pages = staged(pages, "page-lines")
    pairs = nearest(pages.where("host <> ''"))
    sides = pages.select("place", "host", "ranks", "firm", "hashes").join(pairs, "place")
    other = pages.select(F.col("place").alias("near"), F.col("hashes").alias("near_hashes"))
    sides = sides.join(other, "near").withColumn("lines", _shared("ranks", "firm", "hashes", "near_hashes"))
    sides = sides.select("place", "host", (F.array_max("ranks") > PLAIN).alias("declared"), F.explode("lines").alias("x"))
    lines = staged(sides.select("place", "host", "declared", "x.*"), "shared-lines")
    cuts = staged(_frames(pages.where("host <> ''"), lines).groupBy("place").agg(F.collect_list("at").alias("cut")), "lines-cut")
    joined = pages.join(broadcast_within(cuts, F.size("cut") * 4 + 24), "place", "left")
    best = F.greatest(F.array_max("ranks"), F.lit(PLAIN))
    article = F.filter(
        F.arrays_zip("texts", "ranks", F.sequence(F.lit(0), F.size("texts")).alias("at")), lambda x: x["ranks"] >= F.col("best")
    )
    own = F.filter(F.col("article"), lambda x: ~F.coalesce(F.array_contains(F.col("cut"), x["at"]), F.lit(False)))
    joined = joined.withColumn("best", best).withColumn("article", article).withColumn("own", own)
    kept = F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("article"))
    text = F.array_join(F.transform(kept, lambda x: x["texts"]), " ")
    told = joined.select("row", text.alias("text"))
    return told.select(*[F.col("row").getField(c).alias(c) for c in columns], "text")


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
