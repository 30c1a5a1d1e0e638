"""Landed HTML pages as records."""

from __future__ import annotations

import codecs
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.functions.expr import compute_once, json_string
from geoingest.functions.html import html_text, html_title, text_or_null
from geoingest.functions.text import TEXT_LIMIT
from geoingest.sources.record import to_raw_records


# The executors get these functions by value, they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def body_text(df: DataFrame, column: str) -> Column:
    """Body as text; bytes are read as UTF-8 with replacement characters, so no byte ends a job."""
    c = F.col(column)
    return F.make_valid_utf8(c.cast("string")) if dict(df.dtypes)[column] == "binary" else c


def declared_charset(df: DataFrame, column: str) -> Column:
    """Encoding that a byte order mark, the content type or the page itself, wherever, declares first; null if none does."""
    page = F.make_valid_utf8(F.col(column).cast("string"))
    mark = F.hex(F.substring(F.col(column), 1, 3))
    by_mark = (
        F.when(mark == "EFBBBF", "utf-8-sig").when(mark.startswith("FFFE"), "utf-16").when(mark.startswith("FEFF"), "utf-16")
    )
    headers = optional(df, "headers", "map<string,string>")
    types = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == "content-type")
    by_header = F.regexp_extract(F.get(types, F.lit(0))["value"], r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", 1)
    by_page = F.regexp_extract(page, r"(?is)<meta[^>]*charset\s*=\s*[\"']?\s*([A-Za-z0-9._:-]+)", 1)
    return F.lower(F.coalesce(by_mark, F.nullif(by_header, F.lit("")), F.nullif(by_page, F.lit(""))))


@F.arrow_udf(T.StringType())
def _decoded(bodies: pa.Array, charsets: pa.Array) -> pa.Array:
    def text(body: bytes | None, charset: str | None) -> str | None:
        if body is None:
            return None
        try:
            name = codecs.lookup(charset or "utf-8").name
        except LookupError:
            name = "utf-8"
        # Pages that name Latin-1 or ASCII are read as its superset, as browsers do.
        name = "cp1252" if name in ("iso8859-1", "ascii") else name
        try:
            return body.decode(name, "replace")
        except (LookupError, UnicodeError, AttributeError):
            return body.decode("utf-8", "replace")

    return pa.array(map(text, bodies.to_pylist(), charsets.to_pylist()), pa.string())


def page_text(df: DataFrame, column: str) -> Column:
    """Body of a page as text, in the encoding it declares. Only bodies that declare another than UTF-8
    leave the JVM, batch by batch."""
    if dict(df.dtypes)[column] != "binary":
        return F.col(column)
    charset = declared_charset(df, column)
    other = charset.isNotNull() & ~charset.isin("utf-8", "utf8")
    decoded = _decoded(F.when(other, F.col(column)), F.when(other, charset))
    return F.coalesce(decoded, body_text(df, column))


def optional(df: DataFrame, column: str, kind: str) -> Column:
    return (F.col(column) if column in df.columns else F.lit(None)).cast(kind)


def html_records(
    pages: DataFrame,
    *,
    url: str = "url",
    body: str = "body",
    keep_failed: bool = False,
    text_limit: int | None = TEXT_LIMIT,
) -> DataFrame:
    """One record per page, kept also when it yields no title or text; ``text_limit=None`` keeps whole texts."""
    page, link = F.col("_page"), F.col(url)
    pages = compute_once(pages, "_page", page_text(pages, body))
    return to_raw_records(
        pages,
        source="html",
        source_id=link,
        raw=json_string(
            F.struct(
                html_title(page).alias("title"),
                page.alias("body"),
                optional(pages, "headers", "map<string,string>").alias("headers"),
                optional(pages, "strategy", "string").alias("strategy"),
            )
        ),
        raw_ref=link,
        locator=link,
        ok=F.lit(True),
        text=text_or_null(html_text(page), text_limit),
        keep_failed=keep_failed,
    )
