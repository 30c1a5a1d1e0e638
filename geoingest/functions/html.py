"""Title and visible text of an HTML page as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.expr import non_empty

# Marks the border between two text nodes; it is no legal character of an HTML page.
_BREAK = "\u0001"
_EDGE_SPACE = r"(?U)^[\s ]+|[\s ]+$"
# Elements whose content is not page text.
_HIDDEN = r"(?is)<(script|style|template|rt|rp)\b[^>]*>.*?(?:</\1\s*>|\z)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
# A quote opens a value only behind an equals sign, elsewhere it is an ordinary character.
_TAG = r"""</?[A-Za-z](?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>|<[/!?][^>]*>"""
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _named_entities() -> Column:
    entries = {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'"}
    return F.create_map(*[F.lit(x) for kv in sorted(entries.items()) for x in kv])


def _code_point(number: Column) -> Column:
    usable = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(usable, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(
        F.lit("�")
    )


def unescape_entities(text: Column) -> Column:
    """Replace character references once; what a replacement yields is not read again."""
    names = _named_entities()

    def piece(p: Column, i: Column) -> Column:
        ref = F.regexp_extract(p, _ENTITY, 1)
        tail = F.substr(p, F.length(ref) + 2)
        number = F.when(
            F.lower(F.left(ref, F.lit(2))) == "#x",
            F.conv(F.substr(ref, F.lit(3)), 16, 10).cast("bigint"),
        ).otherwise(F.substr(ref, F.lit(2)).try_cast("bigint"))
        char = F.when(ref.startswith("#"), _code_point(number)).otherwise(
            F.try_element_at(names, ref)
        )
        return (
            F.when(i == 0, p)
            .when((ref == "") | char.isNull(), F.concat(F.lit("&"), p))
            .otherwise(F.concat(char, tail))
        )

    decoded = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def _visible(html: Column) -> Column:
    """Markup without comments and without elements whose content is no text."""
    c = F.translate(F.coalesce(html, F.lit("")), _BREAK, "")
    return F.regexp_replace(F.regexp_replace(c, _COMMENT, _BREAK), _HIDDEN, _BREAK)


def html_title(html: Column) -> Column:
    """Stripped text of the first title, ``''`` without one."""
    inner = F.regexp_extract(_visible(html), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return F.regexp_replace(unescape_entities(inner), _EDGE_SPACE, "")


def html_text(html: Column) -> Column:
    """Text nodes, each stripped, blank ones dropped, joined by newlines.

    Scripts, styles, templates, ruby annotations, comments and declarations are no text. This reads
    markup by pattern, so unlike a document parser it does not repair broken markup.
    """
    marked = F.regexp_replace(_visible(html), _TAG, _BREAK)
    nodes = F.transform(
        F.split(marked, _BREAK), lambda n: F.regexp_replace(unescape_entities(n), _EDGE_SPACE, "")
    )
    return F.array_join(F.filter(nodes, lambda n: n != ""), "\n")


def text_or_null(text: Column, limit: int | None) -> Column:
    return non_empty(text if limit is None else F.substring(text, 1, limit))
