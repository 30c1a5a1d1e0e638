"""Text conventions: truncation limits, error texts, packed diagnostics, stable ids, locator lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest text kept in each place, in characters.
TEXT_LIMIT = 50_000
TITLE_LIMIT = 200
DETAIL_LIMIT = 2_000
QUERY_ID_LIMIT = 120


def clip(c: Column, limit: int) -> Column:
    return F.substring(c, 1, limit)


def split_locators(value: Column) -> Column:
    """Inline locator list: a comma separates only in front of another http(s) link."""
    parts = F.transform(F.split(value, r",\s*(?=https?://)"), lambda p: F.trim(p))
    many = F.filter(parts, lambda p: p != "")
    return F.when(value.contains(","), many).otherwise(F.array(value))


def error_text(stage: str, kind: Column, message: Column) -> Column:
    """``stage: Type: message``."""
    return F.concat_ws(": ", F.lit(stage), kind, message)


def persist_error(sink: str, kind: Column, message: Column) -> Column:
    return error_text(f"persist[{sink}]", kind, message)


def pack_diag(diag: Column, prefix: Column | None = None) -> Column:
    """Diagnostics map as ``k=v|k=v``, behind ``prefix | `` when there is one."""
    packed = F.array_join(
        F.transform(
            F.map_entries(diag),
            lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("None"))),
        ),
        "|",
    )
    if prefix is None:
        return packed
    return F.when(F.coalesce(prefix, F.lit("")) == "", packed).otherwise(
        F.concat(prefix, F.lit(" | "), packed)
    )


def stable_id(locator: Column, prefix: str = "searxng", digits: int | None = None) -> Column:
    """Id that is the same in every run, so that a repeated query meets its own key.

    It holds the whole digest. With few ``digits`` (8 in older tables) different queries meet in one key.
    """
    digest = F.sha2(locator, 256)
    return F.concat(F.lit(f"{prefix}:0x"), digest if digits is None else F.left(digest, F.lit(digits)))


def retry_wait_s(attempt: Column, initial: float = 2.0, factor: float = 1.5) -> Column:
    """Seconds waited after a failed ``attempt`` (1, 2, ...)."""
    return F.lit(initial) * F.pow(F.lit(factor), attempt - 1)
