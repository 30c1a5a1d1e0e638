"""Documents with every awkward case, and rows as plain values."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and of thing tion with that over water house small other".split(),
    "de": "der die und nicht für schön über straße haus auch ein mit".split(),
}


def prose(seed: int, n: int = 60, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ".", ","]) for _ in range(n))


def documents(n: int = 40) -> list[tuple]:
    """Null, empty, blank, very long, repeated, equal and nearly equal texts; null ids, languages and sources."""
    rows = []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, prose(i, 30 + i, lang), lang, f"src{i % 20}"))
    base = prose(1000, 400)
    rows += [(100, base, "en", "src0"), (101, "  " + base + "\n", "en", "src0"), (102, base.replace(" ", "\t"), "en", "src1")]
    rows += [(103, base + " end", "en", "src2"), (104, base.upper(), "en", "src2")]
    rows += [(110, None, "en", "src3"), (111, "", None, "src3"), (112, " \t\n", "de", None), (113, "1234 !?", None, None)]
    rows += [(120, prose(7, 20_000), "en", "src4"), (121, "x" * 200_000, None, "odd"), (122, "é" * 3 + " ▁ \x00 😀 a  b ", "en", "src5")]
    rows += [(130, "same row", "en", "src6")] * 3 + [(None, "no id", "en", "src7"), (None, None, None, None)]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS)


def plain(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
