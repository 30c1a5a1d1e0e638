"""Spelling variants among the words of a corpus by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point makes them equal, that is if their common prefix
and their common suffix together reach the length of the longer one less one. Tiles of words lie as two padded
matrices of code points, aligned at the left and at the right; blocks of rows are compared with blocks of rows at
once, and what reaches that length is an edit.

Which words meet in a tile follows from the same rule: of a common prefix and suffix that together reach ``m - 1``, one
has ``m // 2`` code points or more. So each word is filed by its first and its last ``m // 2`` code points, for words of
``m`` as longer ones, and meets every near word. A file of more than ``TILE`` words is cut again, by the same rule, on
what lies behind the shared part, until the rest is one code point, where a file holds no more words than
the alphabet has letters; so no tile grows with the input, no word is left out, and no pair is compared but in tiles.

Defined results: a word that is near to none has no form and is its own root; ties go to the smaller word in
code-point order; a null text has no words; words of a null id are taken as they stand; an empty table gives an
empty result. Input columns other than text and id play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.llm.common import staged
from geoingest.llm.registry import query, table

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: One run in so many loses a letter; a form is this many times as frequent as the word.
ONE_IN, TIMES = 31, 10
#: Words of a tile and their letters that differ, numbers of a block comparison in hand at once, distinct words a task counts before it hands them on.
TILE, TILE_LETTERS, AT_ONCE, COUNTED = 1024, 1 << 22, 1 << 20, 200_000

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def words_of(doc_id: int | None, text: bytes) -> Iterator[tuple[str, int]]:
    """Distinct words of a text of at least ``LEAST_LETTERS``, and how often each occurs there."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if doc_id is not None and h % ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LETTERS:
            yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def given() -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())):
            for word, n in words_of(doc_id, text.as_py() or b""):
                counts[word] += n
            if len(counts) >= COUNTED:
                yield given()
                counts.clear()
    if counts:
        yield given()


def _matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, padded with zeros at the right."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i < j`` of the distinct words that differ by one edit."""
    order = np.argsort([len(w) for w in words], kind="stable")
    words = [words[i] for i in order]
    ends = [w[::-1] for w in words]
    size = np.array([len(w) for w in words])
    block = max(1, min(256, int((AT_ONCE // size[-1]) ** 0.5)))
    found = []
    for a in range(0, len(words), block):
        rows = slice(a, a + block)
        for b in range(a, len(words), block):
            if size[b] > size[min(a + block, len(words)) - 1] + 1:
                break
            others = slice(b, b + block)
            least = np.minimum(size[rows, None], size[None, others])
            shared = np.zeros_like(least)
            width = int(size[others][-1])
            for side in (words, ends):
                differs = _matrix(side[rows], width)[:, None, :] != _matrix(side[others], width)[None, :, :]
                first = differs.argmax(axis=2)
                shared += np.where(differs.any(axis=2), np.minimum(first, least), least)
            most = np.maximum(size[rows, None], size[None, others])
            near = (shared >= most - 1) & (most - least <= 1)
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            found.append(np.stack([order[i], order[j]])[:, i < j])
    i, j = np.concatenate(found, axis=1)
    return np.minimum(i, j), np.maximum(i, j)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, word, n`` in order of key to near pairs; a tile may span batches."""
    names = ["a", "a_n", "b", "b_n"]
    last, words, counts = None, [], []
    out: list[tuple] = []

    def given() -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * 4
        kinds = [pa.string(), pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def compare() -> None:
        if len(words) > 1:
            for pair in zip(*near_pairs(words)):
                i, j = sorted(pair, key=words.__getitem__)
                out.append((words[i], counts[i], words[j], counts[j]))

    for batch in batches:
        for key, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n"))):
            if key != last:
                compare()
                last, words, counts = key, [], []
            words.append(word)
            counts.append(n)
            if len(out) >= 50_000:
                yield given()
                out.clear()
    compare()
    yield given()


def _cut(df: DataFrame, key: Column, half: Column) -> DataFrame:
    """Each row filed by the first and by the last ``half`` code points of the rest ``[from, to)`` of its word."""
    head = F.substring(F.col("word"), F.col("from") + 1, half)
    tail = F.substring(F.col("word"), F.col("to") - half + 1, half)
    ways = F.array(
        F.struct(F.xxhash64(key, F.lit("first"), head).alias("key"), (F.col("from") + half).alias("from"), F.col("to").alias("to")),
        F.struct(F.xxhash64(key, F.lit("last"), tail).alias("key"), F.col("from").alias("from"), (F.col("to") - half).alias("to")),
    )
    cut = df.withColumn("way", F.explode(ways)).withColumn("rest", F.col("rest") - half)
    return cut.select("word", "n", "rest", "way.*")


def tiles(words: DataFrame) -> DataFrame:
    """``key, word, n`` of the tiles: files of two to ``TILE`` words in which every two near words of ``words(word, n)`` meet."""
    size = F.length("word")
    # As the longer word of a pair, and as the shorter; "rest" is what the longer word has left.
    filed = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("rest"), F.lit(0).alias("from"), size.alias("to"))
    filed = staged(_cut(filed, F.col("rest"), F.floor(F.col("rest") / 2).cast("int")), "spelling-files")
    done: DataFrame | None = None
    while True:
        sizes = filed.groupBy("key").agg(F.count("*").alias("members"), F.max("rest").alias("left")).where("members > 1")
        large = (F.col("left") > 1) & ((F.col("members") > TILE) | (F.col("members") * F.col("left") > TILE_LETTERS))
        sizes = staged(sizes.select("key", large.alias("large")), "spelling-sizes")
        sized = filed.join(sizes, "key")
        small = sized.where("NOT large").select("key", "word", "n")
        done = small if done is None else done.unionByName(small)
        if not sizes.where("large").limit(1).count():
            return done
        wide = sized.where("large").drop("large")
        filed = staged(_cut(wide, F.col("key"), F.floor(F.col("rest") / 2).cast("int")), "spelling-files")


def spelling_variants(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Words of all texts with their count ``n``, ``form``, ``root``, ``n_near`` and ``form_n``."""
    runs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    counts = runs.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = staged(counts.where(f"n >= {LEAST_COUNT}"), "spelling-words")
    dealt = tiles(words).repartition("key").sortWithinPartitions("key")
    # A pair that shares both halves meets in two tiles.
    pairs = dealt.mapInArrow(_tiles, "a string, a_n long, b string, b_n long").distinct()
    pairs = staged(pairs, "spelling-pairs")
    near = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    near = near.unionByName(pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
    form = F.when(-F.col("best.col1") >= TIMES * F.col("n"), F.col("best.other"))
    best = staged(best.select("word", "n_near", form.alias("form"), (-F.col("best.col1")).alias("form_n")), "spelling-near")
    forms = best.where("form IS NOT NULL").select("word", "form")
    found = words.join(best, "word", "left").join(roots(forms), "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last, by doubling the way.

    Each form is ``TIMES`` times as frequent as its word, so no way is longer than a count has digits.
    """
    at = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = staged(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")
        at = at.drop("moved")


#: CRC-32 of the text ``x`` in SQL: the table of a byte's remainders follows from the polynomial.
CRC_TABLE = """SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) AS r(i))"""
CRC_OF = """xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(1, octet_length(encode({x})) + 1), lambda i: ('0x' || hex(encode({x}))[2 * i - 1:2 * i])::BIGINT)),
            lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])))"""


@query(
    f"""
    WITH crc AS ({CRC_TABLE}),
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents),
    each AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS x FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
    hashed AS (SELECT doc_id, run, n, {CRC_OF.format(x="x")} AS h FROM each, crc),
    cut AS (
        SELECT CASE WHEN h % 31 = 0 AND doc_id IS NOT NULL THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    holes AS (
        SELECT word, n, unnest(range(1, length(word) + 1)) AS p,
               unnest(list_transform(range(1, length(word) + 1), lambda i: substring(word, 1, i - 1) || substring(word, i + 1))) AS hole
        FROM words),
    near AS (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.p = b.p AND a.hole = b.hole AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.hole = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.hole = b.word),
    best AS (
        SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word, n),
    forms AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE other_n >= 10 * n),
    way AS (
        WITH RECURSIVE way(word, root) AS (SELECT word, form FROM forms UNION ALL SELECT way.word, forms.form FROM way JOIN forms ON way.root = forms.word)
        SELECT way.word, way.root FROM way LEFT JOIN forms ON way.root = forms.word WHERE forms.word IS NULL)
    SELECT words.word, form, coalesce(root, words.word) AS root, words.n, coalesce(n_near, 0) AS n_near, form_n
    FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN way USING (word)
    """
)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
