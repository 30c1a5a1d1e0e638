"""Language identification by interpolated Kneser-Ney models over the characters of words.

One model per language, n-grams of up to ``ORDER`` characters that do not cross word boundaries, kept in
sorted arrays of 64-bit gram hashes. The language with the lowest cross-entropy per character wins;
a text is rejected when that cross-entropy is out of reach of what the model gives its own language.

Each batch gives a distinct word to the models once; a text's score is the sum over its words, so whole
texts of any length are read.

Defined results: a null or letterless text is ``und``, score 0, rejected; a tie goes to the smaller
language name; without any labelled row everything is ``und``; rows are never dropped or merged, so
repeated rows give repeated results; columns of the input stay, a result column replaces one of its name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.llm.common import packed, small_broadcast, staged, unpacked
from geoingest.llm.registry import query, table

ORDER = 4
#: Bound of the fit: labelled rows per language (expected number).
FIT_ROWS = 600
#: Every fourth of the fitted rows calibrates the scores and the rejection instead of the models.
CALIBRATION_PARTS = 4
#: Rejection: so many spreads above the calibrated mean cross-entropy, at least halfway to a uniform code.
REJECT_SPREADS = 8.0
#: Words a worker remembers with their scores, and how many it takes in hand at once.
MEMORY_WORDS = 200_000
TEXTS_AT_ONCE, WORDS_AT_ONCE = 400, 100_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = 2, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. Digits and signs that count as alphanumeric but are no letters are out."""
    if not text:
        return []
    found = _WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def _positions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all padded words, the offset of each within its word, and the words' lengths."""
    padded = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return points, np.arange(len(points)) - starts, lengths


def _hashes(points: np.ndarray) -> list[np.ndarray]:
    """For each length k up to ORDER, the hash of the k characters that end at each position."""
    out, power = [np.full(len(points), 1, dtype=np.uint64)], np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = (points + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        for k in range(1, ORDER + 1):
            shifted = np.concatenate([np.zeros(min(k - 1, len(points)), np.uint64), mixed[: max(len(points) - k + 1, 0)]])
            out.append(out[-1] + shifted * power)
            power = power * np.uint64(0xD6E8FEB86659FD93)
    return out


@dataclass
class Model:
    """One language: per length the sorted gram hashes with their discounted probabilities, and the contexts."""

    alphabet: int = 1
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def bits(self, grams: list[np.ndarray], contexts: list[np.ndarray], offset: np.ndarray) -> np.ndarray:
        """Code length in bits of the last character of each gram, ``offset`` characters into its word."""
        p = np.full(len(offset), 1.0 / (self.alphabet + 1))
        for k in range(1, ORDER + 1):
            own = _lookup(*self.grams[k - 1], grams[k], 0.0)
            rest = _lookup(*self.contexts[k - 1], contexts[k - 1], 1.0)
            p = np.where(offset >= k - 1, own + rest * p, p)
        return -np.log2(np.maximum(p, 1e-12))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def fit(words: dict[str, int]) -> Model:
    """Interpolated Kneser-Ney: raw counts at the full length and at word starts, else continuation counts."""
    model = Model()
    listed = sorted(words)
    points, offset, lengths = _positions(listed)
    weight = np.repeat(np.array([words[w] for w in listed], dtype=np.float64), lengths)
    hashes = _hashes(points)
    model.alphabet = len(np.unique(points))
    for k in range(1, ORDER + 1):
        # The start mark is never predicted. A gram that begins with it has no left neighbour to count.
        ends = np.flatnonzero((offset >= k - 1) & (offset >= 1))
        at_start = offset[ends] == k - 1
        gram, context = hashes[k][ends], hashes[k - 1][ends - 1] if k > 1 else hashes[0][ends]
        if k == ORDER:
            value = weight[ends]
        else:
            longer = hashes[k + 1][ends]
            first = np.zeros(len(ends))
            first[np.unique(longer, return_index=True)[1]] = 1.0
            value = np.where(at_start, weight[ends], first)
        keys, index, inverse = np.unique(gram, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=value, minlength=len(keys))
        seen = counts > 0
        keys, counts, of = keys[seen], counts[seen], context[index][seen]
        ones, twos = float((counts == 1).sum()), float((counts == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        heads, where = np.unique(of, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(heads))
        cut = np.minimum(counts, discount)
        model.grams.append((keys, (counts - cut) / total[where]))
        model.contexts.append((heads, np.bincount(where, weights=cut, minlength=len(heads)) / total))
    return model


@dataclass
class Identifier:
    """The models with what calibration found, and the words a worker has met."""

    langs: list[str]
    models: list[Model]
    sharpness: float = 0.2
    reach: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    memory: _Words | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": None}

    def word_bits(self, words: list[str]) -> np.ndarray:
        """Rows: words; columns: bits under each language, then the number of predicted characters."""
        points, offset, lengths = _positions(words)
        hashes = _hashes(points)
        first = np.cumsum(lengths) - lengths
        # A position's bits depend on its longest gram alone, so each distinct gram is looked up once.
        whole = hashes[ORDER].copy()
        for k in range(1, ORDER):
            whole = np.where(offset == k - 1, hashes[k] ^ np.uint64(k), whole)
        _, index, inverse = np.unique(whole, return_index=True, return_inverse=True)
        contexts = [hashes[0][index]] + [hashes[k][index - 1] for k in range(1, ORDER)]
        grams = [h[index] for h in hashes]
        predicted = (offset >= 1).astype(np.float64)
        columns = [
            np.add.reduceat(m.bits(grams, contexts, offset[index])[inverse] * predicted, first) for m in self.models
        ]
        return np.column_stack([*columns, lengths - 1.0])

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Per text: bits under each language, characters, words."""
        if self.memory is None:
            self.memory = _Words({}, np.zeros((1024, len(self.langs) + 1)))
        out = np.zeros((len(texts), len(self.langs) + 2))
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            tallies = [Counter(words_of(t.as_py())) for t in texts[at : at + TEXTS_AT_ONCE]]
            self.memory.add(self, tallies)
            for i, tally in enumerate(tallies, at):
                if tally:
                    rows = self.memory.bits[np.fromiter(map(self.memory.ids.__getitem__, tally), np.int64, len(tally))]
                    n = np.fromiter(tally.values(), np.float64, len(tally))
                    out[i, :-1], out[i, -1] = n @ rows, n.sum()
        return out

    def judge(self, totals: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each row of ``totals``."""
        n, known = len(totals), totals[:, -2] > 0
        if not self.langs or not n:
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, dtype=bool)
        chars = np.maximum(totals[:, -2], 1.0)
        entropy = totals[:, : len(self.langs)] / chars[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(n), best]
        # Evidence grows with the text, but the words of a text depend on each other.
        gap = (entropy - low[:, None]) * (self.sharpness * np.sqrt(chars))[:, None]
        score = 1.0 / np.exp2(-np.minimum(gap, 60.0)).sum(axis=1)
        limit = np.full(n, np.inf)
        for i, lang in enumerate(self.langs):
            if lang in self.reach:
                mean, spread, per_word = self.reach[lang]
                own = mean + REJECT_SPREADS * np.sqrt(spread**2 + per_word**2 / np.maximum(totals[:, -1], 1.0))
                halfway = (mean + math.log2(self.models[i].alphabet + 1)) / 2
                limit = np.where(best == i, np.maximum(own, halfway), limit)
        langs = [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
        return langs, np.where(known, score, 0.0), np.where(known, low, np.nan), ~known | (low > limit)


@dataclass
class _Words:
    """Words a worker has met, and their rows of :meth:`Identifier.word_bits`."""

    ids: dict[str, int]
    bits: np.ndarray

    def add(self, found: Identifier, tallies: list[Counter]) -> None:
        if len(self.ids) > MEMORY_WORDS:
            self.ids.clear()
        new = list({w: None for tally in tallies for w in tally if w not in self.ids})
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at : at + WORDS_AT_ONCE]
            n = len(self.ids)
            while n + len(part) > len(self.bits):
                self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)])
            self.bits[n : n + len(part)] = found.word_bits(part)
            self.ids.update(zip(part, range(n, n + len(part))))


def _shared(spark: SparkSession, found: Identifier) -> Callable[[], Identifier]:
    """Broadcast the models, which hold what ``FIT_ROWS`` texts per language have, to tasks that open them once each."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(found))
    kept: list[Identifier] = []

    def opened() -> Identifier:
        if not kept:
            kept.append(cloudpickle.loads(sent.value))
        return kept[0]

    return opened


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> Identifier:
    """Fit and calibrate on a sample of about ``FIT_ROWS`` rows per language, drawn by a hash of the key.

    Word counts are summed by Spark; the driver sees the distinct words of the sample, all of them, and one row of
    totals per calibration text. Each language has a text in the fit, however few it has.
    """
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(key_col), F.lit(7)).alias("h")
    ).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, FIT_ROWS / n))).otherwise(share)
    drawn = rows.where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)
    fold = F.pmod(F.shiftright("h", 32), F.lit(CALIBRATION_PARTS)) == 0
    # The text of a language with the least hash is never one that only calibrates.
    least = drawn.groupBy("lang").agg(F.min("h").alias("least"))
    drawn = drawn.join(small_broadcast(least), "lang").withColumn("fold", fold & (F.col("h") != F.col("least"))).drop("least")
    drawn = staged(drawn, "language-sample")

    def count_words(batches):
        for batch in batches:
            tallies: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                tallies.setdefault(lang, Counter()).update(words_of(text))
            flat = [(lang, w, n) for lang, tally in tallies.items() for w, n in tally.items()]
            langs, found, ns = zip(*flat) if flat else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.string()), pa.array(ns, pa.int64())], ["lang", "word", "n"]
            )

    summed = drawn.where("not fold").mapInArrow(count_words, "lang string, word string, n long")
    summed = summed.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by_lang: dict[str, dict[str, int]] = {}
    for r in summed.toLocalIterator():
        by_lang.setdefault(r["lang"], {})[r["word"]] = r["n"]
    langs = sorted(by_lang)
    found = Identifier(langs, [fit(by_lang[lang]) for lang in langs])
    if langs:
        _calibrate(spark, found, drawn.where("fold"))
    return found


def _calibrate(spark: SparkSession, found: Identifier, texts: DataFrame) -> None:
    """Reach of each language's own texts, and the sharpness with the best log loss."""
    opened = _shared(spark, found)

    def total(batches):
        for batch in batches:
            totals = opened().totals(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(totals.tolist(), pa.list_(pa.float64()))], ["lang", "totals"]
            )

    rows = [r for r in texts.mapInArrow(total, "lang string, totals array<double>").collect() if r["totals"][-2] > 0]
    rows = [r for r in rows if r["lang"] in found.langs]
    if not rows:
        return
    totals, truth = np.array([r["totals"] for r in rows]), np.array([found.langs.index(r["lang"]) for r in rows])
    for i, lang in enumerate(found.langs):
        own = totals[truth == i]
        if len(own) < 5:
            continue
        entropy = own[:, i] / own[:, -2]
        mean, deviation = np.median(entropy), entropy - np.median(entropy)
        # The spread of a long text, and what a single word adds to it.
        per_word = math.sqrt(float(np.median(deviation**2 * own[:, -1])) / 0.455)
        spread = max(float(np.sqrt(np.mean(np.minimum(deviation**2, 1.0)))), 0.05)
        found.reach[lang] = (float(mean), spread, max(per_word, 0.5))
    best = math.inf
    for sharpness in (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6):
        found.sharpness = sharpness
        chars = totals[:, -2]
        entropy = totals[:, : len(found.langs)] / chars[:, None]
        x = -(entropy - entropy.min(axis=1, keepdims=True)) * (sharpness * np.sqrt(chars))[:, None]
        p = np.exp2(np.maximum(x, -60.0))
        loss = -np.log(np.maximum((p / p.sum(axis=1, keepdims=True))[np.arange(len(rows)), truth], 1e-9)).mean()
        if loss < best - 1e-6:
            best, chosen = loss, sharpness
    found.sharpness = chosen


_RESULT = "struct<lang_pred: string, score: double, cross_entropy: double, rejected: boolean>"


def identify(df: DataFrame, found: Identifier, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (bits per character) and ``rejected``."""
    opened = _shared(df.sparkSession, found)

    @F.arrow_udf(_RESULT)
    def judged(texts: pa.Array) -> pa.Array:
        langs, score, entropy, rejected = opened().judge(opened().totals(texts))
        return pa.StructArray.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(entropy, pa.float64(), mask=np.isnan(entropy)),
                pa.array(rejected, pa.bool_()),
            ],
            ["lang_pred", "score", "cross_entropy", "rejected"],
        )

    rows = packed(df, text=F.col(f"`{text_col}`")).withColumn("found", judged("text"))
    names = ("lang_pred", "score", "cross_entropy", "rejected")
    return unpacked(rows, df.columns, **{n: F.col("found").getField(n) for n in names})


def held_out(key_col: str = "doc_id"):
    """The fourth of the rows no model may learn from; a row without a key is not held out, nor learned from."""
    part = F.pmod(F.crc32(F.col(key_col).cast("string").cast("binary")), F.lit(4))
    return F.coalesce(part == 2, F.lit(False))


def learn_from_documents(docs: DataFrame) -> Identifier:
    return learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = learn_from_documents(docs.select("doc_id", "text", "lang"))
    rows = identify(docs.select("doc_id", "text", held_out().alias("held_out")), found)
    return rows.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents whose language is rejected go."""
    found = learn_from_documents(docs)
    rows = packed(docs, text=F.col("text"))
    judged = identify(rows, found)
    return unpacked(judged.where("not rejected"), docs.columns)
