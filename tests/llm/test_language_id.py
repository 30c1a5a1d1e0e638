from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoingest.llm import language_id as op
from llm_helpers import documents, frame, plain, prose


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(i, prose(i, 40, lang), lang, "s", 0) for i, lang in enumerate(["en", "de"] * 60)]
    return op.learn(frame(spark, rows))


def slow_bits(words, word):
    """Interpolated Kneser-Ney by dictionaries of strings."""
    tables, alphabet = [], set()
    for k in range(1, op.ORDER + 1):
        counts, lefts = {}, {}
        for w, n in words.items():
            marked = f"\x02{w}\x03"
            alphabet |= set(marked)
            for e in range(max(k - 1, 1), len(marked)):
                gram = marked[e - k + 1 : e + 1]
                if k == op.ORDER or e == k - 1:
                    counts[gram] = counts.get(gram, 0) + n
                else:
                    lefts.setdefault(gram, set()).add(marked[e - k : e + 1])
        for gram, seen in lefts.items():
            counts[gram] = counts.get(gram, 0) + len(seen)
        ones, twos = list(counts.values()).count(1), list(counts.values()).count(2)
        tables.append((counts, ones / (ones + 2 * twos) if ones and twos else 0.5))
    bits, marked = 0.0, f"\x02{word}\x03"
    for e in range(1, len(marked)):
        p = 1 / (len(alphabet) + 1)
        for k, (counts, discount) in enumerate(tables, 1):
            if e < k - 1:
                break
            context = marked[e - k + 1 : e]
            same = {g: c for g, c in counts.items() if g[:-1] == context}
            if same:
                total = sum(same.values())
                own = same.get(context + marked[e], 0)
                p = max(own - min(own, discount), 0) / total + sum(min(c, discount) for c in same.values()) / total * p
        bits -= math.log2(p)
    return bits


def test_model_is_interpolated_kneser_ney():
    words = {"the": 9, "then": 3, "than": 2, "hat": 1, "tea": 4, "eat": 1, "a": 5}
    found = op.Identifier(["x"], [op.fit(words)])
    asked = ["the", "that", "zoo", "a", "hathen"]
    assert np.allclose(found.word_bits(asked)[:, 0], [slow_bits(words, w) for w in asked])
    assert found.word_bits(asked)[:, 1].tolist() == [len(w) + 1 for w in asked]


def test_languages_of_texts(spark, learned):
    rows = [(i, prose(500 + i, 12, lang), lang, "s", 0) for i, lang in enumerate(["en", "de"] * 20)]
    got = op.identify(frame(spark, rows), learned).collect()
    assert all(r["lang_pred"] == r["lang"] and not r["rejected"] and 0.5 < r["score"] <= 1 for r in got)


def test_no_letters_and_noise(spark, learned):
    texts = [None, "", " \n", "123 ½ ² __", "qzx jqv xkw zzqj wvx " * 30]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in op.identify(frame(spark, rows), learned).collect()}
    for i in range(4):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["cross_entropy"], got[i]["rejected"]) == ("und", 0.0, None, True)
    assert got[4]["lang_pred"] in ("en", "de") and got[4]["rejected"]


def test_memory_of_words_does_not_change_results(learned, monkeypatch):
    texts = pa.array([prose(i, 50) for i in range(30)])
    whole = learned.totals(texts)
    learned.memory = None
    monkeypatch.setattr(op, "MEMORY_WORDS", 3)
    monkeypatch.setattr(op, "TEXTS_AT_ONCE", 4)
    monkeypatch.setattr(op, "WORDS_AT_ONCE", 2)
    assert np.allclose(learned.totals(texts), whole)


def test_nothing_to_learn_from(spark):
    found = op.learn(frame(spark, []))
    got = op.identify(frame(spark), found).collect()
    assert len(got) == len(documents()) and {r["lang_pred"] for r in got} == {"und"}
    assert op.identify(frame(spark, []), found).count() == 0


def test_held_out_rows_teach_nothing(spark):
    """Other texts and languages in the held-out rows leave the models as they are."""
    import zlib

    rows = [(i, prose(i, 30, lang), lang, "s", 0) for i, lang in enumerate(["en", "de"] * 60)]
    out = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r["doc_id"] for r in frame(spark, rows).where(op.held_out()).collect()} == out and out
    changed = [(i, "zzz qqq xxx", "xx", "s", 0) if i in out else (i, *rest) for i, *rest in rows]
    one, other = (op.learn_from_documents(frame(spark, r)) for r in (rows, changed))
    assert one.langs == other.langs == ["de", "en"] and one.sharpness == other.sharpness and one.reach == other.reach
    asked = ["haus", "house", "zzz"]
    assert np.array_equal(one.word_bits(asked), other.word_bits(asked))


def test_held_out_accuracy_on_a_whole_table(spark):
    from geoingest.llm.registry import table

    got = op.op7_language_id(spark, "/root/testdata/sf0.01")
    truth = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    rows = got.where("held_out").join(truth, "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)


def test_all_words_of_the_sample_are_learned_and_each_language_has_a_text(spark):
    rows = [(i, " ".join(f"w{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"), "en", "s", 0) for i in range(8)]
    for k in range(40):
        rows.append((1000 + k, f"lonely{'abcdefghij'[k % 10]}{'klmn'[k // 10]} word", f"x{k}", "s", 0))
    found = op.learn(frame(spark, rows))
    assert found.langs == sorted({"en", *(f"x{k}" for k in range(40))})
    bits = found.word_bits(["wjt", "zzz"])
    assert bits[0, 0] < bits[1, 0]


def test_very_long_text(spark, learned):
    rows = [(1, prose(3, 60_000, "de"), None, None, 0), (2, "straße" * 50_000, None, None, 0)]
    got = {r["doc_id"]: r for r in op.identify(frame(spark, rows), learned).collect()}
    assert got[1]["lang_pred"] == "de" and not got[1]["rejected"] and got[2]["lang_pred"] == "de"


def test_clashing_columns_and_repeats(spark, learned):
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("row", "found", "score", "lang_pred")])
    got = op.identify(odd, learned)
    assert got.count() == len(documents()) and dict(got.dtypes)["score"] == "double"


def test_stage_keeps_clean_documents(spark):
    rows = [(i, prose(i, 30, lang), lang, "s", 0) for i, lang in enumerate(["en", "de"] * 60)] + [(900, None, "en", "s", 0), (901, "12", "en", "s", 0)]
    docs = frame(spark, rows)
    got = op.language_stage(spark, docs, "")
    assert got.columns == docs.columns and plain(got.select("doc_id")) == plain(docs.where("doc_id < 900").select("doc_id"))
