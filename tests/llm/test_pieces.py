from __future__ import annotations

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.llm import pieces as op
from llm_helpers import documents, frame

MODEL = op.default_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\t\na.eé世😀 ​"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_chunks_give_the_ids_of_the_whole(text):
    ids = [i for one in op.segment(MODEL, op.chunks_of(text)) for i in one]
    assert ids == LIBRARY.encode(text)


@pytest.mark.parametrize("block_rows,at_once,chunks", [(20_000, 2_000_000, 1_000_000), (3, 8, 5)])
def test_ids_and_texts(spark, monkeypatch, block_rows, at_once, chunks):
    monkeypatch.setattr(op, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(op, "IDS_AT_ONCE", at_once)
    monkeypatch.setattr(op, "OWNER_CHUNKS", chunks)
    got = op.encode_and_decode(frame(spark).repartition(3), MODEL).collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in got) == sorted(repr((r[0], r[1])) for r in documents())
    for r in got:
        ids = LIBRARY.encode(r["text"] or "")
        assert r["ids"] == ids and r["decoded"] == LIBRARY.decode(ids)


def test_packing():
    arrays = [np.arange(5, dtype=np.int32), np.zeros(0, np.int32), np.array([7, 2**31 - 1], np.int32)]
    assert [a.tolist() for a in op._unpack(op._pack(*arrays))] == [a.tolist() for a in arrays]


def test_empty_and_clashing_columns(spark):
    assert op.encode_and_decode(frame(spark, []), MODEL).count() == 0
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("ids", "row", "rows", "block", "owner", "kind", "body")])
    got = op.encode_and_decode(odd, MODEL)
    assert got.count() == len(documents()) and dict(got.dtypes)["ids"] == "array<int>" and "owner" in got.columns


def test_models_whose_pieces_cross_markers_are_refused(monkeypatch):
    class Crossing:
        def __init__(self, model_file):
            pass

        def vocab_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    monkeypatch.setattr(op.sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError):
        op.model("another")
