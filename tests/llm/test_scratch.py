from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from conftest import TESTDATA
from geoingest.llm.common import scratch, staged, staged_by, staging_path
from geoingest.session import checkpoint_dir


def _files(spark) -> set[str]:
    return {str(p) for p in Path(checkpoint_dir(spark), "llm").rglob("*.parquet") if p.is_file()}


def _tables(spark) -> set[str]:
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("llm_")}


def test_staged_tables_go_with_their_scratch(spark, tmp_path):
    files, tables = _files(spark), _tables(spark)
    with scratch(spark) as outer:
        left = staged(spark.range(5), "left")
        with scratch(spark) as inner:
            assert inner.startswith(outer)
            both = left.join(staged_by(spark.range(3), "some-rows", "id"), "id")
            both.write.parquet(str(tmp_path / "both"))
            assert _tables(spark) > tables
        assert left.count() == 5 and _tables(spark) == tables
    assert _files(spark) == files and spark.read.parquet(str(tmp_path / "both")).count() == 3
    assert "scratch" not in staging_path(spark, "after")


def test_scratch_goes_when_its_block_fails(spark):
    files, tables = _files(spark), _tables(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        staged(spark.range(5), "left")
        staged_by(spark.range(3), "some-rows", "id")
        1 / 0
    assert _files(spark) == files and _tables(spark) == tables


def test_pipeline_leaves_its_result_only(spark):
    files, tables = _files(spark), _tables(spark)
    got = corpus_pipeline.run(spark, str(TESTDATA))
    assert got.count() > 0 and _tables(spark) == tables
    folders = {p.split("/llm/")[1].split("/")[0] for p in _files(spark) - files}
    assert {f.rsplit("-", 1)[0] for f in folders} == {"pipeline-sentencepiece"}
