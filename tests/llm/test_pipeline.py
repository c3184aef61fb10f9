from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


def test_stages_pass_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name == "best-fit packing":
            assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
            assert out.select("doc_id").distinct().count() == before
            break
        assert out.columns == columns
        docs = out.cache()
        assert 0 < docs.count() <= before
        before = docs.count()


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


def test_empty_documents_pass_through(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
