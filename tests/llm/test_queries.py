from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle_check import check, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


@pytest.mark.parametrize("name", ["op1_exact_topk", "op7_benchmark_decontamination", "op11_merkle_manifest"])
def test_query_agrees_with_sql(spark, name):
    assert name in entry.oracle_sql()
    assert check(spark, connect(FOLDER), FOLDER, name) is None


@pytest.mark.parametrize("name", [n for n in entry.queries() if re.match(r"op\d+_", n)])
def test_every_query_covers_its_whole_table(spark, name):
    rows = entry.queries()[name](spark, FOLDER)
    found = rows.count()
    size = lambda t: spark.read.parquet(f"{FOLDER}/{t}.parquet").count()
    if name.startswith("op1_"):
        assert found == 20 * -(-size("embeddings") // 20)
    elif name.startswith("op10_"):
        assert rows.select("doc_id").distinct().count() == size("documents")
    else:
        assert found == size("pages" if name.startswith("op4_") else "documents")
