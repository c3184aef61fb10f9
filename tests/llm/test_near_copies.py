from __future__ import annotations

import random

import pytest
from helpers import documents, smallest_reachable

from staylens.llm import near_copies

BASE = " ".join(f"word{i}" for i in range(60))


def plain(text):
    ws = (text or "").lower().split()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def near(x, y):
    a, b = plain(x), plain(y)
    return a == b or (bool(a & b) and 5 * len(a & b) >= 4 * len(a | b))


def planted():
    """Texts, copies of them with a few words changed, copies of copies, and unlike texts with shared halves."""
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        ws = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(ws))
        for _ in range(rng.randint(0, 4)):
            ws = list(ws)
            for _ in range(rng.randint(0, max(1, len(ws) // 50))):
                ws[rng.randrange(len(ws))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(ws))
        texts.append(" ".join(ws[: len(ws) // 2] + [f"o{rng.randrange(10**6)}" for _ in range(len(ws) // 2)]))
    return texts


@pytest.mark.parametrize("cell", [near_copies.CELL, 2])
def test_planted_copies_with_a_few_words_changed(spark, cell):
    texts = planted()
    ids = list(range(len(texts)))
    want = set(smallest_reachable(ids, lambda a, b: near(texts[a], texts[b])))
    assert len(want) < len(texts) - 20
    kept = near_copies.near_dedup(documents(spark, zip(ids, texts, strict=True)), cell=cell)
    assert {r.doc_id for r in kept.collect()} == want


def test_the_stage_of_the_pipeline_finds_them(spark):
    import corpus_pipeline

    changed = BASE.split()
    changed[30] = "other"  # five of 56 shingles differ: 51 / 61 = 0.84
    few = " ".join([*BASE.split()[:52], *(f"z{i}" for i in range(8))])  # 48 / 64 = 0.75
    rows = [(1, BASE), (2, " ".join(changed)), (3, few), (4, BASE)]
    kept = corpus_pipeline.one_of_each(spark, documents(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == {1, 3}


def test_rows_nulls_copies_and_clashing_columns(spark):
    rows = [(5, BASE), (3, BASE), (3, BASE), (None, BASE), (9, None), (8, ""), (7, "alone here now"), (None, "no id")]
    df = documents(spark, rows, "1 AS node")
    kept = near_copies.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", BASE), ("8", ""), ("7", "alone here now"), ("None", "no id")]
    )
    assert near_copies.near_dedup(documents(spark, [])).collect() == []
