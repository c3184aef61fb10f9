from __future__ import annotations

import random

import numpy as np
from helpers import documents

from staylens.llm import quality

WORDS = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("n", "r", "st", "m")]


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    rows, bad = [], {}
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(30, 150))]
        kind = rng.choice(["good"] * 6 + ["symbols", "shout", "repeat", "abuse"])
        if kind == "symbols":
            words = [w + "###" for w in words]
        elif kind == "shout":
            words = [w.upper() + "!!" for w in words]
        elif kind == "repeat":
            words = [words[0]] * len(words)
        elif kind == "abuse":
            words[5:5] = ["worthless", "scum"]
        rows.append((i, " ".join(words) + "."))
        bad[i] = kind != "good"
    return rows, bad


def test_labels_and_votes_find_bad_documents_and_keep_good_ones(spark):
    rows, bad = corpus()
    labels = spark.createDataFrame([(i, int(not bad[i]), 0) for i in range(0, 200)], "doc_id LONG, quality INT, toxic INT")
    model = quality.fit(documents(spark, rows), labels)
    held = [r for r in quality.score(documents(spark, rows, "1 AS votes"), model).collect() if r.doc_id >= 200]
    kept_good = np.mean([r.keep for r in held if not bad[r.doc_id]])
    kept_bad = np.mean([r.keep for r in held if bad[r.doc_id]])
    assert kept_good > 0.97 and kept_bad < 0.1
    assert model.tables["symbols"][1, quality.BAD] > model.tables["symbols"][0, quality.BAD]


def test_votes_alone_suffice(spark):
    rows, bad = corpus(seed=3)
    model = quality.fit(documents(spark, rows))
    found = quality.score(documents(spark, rows), model).collect()
    assert np.mean([r.keep != bad[r.doc_id] for r in found]) > 0.95


def test_expectation_maximisation_recovers_planted_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = [0.9, 0.8, 0.7, 0.85]
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth) + 1 for a in right] + [np.zeros(len(truth), int)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, tables, _ = quality.maximise(patterns, counts.astype(float), rounds=500)
    assert abs(share - 0.3) < 0.03
    for j, a in enumerate(right):
        assert abs(tables[j, 1, 2] - a) < 0.04 and abs(tables[j, 0, 1] - a) < 0.04


def test_nulls_empty_long_repeated_and_clashing(spark):
    rows, _ = corpus(60)
    rows += [(1000, None), (1001, ""), (1002, "..."), (None, rows[0][1]), (3, rows[3][1]), (1003, "ban " * 40_000)]
    df = documents(spark, rows, "true AS keep")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, None)], "doc_id LONG, quality INT, toxic INT")
    model = quality.fit(df, labels)
    got = quality.score(df, model)
    assert got.count() == len(rows)
    assert {r.doc_id: r.keep for r in got.filter("doc_id BETWEEN 1000 AND 1002").collect()} == {1000: False, 1001: False, 1002: False}
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == got.filter("keep").count()


def test_empty_tables(spark):
    df = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    model = quality.fit(df, labels)
    assert quality.score(df, model).collect() == [] and quality.keep_good(df, model).collect() == []
