from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import documents

from staylens.llm import language_model as lm


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def corpus(n=150, seed=0):
    rng = random.Random(seed)
    follow = {w: [f"w{rng.randrange(60)}" for _ in range(3)] for w in [f"w{i}" for i in range(60)]}
    rows = []
    for i in range(n):
        w, text = f"w{rng.randrange(60)}", []
        for _ in range(rng.randint(0, 80)):
            text.append(w)
            w = rng.choice(follow[w])
        rows.append((i, " ".join(text).title()))
    return rows


def test_base_scores_and_counts(spark):
    rows = corpus() + [(900, None), (901, ""), (902, "Never seen É"), (None, "w1 w2"), (3, "w1\x1cw2 w3 \tw4")]
    got = lm.scored(documents(spark, rows, "1 AS block"), block_bytes=3000, rounds=1).collect()
    counts = Counter()
    for doc, text in rows:
        if not held_out(doc):
            counts.update(words(text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for doc, text in rows:
        ws = words(text)
        want.append((str(doc), held_out(doc), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)))
    assert sorted((str(r.doc_id), *tuple(r)[1:5], round(r.base_score, 6)) for r in got) == sorted(want)


def test_model_beats_unigrams_on_held_out_texts(spark):
    rows = corpus(600, 2)
    got = lm.scored(documents(spark, rows)).filter("held_out").collect()
    assert len(got) > 50
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.9


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    weights = lm.Weights(*(rng.normal(size=(lm.ROWS, k)).astype(np.float32) for k in (lm.CLASSES, lm.SLOTS)))
    features = np.repeat(lm.contexts(np.array([5, 900, 31]), np.array([3]))[2:], lm.CLASSES * lm.SLOTS, axis=0)
    every = np.arange(lm.CLASSES * lm.SLOTS)
    assert abs(np.exp(lm.log_probabilities(weights, features, every)).sum() - 1) < 1e-4


def test_contexts_stay_in_their_text():
    a = lm.contexts(np.array([1, 2, 3]), np.array([3]))
    b = lm.contexts(np.array([9, 9, 1, 2, 3, 7]), np.array([2, 3, 1]))
    assert np.array_equal(a, b[2:5])


def test_tables_without_training_texts(spark):
    assert lm.scored(documents(spark, [])).collect() == []
    only = next(i for i in range(100) if held_out(i))
    (row,) = lm.scored(documents(spark, [(only, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.score < 0
