from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
from helpers import documents

from staylens.llm import secret_scan

KEY = "AKIA" + "Z9Q4" * 4
RANDOM = "kJ8s0PqL3xVb7TzNw5Yd2RmC"


def test_base_patterns():
    text = f'É password = "hunter2x" and API_KEY:abc; {KEY} 0123456789abcdef01234567f token=tokenvalue'
    got = secret_scan.base_spans(text)
    assert [(text[a:b], k) for a, b, k in sorted(got)] == [
        ('password = "hunter2x', "assign"),
        (KEY, "access"),
        ("0123456789abcdef01234567f", "hex"),
        ("token=tokenvalue", "assign"),
    ]


def test_failing_matches_use_up_their_text():
    # The first match takes "token=abcdefgh" as its value, as leftmost matches do.
    assert secret_scan.base_spans("password: token=abcdefgh") == [(0, 24, "assign")]
    assert secret_scan.base_spans("secret=abc token=abcde AKIASHORT " + "a1" * 11) == []
    assert secret_scan.base_spans("pasſword=abcdefgh toKen=abcdefgh") == []


def test_entropy_by_increments_is_that_of_the_counts():
    rng = random.Random(3)
    for _ in range(20):
        text = "".join(rng.choice("abcdeXYZ019") for _ in range(rng.randint(20, 80)))
        want = []
        for i in range(len(text) - 19):
            shares = [c / 20 for c in Counter(text[i : i + 20]).values()]
            want.append(-sum(p * math.log2(p) for p in shares))
        assert np.allclose(secret_scan.entropies(text, 20), want)


def test_high_entropy_is_found_and_words_are_not():
    assert [k for *_, k in secret_scan.entropy_spans(f"see {RANDOM} there")] == ["entropy_base64"]
    for clean in ("Donaudampfschifffahrtsgesellschaft", "thanthatwhichoneshtingonred", "2026-01-01-2027-02-03-2028", "----------------------------------", "550e8400-e29b-41d4-a716-446655440000", "a" * 5000):
        assert secret_scan.entropy_spans(clean) == []


def test_scan_rows(spark):
    text = f"x token=abcdefgh {KEY}"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "plain"), (4, "word " * 50_000 + text)]
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans): r.base_sha256 for r in secret_scan.scan(documents(spark, rows, "2 AS spans")).collect()}
    spans = "assign:2:16,access:17:37"
    digest = hashlib.sha256(spans.encode()).hexdigest()
    assert got[(1, 1, 1, 0, spans)] == digest
    assert {k[0] for k in got} == {1, 2, 3, 4, None}
    assert secret_scan.scan(documents(spark, [])).collect() == []


def test_redact(spark):
    rows = [(1, f"a {KEY} b {RANDOM}."), (2, None), (3, "clean text")]
    got = {r.doc_id: r.text for r in secret_scan.redact(documents(spark, rows, "1 AS at")).collect()}
    assert got == {1: "a [SECRET] b [SECRET].", 2: None, 3: "clean text"}
