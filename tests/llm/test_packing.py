from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents
from tokenizers import Tokenizer

from staylens.llm import packing, tokens

TEXTS = [
    "", " ", "Hello, world! It's a test.", "a\x1cb c\x85d e", "we'll 've 'S l'aquila.'s", "x<|endoftext|>y <|startoftext|>",
    "\nfoo bar\nbaz ", " a\nb", "a\0b c", "<|ENDOFTEXT|> A", "H\u0331 \u1e96 E\u0301 \u00c9", "  a \n\n b\t\r\n ", "É é ΣΑΣ ß İ ﬁ ǅ", "foo's, bar''. x1.5 ³² 漢字,   z", "a.́b é ́x", "end  ", "a" * 3000, "don't " * 9,
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library_on_whole_texts(name):
    path = tokens.public_path(name)
    whole = Tokenizer.from_file(path)
    encoder = tokens.Encoder(path)
    for _ in range(2):
        for text, ids in zip(TEXTS, encoder.ids(TEXTS), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_cut():
    assert [packing.cut(n, 10) for n in (1, 10, 20, 23)] == [[(0, 1)], [(0, 10)], [(0, 10), (10, 10)], [(0, 3), (3, 10), (13, 10)]]


def test_best_fit_is_that_of_single_documents():
    rng = random.Random(0)
    for _ in range(200):
        capacity = rng.choice([1, 2, 10, 64, 1024])
        lengths = [min(capacity, rng.choice([1, 3, rng.randint(1, capacity)])) for _ in range(rng.randint(0, 200))]
        counts = Counter(lengths)
        placed, opened = packing.best_fit(dict(counts), capacity)
        inside = defaultdict(list)
        for length in counts:
            ranks = sorted(r for p in placed if p.length == length for r in range(p.rank, p.rank + p.count))
            assert ranks == list(range(counts[length]))
        for p in placed:
            for t in range(p.count):
                inside[p.sequence + t // p.each].append((p.offset + t % p.each * p.length, p.length))
        for parts in inside.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity
        gaps = []
        for length in sorted(lengths, reverse=True):
            fit = [g for g in gaps if g >= length]
            if fit:
                gaps.remove(min(fit))
            gaps.append((min(fit) if fit else capacity) - length)
        assert len(inside) == opened == len(gaps)


def test_packed_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["sun", "moon", "stars,"]) for _ in range(rng.choice([0, 3, 3, 3, 40, 700, 2500])))) for i in range(120)]
    rows += [(5, rows[5][1]), (None, "no id"), (500, None), (501, "")]
    got = packing.packed(documents(spark, rows, "1 AS length"), capacity=1024).collect()
    whole = Tokenizer.from_file(tokens.public_path(packing.TOKENIZER))
    want = []
    for doc, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for n, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            want.append((doc, n, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    inside = defaultdict(list)
    for r in got:
        inside[r.sequence_id].append((r.offset, r.length))
    for parts in inside.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= 1024
    assert len(inside) <= sum(r.length for r in got) / 1024 + 2


def test_sequences_hold_the_ids(spark):
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(60)]
    got = packing.sequences(documents(spark, rows), capacity=64).collect()
    assert all(len(r.ids) == 4 * r.length and r.length <= 64 for r in got)
    whole = Tokenizer.from_file(tokens.public_path(packing.TOKENIZER))
    want = Counter()
    for _, text in rows:
        want.update([*whole.encode(text, add_special_tokens=False).ids, 2])
    assert Counter(i for r in got for i in np.frombuffer(r.ids, "<u4").tolist()) == want


def test_empty_table(spark):
    assert packing.packed(documents(spark, [])).collect() == []
    assert packing.sequences(documents(spark, [])).collect() == []
