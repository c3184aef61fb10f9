"""The SimHash index behind the pipeline's near-dedup stage, against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import documents
from test_near_copies import planted

from staylens.llm import near_copies


def brute_fingerprint(hashes):
    """Bit by bit, with whole numbers of Python."""
    rows = [near_copies._mixed(np.array([h], dtype=np.uint64))[0].tolist() for h in hashes]
    bits = [2 * sum(column) + column[0] > len(hashes) for column in zip(*rows, strict=True)]
    return np.packbits(bits).tobytes()


@pytest.mark.parametrize("n", [1, 2, 9, 255, 256, 700])
def test_fingerprint_is_the_majority_of_the_hashes(n):
    found = np.unique(np.random.default_rng(n).integers(1 << 63, size=n, dtype=np.uint64))
    assert near_copies.fingerprint(found) == brute_fingerprint(found.tolist())
    assert near_copies.fingerprint(found[:0]) is None


def test_bits_differ_as_the_texts_do():
    rng = np.random.default_rng(7)
    for _ in range(20):
        x = rng.integers(1 << 63, size=450, dtype=np.uint64)
        a, b, c = np.sort(x[:400]), np.sort(x[50:]), np.sort(rng.integers(1 << 63, size=400, dtype=np.uint64))
        one, near_one, other = (np.frombuffer(near_copies.fingerprint(v), dtype=np.uint64) for v in (a, b, c))
        bits = 64 * len(one)
        # 350 of 450 shingles are shared: cosine 0.875, angle 0.16 of pi.
        assert 0.12 < np.bitwise_count(one ^ near_one).sum() / bits < 0.21
        assert 0.45 < np.bitwise_count(one ^ other).sum() / bits < 0.55


def test_candidates_are_groups_of_close_fingerprints(spark):
    """A pair is linked if a pair of bytes and all but ``BITS`` of the other bits agree; nothing else is."""
    texts = planted()
    found = near_copies.signatures(documents(spark, enumerate(texts)), "doc_id", "text", near_copies.WORDS)
    fps = {r.node: np.frombuffer(r.fp, dtype=np.uint8) for r in found.collect()}
    index = {n: i for i, n in enumerate(sorted(fps))}
    root = list(range(len(index)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    cut = 2 * near_copies.PAIRS
    for x in index:
        for y in index:
            meet = (fps[x][:cut].reshape(-1, 2) == fps[y][:cut].reshape(-1, 2)).all(axis=1).any()
            if x < y and meet and np.bitwise_count(fps[x][cut:] ^ fps[y][cut:]).sum() <= near_copies.BITS:
                i, j = top(index[x]), top(index[y])
                root[max(i, j)] = min(i, j)
    names = sorted(index)
    sizes = [top(i) for i in range(len(names))]
    want = {(n, names[top(i)]) for n, i in index.items() if sizes.count(top(i)) > 1}
    nodes = found.dropDuplicates(["node"])
    assert {tuple(r) for r in near_copies.candidates(nodes).collect()} == want
    assert want
