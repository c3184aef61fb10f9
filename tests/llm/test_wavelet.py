from __future__ import annotations

import zlib

import numpy as np
import pytest
from helpers import documents
from tokenizers import Tokenizer

from staylens.llm import tokens, wavelet
from staylens.session import work_path


@pytest.mark.parametrize(("n", "most"), [(0, 1), (1, 1), (5, 2), (511, 300), (513, 49_408), (3000, 70_000)])
def test_round_trip_access_count_and_locate(n, most):
    rng = np.random.default_rng(n)
    ids = (most * rng.random(n) ** 3).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.build(ids)
    assert np.array_equal(matrix.decode(), ids)
    for at in rng.integers(0, n, 30).tolist() if n else []:
        token = int(ids[at])
        places = np.flatnonzero(ids == token)
        assert matrix.access(at) == token
        assert matrix.count(token) == len(places) and matrix.count(token, at) == (places >= at).sum()
        nth = int(rng.integers(len(places)))
        assert matrix.locate(token, nth) == places[nth]
    assert matrix.count(1 << 30) == 0
    for call in (lambda: matrix.access(n), lambda: matrix.locate(most + 1, 0)):
        with pytest.raises(IndexError):
            call()


def test_files_hold_the_documents(spark):
    rows = [(i * 7 % 50, f"Some words, number {i}; and more é " * (i % 6)) for i in range(50)]
    rows += [rows[3], (60, None), (61, ""), (None, "without an id"), (62, "long " * 30_000)]
    folder = work_path(spark, "test_shards")
    wavelet.write_shards(documents(spark, rows, "1 AS start"), folder, shard_tokens=100)
    shards = wavelet.read_shards(spark, folder)
    assert shards.count() > 5
    got = wavelet.read_documents(shards).collect()
    whole = Tokenizer.from_file(tokens.public_path(wavelet.TOKENIZER))
    want, start, every = [], 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
        every += ids
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=lambda r: r[1]) == want
    counted = {r.token: r.n for r in wavelet.token_counts(shards, [1, every[0], 40_000]).collect()}
    assert counted == {t: every.count(t) for t in (1, every[0], 40_000)}


def test_empty_table(spark):
    folder = work_path(spark, "test_shards")
    wavelet.write_shards(documents(spark, []), folder)
    assert wavelet.read_documents(wavelet.read_shards(spark, folder)).collect() == []
