from __future__ import annotations

import random
from itertools import combinations

import pytest
import xxhash
from helpers import documents, smallest_reachable

from staylens.llm import simhash
from staylens.llm.graph import components

BASE = " ".join(f"word{i}" for i in range(60))


def plain_fingerprint(text: str) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


TEXTS = ["", " \t\n", "One", "one", "a b c", "a b c d", "a b c d e a b c d e", "É é x Ab", BASE, BASE.upper()]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_that_of_the_definition(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("width", [2, 3])
def test_any_four_shared_bytes_meet_under_a_key(width):
    keys = simhash.key_positions(width)
    for four in combinations(range(8), 4):
        assert any(set(k) <= set(four) for k in keys)


@pytest.mark.parametrize(("width", "cell"), [(2, 20_000), (3, 20_000), (2, 7), (3, 5)])
def test_links_and_components_match_brute_force(spark, width, cell):
    rng = random.Random(1)
    values = [0, (1 << 64) - 1]
    for _ in range(40):
        centre = rng.getrandbits(64)
        values.append(centre)
        for _ in range(rng.choice((0, 1, 12))):
            x = rng.choice(values[-5:])
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << bit
            values.append(x)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    want = smallest_reachable(values, lambda a, b: ((values[a] ^ values[b]) & ((1 << 64) - 1)).bit_count() <= 4)
    nodes = spark.createDataFrame([(v,) for v in values], "fp LONG")
    got = {r.node: r.root for r in components(simhash.links(nodes, 4, width, cell)).collect()}
    assert [got.get(v, v) for v in values] == want


def test_dense_group_is_found_without_its_pairs(spark):
    rng = random.Random(2)
    values = {0}
    while len(values) < 400:
        values.add(sum(1 << b for b in rng.sample(range(63), 2)))
    nodes = spark.createDataFrame([(v,) for v in values], "fp LONG")
    links = simhash.links(nodes, 4)
    assert links.count() < 8 * len(values) * 4
    roots = components(links).collect()
    assert {r.root for r in roots} == {0} and len(roots) == 399


def test_rows_nulls_copies_and_clashing_columns(spark):
    rows = [(5, BASE), (3, BASE), (3, BASE), (None, BASE), (9, None), (8, ""), (7, "alone here now"), (None, "no id")]
    df = documents(spark, rows, "1 AS fp")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    f = lambda t: f"{plain_fingerprint(t or ''):016x}"
    want = [(5, BASE, 3), (3, BASE, 3), (3, BASE, 3), (None, BASE, 3), (9, None, 8), (8, "", 8), (7, "alone here now", 7), (None, "no id", None)]
    assert got == sorted((str(i), f(t), c) for i, t, c in want)
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", BASE), ("8", ""), ("7", "alone here now"), ("None", "no id")]
    )


def test_empty_table(spark):
    df = documents(spark, [])
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.near_dedup(df).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)] + [(300, i) for i in range(250, 299)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (None, 3), (2, 1)], "a LONG, b LONG")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, **{i: 250 for i in [*range(251, 299), 300]}}
