from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from helpers import DOCS
from pyspark.sql import functions as F

from staylens.llm import manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def way(levels, at):
    for level in levels[:-1]:
        run = level[at // 3 * 3 : at // 3 * 3 + 3]
        yield "".join(run[: at % 3]), "".join(run[at % 3 + 1 :])
        at //= 3


def brute(rows, shown=lambda row: row):
    """The contract row by row: ``(doc_id, leaf, subroot, root, proof, folded_root, verified)``."""
    by_source = defaultdict(list)
    for doc, text, lang, source, n in rows:
        leaf = h(*map(said, (doc, source, lang, n, text)))
        doc2, text2, lang2, source2, n2 = shown((doc, text, lang, source, n))
        by_source[source].append((doc is not None, doc or 0, leaf, doc, h(*map(said, (doc2, source2, lang2, n2, text2)))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order]
    over = tree([t[-1][0] for t in trees])
    root, result = over[-1][0], []
    for at, (source, own) in enumerate(zip(order, trees, strict=True)):
        for i, (_, _, leaf, doc, node) in enumerate(sorted(by_source[source], key=lambda x: x[:3])):
            proof = ""
            for before, after in [*way(own, i), *way(over, at)]:
                proof += before + after
                node = h(before, node, after)
            result.append((doc, leaf, own[-1][0], root, proof, node, node == root))
    return result


def table(spark, rows, extra=()):
    return spark.createDataFrame(rows, DOCS).selectExpr("*", *extra)


def compare(spark, rows, height, claim=None, shown=lambda row: row, parts=5):
    docs = table(spark, rows, ("'x' AS hash", "1 AS tree", "2 AS pos", "'y' AS leaf", "0 AS root", "3 AS block")).repartition(parts)
    got = manifest.manifest(docs, height=height, claim=claim).collect()
    mine = [(r.doc_id, r.leaf, r.subroot, r.root, "".join(r.proof), r.folded_root, r.verified) for r in got]
    assert sorted(map(str, mine)) == sorted(map(str, brute(rows, shown)))
    assert all(manifest.fold(r.leaf, r.proof, r.place) == r.root for r in got)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_matches_brute_force(spark, height):
    rng = random.Random(height)
    sizes = {"hot": 131, "a": 1, "b": 3, "é": 9, "z": 10, "": 27, None: 28, "Z": 2}
    ids = rng.sample(range(10**6), sum(sizes.values()))
    rows = [
        (ids.pop(), rng.choice(["", "one\ntwo", "naïve\n\n", "plain", None]), rng.choice(["en", None]), s, rng.choice([1, None]))
        for s, n in sizes.items()
        for _ in range(n)
    ]
    without_breaks = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    compare(spark, rows, height, without_breaks, lambda r: (r[0], r[1] and r[1].replace("\n", ""), *r[2:]))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sizes_around_powers_of_three(spark, n):
    compare(spark, [(i, f"t{i}", "en", "s", 1) for i in range(n)], 1, parts=2)


def test_many_sources_of_one_row(spark):
    compare(spark, [(i, "x", None, f"s{i}", 1) for i in range(40)], 2)


def test_ties_repeats_nulls_and_a_very_long_text(spark):
    rows = [(5, "same", "en", "s", 4)] * 7 + [(5, "other", "en", "s", 5), (None, None, None, None, None), (None, "x", None, "s", 1)]
    rows += [(9, "long \n" * 200_000, "en", "t", 1_200_000), (10, "", "", "", 0)]
    compare(spark, rows, 1)


def test_a_changed_row_is_not_verified(spark):
    rows = [(i, f"line {i}\nend" if i % 3 else "line", "en", f"s{i % 4}", 1) for i in range(60)]
    got = manifest.manifest(table(spark, rows), claim={"text": F.replace("text", F.lit("\n"), F.lit(""))}).collect()
    assert {r.doc_id for r in got if r.verified} == {i for i in range(60) if i % 3 == 0}
    other = manifest.manifest(table(spark, rows[1:])).first()
    assert other.verified and other.root != got[0].root


def test_empty_table(spark):
    got = manifest.manifest(table(spark, []))
    assert got.collect() == [] and "verified" in got.columns
