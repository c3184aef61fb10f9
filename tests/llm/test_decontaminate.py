from __future__ import annotations

import hashlib
import random
import re

from helpers import documents

from staylens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items):
    ws = words(text)
    hit, found = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1) if n else ():
            if tuple(ws[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(ws), len(hit), len(found), digest, bool(hit)


ITEMS = [(i, " ".join(f"b{i}x{j}" for j in range(n))) for i, n in ((1, 25), (2, 10), (10, 12), (3, 4), (4, 1))]
ITEMS += [(11, ITEMS[1][1].upper() + "!"), (5, ""), (6, "..."), (7, None), (None, "b1x0 b1x1"), (8, "Éa  éb"), (2, ITEMS[1][1])]


def docs():
    rng = random.Random(0)
    rows = [(0, None), (1, ""), (2, ITEMS[0][1]), (3, "b4x0"), (4, "x " * 30_000 + ITEMS[2][1] + " y" * 10), (5, "Éa, éb"), (6, "éa éb")]
    for i in range(10, 40):
        parts = []
        for _ in range(4):
            ws = words(rng.choice([t for _, t in ITEMS if t]))
            a = rng.randrange(len(ws)) if ws else 0
            parts += ws[a : a + rng.randint(1, 14)] + ["free"] * rng.randint(0, 3)
        rows.append((i, ", ".join(parts).title()))
    return [*rows, rows[3], (None, ITEMS[1][1])]


def answers(spark, limit=decontaminate.BROADCAST_BYTES):
    benchmark = spark.createDataFrame(ITEMS, "item_id LONG, text STRING").selectExpr("*", "1 AS doc_id")
    df = documents(spark, docs(), "1 AS hits")
    rows = decontaminate.report(df, benchmark, limit=limit).collect()
    return sorted(str((r.doc_id, (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated))) for r in rows)


def test_report_matches_brute_force(spark):
    items = [(i, t) for i, t in ITEMS if i is not None]
    want = sorted(str((i, brute(t, items))) for i, t in docs())
    assert answers(spark) == want


def test_a_benchmark_in_parts_gives_the_same(spark):
    assert answers(spark, limit=120) == answers(spark)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    assert decontaminate.report(documents(spark, []), none).collect() == []
    rows = decontaminate.report(documents(spark, [(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(2, 0, False)]


def test_clean_cuts_spans_drops_and_leaves_the_rest(spark):
    passage = ITEMS[1][1]
    benchmark = spark.createDataFrame(ITEMS[:2], "item_id LONG, text STRING")
    filler = " ".join(f"w{i}" for i in range(30))
    df = documents(spark, [(1, f"{filler}. {passage.title()}! {filler}"), (2, passage), (3, filler), (4, None)], "1 AS keep")
    rows = {r.doc_id: r.text for r in decontaminate.clean(df, benchmark).collect()}
    assert rows == {1: f"{filler}. ! {filler}", 3: filler, 4: None}


def test_clean_unites_the_hits_of_all_parts(spark):
    # Overlapping windows, words that only a cut would join, and a share reached by both parts together.
    a = [f"a{i}" for i in range(14)]
    items = [(1, " ".join(a[:10])), (2, " ".join(a[4:])), (3, " ".join(f"c{i}" for i in range(10)))]
    c = items[2][1].split()
    benchmark = spark.createDataFrame(items, "item_id LONG, text STRING")
    filler = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, f"{filler} {' '.join(a)} end"),
        (2, f"{filler} {' '.join(c[:5])} {items[0][1]} {' '.join(c[5:])} end"),
        (3, f"{items[0][1]} x {items[2][1]} {' '.join(filler.split()[:12])}"),
        (4, None),
    ]
    df = documents(spark, rows, "1 AS keep")
    want = {r.doc_id: r.text for r in decontaminate.clean(df, benchmark).collect()}
    assert set(want) == {1, 2, 4} and want[1] == f"{filler}  end"
    parts = decontaminate.clean(df, benchmark, limit=30)
    assert parts.columns == df.columns
    assert {r.doc_id: r.text for r in parts.collect()} == want
